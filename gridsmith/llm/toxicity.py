"""Toxicity by classifier chains.

Categories are predicted one after the other by linear (logistic) models on word counts; the model
of a category also gets the log-odds of the categories before it.  In training these come from
out-of-fold predictions, so a later model sees earlier categories with the errors they make on new
documents.  The given labels yield the chain low_quality -> toxic -> severe (toxic and of low
quality); any ordered list of label expressions can be used.

Models are fitted on a bounded sample of labelled documents, ``sample`` of them by a hash of the id;
a word is a feature if at least ``min_docs`` of them hold it and, for each model, if its
shares of the two outcomes differ clearly (chosen anew from the documents of each fit).  All documents are scored whole, in
tasks, with the fitted weights (bounded by the sample) broadcast.

Defined results: a null or wordless text gets the models' intercepts; categories without both
outcomes in the sample have their smoothed share as probability; with no labels every probability is 0; repeated labels
of a document count as their largest values, null labels as none; repeated documents are each scored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridsmith.llm.common import CACHED_WORDS, plain_words

#: Categories in chain order and what they are in the label table.
CHAIN = (("low_quality", "1 - quality"), ("toxic", "toxic"), ("severe", "toxic * (1 - quality)"))


@dataclass(frozen=True)
class Params:
    sample: int = 6000
    min_docs: int = 4
    #: Counts of a word in a document over this count as this.
    max_count: int = 4
    #: Longest list of words kept of a document of the sample; longer ones are not sampled.
    max_words: int = 20_000
    folds: int = 3
    penalty: float = 0.2
    #: A word is a feature of a model if its shares of the two outcomes differ by so many standard errors.
    min_z: float = 4.0
    newton: int = 12
    #: Documents whose probability of ``toxic`` reaches this are rejected.
    reject_from: float = 0.5


def word_counts(data: bytes, known: dict[bytes, int]) -> dict[int, int]:
    """Counts by word hash."""
    out: dict[int, int] = {}
    for words in plain_words(data):
        for w in words:
            h = known.get(w)
            if h is None:
                if len(known) > CACHED_WORDS:
                    known.clear()
                known[w] = h = zlib.crc32(w)
            out[h] = out.get(h, 0) + 1
    return out


class Rows:
    """A sparse matrix of documents by features with dense columns behind."""

    def __init__(self, at: np.ndarray, col: np.ndarray, val: np.ndarray, n_cols: int):
        self.at, self.col, self.val, self.n, self.n_cols = at, col, val, len(at) - 1, n_cols
        self.row = np.repeat(np.arange(self.n), np.diff(at))

    def dot(self, w: np.ndarray, dense: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.val * w[self.col], self.n) + dense @ w[self.n_cols:]

    def back(self, g: np.ndarray, dense: np.ndarray) -> np.ndarray:
        return np.concatenate([np.bincount(self.col, self.val * g[self.row], self.n_cols), dense.T @ g])

    def some(self, rows: np.ndarray) -> "Rows":
        pick = np.isin(self.row, rows)
        sizes = np.diff(self.at)[rows]
        return Rows(np.concatenate([[0], np.cumsum(sizes)]), self.col[pick], self.val[pick], self.n_cols)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def telling(x: Rows, y: np.ndarray, p: Params) -> np.ndarray:
    """Which features are held by far more, or far fewer, documents of one outcome (a test of two shares)."""
    held, hits = np.bincount(x.col, minlength=x.n_cols), np.bincount(x.col, y[x.row], x.n_cols)
    n1, q = y.sum(), held / len(y)
    n0 = len(y) - n1
    spread = np.sqrt(np.maximum(q * (1 - q) * (1 / max(n1, 1) + 1 / max(n0, 1)), 1e-12))
    return np.abs(hits / max(n1, 1) - (held - hits) / max(n0, 1)) >= p.min_z * spread


def fit(x: Rows, dense: np.ndarray, y: np.ndarray, p: Params) -> np.ndarray:
    """Weights of the telling features (the others' are zero) and the dense columns."""
    keep = telling(x, y, p)
    pick = keep[x.col]
    sizes = np.bincount(x.row[pick], minlength=x.n)
    w = solve(Rows(np.concatenate([[0], np.cumsum(sizes)]), (np.cumsum(keep) - 1)[x.col[pick]], x.val[pick], int(keep.sum())), dense, y, p)
    out = np.zeros(x.n_cols + dense.shape[1])
    out[:x.n_cols][keep] = w[:int(keep.sum())]
    out[x.n_cols:] = w[int(keep.sum()):]
    return out


def solve(x: Rows, dense: np.ndarray, y: np.ndarray, p: Params) -> np.ndarray:
    """Logistic regression with a ridge penalty (not on the intercept, the first dense column): Newton steps by
    conjugate gradients."""
    w = np.zeros(x.n_cols + dense.shape[1])
    if y.min() == y.max():
        share = (y.sum() + 0.5) / (len(y) + 1)
        w[x.n_cols] = np.log(share / (1 - share))
        return w
    ridge = np.full(len(w), p.penalty)
    ridge[x.n_cols] = 1e-6
    for _ in range(p.newton):
        q = sigmoid(x.dot(w, dense))
        g = x.back(y - q, dense) - ridge * w
        h = np.maximum(q * (1 - q), 1e-6)
        step, r = np.zeros_like(w), g.copy()
        scale = 1 / (ridge + np.concatenate([np.bincount(x.col, x.val ** 2 * h[x.row], x.n_cols), (dense ** 2).T @ h]))
        z = scale * r
        d, rz = z.copy(), float(r @ z)
        for _ in range(20):
            if rz <= 0:
                break
            hd = x.back(h * x.dot(d, dense), dense) + ridge * d
            a = rz / float(d @ hd)
            step += a * d
            r -= a * hd
            z = scale * r
            new = float(r @ z)
            if new < 1e-6 * float(g @ (scale * g)):
                break
            d, rz = z + new / rz * d, new
        w += step
        if np.abs(step).max() < 1e-3:
            break
    return w


def folds_of(ids: list[int], p: Params) -> np.ndarray:
    return np.array([zlib.crc32(str(i).encode()) % p.folds for i in ids], dtype=np.int64)


def train(docs: DataFrame, labels: DataFrame, chain=CHAIN, p: Params = Params()) -> dict:
    """Fitted chain: ``features`` (sorted word hashes), ``words`` (features x categories), ``dense`` (per category the
    intercept and the weights of the categories before)."""
    names = [n for n, _ in chain]
    named = {x.lower() for _, e in chain for x in re.findall(r"\w+", e)}
    facts = [c for c in labels.columns if c.lower() in named]
    known = labels.where("doc_id is not null").groupBy("doc_id").agg(*[F.max(c).alias(c) for c in facts])
    known = known.select(F.col("doc_id").alias("__id"), *[F.expr(e).cast("double").alias(n) for n, e in chain])
    chosen = known.orderBy(F.xxhash64("__id"), "__id").limit(p.sample)
    # the sample has p.sample rows at most: broadcast, so that documents are not moved to find them
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("__id")).groupBy("doc_id").agg(
        F.min("text").alias("text"), *[F.max(n).alias(n) for n in names])

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        for b in batches:
            ids, hs, cs, keep = [], [], [], []
            for i, (doc_id, data) in enumerate(zip(b.column("doc_id").to_pylist(), b.column("text").cast(pa.binary()).to_pylist())):
                c = word_counts(data or b"", known)
                if len(c) <= p.max_words:
                    keep.append(i)
                    hs.append(list(c))
                    cs.append([min(v, p.max_count) for v in c.values()])
            part = b.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(hs, pa.list_(pa.int64())), pa.array(cs, pa.list_(pa.int32())),
                                              *[part.column(n) for n in names]], ["doc_id", "h", "c", *names])

    got = texts.mapInArrow(features, "doc_id long, h array<long>, c array<int>, " + ", ".join(f"`{n}` double" for n in names)).toArrow()
    got = got.sort_by("doc_id").combine_chunks()
    empty = {"names": names, "features": np.zeros(0, np.int64), "words": np.zeros((0, len(names))), "dense": None}
    if not got.num_rows:
        return empty
    column = lambda k: got.column(k).combine_chunks()
    sizes = np.array([len(x) for x in column("h")])
    h, c = column("h").flatten().to_numpy(), column("c").flatten().to_numpy().astype(float)
    values, inverse, held = np.unique(h, return_inverse=True, return_counts=True)
    used = held >= p.min_docs
    number = np.cumsum(used) - 1
    pick = used[inverse]
    row = np.repeat(np.arange(len(sizes)), sizes)[pick]
    x = Rows(np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(sizes)))]), number[inverse[pick]], c[pick], int(used.sum()))
    fold = folds_of(column("doc_id").to_pylist(), p)
    ones = np.ones((len(sizes), 1))
    before, words, dense = ones, [], []
    for n in names:
        y = column(n).to_numpy(zero_copy_only=False)
        have = ~np.isnan(y)
        odds = np.zeros(len(y))
        if not have.any():
            words.append(np.zeros(x.n_cols))
            dense.append(np.array([-35.0, *np.zeros(before.shape[1] - 1)]))
        else:
            full = fit(x.some(np.flatnonzero(have)), before[have], y[have], p)
            words.append(full[:x.n_cols])
            dense.append(full[x.n_cols:])
            for f in range(p.folds):
                learn, test = np.flatnonzero(have & (fold != f)), np.flatnonzero(fold == f)
                w = fit(x.some(learn), before[learn], y[learn], p) if len(learn) else full
                odds[test] = x.some(test).dot(w, before[test])
        before = np.column_stack([before, np.clip(odds, -8, 8)])
    return {"names": names, "features": values[used], "words": np.stack(words, axis=1), "dense": dense}


def chain_odds(base: np.ndarray, model: dict) -> list[float]:
    """Probabilities along the chain from the words' part of each category's log-odds."""
    before, out = [1.0], []
    for k in range(len(model["names"])):
        o = float(base[k] + np.dot(model["dense"][k], before))
        before.append(min(8.0, max(-8.0, o)))
        out.append(float(sigmoid(np.float64(o))))
    return out


def probabilities(batches: Iterator[pa.RecordBatch], model: dict, p: Params) -> Iterator[tuple[pa.RecordBatch, list[list[float]]]]:
    """Each batch with its documents' probabilities."""
    features, weights = model["features"], model["words"]
    number: dict[bytes, int] = {}

    class Known(dict):
        def __missing__(self, w: bytes) -> int:
            h = zlib.crc32(w)
            i = int(np.searchsorted(features, h))
            if len(self) > CACHED_WORDS:
                self.clear()
            self[w] = n = i if i < len(features) and features[i] == h else -1
            return n

    number = Known()
    for b in batches:
        out = []
        for data in b.column("text").cast(pa.binary()).to_pylist():
            if model["dense"] is None:
                out.append([0.0] * len(model["names"]))
                continue
            counts = np.zeros(len(features) + 1, dtype=np.int64) if data and len(data) > SPARSE else None
            base = np.zeros(len(model["names"]))
            parts = [np.fromiter(map(number.__getitem__, w), np.int64, len(w)) for w in plain_words(data or b"")] if counts is None else []
            if counts is not None:
                for w in plain_words(data):
                    counts += np.bincount(np.fromiter(map(number.__getitem__, w), np.int64, len(w)) + 1, minlength=len(features) + 1)
                at = np.flatnonzero(counts[1:])
                base = np.minimum(counts[1:][at], p.max_count) @ weights[at]
            else:
                at, n = np.unique(np.concatenate(parts), return_counts=True) if parts else (np.zeros(0, np.int64), np.zeros(0, np.int64))
                n, at = n[at >= 0], at[at >= 0]
                base = np.minimum(n, p.max_count) @ weights[at]
            out.append(chain_odds(base, model))
        yield b, out


#: Longer texts are counted slice by slice into a dense vector.
SPARSE = 1 << 20


def score(docs: DataFrame, model: dict, p: Params = Params()) -> DataFrame:
    """(doc_id, p_<category> ..., rejected) of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [f"p_{n}" for n in model["names"]]
    toxic = model["names"].index("toxic")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, rows in probabilities(batches, shared.value, p):
            cols = [pa.array(list(v), pa.float64()) for v in zip(*rows)] or [pa.array([], pa.float64())] * len(names)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *cols, pa.array([r[toxic] >= p.reject_from for r in rows], pa.bool_())],
                                             ["doc_id", *names, "rejected"])

    schema = docs.select("doc_id").schema
    for n in names:
        schema = schema.add(n, "double")
    return docs.select("doc_id", "text").mapInArrow(run, schema.add("rejected", "boolean"))


def keep_clean(docs: DataFrame, labels: DataFrame, p: Params = Params()) -> DataFrame:
    """The rows of docs, all columns, whose probability of toxic stays under reject_from."""
    model = train(docs, labels, CHAIN, p)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    toxic = model["names"].index("toxic")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, rows in probabilities(batches, shared.value, p):
            yield b.filter(pa.array([r[toxic] < p.reject_from for r in rows], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
