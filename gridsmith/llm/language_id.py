"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased, everything but letters becomes a single space, and the 1-,
2- and 3-grams of code points are hashed into ``dim`` buckets.  Counts by language
are summed over *all* learning documents in Spark (each task adds up its own
documents and hands on one sparse vector per language).  The matrix of log
probabilities, languages x dim, is the only thing that reaches the driver and is
broadcast; its size is bounded by ``max_langs`` and checked.  Scoring multiplies
each document's sparse count vector by the matrix in numpy.

Defined results: a text that is null or has no letter is ``und`` with score 0, as is
every text if nothing was learned; of languages with equal score the first in order
wins; repeated documents count as often as they occur; documents without lang or text
are not learned from.  Long texts are counted slice by slice.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridsmith.llm.common import slices

UNKNOWN = "und"
#: Code points below this have a table of letters; those from it on are asked for one by one.
TABLE = 0x10000


@dataclass(frozen=True)
class Params:
    dim: int = 1 << 15
    orders: tuple[int, ...] = (1, 2, 3)
    smoothing: float = 0.5
    #: At most so many languages; dim * max_langs doubles are what the driver may hold.
    max_langs: int = 200


def letter_table() -> np.ndarray:
    """Code point -> itself if a letter, else a space."""
    return np.fromiter((c if chr(c).isalpha() else 32 for c in range(TABLE)), np.uint32, TABLE)


def letters(a: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Code points with a space for each that is no letter."""
    if not len(a) or a.max() < TABLE:
        return table[a]
    high, at = np.unique(a[a >= TABLE], return_inverse=True)
    out = table[np.minimum(a, TABLE - 1)]
    out[a >= TABLE] = np.array([c if chr(c).isalpha() else 32 for c in high.tolist()], dtype=np.uint32)[at]
    return out


def ngram_counts(data: bytes, p: Params, table: np.ndarray) -> np.ndarray | None:
    """Counts of the hashed n-grams of a text, or None if it has no letter."""
    total, any_letter = np.zeros(p.dim, dtype=np.int64), False
    tail = np.array([32], dtype=np.uint32)  # the last code points of the slice before
    for piece in slices(data):
        a = np.frombuffer(piece.decode().lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
        a = letters(a, table)
        any_letter |= bool((a != 32).any())
        space, before = a == 32, np.concatenate([tail[-1:] == 32, a[:-1] == 32])
        a = np.concatenate([tail, a[~(space & before)]])
        for k in p.orders:  # n-grams that end in this slice
            x = a[max(0, len(tail) - k + 1):]
            if len(x) >= k:
                h = x * np.uint32(0x9E3779B1)
                for i in range(1, k):
                    h = (h[:-1] ^ (h[:-1] >> np.uint32(15))) * np.uint32(0x85EBCA77) + x[i:] * np.uint32(0x9E3779B1)
                h = (h ^ np.uint32(k)) * np.uint32(0xC2B2AE3D)
                total += np.bincount((h >> np.uint32(15)) % np.uint32(p.dim), minlength=p.dim)
        tail = a[-max(1, max(p.orders) - 1):]
    return total if any_letter else None


def train(docs: DataFrame, p: Params = Params()) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages in order, log priors and log probabilities (dim x languages) from (text, lang)."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, sums, n = letter_table(), {}, {}

        def out() -> Iterator[pa.RecordBatch]:
            for lang, v in sums.items():
                at = np.flatnonzero(v)
                yield pa.RecordBatch.from_pydict({"lang": [lang] * (len(at) + 1), "at": np.append(at, -1).astype(np.int32),
                                                  "n": np.append(v[at], n[lang])})
            sums.clear()
            n.clear()

        for batch in batches:
            for lang, data in zip(batch.column("lang").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()):
                if (v := ngram_counts(data, p, table)) is not None:
                    n[lang] = n.get(lang, 0) + 1
                    sums[lang] = sums[lang] + v if lang in sums else v
                    if len(sums) > 64:
                        yield from out()
        yield from out()

    counts = (docs.where("lang is not null and text is not null").select("lang", "text")
              .mapInArrow(count, "lang string, at int, n long").groupBy("lang", "at").agg(F.sum("n").alias("n")))
    counts = counts.persist()
    try:
        langs = [r["lang"] for r in counts.where("at = -1").select("lang").orderBy("lang").limit(p.max_langs + 1).collect()]
        if len(langs) > p.max_langs:
            raise ValueError(f"more than {p.max_langs} languages; raise max_langs if the driver can hold them")
        got = counts.toArrow()
    finally:
        counts.unpersist()
    column = {x: i for i, x in enumerate(langs)}
    m, n = np.full((p.dim, len(langs)), p.smoothing), np.zeros(len(langs))
    lang = got.column("lang").combine_chunks().dictionary_encode() if got.num_rows else None
    if lang is not None:
        j = np.array([column[x] for x in lang.dictionary.to_pylist()])[lang.indices.to_numpy()]
        at, k = got.column("at").to_numpy(), got.column("n").to_numpy()
        n[j[at < 0]] = k[at < 0]
        m[at[at >= 0], j[at >= 0]] += k[at >= 0]
    return langs, np.log(n / max(1, n.sum())), np.log(m / m.sum(axis=0))


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray, np.ndarray], p: Params = Params(), *keep: str) -> DataFrame:
    """``keep`` columns of docs with lang_pred and score (the posterior probability); only text is looked at."""
    langs, prior, logp = model
    shared = docs.sparkSession.sparkContext.broadcast((langs, prior, logp))
    schema = docs.select(*keep).schema.add("lang_pred", "string").add("score", "double")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, (langs, prior, logp) = letter_table(), shared.value
        for batch in batches:
            names, scores = [], []
            for data in batch.column("text").cast(pa.binary()).to_pylist():
                v = ngram_counts(data, p, table) if data and langs else None
                if v is None:
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                at = np.flatnonzero(v)
                s = prior + v[at] @ logp[at]
                best = int(s.argmax())
                names.append(langs[best])
                scores.append(float(1 / np.exp(np.maximum(s - s[best], -700)).sum()))
            yield pa.RecordBatch.from_arrays([batch.column(k) for k in keep] + [pa.array(names, pa.string()),
                                             pa.array(scores, pa.float64())], [*keep, "lang_pred", "score"])

    return docs.select(*keep, "text").mapInArrow(score, schema)
