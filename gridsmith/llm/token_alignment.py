"""Alignment of two tokenizers' tokens through sparse token-byte incidence matrices.

A text with a space before it is encoded by A (byte-level BPE) and by B (sentencepiece).  Each side's tokens give a matrix
in CSR form, tokens by bytes.  Gustavson's row product A B^T has an entry for every pair of tokens that overlap: the
number of bytes they share.  The same product of the matrices that keep only each token's last byte links the tokens that
end together.  Those ends cut the text into groups; tokens by groups are incidence matrices again, and their product links
all tokens that share a group.

Texts are cut at spaces behind anything but white space, where neither side joins bytes, into units of a word with its
space.  A cut is an end on both sides, so a text's links and groups are those of its units, and the matrices are built
once for each different unit of a worker.  (If a vocabulary of B has pieces that cross such a cut, texts stay whole.)

Texts are encoded once: their links and groups are written to the shared folder, the links are counted by Spark over the
corpus, and the counts are looked up for the written links.  The table of counted pairs grows with the vocabularies, not
the texts; it is broadcast only up to ``broadcast_pairs`` rows, else the documents' pairs are joined to it.

Defined results: null and empty texts, and texts whose tokens' bytes are not the text's (as B normalizes some), have no
tokens: zeros and empty groups.  Every row gives one row; ids may be null or repeat.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridsmith.llm.common import SLICE_BYTES, by_size, per_worker
from gridsmith.session import cut_lineage, shared_dir


@dataclass(frozen=True)
class Params:
    #: Most rows of the table of pairs that are broadcast (17 bytes each).
    broadcast_pairs: int = 1 << 21
    #: Most different units, and characters of them, that a worker remembers, from task to task.
    units: int = 200_000
    chars: int = 4 << 20


# -- sparse matrices ---------------------------------------------------------------------------------------------

@dataclass
class Csr:
    """Rows of column numbers and values: row i has entries indptr[i] to indptr[i + 1]."""
    indptr: np.ndarray
    indices: np.ndarray
    data: np.ndarray
    columns: int

    @classmethod
    def runs(cls, sizes: np.ndarray) -> Csr:
        """Row i covers the next sizes[i] columns."""
        ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        return cls(ends, np.arange(ends[-1]), np.ones(ends[-1], dtype=np.int64), int(ends[-1]))

    @classmethod
    def single(cls, columns: np.ndarray, n: int) -> Csr:
        """Row i has one entry, in columns[i]."""
        return cls(np.arange(len(columns) + 1), columns, np.ones(len(columns), dtype=np.int64), n)

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.indptr) - 1), np.diff(self.indptr))

    def transpose(self) -> Csr:
        order = np.argsort(self.indices, kind="stable")
        ends = np.concatenate([[0], np.cumsum(np.bincount(self.indices, minlength=self.columns))])
        return Csr(ends, self.rows()[order], self.data[order], len(self.indptr) - 1)

    def last(self) -> Csr:
        """Only the last entry of each row (rows are not empty)."""
        at = self.indptr[1:] - 1
        return Csr(np.arange(len(self.indptr)), self.indices[at], self.data[at], self.columns)

    def __matmul__(self, other: Csr) -> Csr:
        """Gustavson's product: row i is the sum of the rows of ``other`` that row i's entries name."""
        sizes = np.diff(other.indptr)[self.indices]
        ends = np.cumsum(sizes)
        take = np.arange(ends[-1] if len(ends) else 0) + np.repeat(other.indptr[self.indices] - ends + sizes, sizes)
        row, column, value = np.repeat(self.rows(), sizes), other.indices[take], np.repeat(self.data, sizes) * other.data[take]
        order = np.lexsort((column, row))
        row, column, value = row[order], column[order], value[order]
        new = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (column[1:] != column[:-1]))) if len(row) else row
        value = np.add.reduceat(value, new) if len(row) else value
        n = len(self.indptr) - 1
        return Csr(np.concatenate([[0], np.cumsum(np.bincount(row[new], minlength=n))]), column[new], value, other.columns)


@dataclass
class Alignment:
    """Links of the tokens of one stretch of bytes, given the tokens' sizes on either side."""
    a: Csr
    b: Csr

    @classmethod
    def of(cls, a_sizes: np.ndarray, b_sizes: np.ndarray) -> Alignment:
        return cls(Csr.runs(a_sizes), Csr.runs(b_sizes))

    def overlaps(self) -> Csr:
        return self.a @ self.b.transpose()

    def ends(self) -> Csr:
        return self.a.last() @ self.b.last().transpose()

    def groups(self) -> tuple[Csr, Csr]:
        """Tokens by groups, on either side."""
        cuts = np.intersect1d(self.a.last().indices, self.b.last().indices, assume_unique=True)
        return tuple(Csr.single(np.searchsorted(cuts, x.last().indices), len(cuts)) for x in (self.a, self.b))

    def shared_groups(self) -> Csr:
        a, b = self.groups()
        return a @ b.transpose()


# -- tokens ------------------------------------------------------------------------------------------------------

def byte_signs() -> dict[str, int]:
    """The byte that each sign of a byte-level vocabulary stands for: visible Latin-1 signs themselves, the others in
    order from U+0100 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Encoders:
    """Both tokenizers, and the bytes of each of their ids."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        signs = byte_signs()
        names = {i: t for t, i in self.a.get_vocab().items()}
        self.a_bytes = [bytes(signs[c] for c in t) if all(c in signs for c in t) else t.encode()
                        for t in (names.get(i, "") for i in range(max(names) + 1))]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(x[3:5], 16)]) if self.b.is_byte(i) else x.replace("▁", " ").encode() for i, x in enumerate(pieces)]
        self.a_size, self.b_size = (np.array([len(x) for x in s], dtype=np.int64) for s in (self.a_bytes, self.b_bytes))
        self.space = self.b.piece_to_id("▁")
        # Ids in decimal with what follows them: A's, where the group goes on and where it ends, then B's.
        self.signs = [[f"{i}{c}" for i in range(len(s))] for s, c in
                      ((self.a_bytes, ","), (self.a_bytes, "|"), (self.b_bytes, ","), (self.b_bytes, ";"))]
        self.may_cut = not any("▁" in x.lstrip("▁") for x in pieces)

    def encode(self, unit: str) -> tuple[list[int], list[int]] | None:
        """Ids of a space and the unit; None if their bytes differ from it."""
        data = b" " + unit.encode()
        a = self.a.encode(" " + unit, add_special_tokens=False).ids
        b = self.b.encode(unit) if unit else [self.space]
        ok = b"".join([self.a_bytes[i] for i in a]) == data == b"".join([self.b_bytes[i] for i in b])
        return (a, b) if ok else None


WHITE_BEFORE_SPACE = re.compile(r"\s ")
CUT = re.compile(r"(?<=\S) ")


def units_of(text: str) -> list[str]:
    """The units of a text that has a space before it, each without its first space."""
    if text[:1] != " " and not WHITE_BEFORE_SPACE.search(text):
        return text.split(" ")
    first, *rest = CUT.split(" " + text)
    return [first[1:], *rest]


class Units(dict):
    """Number of each different unit, and by number: tokens, groups, links (pairs a * size of B + b) and groups as text.
    Number 0 is a unit that cannot be aligned."""

    def __init__(self, encoders: Encoders, p: Params):
        self.encoders, self.p = encoders, p
        self.reset()

    def reset(self) -> None:
        self.clear()
        self.new: list[str] = []
        self.chars, self.bad = 0, set()
        self.text, self.parts = [""], [[np.zeros(1, dtype=np.int64)] * 3]
        self.link_parts: list[np.ndarray] = []
        self.n_a = self.n_b = self.n_links = np.zeros(1, dtype=np.int64)
        self.links = np.array([], dtype=np.int64)
        self.start = np.zeros(1, dtype=np.int64)

    def full(self) -> bool:
        return len(self) > self.p.units or self.chars > self.p.chars

    def __missing__(self, unit: str) -> int:
        self[unit] = n = len(self) + 1
        self.new.append(unit)
        self.chars += len(unit)
        return n

    def learn(self) -> None:
        """Encode the new units and align them, many at a time in one pair of matrices."""
        e, at = self.encoders, 0
        while at < len(self.new):
            run, size = [], 0
            while at < len(self.new) and (not run or size + len(self.new[at]) < 1 << 15):
                run.append(self.new[at])
                size += len(self.new[at])
                at += 1
            self.add(self.encoded(run), e)
        if self.new:
            self.new = []
            self.n_a, self.n_b, self.n_links = (np.concatenate(c) for c in zip(*self.parts))
            self.parts = [[self.n_a, self.n_b, self.n_links]]
            self.links = np.concatenate(self.link_parts) if self.link_parts else self.links
            self.link_parts = [self.links]
            self.start = np.cumsum(self.n_links) - self.n_links

    def encoded(self, run: list[str]) -> list[tuple[list[int], list[int]] | None]:
        """Both sides' ids of each unit: A takes the run as one text, as it joins nothing across cuts."""
        e = self.encoders
        data = [b" " + u.encode() for u in run]
        whole = b"".join(data)
        line = e.a.encode_batch_fast([whole.decode()], add_special_tokens=False)[0].ids
        if b"".join([e.a_bytes[i] for i in line]) != whole:
            return [e.encode(u) for u in run]
        ends = np.cumsum(np.fromiter(map(len, data), np.int64, len(data)))
        cut = np.searchsorted(np.cumsum(e.a_size[line]), ends, "left") + 1
        b = e.b.encode(run, num_threads=1)
        b = [ids if u else [e.space] for u, ids in zip(run, b)]
        a = [line[i:j] for i, j in zip([0, *cut.tolist()], cut.tolist())]
        sizes = np.cumsum(e.b_size[np.fromiter(chain.from_iterable(b), np.int64)])[np.cumsum([len(x) for x in b]) - 1]
        if (sizes == ends).all() and b"".join([e.b_bytes[i] for i in chain.from_iterable(b)]) == whole:
            return list(zip(a, b))
        return [(x, y) if b"".join([e.b_bytes[i] for i in y]) == d else None for x, y, d in zip(a, b, data)]

    def add(self, ids: list[tuple[list[int], list[int]] | None], e: Encoders) -> None:
        self.bad.update(len(self.text) + i for i, x in enumerate(ids) if x is None)
        good = [x or ([], []) for x in ids]
        n_a, n_b = (np.array([len(x[k]) for x in good], dtype=np.int64) for k in (0, 1))
        a, b = (np.array([i for x in good for i in x[k]], dtype=np.int64) for k in (0, 1))
        if not len(a):
            self.parts.append([n_a, n_b, n_a])
            self.text += [""] * len(ids)
            return
        both = Alignment.of(e.a_size[a], e.b_size[b])
        ends = both.ends()
        pairs = a[ends.rows()] * len(e.b_size) + b[ends.indices]
        unit = np.repeat(np.arange(len(ids)), n_a)
        n_links = np.bincount(unit[ends.rows()], minlength=len(ids))
        # In order of the groups, each one's A tokens before its B tokens; the last one of a side says so.
        ga, gb = (g.indices for g in both.groups())
        order = np.argsort(np.concatenate([2 * ga, 2 * gb + 1]), kind="stable")
        final = [np.append(g[1:] != g[:-1], True) for g in (ga, gb)]
        kind = np.concatenate([final[0].astype(int), 2 + final[1].astype(int)])[order].tolist()
        signs = [e.signs[k][i] for k, i in zip(kind, np.concatenate([a, b])[order].tolist())]
        at = np.cumsum(n_a + n_b).tolist()
        self.text += ["".join(signs[i:j])[:-1] for i, j in zip([0, *at], at)]
        self.parts.append([n_a, n_b, n_links])
        self.link_parts.append(pairs)

    def numbers(self, text: str) -> np.ndarray:
        """Numbers of the units of a text; empty if it has no tokens."""
        if not text:
            return np.array([], dtype=np.int64)
        units = units_of(text) if self.encoders.may_cut else [text]
        return np.fromiter(map(self.__getitem__, units), np.int64, len(units))

    def of_batch(self, texts: list[str | None]) -> list[np.ndarray]:
        if self.full():
            self.reset()
        out = [self.numbers(t) for t in texts]
        self.learn()
        if self.bad:
            bad = np.array(sorted(self.bad))
            out = [n[:0] if np.isin(n, bad).any() else n for n in out]
        return out

    def of_units(self, values: np.ndarray, numbers: list[np.ndarray]) -> np.ndarray:
        """Sum of the units' values, by text."""
        flat = np.concatenate([*numbers, np.array([], dtype=np.int64)])
        ends = np.cumsum(np.fromiter(map(len, numbers), np.int64, len(numbers)))
        sums = np.concatenate([[0], np.cumsum(values[flat])])
        return np.diff(sums[ends], prepend=0)


# -- documents ---------------------------------------------------------------------------------------------------

def units_in_task(a_path: str, b_path: str, p: Params) -> Units:
    encoders = per_worker(("align", a_path, b_path), lambda: Encoders(a_path, b_path))
    return per_worker(("units", a_path, b_path, p), lambda: Units(encoders, p))


def aligned(docs: DataFrame, a_path: str, b_path: str, p: Params = Params()) -> DataFrame:
    """A row per row of docs (doc_id, text): tokens, groups, links (pairs a * size of B + b, in order) and groups as text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = units_in_task(a_path, b_path, p)
        for whole in batches:
            for b in by_size(whole, "text", SLICE_BYTES):
                numbers = units.of_batch(b.column("text").to_pylist())
                n_a, n_b, n_links = (units.of_units(x, numbers) for x in (units.n_a, units.n_b, units.n_links))
                flat = np.concatenate([*numbers, np.array([], dtype=np.int64)])
                size = units.n_links[flat]
                at = np.arange(size.sum()) + np.repeat(units.start[flat] - np.cumsum(size) + size, size)
                links = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n_links)]), pa.int32()), pa.array(units.links[at]))
                groups = [";".join(map(units.text.__getitem__, n.tolist())) for n in numbers]
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), *map(pa.array, (n_a, n_b, n_links, n_links)), links,
                                                  pa.array(groups, pa.string())], [x.split()[0] for x in ALIGNED.split(", ")])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, ALIGNED)


ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, links array<long>, groups string"


def pair_counts(rows: DataFrame, b_size: int) -> DataFrame:
    """(pair, n, best): how many links of all rows have this pair of ids, and whether that is the most for its B id."""
    counts = rows.select(F.explode("links").alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))
    return counts.withColumn("best", F.col("n") == F.max("n").over(W.partitionBy(F.col("pair") % b_size)))


def align(docs: DataFrame, a_path: str, b_path: str, p: Params = Params()) -> DataFrame:
    """A row per row of docs (doc_id, text): tokens of either side, groups, links that end together, how many of these
    have the most frequent A id of their B id, the sum of their corpus counts, and the groups as text (A ids, a bar and
    B ids, groups apart by semicolons).  ``a_path``, ``b_path``: files that every executor has."""
    spark = docs.sparkSession
    path = shared_dir(spark, "aligned")
    aligned(docs, a_path, b_path, p).withColumn("row", F.monotonically_increasing_id()).write.option(
        "parquet.block.size", 32 << 20).parquet(path)  # a task holds a row group
    rows = spark.read.parquet(path)
    b_size = len(per_worker(("align", a_path, b_path), lambda: Encoders(a_path, b_path)).b_size)
    counts = cut_lineage(pair_counts(rows, b_size))
    if counts.limit(p.broadcast_pairs + 1).count() <= p.broadcast_pairs:
        table = counts.toArrow().sort_by("pair")
        table = spark.sparkContext.broadcast(tuple(table.column(c).to_numpy() for c in ("pair", "n", "best")))

        @F.arrow_udf("struct<n_best:long,count_sum:long>")
        def look_up(links: pa.Array) -> pa.Array:
            pair, n, best = table.value
            ends = np.cumsum(links.value_lengths().to_numpy())
            at = np.searchsorted(pair, links.flatten().to_numpy())
            sums = [np.concatenate([[0], np.cumsum(x[at])])[ends] for x in (best, n)]
            return pa.StructArray.from_arrays([pa.array(np.diff(x, prepend=0)) for x in sums], ["n_best", "count_sum"])

        rows = rows.withColumn("sums", look_up("links"))
    else:
        best = F.sum(F.when(F.col("best"), F.col("k")).otherwise(0))
        sums = rows.select("row", F.explode("links").alias("pair")).groupBy("row", "pair").agg(F.count("*").alias("k")).join(
            counts, "pair").groupBy("row").agg(F.struct(best.alias("n_best"), F.sum(F.col("k") * F.col("n")).alias("count_sum")).alias("sums"))
        rows = rows.join(sums, "row", "left")
    found = [F.coalesce(F.col("sums")[c], F.lit(0)).alias(c) for c in ("n_best", "count_sum")]
    return rows.select("doc_id", "n_a", "n_b", "n_groups", "n_links", *found, "groups")


def link_rows(docs: DataFrame, a_path: str, b_path: str, kind: str = "overlap") -> DataFrame:
    """All links of docs (doc_id, text), a row each: (doc_id, a, b, a_id, b_id, weight) with the tokens' places in the
    text.  ``kind``: overlap (weight: shared bytes), end, or group (weight 1)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = per_worker(("align", a_path, b_path), lambda: Encoders(a_path, b_path))
        for b in batches:
            for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                ids = [e.encode(u) for u in (units_of(text) if e.may_cut else [text])] if text else [None]
                if None in ids:
                    continue
                a, c = (np.array([i for x in ids for i in x[k]], dtype=np.int64) for k in (0, 1))
                both = Alignment.of(e.a_size[a], e.b_size[c])
                links = {"overlap": both.overlaps, "end": both.ends, "group": both.shared_groups}[kind]()
                at = links.rows()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([doc] * len(at), pa.int64()), *map(pa.array, (at, links.indices, a[at], c[links.indices], links.data))],
                    ["doc_id", "a", "b", "a_id", "b_id", "weight"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, a long, b long, a_id long, b_id long, weight long")
