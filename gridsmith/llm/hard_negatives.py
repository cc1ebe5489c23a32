"""Hard negatives by exact integer scores from Kronecker-packed products.

Rows are (vec_id, label, vec) with integer components.  A score is the inner product of a row and an anchor.  In a task a
block of anchors meets a block of rows: the rows' components are biased to be at least zero, and the components of
``fields`` rows are laid into separated fields of one wide integer, wide enough for the largest sum.  One multiplication
of that integer by an anchor's component multiplies all of its rows; the sums over the components are unpacked field by
field, and the bias is taken off by the sums of either side, so scores are exact.  Wide integers of up to 53 bits are held
as doubles, which are exact there, so that the products of a block are one matrix product; wider ones are Python's.

Plan: anchors and rows are dealt to a grid of blocks (anchor block, row block) of bounded size, whose cells are groups of
a cogroup.  A cell returns an anchor's best rows of the block only, and a window over these few takes the best of all.
A first pass finds the positives, a second one the negatives between their bounds.  The work is anchors times rows, as it
must be for exact results; rows travel once for every ``anchor_block`` anchors, anchors once for every ``row_block`` rows.
Blocks are dealt by a hash of the row, so labels and equal vectors skew nothing.

Defined results: rows with a null id, label or vector, an empty vector, a null or non-finite component or one beyond
+-2^24 take no part; shorter vectors count as filled up with zeros; rows of equal id are rows of their own (an anchor that
stands there twice is mined twice); of equal scores the smaller vec_id comes first.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridsmith.session import cut_lineage

LARGEST = 1 << 24


@dataclass(frozen=True)
class Params:
    positives: int = 5
    negatives: int = 10
    #: A negative's score lies between these percentages of the positive's.
    low: int = 30
    high: int = 90
    anchor_block: int = 8_192
    row_block: int = 32_768
    #: Scores held at a time.
    scores: int = 1 << 21


def scaled(vec: str, scale: float) -> Column:
    """Components as integers, floor(scale * x); null for vectors that take no part."""
    ok = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) <= F.lit(LARGEST / scale))
    doubles = F.transform(vec, lambda x: x.cast("double"))
    return F.when((F.size(vec) > 0) & F.forall(doubles, ok), F.transform(doubles, lambda x: F.floor(x * F.lit(float(scale))).cast("int")))


# -- packed products ---------------------------------------------------------------------------------------------

class Packed:
    """Rows' components in fields of wide integers.  ``matrix`` has a wide integer per component and ``fields`` rows."""

    def __init__(self, rows: np.ndarray, anchors: np.ndarray):
        self.n, self.d = rows.shape
        self.row_low, self.anchor_low = int(rows.min(initial=0)), int(anchors.min(initial=0))
        biased = rows - self.row_low
        largest = self.d * int(biased.max(initial=0)) * (int(anchors.max(initial=0)) - self.anchor_low)
        self.width = max(1, largest.bit_length())
        self.fields = max(1, 53 // self.width)
        self.wide = self.width > 53
        if self.wide:  # a Python integer has room for many rows
            self.fields = 64
        pad = -self.n % self.fields
        by_field = np.concatenate([biased, np.zeros((pad, self.d), dtype=biased.dtype)]).reshape(-1, self.fields, self.d)
        held = by_field.astype(object) if self.wide else by_field.astype(np.int64)
        self.matrix = sum(held[:, f] << (self.width * f) for f in range(self.fields)).T
        if not self.wide:
            self.matrix = self.matrix.astype(np.float64)
        self.row_sums = rows.sum(axis=1)

    def scores(self, anchors: np.ndarray) -> np.ndarray:
        """Inner products (anchors x rows) as int64: each packed component is multiplied once per anchor."""
        biased = anchors - self.anchor_low
        wide = biased.astype(object if self.wide else np.float64) @ self.matrix
        if not self.wide:
            wide = wide.astype(np.int64)
        field = (1 << self.width) - 1
        sums = np.stack([(wide >> (self.width * f)) & field for f in range(self.fields)], axis=2)
        sums = sums.reshape(len(anchors), -1)[:, :self.n].astype(np.int64)
        # sum (a + A)(c + C) = sum a c + C sum a + A sum (c + C)
        return sums + self.row_low * biased.sum(axis=1)[:, None] + self.anchor_low * self.row_sums[None, :]


def best(score: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """Of ``rows`` (ascending by id) the first k by falling score, then id."""
    s = score[rows]
    if len(s) > k:
        near = np.flatnonzero(s >= np.partition(s, len(s) - k)[len(s) - k])
        rows, s = rows[near], s[near]
    return rows[np.argsort(-s, kind="stable")[:k]]


# -- grid --------------------------------------------------------------------------------------------------------

def matrix_of(column: pa.ChunkedArray, d: int) -> np.ndarray:
    lists = column.combine_chunks()
    sizes = lists.value_lengths().to_numpy()
    out = np.zeros((len(sizes), d), dtype=np.int64)
    out[np.arange(d)[None, :] < sizes[:, None]] = lists.flatten().to_numpy()
    return out


def on_grid(anchors: DataFrame, rows: DataFrame, counts: tuple[int, int], cell, schema: str, p: Params) -> DataFrame:
    """Apply ``cell`` to every (anchor block, row block): anchors and rows as tables, rows ascending by vec_id."""
    n_rows = max(1, -(-counts[1] // p.row_block), min(rows.sparkSession.sparkContext.defaultParallelism, counts[1] // 1024))
    n_anchors = max(1, -(-counts[0] // p.anchor_block))
    part = lambda n: F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = anchors.withColumn("i", part(n_anchors)).withColumn("j", every(n_rows))
    right = rows.withColumn("j", part(n_rows)).withColumn("i", every(n_anchors))
    cells = min(n_anchors * n_rows, 100_000)
    left, right = (x.repartition(cells, "i", "j") for x in (left, right))

    def run(a: pa.Table, r: pa.Table) -> pa.Table:
        names = [x.rsplit(" ", 1)[0] for x in schema.split(", ")]
        kinds = [pa.int64()] * len(names)
        if not a.num_rows or not r.num_rows:
            return pa.table([pa.array([], t) for t in kinds], names)
        out = list(cell(a, r.sort_by([("vec_id", "ascending"), ("row", "ascending")])))
        return pa.table([pa.array(np.concatenate([x[c] for x in out]) if out else [], t) for c, t in enumerate(kinds)], names)

    return left.groupBy("i", "j").cogroup(right.groupBy("i", "j")).applyInArrow(run, schema)


def tiles(a: pa.Table, r: pa.Table, p: Params) -> Iterator[tuple[int, np.ndarray]]:
    """(row of a, scores of all rows of r), by tiles of a bounded number of scores."""
    d = max(int(np.max(t.column("vec").combine_chunks().value_lengths().to_numpy())) for t in (a, r))
    anchors, rows = matrix_of(a.column("vec"), d), matrix_of(r.column("vec"), d)
    packed = Packed(rows, anchors)
    step = max(1, p.scores // len(rows))
    for at in range(0, len(anchors), step):
        yield from enumerate(packed.scores(anchors[at:at + step]), at)


def mine(rows: DataFrame, is_anchor: Column, p: Params = Params()) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for rows (vec_id, label, vec) with an
    integer array vec.  Positives: the first ``positives`` other rows of the anchor's label.  Negatives of each: the first
    ``negatives`` rows of other labels whose score lies between ``low`` and ``high`` percent of the positive's."""
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vec").isNotNull()).select(
        F.col("vec_id").cast("long"), F.col("label").cast("long"), "vec", F.monotonically_increasing_id().alias("row"),
        F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"))
    rows = cut_lineage(rows)
    counts = tuple(rows.agg(F.coalesce(F.sum(F.col("is_anchor").cast("long")), F.lit(0)), F.count("*")).first())
    anchors, rows = rows.where("is_anchor").drop("is_anchor"), rows.drop("is_anchor")

    def positives(a: pa.Table, r: pa.Table) -> Iterator[tuple[np.ndarray, ...]]:
        ids, names, labels = (r.column(c).to_numpy() for c in ("row", "vec_id", "label"))
        of_label = {x: np.flatnonzero(labels == x) for x in np.unique(labels).tolist()}
        a_row, a_label = a.column("row").to_pylist(), a.column("label").to_pylist()
        for i, score in tiles(a, r, p):
            same = of_label.get(a_label[i])
            if same is None:
                continue
            at = best(score, same[ids[same] != a_row[i]], p.positives)
            yield np.full(len(at), a_row[i]), names[at], ids[at], score[at]

    found = on_grid(anchors, rows, counts, positives, "anchor long, positive_id long, positive long, positive_score long", p)
    order = W.partitionBy("anchor").orderBy(F.desc("positive_score"), "positive_id", "positive")
    found = found.withColumn("k", F.row_number().over(order)).where(F.col("k") <= p.positives)
    found = found.groupBy(F.col("anchor").alias("row")).agg(F.sort_array(F.collect_list(
        F.struct("k", "positive_id", "positive_score"))).alias("positives"))
    asked = cut_lineage(anchors.join(found, "row"))

    def negatives(a: pa.Table, r: pa.Table) -> Iterator[tuple[np.ndarray, ...]]:
        names, labels, ids = (r.column(c).to_numpy() for c in ("vec_id", "label", "row"))
        others = {x: np.flatnonzero(labels != x) for x in np.unique(a.column("label").to_numpy()).tolist()}
        a_row, a_label, a_id, wanted = (a.column(c).to_pylist() for c in ("row", "label", "vec_id", "positives"))
        for i, score in tiles(a, r, p):
            other = others[a_label[i]]
            mine_ = score[other]
            for w in wanted[i]:
                s = w["positive_score"]
                lo, hi = -(-s * p.low // 100), s * p.high // 100
                at = best(score, other[(mine_ >= lo) & (mine_ <= hi)], p.negatives)
                one = np.ones(len(at), dtype=np.int64)
                yield one * a_row[i], one * a_id[i], one * w["k"], one * w["positive_id"], one * s, names[at], ids[at], score[at]

    found = on_grid(asked, rows, counts, negatives, "anchor long, anchor_id long, k long, positive_id long, positive_score long, "
                    "negative_id long, negative long, negative_score long", p)
    order = W.partitionBy("anchor", "k").orderBy(F.desc("negative_score"), "negative_id", "negative")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= p.negatives).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
