"""SimHash near-duplicates with pigeonring candidate filtering.

A fingerprint has 64 bits: bit b is set if it is set in over half of the XXH64
hashes (seed 42) of the document's word shingles.  Fingerprints link at
``max_bits`` or fewer differing bits; documents are grouped into the connected
components of these links.

Search (exact, no candidate is dropped): the bits are cut into m = max_bits + 1
segments on a ring.  If two fingerprints differ in at most max_bits bits, some
segment i starts a chain whose cumulative differences stay within the proportional
budgets floor(l * max_bits / m) for l = 1 .. m (the pigeonring principle).  The first
budget is zero, so distinct fingerprints are dealt by (i, value of segment i); in a
group the second segment is matched by its one-bit neighbourhood on sorted keys, then
pairs must pass the budgets of longer chains and at last the full Hamming check.

Skew: equal fingerprints are one row before anything else.  A segment value with more
than ``block`` distinct fingerprints is dealt by the value of the next segment as well, to
the own value and to those with one bit more (the second budget is one), so what is shuffled
stays in proportion to the input.  A pair of values that is still larger is split into
blocks that meet pairwise in separate tasks, so a task never holds more than two blocks;
within a task pairs come in bounded runs and only a spanning forest of the links is handed on, never all pairs.
Joins by fingerprint or component deal the few keys with many rows to several tasks.
Components are then found by alternating large-star and small-star steps over the
forests, with a reliable checkpoint per round.

Defined results: a null, empty or all-space text has fingerprint zero and links like
any other; repeated rows and equal texts share a component; rows with a null doc_id
take part, and component_id is the smallest non-null doc_id reachable (null if none).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridsmith.llm.common import fresh, join_hot, slices
from gridsmith.session import cut_lineage

BITS = 64


@dataclass(frozen=True)
class Params:
    shingle: int = 4
    max_bits: int = 4
    #: Most distinct fingerprints of one segment value that meet in one task; larger groups are dealt by two segments,
    #: and what is larger still is split into blocks.
    block: int = 20_000
    #: Most candidate pairs held at a time.
    pairs: int = 2_000_000
    #: Most keys of groups in blocks that are broadcast (20 bytes each).
    broadcast_keys: int = 1 << 20
    max_rounds: int = 60


def fingerprint(data: bytes, shingle: int) -> int:
    """SimHash of a text; words are runs of anything but space and \\x09-\\x0D, A-Z lower-cased."""
    ones, n, carry = np.zeros(BITS, dtype=np.int64), 0, []
    hashes = lambda at: [xxhash.xxh64_intdigest(x, 42) for x in at]
    for piece in slices(data.lower()):
        words = carry + piece.split()
        if len(words) >= shingle:
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
            line, last = b" ".join(words), (ends[shingle - 1:] - 1).tolist()
            first = [0, *ends[:len(words) - shingle].tolist()]
            h = np.array(hashes(line[a:b] for a, b in zip(first, last)), dtype="<u8")
            ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
            n += len(h)
            carry = words[len(words) - shingle + 1:] if shingle > 1 else []
        else:
            carry = words
    if not n and carry:
        return hashes([b" ".join(carry)])[0]
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0]) if n else 0


def with_fingerprint(docs: DataFrame, p: Params = Params(), name: str = "fp") -> DataFrame:
    """All columns of docs and the fingerprint as a (signed) long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(x, p.shingle) if x else 0 for x in b.column("text").cast(pa.binary()).to_pylist()],
                           dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(fps)], [*b.schema.names, name])
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())]))


def as_hex(c: Column) -> Column:
    return F.lpad(F.lower(F.hex(c)), 16, "0")


# -- links -------------------------------------------------------------------------------------------------------

def segments(p: Params) -> list[tuple[int, int]]:
    """(shift, width) of the m segments, in ring order."""
    m = p.max_bits + 1
    ends = [round(BITS * i / m) for i in range(m + 1)]
    return [(a, b - a) for a, b in zip(ends, ends[1:])]


def chained_pairs(fp: np.ndarray, group: np.ndarray, i: int, p: Params) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (u, v) of rows in the same group (equal in segment i) whose chain from i stays within all
    budgets and that differ in at most max_bits bits, in bounded runs."""
    ring = segments(p)
    m = len(ring)
    part = lambda x, k: (x >> np.uint64(ring[k % m][0])) & np.uint64((1 << ring[k % m][1]) - 1)
    budget = [length * p.max_bits // m for length in range(1, m + 1)]
    width = ring[(i + 1) % m][1]
    flips = [0] + ([1 << b for b in range(width)] if m > 1 and budget[1] else [])
    key = (group.astype(np.uint64) << np.uint64(width)) | part(fp, i + 1)
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    for flip in flips:
        want = key ^ np.uint64(flip)
        lo, hi = np.searchsorted(ranked, want, "left"), np.searchsorted(ranked, want, "right")
        n = hi - lo
        ends = np.cumsum(n)
        a = 0
        while a < len(fp):
            done = ends[a - 1] if a else 0
            b = max(a + 1, int(np.searchsorted(ends, done + p.pairs, "right")))
            for c in range(0, int(n[a]) if b == a + 1 else 1, p.pairs):  # one row alone may have more than a run
                left = np.repeat(np.arange(a, b), n[a:b]) if b > a + 1 else np.full(min(p.pairs, int(n[a]) - c), a)
                at = np.arange(len(left)) - np.repeat(ends[a:b] - n[a:b] - done, n[a:b]) if b > a + 1 else np.arange(c, c + len(left))
                right = order[lo[left] + at]
                keep = left < right
                left, right = left[keep], right[keep]
                x = fp[left] ^ fp[right]
                total = np.bitwise_count(part(x, i + 1)).astype(np.int64)
                for length in range(3, m + 1):
                    total = total + np.bitwise_count(part(x, i + length - 1))
                    ok = total <= budget[length - 1]
                    left, right, x, total = left[ok], right[ok], x[ok], total[ok]
                near = np.bitwise_count(x) <= p.max_bits
                yield left[near], right[near]
            a = b


def merge(label: np.ndarray, u: np.ndarray, v: np.ndarray) -> None:
    """Unite the classes of u and v in ``label`` (each class is named by its smallest row)."""
    while True:
        a, b = label[u], label[v]
        open_ = a != b
        if not open_.any():
            return
        u, v, a, b = u[open_], v[open_], a[open_], b[open_]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while (up := label[label]).tobytes() != label.tobytes():
            label[:] = up


def links(fps: DataFrame, p: Params = Params()) -> DataFrame:
    """A spanning forest (u, v) of the links between the distinct fingerprints ``fp`` of ``fps``."""
    ring = segments(p)
    if len(ring) == 1:  # no bit may differ
        return fps.select(F.col("fp").alias("u"), F.col("fp").alias("v")).where("false")
    cut = lambda k: F.shiftrightunsigned("fp", ring[k % len(ring)][0]).bitwiseAND(F.lit((1 << ring[k % len(ring)][1]) - 1))
    key = ["i", "seg", "next"]
    rows = fps.select("fp", F.posexplode(F.array(*map(cut, range(len(ring))))).alias("i", "seg")).withColumn("next", F.lit(-1).cast("long"))
    # The keys number at most (max_bits + 1) * 2^width, whatever the input.
    wide = rows.groupBy("i", "seg").agg(F.count("*").alias("n")).where(F.col("n") > p.block).select("i", "seg")
    if not wide.isEmpty():
        # Large values are dealt by the next segment as well, where a chain has at most one differing bit: to the own value
        # and to those with one bit more.
        own, width = F.array(*map(cut, range(1, len(ring) + 1)))[F.col("i")], F.array(*[F.lit(w) for _, w in ring[1:] + ring[:1]])[F.col("i")]
        more = F.transform(F.sequence(F.lit(0), width - 1), lambda k: own.bitwiseOR(F.pow(F.lit(2), k).cast("long")))
        visits = F.array_distinct(F.concat(F.array(own), more)) if 2 * p.max_bits // len(ring) else F.array(own)
        far = rows.drop("next").join(F.broadcast(wide), ["i", "seg"], "left_semi").select("fp", "i", "seg", F.explode(visits).alias("next"))
        rows = rows.join(F.broadcast(wide), ["i", "seg"], "left_anti").select("fp", *key).union(far.select("fp", *key))
        # What is still too large is cut into blocks that meet pairwise.
        many = (far.groupBy(*key).agg(F.count("*").alias("n")).where(F.col("n") > p.block)
                .select(*key, F.ceil(F.col("n") / p.block).cast("int").alias("blocks")))
        many = cut_lineage(many)
        few = many.limit(p.broadcast_keys + 1).count() <= p.broadcast_keys
        rows = rows.join(F.broadcast(many) if few else many, key, "left")
    else:
        rows = rows.withColumn("blocks", F.lit(None).cast("int"))
    mine = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    both = lambda a, b: F.struct(a.alias("a"), b.alias("b"))
    pair = F.when(F.col("blocks").isNull(), F.array(both(F.lit(0), F.lit(0)))).otherwise(
        F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: both(F.least(mine, k), F.greatest(mine, k))))
    key += ["a", "b"]
    dealt = rows.select("i", "seg", "next", "fp", F.explode(pair).alias("x")).select("i", "seg", "next", "fp", "x.a", "x.b")
    dealt = dealt.repartition(*key).sortWithinPartitions(*key)

    def forest(fp: np.ndarray, group: np.ndarray, i: int) -> pa.RecordBatch:
        label = np.arange(len(fp))
        for u, v in chained_pairs(fp, group, i, p):
            merge(label, u, v)
        at = np.flatnonzero(label != np.arange(len(fp)))
        return pa.RecordBatch.from_arrays([pa.array(fp[at].view(np.int64)), pa.array(fp[label[at]].view(np.int64))], ["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Whole groups together, several of the same i at a time."""
        held: list[np.ndarray] = []

        def ready(rest: bool) -> Iterator[pa.RecordBatch]:
            x = np.concatenate(held, axis=1)
            new = np.concatenate([[True], (x[:5, 1:] != x[:5, :-1]).any(axis=0)])
            end = x.shape[1] if rest else int(np.flatnonzero(new)[-1])  # the last group may go on
            held[:] = [x[:, end:]]
            number = np.cumsum(new)
            for i in np.unique(x[0, :end]):
                at = np.flatnonzero(x[0, :end] == i)
                yield forest(x[5, at].view(np.uint64), number[at], int(i))

        for b in batches:
            held.append(np.stack([b.column(k).cast(pa.int64()).to_numpy() for k in (*key, "fp")]))
            if sum(h.shape[1] for h in held) >= 2 * p.block:
                yield from ready(False)
        if held:
            yield from ready(True)

    return dealt.mapInArrow(run, "u long, v long")


# -- components --------------------------------------------------------------------------------------------------

def components(edges: DataFrame, p: Params = Params()) -> DataFrame:
    """(node, root) for the nodes of ``edges`` (u, v): root is the smallest node of the component.  Large-star and
    small-star steps on a table of edges that is checkpointed each round; smallest neighbours are partial
    aggregates, so no task collects the neighbours of a hub."""
    def hook(e: DataFrame, both: bool) -> DataFrame:
        # e: u > v.  large-star: each node's larger neighbours go to its smallest (itself included); small-star:
        # its smaller neighbours and itself do.
        near = e.union(e.select(F.col("v"), F.col("u"))).toDF("x", "y") if both else e.toDF("x", "y")
        low = near.groupBy("x").agg(F.min("y").alias("m")).withColumn("m", F.least("x", "m"))
        j = near.join(low, "x")
        if both:
            out = j.where("y > x").select(F.col("y").alias("u"), F.col("m").alias("v"))
        else:
            out = j.where("y <> m").select(F.col("y").alias("u"), F.col("m").alias("v")).union(low.select("x", "m"))
        return out.where("u <> v").distinct()

    e = cut_lineage(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = None
    for _ in range(p.max_rounds):
        e = cut_lineage(hook(hook(e, True), False))
        now = tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {p.max_rounds} rounds")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        e.select("v", "v").distinct())


def fingerprint_groups(rows: DataFrame, p: Params = Params()) -> DataFrame:
    """(fp, component_id, root) for rows (doc_id, fp): the smallest doc_id of each fingerprint's component, and a
    fingerprint that names the component (ids may repeat, so that two components have the same smallest one)."""
    # ranks doc_id by component; equal fingerprints are one row after a partial aggregate
    fps = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    comp = components(links(fps.select("fp"), p), p)
    known = fps.join(comp.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    known = cut_lineage(known)
    low = known.groupBy("root").agg(F.min("least").alias("component_id"))
    return join_hot(known.select("fp", "root"), low, "root").select("fp", "component_id", "root")


def near_duplicates(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """(doc_id, fp, component_id), a row per row of docs (doc_id, text)."""
    rows = cut_lineage(with_fingerprint(docs.select("doc_id", "text"), p).select("doc_id", "fp"))
    groups = cut_lineage(fingerprint_groups(rows, p))
    return join_hot(rows, groups, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """The rows of docs that stay: of each component the row with the smallest doc_id (null last), then fingerprint;
    of its repetitions one.  All columns are kept.  Texts are hashed once; only where several rows have a doc_id, or
    none, are theirs hashed again, to tell them apart."""
    fp, d, f = (fresh(docs, c) for c in ("fp", "d", "f"))
    rows = cut_lineage(with_fingerprint(docs.select("doc_id", "text"), p).select("doc_id", "fp"))
    groups = cut_lineage(fingerprint_groups(rows, p))
    first = join_hot(rows.distinct(), groups, "fp").groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no"), F.col("doc_id").alias("d"), F.col("fp").alias("f"))).alias("x"))
    first = first.select(F.col("x.d").alias(d), F.col("x.f").alias(f))
    times = rows.groupBy(F.col("doc_id").alias(d)).agg(F.count("*").alias("n"))
    alone = F.col("n").eqNullSafe(1) & F.col(d).isNotNull()
    first = cut_lineage(first.join(times.where(alone), d, "left"))
    single = docs.join(first.where(F.col("n") == 1).select(d), docs["doc_id"] == F.col(d), "left_semi")
    again = times.where(~alone).select(d)
    marked = with_fingerprint(docs.join(again, docs["doc_id"].eqNullSafe(again[d]), "left_semi"), p, fp)
    left = first.where("n is null")
    marked = marked.join(left, marked["doc_id"].eqNullSafe(left[d]) & (marked[fp] == left[f]), "left_semi")
    return single.union(marked.dropDuplicates([fp, "doc_id"]).drop(fp))
