"""Removal of repeated passages by prefix-free parsing.

A byte goes if a string of ``length`` bytes covers it that also starts earlier (in a document of smaller doc_id, or
earlier in the same document); strings never cross documents and are judged on the input.

Parse: a rolling hash gives every ``trigger`` bytes a number; the smallest number in a window of ``length`` bytes (the
first, among equal ones) is that window's trigger.  Consecutive windows with the same trigger form a phrase; its
extended phrase reaches to the end of its last window, so it overlaps the next ones and holds whole windows.  Where
triggers lie depends on nothing but the bytes of the window, so equal windows have their triggers at equal places and
every window belongs to exactly one phrase, whatever stands around it.

Dictionary: equal extended phrases (trigger hash and 64 more bits) hold equal windows.  The parse is dealt by trigger,
and in the order of (trigger, phrase, place) all but the first of equal phrases are repeats as they stand, without a
look at their windows: that is what highly repetitive text consists of.  Of the distinct phrases only those can share
windows that have the same trigger; the rest are done.

Corpus order: phrases that share a trigger meet, and the suffix array of their bytes is built by doubling (8, 16, 32,
64 and then ``length`` bytes).  Suffixes of one rank are equal windows; in the order of (rank, place) all but the first
are repeats.  Only runs of repeated windows travel back to the documents.  There is no array of the whole corpus: the
order is needed only among windows that may be equal, and those have one trigger.

Skew: equal phrases of an Arrow batch leave it as one row that is dealt by trigger; the others are known repeats, which
leave it in runs (a copied document is one row) and are dealt by place.  A trigger with ``block`` or more distinct phrases is worked on in blocks; the first windows of each
class of a block then meet by digest (128 bits) in a window over few rows, so no task holds more than two blocks.

Defined results: null and empty texts have nothing to remove; rows without an id come first; rows of equal id stand in
the order of a hash of their text, and of equal rows the second and later ones repeat the first; texts under ``length``
bytes stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridsmith.llm.common import SLICE_BYTES, by_size, fresh, mix64
from gridsmith.session import cut_lineage

NO_ID = -2**63
PLACE = (1 << 24) - 1


@dataclass(frozen=True)
class Params:
    length: int = 100
    #: Bytes of a trigger.  Longer ones are shared by chance more rarely, but make more phrases.
    trigger: int = 40
    #: Most distinct phrases of one trigger whose suffixes are sorted together.
    block: int = 2_000
    #: About how many bytes of phrases are sorted together.
    sort_bytes: int = 2 << 20


# -- parse -------------------------------------------------------------------------------------------------------

def rolling(b: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit polynomial hash of every ``size`` bytes, put together from those of half the size."""
    if size == 1:
        return mix64(b, 1)
    half = size // 2
    part = rolling(b, half)
    base = np.uint64(pow(0x9E3779B97F4A7C15, half, 1 << 64))
    both = part[:len(part) - half] * base + part[half:]
    if size % 2:
        both = both[:-1] * np.uint64(0x9E3779B97F4A7C15) + mix64(b[size - 1:], 1)
    return both


def window_minima(x: np.ndarray, n: int) -> np.ndarray:
    """The minimum of every n consecutive entries."""
    low, have = x, 1
    while have < n:
        step = min(have, n - have)
        low = np.minimum(low[:len(low) - step], low[step:])
        have += step
    return low


def phrases(data: np.ndarray, ends: np.ndarray, p: Params) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, windows, trigger hash) of the phrases of texts that lie one behind the other in ``data``, up to
    ``ends`` (each at least ``length`` bytes long).  Windows that cross an end are in no phrase."""
    none = np.array([], dtype=np.int64)
    if len(data) < p.length:
        return none, none, none.astype(np.uint64)
    h = mix64(rolling(data, p.trigger), 2)
    seen = (h & np.uint64(2**64 - 1 - PLACE)) | np.arange(len(h), dtype=np.uint64)
    at = (window_minima(seen, p.length - p.trigger + 1) & np.uint64(PLACE)).astype(np.int64)
    late = np.zeros(len(data) + 1, dtype=np.int8)  # windows that start fewer than ``length`` bytes before an end
    late[ends - p.length + 1] += 1
    late[ends] -= 1
    whole = np.cumsum(late[:len(at)]) == 0
    new = np.diff(at, prepend=-1) != 0
    new[1:] |= whole[1:] != whole[:-1]
    first = np.flatnonzero(new)
    n = np.diff(np.append(first, len(at)))
    keep = whole[first]
    return first[keep], n[keep], h[at[first[keep]]]


def occurrences(docs: DataFrame, p: Params) -> DataFrame:
    """A row per phrase: its trigger and phrase hash, place (doc, tie, a) and number of windows n.  Phrases of which their batch
    holds an earlier equal one are ``known``: a row per run of such phrases that follow each other, with any hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in by_size(whole):
                docs_, ties = (b.column(k).to_numpy() for k in ("doc", "tie"))
                out: list[list[np.ndarray]] = []  # phrases of a text in the order of their places
                for rows, offsets, data in pieces(b.column("text"), p.length):
                    sizes, line = np.fromiter(map(len, data), np.int64, len(data)), b"".join(data)
                    ends = np.cumsum(sizes)
                    a, n, trigger = phrases(np.frombuffer(line, np.uint8), ends, p)
                    phrase = np.fromiter((xxhash.xxh3_64_intdigest(line[i:j]) for i, j in zip(a.tolist(), (a + n + p.length - 1).tolist())),
                                         np.uint64, len(a))
                    at = np.searchsorted(ends, a, "right")
                    out.append([trigger, phrase, rows[at], a + (offsets + sizes - ends)[at], n])
                if not out:
                    continue
                trigger, phrase, row, a, n = (np.concatenate(c) for c in zip(*out))
                doc, tie = docs_[row], ties[row]
                order = np.lexsort((a, tie, doc, phrase, trigger))
                known = np.zeros(len(order), dtype=bool)
                t, f = trigger[order], phrase[order]
                known[order[1:]] = (t[1:] == t[:-1]) & (f[1:] == f[:-1])
                goes_on = known[1:] & known[:-1] & (row[1:] == row[:-1]) & (a[1:] == a[:-1] + n[:-1])
                at = np.flatnonzero(np.append(True, ~goes_on)[:len(known)])
                if len(at):
                    n = np.add.reduceat(n, at)
                trigger, phrase, doc, tie, a, known = (c[at] for c in (trigger, phrase, doc, tie, a, known))
                trigger = np.where(known, mix64(a.astype(np.uint64), 3) ^ mix64(doc.view(np.uint64), 4), trigger)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(known), pa.array(trigger.view(np.int64)), pa.array(np.where(known, 0, phrase.view(np.int64))),
                     pa.array(doc), pa.array(tie), pa.array(a), pa.array(n.astype(np.int32))],
                    ["known", "trigger", "phrase", "doc", "tie", "a", "n"])
    return docs.select("doc", "tie", "text").mapInArrow(
        run, "known boolean, trigger long, phrase long, doc long, tie long, a long, n int")


def pieces(texts: pa.Array, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, list[bytes]]]:
    """(rows, offsets, bytes) of the texts of a batch, bounded: long texts come in slices that overlap by length - 1."""
    data = [t or b"" for t in texts.cast(pa.binary()).to_pylist()]
    short = [i for i, t in enumerate(data) if length <= len(t) <= SLICE_BYTES]
    if short:
        yield np.array(short), np.zeros(len(short), np.int64), [data[i] for i in short]
    for i, t in enumerate(data):
        if len(t) > SLICE_BYTES:
            for at in range(0, len(t) - length + 1, SLICE_BYTES):
                yield np.array([i]), np.array([at]), [t[at:at + SLICE_BYTES + length - 1]]


# -- dictionary --------------------------------------------------------------------------------------------------

def judged(rows: DataFrame, p: Params) -> DataFrame:
    """Of ``occurrences`` those that repeat an earlier one as a whole (block null) and those that are the first of their
    kind and share the trigger with other phrases (numbered in blocks).  The rest repeat nothing and are left out."""
    trigger = W.partitionBy("trigger")
    first = F.row_number().over(W.partitionBy("trigger", "phrase").orderBy("doc", "tie", "a")) == 1
    rows = rows.repartition("trigger").select(
        "*", first.alias("first"), F.dense_rank().over(trigger.orderBy("phrase")).alias("number"),
        (F.min("phrase").over(trigger) != F.max("phrase").over(trigger)).alias("shared"))
    open_ = F.col("first") & ~F.col("known")
    return rows.where(~open_ | F.col("shared")).select(
        F.when(open_, F.col("trigger")).alias("trigger"), "doc", "tie", "a", "n",
        F.when(open_, F.floor((F.col("number") - 1) / p.block).cast("int")).alias("block"))


def runs_of(c: str = "runs") -> Column:
    return F.collect_list(F.struct("a", "n", "trigger", "block")).alias(c)


def cut_out(keyed: DataFrame, asked: DataFrame, p: Params) -> DataFrame:
    """The bytes of the asked phrases: (trigger, block, doc, tie, a, n, bytes)."""
    lists = asked.groupBy("doc", "tie").agg(runs_of())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in by_size(whole):
                lists_ = b.column("runs")
                a, n, trigger, block = (lists_.flatten().field(i) for i in range(4))
                row = np.repeat(np.arange(b.num_rows), lists_.value_lengths().to_numpy())
                texts = b.column("text").cast(pa.binary()).to_pylist()
                data = [texts[r][i:i + m + p.length - 1] for r, i, m in zip(row.tolist(), a.to_pylist(), n.to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [trigger, block, b.column("doc").take(pa.array(row)), b.column("tie").take(pa.array(row)), a, n, pa.array(data, pa.binary())],
                    ["trigger", "block", "doc", "tie", "a", "n", "bytes"])

    return keyed.where("copy = 1").join(lists, ["doc", "tie"]).select(*KEYED, "runs").mapInArrow(
        run, "trigger long, block int, doc long, tie long, a long, n int, bytes binary")


# -- corpus order ------------------------------------------------------------------------------------------------

def suffix_ranks(data: bytes, at: np.ndarray, length: int) -> np.ndarray:
    """Ranks of the strings of ``length`` bytes at the places ``at``, in byte order; equal strings have equal ranks.
    Suffixes are sorted by their first 8 bytes and then by pairs of ranks, of twice the depth each time."""
    b = np.frombuffer(data + b"\0" * length, np.uint8)
    depth = min(8, length)
    key = np.zeros(len(data), dtype=np.uint64)
    for k in range(depth):
        key = (key << np.uint64(8)) | b[k:k + len(data)]
    rank = np.unique(key, return_inverse=True)[1]
    while depth < length:
        step = min(depth, length - depth)
        here = at if depth + step == length else np.arange(len(data))
        there = np.minimum(here + step, len(data) - 1)
        rank = np.unique(rank[here] * (len(data) + 1) + rank[there], return_inverse=True)[1]
        depth += step
    return rank if len(rank) == len(at) else rank[at]


def repeats(phrases_: DataFrame, p: Params) -> DataFrame:
    """(doc, tie, a, n): the windows of these phrases that are equal to earlier ones, in runs."""
    dealt = phrases_.repartition("trigger", "block").sortWithinPartitions("trigger", "block", "doc", "tie", "a")

    def solve(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        trigger, block, doc, tie, a, n = (rows.column(c).to_numpy() for c in ("trigger", "block", "doc", "tie", "a", "n"))
        data = rows.column("bytes").to_pylist()
        starts = np.cumsum(np.fromiter(map(len, data), np.int64, len(data))) - n - p.length + 1
        ends = np.cumsum(n.astype(np.int64))
        row = np.repeat(np.arange(len(n)), n)
        off = np.arange(ends[-1]) - (ends - n)[row]
        group = np.cumsum(np.append(True, (trigger[1:] != trigger[:-1]) | (block[1:] != block[:-1]))) - 1
        rank = suffix_ranks(b"".join(data), starts[row] + off, p.length) * (group[-1] + 1) + group[row]
        order = np.argsort(rank, kind="stable")  # places of a rank in corpus order, as the rows are
        head = np.append(True, rank[order][1:] != rank[order][:-1])
        again = np.zeros(len(rank), dtype=bool)
        again[order[~head]] = True
        new = again & np.append(True, ~again[:-1] | (row[1:] != row[:-1]))
        at = np.flatnonzero(new)
        count = np.bincount(np.cumsum(new)[again] - 1, minlength=len(at))
        yield out(doc[row[at]], tie[row[at]], a[row[at]] + off[at], count, [None] * len(at))
        full = (np.bincount(group) >= p.block)[group] | (block > 0)
        left = np.flatnonzero(~again & full[row])
        if len(left):
            digest = [xxhash.xxh3_128_digest(data[r][i:i + p.length]) for r, i in zip(row[left].tolist(), off[left].tolist())]
            yield out(doc[row[left]], tie[row[left]], a[row[left]] + off[left], np.ones(len(left)), digest)

    def out(doc, tie, a, n, digest) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(tie, pa.int64()), pa.array(a, pa.int64()),
                                           pa.array(n.astype(np.int64)), pa.array(digest, pa.binary())], ["doc", "tie", "a", "n", "digest"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Whole groups, some at a time."""
        held: list[pa.RecordBatch] = []
        for b in batches:
            held.append(b)
            if sum(h.nbytes for h in held) >= p.sort_bytes:
                rows = pa.Table.from_batches(held)
                t, k = rows.column("trigger").to_numpy(), rows.column("block").to_numpy()
                edge = np.flatnonzero((t[1:] != t[:-1]) | (k[1:] != k[:-1]))
                if len(edge):
                    yield from solve(rows.slice(0, edge[-1] + 1))
                    held = rows.slice(edge[-1] + 1).combine_chunks().to_batches()
        if held:
            yield from solve(pa.Table.from_batches(held))

    rows = dealt.mapInArrow(run, "doc long, tie long, a long, n long, digest binary")
    # Blocks of one trigger meet by digest; rows of solved windows have none and are dealt by place.
    key = F.coalesce("digest", F.encode(F.concat_ws(",", "doc", "a"), "utf-8"))
    rank = F.row_number().over(W.partitionBy("key").orderBy("doc", "tie", "a"))
    rows = rows.withColumn("key", key).withColumn("rank", rank)
    return rows.where(F.col("digest").isNull() | (F.col("rank") > 1)).select("doc", "tie", "a", "n")


# -- documents ---------------------------------------------------------------------------------------------------

KEYED = ["doc_id", "doc", "tie", "copy", "text"]


def spans_of(runs: list[tuple[int, int]], length: int) -> list[tuple[int, int]]:
    """Maximal stretches covered by the windows of the runs (first window, number of windows)."""
    spans: list[list[int]] = []
    for a, n in sorted(runs):
        if spans and a <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], a + n - 1 + length)
        else:
            spans.append([a, a + n - 1 + length])
    return spans


def remove_repeats(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """(doc_id, n_bytes, spans array<struct<start, end>>, kept binary), a row per row of docs (doc_id, text): the removed
    stretches in bytes of UTF-8 and what is left."""
    if not 8 <= p.trigger <= p.length:
        raise ValueError("a trigger has 8 bytes or more and fits into the length")
    keyed = docs.select("doc_id", F.coalesce("doc_id", F.lit(NO_ID)).cast("long").alias("doc"), F.xxhash64("text").alias("tie"), "text")
    found = cut_lineage(judged(occurrences(keyed, p), p))
    copies = W.partitionBy("doc", "tie").orderBy(F.col("doc_id").isNull())
    # Dealt before the window: a limit on ``copy`` stays behind the exchange then, and both uses of the texts share it.
    keyed = keyed.repartition("doc", "tie").withColumn("copy", F.row_number().over(copies)).select(*KEYED)
    windows = repeats(cut_out(keyed, found.where("block is not null"), p), p)
    gone = found.where("block is null").select("doc", "tie", "a", F.col("n").cast("long")).union(windows)
    lists = gone.groupBy("doc", "tie").agg(F.collect_list(F.struct("a", "n")).alias("runs"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in by_size(whole):
                texts = [t or b"" for t in b.column("text").cast(pa.binary()).to_pylist()]
                spans, kept = [], []
                runs = b.column("runs")
                flat = list(zip(*(runs.flatten().field(i).to_pylist() for i in (0, 1))))
                ends = np.cumsum(runs.value_lengths().fill_null(0).to_numpy()).tolist()
                for t, copy, a, e in zip(texts, b.column("copy").to_pylist(), [0, *ends], ends):
                    one = spans_of(flat[a:e], p.length) if copy == 1 else [(0, len(t))] if len(t) >= p.length else []
                    at = [0, *(x for s in one for x in s), len(t)]
                    spans.append([{"start": s, "end": x} for s, x in one])
                    kept.append(b"".join(t[i:j] for i, j in zip(at[::2], at[1::2])))
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").cast(pa.int64()), pa.array(map(len, texts), pa.int64()), pa.array(spans, SPANS), pa.array(kept, pa.binary())],
                    ["doc_id", "n_bytes", "spans", "kept"])

    return keyed.join(lists, ["doc", "tie"], "left").select(*KEYED, "runs").mapInArrow(
        run, "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
