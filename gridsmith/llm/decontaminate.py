"""Benchmark decontamination: CGK embeddings, bit-sampling LSH, exact edit verification.

Texts and benchmark items are sequences of words (runs of a-z, 0-9 and non-ASCII
characters, A-Z lower-cased).  The CGK random walk maps a sequence to another one: at
step j it writes the symbol under its pointer and moves on by r_j(symbol), a random
bit; few edits in the input become few differing places in the output with good
probability, as walks that got out of step fall back into step.

Items are classed by length: ``c`` is the largest power of two that is at most an item's
length.  Every window of c words of every document is embedded by a walk of c steps, and so
is every window of an item (an item longer than c has several, and walks from its last
words count as long as they stay in it), so an item is sampled all over.  A repetition
has its own walk and samples ``samples`` of its c places, the first always; where a document's
window agrees with one of an item in all of them, the stretch of the document that the item
would fill is a candidate.  ``repetitions`` follows from the target recall and a measured hit
rate.  A verbatim passage agrees in every repetition, as a walk of c steps
cannot leave an item's first window.  Windows whose first sampled symbols no item of the class
has are not walked to the end.

Candidates collapse to regions of a document and an item, in bounded runs, and are checked exactly: the
smallest number of word edits between the item and any stretch of the region, by dynamic
programming; at most ``max_edits`` of the item's words may be edited (similarity 0.8 or
more).  Further places of the item are looked for on both sides of the best one.

The benchmark is a stated query set: it goes to the tasks in blocks of ``block`` items or
``block_words`` words, one pass over the documents each, so what is broadcast is bounded but
for single long items.  Nothing is shuffled.

Defined results: null or wordless texts and items match nothing; equal items are each reported; an item that occurs several
times in a document gives one row with the number of places; repeated documents are each
reported; an empty benchmark matches nothing.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from gridsmith.llm.common import CACHED_WORDS, by_size, mix64, plain_words
from gridsmith.session import cut_lineage

PAD = 0
CHUNK = 1 << 16
#: Most pairs of a window and an item that are held at once.
RUN = 1 << 18
#: Items under so many words are sought with a higher target.
SHORT = 16
FOUND = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("n_spans", pa.int32()), ("edits", pa.int32()),
                   ("similarity", pa.float64()), ("first_word", pa.int64()), ("last_word", pa.int64())])


@dataclass(frozen=True)
class Params:
    max_edits: float = 0.2
    samples: int = 3
    target_recall: float = 0.95
    #: Target for items under ``SHORT`` words, which take few steps.
    short_recall: float = 0.9999
    #: Chance that one repetition finds an item at the edit limit: a little under the lowest measured over items of 5 to
    #: 250 words and over edits anywhere, at one end and evenly spread (0.86, at 16 words with even edits).
    hit_rate: float = 0.8
    #: Items, and words of items, per pass over the documents.
    block: int = 20_000
    block_words: int = 1_000_000

    def repetitions(self, words: int) -> int:
        if int(self.max_edits * words) == 0:  # only verbatim copies count, and these agree in every repetition
            return 1
        target = self.short_recall if words < SHORT else self.target_recall
        return math.ceil(math.log(1 - target) / math.log(1 - self.hit_rate))


class Symbols(dict):
    """Word -> symbol (never PAD), remembered for a task."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > CACHED_WORDS:
            self.clear()
        self[word] = s = zlib.crc32(word) or 1
        return s


def symbols(data: bytes, known: Symbols) -> np.ndarray:
    parts = [np.fromiter(map(known.__getitem__, w), np.uint32, len(w)) for w in plain_words(data) if w]
    return np.concatenate(parts) if parts else np.zeros(0, np.uint32)


def window_words(words: int) -> int:
    """Words of an item's windows: its class."""
    return 1 << words.bit_length() - 1


def places(rep: int, c: int, samples: int) -> list[int]:
    """Sampled steps of a walk of c steps in a repetition: the first, and others anywhere."""
    return [0, *sorted(int(i) + 1 for i in np.random.default_rng([rep, c]).choice(c - 1, min(samples, c) - 1, replace=False))]


class Walks:
    """CGK walks over one stretch of symbols; the random bits of its words are made once a repetition and 64 steps."""

    def __init__(self, x: np.ndarray):
        self.x, self.bits = x, {}

    def moves(self, rep: int, step: int) -> np.ndarray:
        if (rep, step // 64) not in self.bits:
            self.bits[rep, step // 64] = mix64(self.x, 1000 * rep + 1 + step // 64)
        return self.bits[rep, step // 64]

    def walk(self, start: np.ndarray, rep: int, at: list[int], seen: list[np.ndarray] | None = None) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
        """The walks from the words ``start``: where they began, their keys at each sampled place and where they are at the
        last.  With ``seen`` (marks by low bits of a key, for each place) only walks whose keys are marked go on, and the
        last keys alone are kept."""
        p, key, step, keys = start, np.zeros(len(start), np.uint64), 0, []
        for k, place in enumerate(at):
            while step < place:
                p = p + (self.moves(rep, step)[p] >> np.uint64(step % 64) & np.uint64(1)).astype(np.int64)
                step += 1
            key = mix64(key ^ self.x[p], 1000 * rep + k)
            if seen is not None:
                go = np.flatnonzero(seen[k][(key & np.uint64(len(seen[k]) - 1)).astype(np.int64)])
                start, key, p, keys = start[go], key[go], p[go], []
            keys.append(key)
        return start, keys, p


def marks(keys: np.ndarray) -> np.ndarray:
    """Marks of keys by their low bits."""
    seen = np.zeros(1 << max(12, (8 * len(keys)).bit_length()), dtype=bool)
    seen[(keys & np.uint64(len(seen) - 1)).astype(np.int64)] = True
    return seen


@dataclass(frozen=True)
class Table:
    """Keys of a class of items that one repetition looks for: ascending, each with an item and the first and last of its
    words from which a walk has this key; marks of the keys at each sampled place."""
    rep: int
    at: list[int]
    keys: np.ndarray
    items: np.ndarray
    first: np.ndarray
    last: np.ndarray
    seen: list[np.ndarray]

    @staticmethod
    def of(rep: int, at: list[int], items: list[tuple[int, np.ndarray]]) -> Table:
        """items: (number, symbols) rows."""
        sizes = np.array([len(s) for _, s in items])
        begin = np.cumsum(sizes) - sizes
        x = np.concatenate([*(s for _, s in items), np.zeros(at[-1] + 1, np.uint32)])
        start, keys, end = Walks(x).walk(np.arange(int(sizes.sum())), rep, at)
        which = np.repeat(np.arange(len(items)), sizes)
        inside = end < (begin + sizes)[which]  # a walk that leaves its item says nothing of it
        word, which, keys = (start - begin[which])[inside], which[inside], [k[inside] for k in keys]
        order = np.lexsort((word, which, keys[-1]))
        word, which, key = word[order], which[order], keys[-1][order]
        new = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (which[1:] != which[:-1])]))
        last = np.concatenate([new[1:], [len(key)]]) - 1
        return Table(rep, at, key[new], np.array([n for n, _ in items], np.int64)[which[new]], word[new], word[last],
                     [marks(k) for k in keys])


def merged(rows: np.ndarray) -> np.ndarray:
    """(document, item number, from, to) rows with overlapping stretches of a document and an item made one, in order."""
    if len(rows) < 2:
        return rows
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    other = np.concatenate([[True], (rows[1:, :2] != rows[:-1, :2]).any(axis=1)])
    shift = np.cumsum(other) * (rows[:, 3].max() + 1)  # so that stretches of different pairs lie apart
    reach = np.maximum.accumulate(rows[:, 3] + shift)
    new = np.flatnonzero(np.concatenate([[True], rows[1:, 2] + shift[1:] > reach[:-1]]))
    out = rows[new].copy()
    out[:, 3] = (reach - shift)[np.concatenate([new[1:], [len(rows)]]) - 1]
    return out


class Index:
    """Keys of the items of a block, by class and repetition."""

    def __init__(self, items: list[tuple[int, np.ndarray]], p: Params):
        self.items, self.p = items, p
        self.sizes = np.array([len(s) for _, s in items], dtype=np.int64)
        self.limits = (p.max_edits * self.sizes).astype(np.int64)
        # Words that at most one item in fifty holds, by their lowest bits, and how many each item must keep of its own.
        words, held = np.unique(np.concatenate([np.unique(s) for _, s in items]), return_counts=True)
        rare = words[held <= max(1, len(items) // 50)]
        self.rare = np.zeros(1 << 22, dtype=bool)
        self.rare[rare & np.uint32(len(self.rare) - 1)] = True
        self.needed = np.array([np.isin(s, rare).sum() for _, s in items], dtype=np.int64) - self.limits
        classes: dict[tuple[int, int], list[tuple[int, np.ndarray]]] = {}
        for n, (_, s) in enumerate(items):
            for rep in range(p.repetitions(len(s))):
                classes.setdefault((window_words(len(s)), rep), []).append((n, s))
        self.tables = [Table.of(rep, places(rep, c, p.samples), those) for (c, rep), those in sorted(classes.items(), key=lambda x: x[0])]
        self.steps = max((t.at[-1] for t in self.tables), default=0)

    def candidates(self, x: np.ndarray, a: int, n: int, starts: np.ndarray, words: np.ndarray) -> np.ndarray:
        """(document, item number, from, to) regions of the documents for the walks that start in x[a:a + n]; starts: of
        the documents in x; words: how many rare words of items lie before each word of x.  A candidate whose region has
        fewer of them than its item has beyond the edit limit is left out at once."""
        out = np.zeros((0, 4), np.int64)
        walks = Walks(x[a:a + n + self.steps + 1])
        for t in self.tables:
            start, keys, _ = walks.walk(np.arange(n), t.rep, t.at, t.seen)
            lo, hi = np.searchsorted(t.keys, keys[-1], "left"), np.searchsorted(t.keys, keys[-1], "right")
            ends = np.cumsum(hi - lo)
            i = 0
            while i < len(start):
                j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + RUN, "right")))
                many = hi[i:j] - lo[i:j]
                which = np.repeat(lo[i:j], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                word, item = np.repeat(start[i:j] + a, many), t.items[which]
                doc = np.searchsorted(starts, word, "right") - 1
                size, limit = self.sizes[item], self.limits[item]
                lower = np.maximum(word - t.last[which] - limit, starts[doc])
                upper = np.minimum(word - t.first[which] + size + limit, starts[doc + 1] - 1)
                ok = words[upper] - words[lower] >= self.needed[item]
                out = merged(np.concatenate([out, merged(np.stack([doc, item, lower - starts[doc], upper - starts[doc]], axis=1)[ok])]))
                i = j
        return out


def edits_by_end(item: np.ndarray, region: np.ndarray) -> np.ndarray:
    """Smallest number of word edits between the item and a stretch of the region that ends before each place."""
    steps = np.arange(len(region) + 1)
    d = np.zeros(len(region) + 1, dtype=np.int64)
    for k, w in enumerate(item.tolist()):
        e = d + 1
        e[1:] = np.minimum(e[1:], d[:-1] + (region != w))
        d = np.minimum.accumulate(e - steps) + steps
    return d


def best_stretch(item: np.ndarray, region: np.ndarray, limit: int) -> tuple[int, int]:
    """Smallest number of word edits between the item and a stretch of the region, and where that stretch ends
    (the first such end); (limit + 1, 0) if over the limit."""
    there = set(region.tolist())
    if sum(w in there for w in item.tolist()) < len(item) - limit:  # each word that isn't there needs an edit
        return limit + 1, 0
    d = edits_by_end(item, region)
    at = int(d.argmin())
    return (int(d[at]), at) if d[at] <= limit else (limit + 1, 0)


def stretch_start(item: np.ndarray, region: np.ndarray, end: int, limit: int) -> int:
    """First word of the best stretch that ends before ``end``: the same search backwards from there."""
    back = region[max(0, end - len(item) - limit):end][::-1]
    d = np.arange(len(back) + 1)  # anchored: no word behind the end is free
    steps = np.arange(len(back) + 1)
    for w in item[::-1].tolist():
        e = d + 1
        e[1:] = np.minimum(e[1:], d[:-1] + (back != w))
        d = np.minimum.accumulate(e - steps) + steps
    return end - int(d.argmin())


def places_in_order(item: np.ndarray, region: np.ndarray, limit: int) -> Iterator[tuple[int, int, int]]:
    """(edits, first, end) of places of the item in the region from left to right, none over another: each time the best
    of those that end within ``limit`` words of the first end.  The region is searched in pieces of bounded length."""
    lo, reach = 0, len(item) + limit
    while lo < len(region):
        part = region[lo:lo + 4 * reach]
        edits, _ = best_stretch(item, part, limit)
        if edits > limit:
            if lo + len(part) == len(region):
                return
            lo += 3 * reach
            continue
        d = edits_by_end(item, part)
        first = int(np.flatnonzero(d <= limit)[0])
        end = first + int(d[first:first + limit + 1].argmin())
        if not end:
            return  # the limit allows the empty stretch
        yield int(d[end]), lo + stretch_start(item, part, end, limit), lo + end
        lo += end


def verified(index: Index, x: np.ndarray, found: np.ndarray, p: Params) -> list[tuple[int, int, int, int]]:
    """(item number, edits, first word, last word) of the regions (item number, from, to) of one document that pass the
    exact check: of each the best place, and further ones before and behind it."""
    out = []
    for n, lo, hi in merged(np.insert(found, 0, 0, axis=1))[:, 1:].tolist():
        item, limit, region = index.items[n][1], int(index.limits[n]), x[lo:hi]
        edits, end = best_stretch(item, region, limit)
        if edits > limit:
            continue
        first = stretch_start(item, region, end, limit)
        out.append((n, edits, lo + first, lo + end - 1))
        for at, part in ((0, region[:first]), (end, region[end:])):
            out += [(n, e, lo + at + i, lo + at + j - 1) for e, i, j in places_in_order(item, part, limit)]
    return out


def matches(index: Index, docs: list[np.ndarray], p: Params) -> list[list[tuple[int, int, int, int]]]:
    """Matches of every document: documents are laid end to end, a pad between, and walked in chunks."""
    starts = np.cumsum([0, *(len(d) + 1 for d in docs)])
    x = np.zeros(starts[-1] + index.steps + 1, dtype=np.uint32)
    for a, d in zip(starts.tolist(), docs):
        x[a:a + len(d)] = d
    words = np.concatenate([[0], np.cumsum(index.rare[x & np.uint32(len(index.rare) - 1)], dtype=np.int32)])
    found = [index.candidates(x, a, min(CHUNK, int(starts[-1]) - a), starts, words) for a in range(0, int(starts[-1]), CHUNK)]
    found = np.concatenate(found) if found else np.zeros((0, 4), np.int64)
    found = found[np.argsort(found[:, 0], kind="stable")]
    out: list[list[tuple[int, int, int, int]]] = [[] for _ in docs]
    hit, at = np.unique(found[:, 0], return_index=True)
    for d, mine in zip(hit.tolist(), np.split(found, at[1:])):
        out[d] = verified(index, docs[d], mine[:, 1:], p)
    return out


def item_blocks(benchmark: DataFrame, p: Params) -> Iterator[list[tuple[int, np.ndarray]]]:
    """Items (item_id, symbols) in blocks; the benchmark is streamed through the driver block by block."""
    known, block, words = Symbols(), [], 0
    for r in benchmark.select("item_id", "text").where("text is not null").orderBy("item_id", "text").toLocalIterator():
        s = symbols(r["text"].encode(), known)
        if len(s):
            block.append((r["item_id"], s))
            words += len(s)
        if len(block) >= p.block or words >= p.block_words:
            yield block
            block, words = [], 0
    if block:
        yield block


def document_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Slices of the batches with their documents' symbols, of bounded size but for single long documents."""
    known = Symbols()
    for batch in batches:
        for part in by_size(batch):
            yield part, [symbols(t or b"", known) for t in part.column("text").cast(pa.binary()).to_pylist()]


def find_matches(docs: DataFrame, benchmark: DataFrame, p: Params = Params()) -> DataFrame:
    """(doc_id, item_id, n_spans, edits, similarity, first_word, last_word) per document and item found in it: the
    number of places, and of the best (fewest edits, then first) its edits, similarity and words."""
    schema, out = "doc_id long, item_id long, n_spans int, edits int, similarity double, first_word long, last_word long", None
    for block in item_blocks(benchmark, p):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = Index(shared.value, p)
            for part, seqs in document_groups(batches):
                rows = []
                for doc_id, got in zip(part.column("doc_id").to_pylist(), matches(index, seqs, p)):
                    for n in sorted({m[0] for m in got}):
                        mine = sorted(m[1:] for m in got if m[0] == n)
                        item_id, item = index.items[n]
                        rows.append((doc_id, item_id, len(mine), mine[0][0], 1 - mine[0][0] / len(item), *mine[0][1:]))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(list(v), t) for v, t in zip(zip(*rows), FOUND.types)], schema=FOUND)

        one = docs.select("doc_id", "text").mapInArrow(run, schema)
        out = one if out is None else out.union(one)
    return out if out is not None else docs.sparkSession.createDataFrame([], schema)


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, p: Params = Params()) -> DataFrame:
    """The rows of docs, all columns, in which no item was found.  What a block of items leaves is checkpointed before the
    next block's pass, so that a task holds one index."""
    first = True
    for block in item_blocks(benchmark, p):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = Index(shared.value, p)
            for part, seqs in document_groups(batches):
                yield part.filter(pa.array([not m for m in matches(index, seqs, p)], pa.bool_()))

        docs = (docs if first else cut_lineage(docs)).mapInArrow(run, docs.schema)
        first = False
    return docs
