"""Edit-aware token counts: a segment tree of token counts per document.

A text is cut into segments, each a run of white space and the run of other
characters behind it.  The byte-level pre-tokenizer never joins characters across
such a cut, so a text's token count is the sum over its segments.  ``LEAF`` segments
form a leaf; the leaves carry a binary tree with the characters and tokens of each
subtree.  ``build_trees`` makes one tree per document; ``apply_edits`` finds the
segments an edit touches by descending the tree, re-encodes only those and the
segment on either side (an edit may join or split segments there), and adds the
differences along the paths to the root.

Defined results: a null text is empty (0 tokens); an edit is (start, length, insert) in
code points of the text as left by the edits before it, and is clipped to that text;
null edits, starts, lengths and inserts count as none, 0, 0 and empty; repeated
documents have a tree each.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from gridsmith.llm.common import SLICE_BYTES, by_size

LEAF = 64
#: Most segments whose counts a task remembers.
CACHE = 400_000
#: Up to this many new segments are encoded one by one: an edit brings one or two, too few for a run.
FEW = 8
#: White space as the pre-tokenizer has it (the Unicode property).
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
SEGMENT = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
JOINABLE = re.compile(f"[{SPACE}].*[^{SPACE}]", re.S)

TREE = "seg_chars array<int>, seg_tokens array<int>, leaf_segs array<int>, node_chars array<long>, node_tokens array<long>"
EDITS = "array<struct<start:int,length:int,insert:string>>"


class SegmentCounter(dict):
    """Tokens by segment; new segments are encoded in runs, joined where the cut between them holds."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True

    def learn(self, segments) -> None:
        segments = dict.fromkeys(segments)
        new = [s for s in segments if s not in self]
        if len(self) + len(new) > CACHE:
            self.clear()
            new = list(segments)
        alone, joined = ([], []) if len(new) > FEW else (new, [])
        if alone is not new:
            for s, joins in zip(new, map(JOINABLE.fullmatch, new)):
                (joined if joins else alone).append(s)
        for s in alone:
            self[s] = len(self.tokenizer.encode(s, add_special_tokens=False))
        for i in range(0, len(joined), 512):  # one run at a time: an encoding takes some hundred bytes a token
            run = joined[i:i + 512]
            e = self.tokenizer.encode("".join(run), add_special_tokens=False)
            starts = np.cumsum([0, *map(len, run)])
            at = np.searchsorted(starts, np.fromiter((o[0] for o in e.offsets), np.int64, len(e)), "right") - 1
            self.update(zip(run, np.bincount(at, minlength=len(run)).tolist()))

    def counts(self, segments: list[str]) -> list[int]:
        try:
            return list(map(self.__getitem__, segments))
        except KeyError:
            self.learn(segments)
            return list(map(self.__getitem__, segments))


class Tree:
    """Leaves of segment lengths and counts, with the sums of every subtree in heap order (root 1)."""

    def __init__(self, chars: list[int], tokens: list[int], leaf_segs: list[int] | None = None, nodes=None):
        sizes = leaf_segs or [min(LEAF, len(chars) - i) for i in range(0, len(chars), LEAF)] or [0]
        ends = np.cumsum(sizes).tolist()
        self.chars = [chars[b - n:b] for n, b in zip(sizes, ends)]
        self.tokens = [tokens[b - n:b] for n, b in zip(sizes, ends)]
        self.base = 1 << (len(sizes) - 1).bit_length()
        if nodes:
            self.node_chars, self.node_tokens = nodes
        else:
            self.node_chars, self.node_tokens = ([0] * 2 * self.base for _ in range(2))
            for i in range(len(sizes)):
                self.node_chars[self.base + i], self.node_tokens[self.base + i] = sum(self.chars[i]), sum(self.tokens[i])
            for k in range(self.base - 1, 0, -1):
                for s in (self.node_chars, self.node_tokens):
                    s[k] = s[2 * k] + s[2 * k + 1]

    def find(self, char: int) -> tuple[int, int, int]:
        """(leaf, segment in it, its first char) of the segment that holds a char; the last one if behind the end."""
        k, left = 1, min(char, self.node_chars[1] - 1)
        at = left
        while k < self.base:
            k *= 2
            if left >= self.node_chars[k]:
                left -= self.node_chars[k]
                k += 1
        leaf, i = k - self.base, 0
        while left >= self.chars[leaf][i]:
            left -= self.chars[leaf][i]
            i += 1
        return leaf, i, at - left

    def put(self, first: tuple[int, int], last: tuple[int, int], chars: list[int], tokens: list[int]) -> None:
        """Replace the segments from first to last (both included) and add the differences up to the root."""
        (a, i), (b, j) = first, last
        for leaf in range(a, b + 1):
            lo, hi = (i if leaf == a else 0), (j + 1 if leaf == b else len(self.chars[leaf]))
            self.chars[leaf][lo:hi] = chars if leaf == a else []
            self.tokens[leaf][lo:hi] = tokens if leaf == a else []
            k = self.base + leaf
            dc, dt = sum(self.chars[leaf]) - self.node_chars[k], sum(self.tokens[leaf]) - self.node_tokens[k]
            while k:
                self.node_chars[k] += dc
                self.node_tokens[k] += dt
                k //= 2

    def edit(self, text: str, start: int, length: int, insert: str, counter: SegmentCounter) -> tuple[str, int]:
        """The edited text and the number of segments encoded for it."""
        start = min(max(0, start), len(text))
        end = min(len(text), start + max(0, length))
        new = text[:start] + insert + text[end:]
        if not text:
            segs = SEGMENT.findall(new)
            self.__init__([len(s) for s in segs], counter.counts(segs))
            return new, len(segs)
        a, i, lo = self.find(max(0, start - 1))
        b, j, at = self.find(end)
        # One segment of context on either side: the edit may join it to its neighbour or cut it off.
        if lo:
            a, i, lo = self.find(lo - 1)
        hi = at + self.chars[b][j]
        segs = SEGMENT.findall(new, lo, len(new) - (len(text) - hi))
        self.put((a, i), (b, j), [len(s) for s in segs], counter.counts(segs))
        if len(self.chars[a]) > 4 * LEAF:  # too full: lay the leaves anew from the counts, nothing is encoded
            self.__init__([x for c in self.chars for x in c], [x for t in self.tokens for x in t])
        return new, len(segs)


def build_trees(docs: DataFrame, vocabulary: str, *keep: str) -> DataFrame:
    """``keep`` columns and text of docs with the tree columns (``TREE``).  ``vocabulary``: path of a byte-level BPE
    tokenizer file on every executor."""
    schema = docs.select(*keep, "text").schema
    out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema) + ", " + TREE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = SegmentCounter(vocabulary)
        for whole in batches:
            for b in by_size(whole, "text", SLICE_BYTES // 2):
                segs = [SEGMENT.findall(t or "") for t in b.column("text").to_pylist()]
                counter.learn(chain.from_iterable(segs))
                trees = [Tree(list(map(len, one)), counter.counts(one)) for one in segs]
                yield pa.RecordBatch.from_arrays([*b.columns, *tree_columns(trees)], [*b.schema.names, *TREE_NAMES])

    return docs.select(*keep, "text").mapInArrow(run, out)


TREE_NAMES = [x.split()[0] for x in TREE.split(", ")]


def as_lists(rows: list[list[int]], kind: pa.DataType) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, rows)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(list(chain.from_iterable(rows)), kind))


def tree_columns(trees: list[Tree]) -> list[pa.Array]:
    flat = lambda v: list(chain.from_iterable(v))
    return [as_lists([flat(t.chars) for t in trees], pa.int32()), as_lists([flat(t.tokens) for t in trees], pa.int32()),
            as_lists([list(map(len, t.chars)) for t in trees], pa.int32()),
            as_lists([t.node_chars for t in trees], pa.int64()), as_lists([t.node_tokens for t in trees], pa.int64())]


def read_lists(column: pa.ListArray) -> Iterator[list[int]]:
    """The rows of a column of lists, read from its values at once (a call per value takes most of the time)."""
    values, ends = column.flatten().to_numpy(zero_copy_only=False), np.cumsum([0, *column.value_lengths().fill_null(0).to_pylist()])
    return (values[a:b].tolist() for a, b in zip(ends, ends[1:]))


def apply_edits(trees: DataFrame, vocabulary: str, edits: str, *keep: str) -> DataFrame:
    """Apply the ``edits`` column (``EDITS``) of each row to its text and tree: ``keep`` columns, the new text and
    tree, n_tokens before and after, and the number of segments encoded."""
    schema = trees.select(*keep).schema
    out = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in schema), "text string", TREE,
                     "n_tokens long, n_tokens_edited long, n_segments long, n_encoded long"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = SegmentCounter(vocabulary)
        for whole in batches:
            for b in by_size(whole, "text", SLICE_BYTES // 2):
                made, texts, figures = [], [], []
                for text, es, *cols in zip(b.column("text").to_pylist(), b.column(edits).to_pylist(),
                                                 *(read_lists(b.column(c)) for c in TREE_NAMES)):
                    tree, text = Tree(*cols[:3], cols[3:]), text or ""
                    before, encoded = tree.node_tokens[1], 0
                    for e in es or []:
                        if e:
                            text, n = tree.edit(text, e["start"] or 0, e["length"] or 0, e["insert"] or "", counter)
                            encoded += n
                    made.append(tree)
                    texts.append(text)
                    figures.append((before, tree.node_tokens[1], sum(map(len, tree.chars)), encoded))
                yield pa.RecordBatch.from_arrays(
                    [b.column(c) for c in keep] + [pa.array(texts, pa.string()), *tree_columns(made)]
                    + [pa.array(list(v), pa.int64()) for v in zip(*figures)],
                    [*keep, "text", *TREE_NAMES, "n_tokens", "n_tokens_edited", "n_segments", "n_encoded"])

    return trees.mapInArrow(run, out)
