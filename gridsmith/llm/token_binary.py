"""Token-id output: files of fixed-width packed ids with block offsets.

Each id takes the fewest bits that hold the vocabulary (16 for 49,408 ids), most significant
bit first, one behind the other.  A file is a Parquet file whose rows are blocks: the number of
its shard (an id range of documents), of the block in it, ``start`` (ids of the shard before it),
the bit width, the blocks' document ids and lengths in ids, and the packed ids as bytes.  Blocks
hold whole documents, about ``BLOCK_IDS`` ids each; shards, blocks and documents ascend by doc_id.
Spark writes the files, so a lost task leaves nothing behind.  Readers unpack a block, or a stretch
of it, with numpy; ``read_ids`` fetches single documents by the blocks' id ranges.

Documents are dealt by id range as text (once) and tokenized in order.  Texts are cut at spaces and
line ends, where the tokenizer cuts as well, and each different piece is encoded once a worker; Latin texts
are lower-cased first, as the tokenizer does, so that there are fewer of them.

Defined results: null and empty texts have the end id only; documents of equal doc_id stand together
in the order of a hash of their text; null ids come first; an empty table gives no files rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridsmith.llm.common import by_size, fresh, id_bounds, per_worker, with_bucket

BUCKET_BYTES = 20 << 20
MAX_BUCKETS = 10_000
BLOCK_IDS = 1 << 18
#: Most pieces whose ids a worker remembers, from task to task.
CACHE = 250_000

BLOCK = "shard int, block int, start long, width int, doc_ids array<long>, lengths array<int>, ids binary"


# -- packing -----------------------------------------------------------------------------------------------------

def bits_for(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    """ids in ``width`` bits each, most significant bit first; the last byte is filled up with zeros."""
    if width == 16:
        return ids.astype(">u2").tobytes()
    bits = np.unpackbits(ids.astype(">u4").view(np.uint8).reshape(-1, 4), axis=1)[:, 32 - width:]
    return np.packbits(bits.ravel()).tobytes()


def unpack(data: bytes, width: int, first: int, n: int) -> np.ndarray:
    """ids first .. first + n - 1 of a packed block, without unpacking the others."""
    if width == 16:
        return np.frombuffer(data, ">u2", n, 2 * first).astype(np.uint32)
    a = first * width
    raw = np.frombuffer(data, np.uint8, -(-(a + n * width) // 8) - a // 8, a // 8)
    bits = np.unpackbits(raw)[a % 8:a % 8 + n * width].reshape(n, width)
    full = np.zeros((n, 32), dtype=np.uint8)
    full[:, 32 - width:] = bits
    return np.packbits(full, axis=1).view(">u4").ravel().astype(np.uint32)


# -- tokenizing --------------------------------------------------------------------------------------------------



class Pieces(dict):
    """Number of each different piece of text; the pieces' ids lie one behind the other in ``flat``.  Piece 0 is the end id."""

    def __init__(self, path: str, end_id: int):
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer = Tokenizer.from_file(path)
        ends = self.tokenizer.get_vocab()
        self.word_end = np.zeros(max(ends.values()) + 1, dtype=bool)
        self.word_end[[i for t, i in ends.items() if t.endswith("</w>")]] = True
        self.split, self.split_id = "<|endoftext|>", ends["<|endoftext|>"]
        # The same model for words that are lower-cased and apart already.
        self.words = Tokenizer.from_file(path)
        self.words.normalizer = None
        self.words.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.end_id = end_id
        self.reset()

    def reset(self) -> None:
        self.clear()
        self[END] = 0
        self.new: list[str] = []
        self.flat, self.start, self.size = np.array([self.end_id], dtype=np.uint32), np.array([0]), np.array([1])

    def __missing__(self, piece: str) -> int:
        self[piece] = n = len(self)
        self.new.append(piece)
        return n

    def encode_words(self, words: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """(ids, sizes) in runs, for words of lower-case letters only: the ids of a word are those up to its word end."""
        ids, sizes = [], []
        runs = [words[i:i + 256] for i in range(0, len(words), 256)]
        for run, e in zip(runs, self.words.encode_batch_fast([" ".join(r) for r in runs], add_special_tokens=False)):
            got = np.array(e.ids, dtype=np.uint32)
            ids.append(got)
            sizes.append(np.diff(np.flatnonzero(self.word_end[got]) + 1, prepend=0))
        return ids, sizes

    def encode_others(self, pieces: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """(ids, sizes) in runs, for pieces of any kind: a special token stands between them; pieces that hold its
        opening sign are encoded alone."""
        ids, sizes, at = [], [], 0
        while at < len(pieces):
            run = pieces[at:at + 256]
            alone = next((i for i, x in enumerate(run) if "<|" in x), len(run))
            if alone == 0:
                got = np.array(self.tokenizer.encode(run[0], add_special_tokens=False).ids, dtype=np.uint32)
                ids.append(got)
                sizes.append(np.array([len(got)]))
                at += 1
                continue
            run = run[:alone]
            line = f" {self.split} ".join(run) + f" {self.split}"
            got = np.array(self.tokenizer.encode(line, add_special_tokens=False).ids, dtype=np.uint32)
            cut = got == self.split_id
            ids.append(got[~cut])
            sizes.append(np.diff(np.flatnonzero(cut), prepend=-1) - 1)
            at += len(run)
        return ids, sizes

    def learn(self) -> None:
        """Encode the pieces that are new: words of lower-case letters by the bare model, others as they are."""
        if not self.new:
            return
        is_word = np.fromiter((x.isalpha() and x.islower() and is_latin(x) for x in self.new), bool, len(self.new))
        parts = [[x for x, w in zip(self.new, is_word) if w], [x for x, w in zip(self.new, is_word) if not w]]
        size, start, end = np.zeros(len(self.new), np.int64), np.zeros(len(self.new), np.int64), len(self.flat)
        flat = [self.flat]
        for at, part, encode in ((is_word, parts[0], self.encode_words), (~is_word, parts[1], self.encode_others)):
            if part:
                ids, sizes = encode(part)
                size[at] = np.concatenate(sizes)
                start[at] = end + np.cumsum(size[at]) - size[at]
                end += int(size[at].sum())
                flat += ids
        self.flat, self.new = np.concatenate(flat), []
        self.start, self.size = np.concatenate([self.start, start]), np.concatenate([self.size, size])

    def ids_of(self, line: str) -> list[np.ndarray]:
        """Ids of the texts of a line, END behind each."""
        pieces = line.replace("\n", " ").split(" ")
        at = np.fromiter(map(self.__getitem__, pieces), np.int64, len(pieces))
        self.learn()
        size = self.size[at]
        ends = np.cumsum(size)
        ids = self.flat[np.arange(ends[-1]) + np.repeat(self.start[at] - ends + size, size)]
        return np.split(ids, ends[at == 0][:-1])

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text with the end id behind."""
        if len(self) > CACHE:
            self.reset()
        out: list[np.ndarray] = [None] * len(texts)
        latin, others = [], []
        for i, t in enumerate(texts):
            if END in t:  # a piece like the sign between texts
                out[i] = np.array([*self.tokenizer.encode(t, add_special_tokens=False).ids, self.end_id], dtype=np.uint32)
            else:
                (latin if is_latin(t) else others).append(i)
        for group, line in ((latin, apart), (others, str)):
            if group:
                joined = line(f" {END} ".join(texts[i] for i in group)) + f" {END}"
                for i, ids in zip(group, self.ids_of(joined)):
                    out[i] = ids
        return out


#: The piece behind a text.
END = "\x02\x03"


def is_latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def apart(line: str) -> str:
    """A Latin line in lower case, with a space before each full stop or comma between a letter and white space: there
    it is a pre-token of its own."""
    b = np.frombuffer((line.lower() + " ").encode("latin-1"), dtype=np.uint8)
    at = np.flatnonzero((b[:-1] == 46) | (b[:-1] == 44))
    at = at[at > 0]
    at = at[LETTER[b[at - 1]] & ((b[at + 1] == 32) | (b[at + 1] == 10))]
    return np.insert(b, at, 32)[:-1].tobytes().decode("latin-1")


LETTER = np.array([chr(c).isalpha() for c in range(256)])


# -- files -------------------------------------------------------------------------------------------------------

def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int, width: int) -> None:
    """Tokenize docs (doc_id, text) and write them to ``path`` (a folder that all executors share)."""
    bucket, tie = fresh(docs, "bucket"), fresh(docs, "tie")
    docs = docs.select("doc_id", "text")
    bounds = id_bounds(docs, BUCKET_BYTES, MAX_BUCKETS)
    rows = with_bucket(docs, bounds, bucket).withColumn(tie, F.xxhash64("text"))
    rows = rows.repartitionById(max(1, len(bounds)), F.col(bucket)).sortWithinPartitions(
        bucket, F.asc_nulls_first("doc_id"), tie)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = per_worker(("pieces", tokenizer, end_id), lambda: Pieces(tokenizer, end_id))
        shard, block, start, held, names, size = None, 0, 0, [], [], 0

        def out() -> pa.RecordBatch:
            nonlocal block, start, held, names, size
            row = pa.RecordBatch.from_arrays(
                [pa.array([x], t) for x, t in ((shard, pa.int32()), (block, pa.int32()), (start, pa.int64()), (width, pa.int32()),
                                               (names, pa.list_(pa.int64())), ([len(h) for h in held], pa.list_(pa.int32())),
                                               (pack(np.concatenate(held), width), pa.binary()))],
                [x.split()[0] for x in BLOCK.split(", ")])
            block, start, held, names, size = block + 1, start + size, [], [], 0
            return row

        for b in batches:
            for part in by_size(b):
                ids = pieces([t or "" for t in part.column("text").to_pylist()])
                for to, name, one in zip(part.column(bucket).to_pylist(), part.column("doc_id").to_pylist(), ids):
                    if held and (to != shard or size >= BLOCK_IDS):
                        yield out()
                    if to != shard:
                        shard, block, start = to, 0, 0
                    held.append(one)
                    names.append(name)
                    size += len(one)
        if held:
            yield out()

    rows.select(bucket, "doc_id", "text").mapInArrow(run, BLOCK).write.mode("errorifexists").parquet(path)


def shard_starts(blocks: DataFrame) -> dict[int, int]:
    """Ids of all shards before each shard (at most MAX_BUCKETS rows reach the driver)."""
    sizes = blocks.groupBy("shard").agg(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n"))
    rows = sorted((r["shard"], r["n"]) for r in sizes.collect())
    return dict(zip([s for s, _ in rows], accumulate([n for _, n in rows], initial=0)))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files."""
    blocks = spark.read.schema(BLOCK).parquet(path)
    before = shard_starts(blocks.select("shard", "lengths"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in range(b.num_rows):
                shard, _, start, width, names, lengths, data = (b.column(c)[r].as_py() for c in range(7))
                at = list(accumulate(lengths, initial=0))
                ids = unpack(data, width, 0, at[-1]).astype("<u4")
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.int64()), pa.array([before[shard] + start + a for a in at[:-1]], pa.int64()),
                     pa.array(lengths, pa.int64()), pa.array([zlib.crc32(ids[a:e]) for a, e in zip(at, at[1:])], pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"])

    return blocks.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_ids(spark: SparkSession, path: str, doc_id: int) -> list[np.ndarray]:
    """The ids of the documents with this id: only their blocks are read, only their stretch is unpacked."""
    blocks = spark.read.schema(BLOCK).parquet(path).where(F.array_contains("doc_ids", F.lit(doc_id).cast("long")))
    out = []
    for r in blocks.orderBy("shard", "block").toLocalIterator():
        at = list(accumulate(r["lengths"], initial=0))
        out += [unpack(r["ids"], r["width"], at[i], r["lengths"][i]) for i, d in enumerate(r["doc_ids"]) if d == doc_id]
    return out
