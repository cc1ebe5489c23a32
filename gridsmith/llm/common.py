"""Small helpers shared by the operators: word splitting, bounded slices of
long texts and a range layout of documents by id."""

from __future__ import annotations

import re
import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
#: Words are runs of 0-9, a-z (after A-Z are lower-cased) and anything outside ASCII; all other bytes separate.
WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
                   for c in range(256))
#: Keys with more than one in HOT_SHARE of all rows, and more than HOT_LEAST, are joined in SALTS parts.
HOT_SHARE, HOT_LEAST, SALTS = 1000, 500, 64
#: Most words of which a task remembers something.
CACHED_WORDS = 300_000
#: Long texts are worked on in slices of about this many bytes, so a task's memory does not follow the longest text.
SLICE_BYTES = 1 << 20


def lower_az(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def small_batches(spark: SparkSession) -> SparkSession:
    """Cap the Arrow batches that go to Python tasks at 8 MB, unless the session asks for less: with texts of a few KB the
    default (64 MB, held once in the JVM and some times in the Python worker) is most of a small executor."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    size = re.fullmatch(r"(\d+)([kmgt]?)b?", spark.conf.get(key).strip().lower())
    if size and int(size[1]) << 10 * " kmgt".index(size[2] or " ") > 8 << 20:
        spark.conf.set(key, str(8 << 20))
    return spark


def by_size(batch: pa.RecordBatch, name: str = "text", size: int = 2 * SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``size`` bytes of text each, but for single long texts."""
    ends = np.cumsum(pc.binary_length(batch.column(name)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    a = 0
    while a < batch.num_rows:
        done = ends[a - 1] if a else 0
        b = max(a + 1, int(np.searchsorted(ends, done + size, "right")))
        yield batch.slice(a, b - a)
        a = b


def slices(data: bytes, size: int = SLICE_BYTES, cut: bytes = b" ") -> Iterator[bytes]:
    """Cut ``data`` behind a ``cut`` byte at about every ``size`` bytes; joined, the pieces are ``data`` again.
    A run without any cut byte stays whole."""
    at = 0
    while len(data) - at > size:
        end = data.find(cut, at + size)
        if end < 0:
            break
        yield data[at:end + 1]
        at = end + 1
    yield data[at:]


def plain_words(data: bytes) -> Iterator[list[bytes]]:
    """Words of a text (see WORD_BYTES), slice by slice."""
    for piece in slices(data.translate(WORD_BYTES)):
        yield piece.split()


def mix64(x: np.ndarray, salt: int) -> np.ndarray:
    """A 64-bit finalizer (multiply, shift, xor), vectorised."""
    x = (x.astype(np.uint64) + np.uint64(salt * 0x9E3779B97F4A7C15 % 2**64))
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def id_bounds(docs: DataFrame, bucket_bytes: int, max_buckets: int) -> np.ndarray:
    """Ascending ids (values of doc_id) that cut the documents into ranges of about ``bucket_bytes`` of text; the
    first is the smallest id.  Empty if there is no id.  At most ``max_buckets`` numbers reach the driver."""
    size = docs.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 16).alias("b"), F.min("doc_id").alias("lo")).first()
    if size["lo"] is None:
        return np.array([], dtype=np.int64)
    n = int(min(max_buckets, max(8, -(-size["b"] // bucket_bytes))))
    steps = F.array(*[F.lit(i / n) for i in range(1, n)])
    cuts = docs.agg(F.percentile_approx("doc_id", steps, F.lit(max(10_000, 20 * n)))).first()[0]
    return np.unique(np.array([size["lo"], *cuts], dtype=np.int64))


def with_bucket(docs: DataFrame, bounds: np.ndarray, name: str) -> DataFrame:
    """Add the number of each row's id range; rows without an id belong to the first."""
    @F.arrow_udf(T.IntegerType())
    def bucket(ids: pa.Array) -> pa.Array:
        at = np.searchsorted(bounds, ids.fill_null(int(bounds[0])).to_numpy(zero_copy_only=False), side="right") - 1
        return pa.array(np.maximum(0, at).astype(np.int32))
    return docs.withColumn(name, bucket("doc_id") if len(bounds) > 1 else F.lit(0))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have (names compare without case)."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name = f"_{name}"
    return name


def join_hot(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Inner join of rows to a table with one row a key.  Keys that hold more than one in HOT_SHARE of the rows (so fewer
    than HOT_SHARE keys, which the driver names) are dealt to SALTS tasks, with their row of the table in each.  ``rows``
    is read three times: cut its lineage before."""
    counts = rows.groupBy(key).agg(F.count("*").alias("n"))
    least = max(rows.count() // HOT_SHARE, HOT_LEAST)
    hot = [r[0] for r in counts.where((F.col("n") > least) & F.col(key).isNotNull()).select(key).collect()]
    if not hot:
        return rows.join(table, key)
    part = "_part"
    while part in {c.lower() for c in rows.columns + table.columns}:
        part = f"_{part}"
    others = [c for c in rows.columns if c != key]
    drawn = F.pmod(F.xxhash64(*others) if others else F.monotonically_increasing_id(), F.lit(SALTS))
    many = F.col(key).isin(hot)
    rows = rows.withColumn(part, F.when(many, drawn).otherwise(F.lit(0)).cast("int"))
    table = table.withColumn(part, F.explode(F.when(many, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))))
    return rows.join(table, [key, part]).drop(part)


def per_worker(key: tuple, make):
    """``make()``, kept for the life of the Python worker under ``key``.  Native tokenizers leave memory behind when they
    are dropped, so a worker that serves many tasks must not make one a task.  This package is pickled by value and its
    globals are new in each task; the holder is a module of its own."""
    holder = sys.modules.setdefault("_gridsmith_worker", types.ModuleType("_gridsmith_worker"))
    made = holder.__dict__.setdefault("made", {})
    if key not in made:
        made[key] = make()
    return made[key]
