"""Document fingerprints: quartile bucket digests of hashed byte triplets.

A window of five bytes slides over the UTF-8 text; the six byte triplets that hold
its last byte are hashed into 128 buckets.  Each bucket is coded by the quartile of
the bucket counts it falls into (2 bits), in front of that stand a logarithmic code
of the length and the ratios of the quartiles.  Two digests are compared by a
difference score that adds bucket, length and ratio distances; likeness is
1 - min(score, BOUND) / BOUND.

Defined results: a null text is empty; texts under five bytes have no window, their
digest codes only the length (the empty text's is all zeros); equal texts have equal
digests and likeness 1; documents are ordered by doc_id (nulls first, equal ids by a
hash of the text), the one behind the last is the first; a single document is its own
next one.  Texts are hashed slice by slice.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridsmith.llm.common import fresh, id_bounds, with_bucket

BUCKETS = 128
WINDOW = 5
BOUND = 256
#: Offsets from the window's last byte of the other two bytes of each triplet.
TRIPLETS = ((1, 2), (1, 3), (2, 3), (1, 4), (2, 4), (3, 4))
SLICE = 1 << 18
BUCKET_BYTES = 24 << 20
MAX_BUCKETS = 10_000


def triplet_counts(data: bytes) -> np.ndarray:
    total = np.zeros(BUCKETS, dtype=np.int64)
    whole = np.frombuffer(data, dtype=np.uint8)
    for a in range(0, len(whole) - WINDOW + 1, SLICE):
        x = whole[a:a + SLICE + WINDOW - 1].astype(np.uint32)
        last, near, far = x * np.uint32(0x9E3779B1), x * np.uint32(0x85EBCA77), x * np.uint32(0xC2B2AE3D)
        n = len(x) - WINDOW + 1
        h = np.empty((len(TRIPLETS), n), dtype=np.uint32)
        for row, (i, j) in zip(range(len(TRIPLETS)), TRIPLETS):
            np.add(last[WINDOW - 1:], near[WINDOW - 1 - i:WINDOW - 1 - i + n], out=h[row])
            h[row] += far[WINDOW - 1 - j:WINDOW - 1 - j + n]
            h[row] += np.uint32(0x27D4EB2F * (row + 1) % 2**32)
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
        total += np.bincount((h >> np.uint32(25)).ravel(), minlength=BUCKETS)
    return total


def digest(data: bytes) -> str:
    """4 hex digits of length and ratios, 64 of bucket quartiles."""
    c = triplet_counts(data)
    q1, q2, q3 = np.sort(c)[[BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]].tolist()
    code = (c > q1).astype(np.uint8) + (c > q2) + (c > q3)
    four = code.reshape(-1, 4).astype(np.uint8)
    body = four[:, 0] << 6 | four[:, 1] << 4 | four[:, 2] << 2 | four[:, 3]
    length = min(255, round(math.log(len(data)) * 12) + 1) if data else 0
    ratio = (q1 * 15 // q3) << 4 | q2 * 15 // q3 if q3 else 0
    return bytes([length, ratio]).hex() + body.astype(np.uint8).tobytes().hex()


def difference(a: str, b: str) -> int:
    """Bucket distances (a step of three counts six), length codes beyond one step, ratio codes."""
    x, y = np.frombuffer(bytes.fromhex(a), np.uint8), np.frombuffer(bytes.fromhex(b), np.uint8)
    codes = lambda v: np.stack([v >> 6, v >> 4 & 3, v >> 2 & 3, v & 3]).astype(np.int64)
    d = np.abs(codes(x[2:]) - codes(y[2:]))
    length = abs(int(x[0]) - int(y[0]))
    ratios = abs((int(x[1]) >> 4) - (int(y[1]) >> 4)) + abs((int(x[1]) & 15) - (int(y[1]) & 15))
    return int(d.sum() + 3 * (d == 3).sum()) + (length if length > 1 else 0) + ratios


def likeness(a: str, b: str) -> float:
    return 1 - min(difference(a, b), BOUND) / BOUND


def fingerprint(docs: DataFrame, *keep: str) -> DataFrame:
    """``keep`` columns of docs and the digest of text as ``fingerprint``."""
    @F.arrow_udf("string")
    def of(text: pa.Array) -> pa.Array:
        return pa.array([digest(x or b"") for x in text.cast(pa.binary()).to_pylist()], pa.string())
    return docs.select(*keep, of("text").alias("fingerprint"))


def with_next(docs: DataFrame, fn, schema: str) -> DataFrame:
    """Apply ``fn(doc_id, text, next_text) -> tuple`` to every document and the next one by id, in id order.

    Documents are dealt by id range and sorted within; the first of each range is sent to the range before as well
    (the very first to the last range), so nothing but these few rows is sent twice."""
    bucket, extra, tie = (fresh(docs, x) for x in ("bucket", "extra", "tie"))
    docs = docs.select("doc_id", "text")
    bounds = id_bounds(docs, BUCKET_BYTES, MAX_BUCKETS)
    n = max(1, len(bounds))
    rows = with_bucket(docs, bounds, bucket).withColumn(tie, F.xxhash64("text"))
    # The heads: ids that open a range; with null ids these come first of all.
    first = F.col("doc_id").isNull() if not len(bounds) or docs.where("doc_id is null").limit(1).count() else \
        F.col("doc_id") == int(bounds[0])
    @F.arrow_udf("boolean")
    def opens(ids: pa.Array) -> pa.Array:
        return pa.array(np.isin(ids.fill_null(int(bounds[0])).to_numpy(zero_copy_only=False), bounds[1:]))

    home = F.struct(F.col(bucket).alias("to"), F.lit(False).alias("extra"))
    before = F.struct((F.col(bucket) - 1).alias("to"), F.lit(True).alias("extra"))
    end = F.struct(F.lit(n - 1).alias("to"), F.lit(True).alias("extra"))
    to = F.when(first, F.array(home, end))
    to = (to.when(opens("doc_id"), F.array(home, before)) if n > 1 else to).otherwise(F.array(home))
    dealt = rows.withColumn(extra, F.explode(to)).select(
        F.col(f"{extra}.to").alias(bucket), F.col(f"{extra}.extra").alias(extra), "doc_id", tie, "text")
    dealt = dealt.repartitionById(n, F.col(bucket)).sortWithinPartitions(bucket, extra, F.asc_nulls_first("doc_id"), tie)
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at, done = None, None, []
        for b in batches:
            for to, more, doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(),
                                              b.column(4).to_pylist()):
                text = text or ""
                if held and at == to:
                    done.append(fn(*held, text))
                at, held = to, None if more else (doc_id, text)
            if done:
                yield pa.RecordBatch.from_pydict(dict(zip(names, map(list, zip(*done)))))
                done = []

    return dealt.mapInArrow(run, schema)


def edited(text: str, following: str) -> str:
    """The text with its last floor(n / 2) code points replaced by the first as many of the following text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def compare_with_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of every document, of its edited text and their likenesses; see the module."""
    last: dict[str, str] = {}  # the next document's digest is needed again as its own

    def one(doc_id, text: str, following: str) -> tuple:
        now = last.get("fp") if last.get("text") == text else None
        now = now or digest(text.encode())
        then = digest(following.encode())
        last.update(text=following, fp=then)
        changed = edited(text, following).encode()
        e = digest(changed)
        return (doc_id, len(text), hashlib.sha256(changed).hexdigest(), now, e, likeness(now, e), likeness(now, then))

    return with_next(docs, one, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                                "edited_fingerprint string, near_edited double, near_next double")
