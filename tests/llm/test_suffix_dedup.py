"""Repeated passages against a brute-force search for equal strings, and the parse against its definition."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridsmith.llm import suffix_dedup as S

SMALL = S.Params(length=24, trigger=10)


def brute(rows, length):
    """doc_id, text rows -> {(doc_id, text): [(n_bytes, spans, kept), ...]} by a walk in order over all strings."""
    seen, out = set(), {}
    for d, t in rows:
        data = (t or "").encode()
        gone = np.zeros(len(data), dtype=bool)
        for i in range(len(data) - length + 1):
            s = data[i:i + length]
            if s in seen:
                gone[i:i + length] = True
            seen.add(s)
        edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(int), [0]])))
        spans = list(zip(edge[::2].tolist(), edge[1::2].tolist()))
        out.setdefault(d, []).append((len(data), spans, bytes(np.frombuffer(data, np.uint8)[~gone])))
    return out


def got(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.doc_id, []).append((r.n_bytes, [(s.start, s.end) for s in r.spans], bytes(r.kept)))
    return out


def same(spark, rows, p):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    have, want = got(S.remove_repeats(df, p)), brute(rows, p.length)
    assert {k: sorted(v) for k, v in have.items()} == {k: sorted(v) for k, v in want.items()}
    return want


def corpus(seed, n=60):
    """Documents of few words with shared passages, edited copies, periods and a stretch common to all."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdeé", k=rng.randint(2, 8)))
    passages = [" ".join(word() for _ in range(rng.randint(4, 30))) for _ in range(8)]
    common = "this line stands in every single document"
    rows = []
    for i in range(n):
        parts = [" ".join(word() for _ in range(rng.randint(0, 12))), rng.choice(passages), common if i % 3 else common.upper()]
        rng.shuffle(parts)
        if i % 7 == 3 and rows:
            t = list(rows[-1][1])
            for _ in range(3):
                t[rng.randrange(len(t))] = "#"
            parts = ["".join(t)]
        if i % 11 == 5:
            parts.append("abc" * 40)
        rows.append((3 * i, " ".join(parts)))
    return rows


@pytest.mark.parametrize("p", [SMALL, S.Params(24, 10, block=2, sort_bytes=200), S.Params(33, 8), S.Params(16, 16, block=1)])
def test_against_brute_force(spark, p):
    want = same(spark, corpus(p.length), p)
    assert sum(bool(s) for v in want.values() for _, s, _ in v) > 10


def test_production_parameters(spark, documents):
    rows = list(zip(documents.doc_id.tolist(), documents.text.tolist()))
    want = same(spark, rows, S.Params())
    assert any(s for v in want.values() for _, s, _ in v)


def test_query(spark, documents):
    from gridsmith.llm.queries import QUERIES
    rows = {r.doc_id: r for r in QUERIES["op11_suffix_dedup"](spark, "/root/testdata/sf0.001").collect()}
    want = brute(list(zip(documents.doc_id.tolist(), documents.text.tolist())), 100)
    assert len(rows) == len(documents)
    for d, [(n, spans, kept)] in want.items():
        r = rows[d]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (n, n - len(kept), len(spans), hashlib.sha256(kept).hexdigest())


def test_long_texts_are_cut_without_loss(spark, monkeypatch):
    """Slices inside a task; the tasks get the small slice size through the pickled module."""
    monkeypatch.setattr(S, "SLICE_BYTES", 50)
    same(spark, corpus(5, 20), SMALL)


def test_odd_rows(spark, odd_docs, no_docs):
    rows = S.remove_repeats(odd_docs, SMALL).collect()
    assert len(rows) == odd_docs.count()
    assert S.remove_repeats(no_docs, SMALL).count() == 0
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert [len(r.kept) for r in by[9]] == [1]                     # one letter, repeated: all strings but the first go
    assert [r.n_bytes for r in by[0] + by[1]] == [0, 0]
    assert len(by[None]) == 1


def test_equal_ids_and_rows(spark):
    t, u = "one two three four five six seven", "another text that is long enough here"
    df = spark.createDataFrame([(5, t), (5, t), (5, u), (None, t), (4, u + t)], "doc_id long, text string")
    rows = S.remove_repeats(df, SMALL).collect()
    kept = sorted((r.doc_id if r.doc_id is not None else -1, bytes(r.kept)) for r in rows)
    assert kept[0] == (-1, t.encode())                              # without an id: first
    assert [k for d, k in kept if d == 5] == [b"", b"", b""]        # all repeat earlier ones
    assert [k for d, k in kept if d == 4] == [(u + t).encode()[:len(u)]]


def test_windows_of_a_phrase_share_the_trigger():
    """Every whole window is in one phrase; its trigger is the least hash in it, whatever stands around."""
    rng = np.random.default_rng(0)
    data = rng.integers(97, 100, 4000).astype(np.uint8)
    ends = np.array([700, 724, 2000, 4000])
    a, n, trigger = S.phrases(data, ends, SMALL)
    inside = sorted(x for i, m in zip(a, n) for x in range(i, i + m))
    want = [x for s, e in zip([0, *ends], ends) for x in range(s, e - SMALL.length + 1)]
    assert inside == want
    for i, m, h in zip(a.tolist(), n.tolist(), trigger.tolist()):
        for x in (i, i + m - 1):
            one = S.phrases(data[x:x + SMALL.length], np.array([SMALL.length]), SMALL)
            assert one[2].tolist() == [h]


def test_suffix_ranks():
    rng = np.random.default_rng(1)
    for length in (16, 24, 33, 100):
        data = bytes(rng.integers(97, 99, 3000).astype(np.uint8)) + bytes(rng.integers(97, 99, 400).astype(np.uint8)) * 2
        at = np.arange(0, len(data) - length, 3)
        rank = S.suffix_ranks(data, at, length)
        want = [data[i:i + length] for i in at]
        order = sorted(set(want))
        assert rank.tolist() == [order.index(w) for w in want]


def test_copies_leave_the_parse_as_runs(spark):
    """Of a text and its copies in a batch, the copies are a row each; a new stretch in between cuts the row in two."""
    rng = random.Random(3)
    t, new = ("".join(rng.choices("abcdefgh ", k=k)) for k in (600, 60))
    df = spark.createDataFrame([(1, 0, t), (2, 0, t), (3, 0, t[:300] + new + t[300:])], "doc long, tie long, text string").coalesce(1)
    rows = [r for r in S.occurrences(df, SMALL).collect()]
    known = {d: sorted((r.a, r.n) for r in rows if r.known and r.doc == d) for d in (1, 2, 3)}
    assert known[1] == [] and known[2] == [(0, 600 - SMALL.length + 1)]
    assert len(known[3]) == 2 and known[3][0][0] == 0 and sum(known[3][1]) == 660 - SMALL.length + 1
    for d, size in ((1, 600), (2, 600), (3, 660)):  # each window is in one row
        at = sorted(x for r in rows if r.doc == d for x in range(r.a, r.a + r.n))
        assert at == list(range(size - SMALL.length + 1))


def test_texts_are_shuffled_once(spark, tmp_path):
    spark.createDataFrame(corpus(9), "doc_id long, text string").write.parquet(str(tmp_path / "docs"))
    rows = S.remove_repeats(spark.read.parquet(str(tmp_path / "docs")), SMALL)
    assert any(r.spans for r in rows.collect())
    plan = rows._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "ReusedExchange" in plan and plan.count("FileScan parquet") == 1
