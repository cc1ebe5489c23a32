import collections
import random

import numpy as np
import pytest
import xxhash

from gridsmith.llm import simhash_dedup as S
from tests.llm.conftest import SF_SMALL


def brute_fingerprint(text, shingle=4):
    import re
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i:i + shingle]) for i in range(len(words) - shingle + 1)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def brute_components(rows, bits=4):
    """rows: (doc_id, unsigned fp) -> component id per row."""
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] ^ rows[j][1]).bit_count() <= bits:
                parent[max(find(i), find(j))] = min(find(i), find(j))
    low = collections.defaultdict(list)
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)].append(d)
    return [min(low[find(i)], default=None) for i in range(len(rows))]


def test_whole_table_against_brute_force(spark, documents):
    from gridsmith.llm.queries import op3_simhash_dedup
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in op3_simhash_dedup(spark, SF_SMALL).collect()}
    rows = [(int(d), brute_fingerprint(t)) for d, t in zip(documents.doc_id, documents.text)]
    want = {d: (f"{f:016x}", c) for (d, f), c in zip(rows, brute_components(rows))}
    assert got == want


def test_sliced_text_has_the_same_fingerprint(monkeypatch, documents):
    for t in documents.text[:40]:
        whole = S.fingerprint(t.encode(), 4)
        assert whole == brute_fingerprint(t)
        monkeypatch.setattr(S, "slices", lambda d: __import__("gridsmith.llm.common", fromlist=["x"]).slices(d, 100))
        assert S.fingerprint(t.encode(), 4) == whole
        monkeypatch.undo()


@pytest.mark.parametrize("params", [S.Params(), S.Params(block=40, pairs=500), S.Params(max_bits=3), S.Params(max_bits=7, block=60)])
def test_links_lose_none(spark, params):
    """Clusters of fingerprints at all distances: the forest's components equal brute force, blocks and runs split or not."""
    rnd = random.Random(5)
    fps = {0, 1, (1 << 64) - 1}
    for _ in range(12):
        base = rnd.getrandbits(64)
        for _ in range(25):
            x = base
            for b in rnd.sample(range(64), rnd.randint(0, 7)):
                x ^= 1 << b
            fps.add(x)
    fps = sorted(fps)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    docs = spark.createDataFrame([(i, s) for i, s in enumerate(signed)], "doc_id long, fp long")
    got = {r.fp: r.component_id for r in S.fingerprint_groups(docs, params).collect()}
    want = brute_components(list(enumerate(fps)), params.max_bits)
    assert [got[s] for s in signed] == want


def test_pigeonring_passes_every_close_pair():
    rnd = np.random.default_rng(3)
    a = rnd.integers(0, 2**63, 400, dtype=np.uint64)
    b = a.copy()
    for i in range(len(a)):
        for bit in rnd.choice(64, rnd.integers(0, 5), replace=False):
            b[i] ^= np.uint64(1) << np.uint64(bit)
    p, hit = S.Params(), set()
    for i, (shift, width) in enumerate(S.segments(p)):
        fp = np.concatenate([a, b])
        group = ((fp >> np.uint64(shift)) & np.uint64((1 << width) - 1)).astype(np.int64)
        for u, v in S.chained_pairs(fp, group, i, p):
            hit |= {(int(x), int(y)) for x, y in zip(u, v)}
    assert all((i, i + 400) in hit for i in range(400))


def test_long_chain_and_star_components(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, k) for k in range(1001, 1400)] + [(2000, 2000)]
    got = {r.node: r.root for r in S.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert all(got[i] == 0 for i in range(301)) and all(got[k] == 1000 for k in range(1000, 1400))


def test_odd_rows(spark, odd_docs, no_docs):
    rows = S.near_duplicates(odd_docs).collect()
    assert len(rows) == 11
    empty = [r for r in rows if r.fp == 0]
    assert len(empty) == 3 and {r.component_id for r in empty} == {0}
    kept = S.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(6) == 1 and 0 in ids and 1 not in ids and 2 not in ids
    assert S.near_duplicates(no_docs).count() == 0 and S.keep_one(no_docs).count() == 0


def test_only_null_ids(spark):
    docs = spark.createDataFrame([(None, "a b c d e"), (None, "a b c d e"), (None, "q r s t u")], "doc_id long, text string")
    assert S.near_duplicates(docs).where("component_id is null").count() == 3
    assert S.keep_one(docs).count() == 2


def test_keep_one_keeps_the_smallest_of_each_component(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    comp = {r.component_id for r in S.near_duplicates(docs).collect()}
    assert sorted(r.doc_id for r in S.keep_one(docs).collect()) == sorted(comp)


@pytest.mark.parametrize("params", [S.Params(block=3, pairs=40), S.Params(block=2, max_bits=7), S.Params(block=3, max_bits=1),
                                    S.Params(block=2, broadcast_keys=0), S.Params(block=2, max_bits=0)])
def test_large_values_are_dealt_by_two_segments(spark, params):
    """Fingerprints that share segments by the hundred: dealing by a second segment, then by blocks, loses no link."""
    rnd = random.Random(9)
    fps = sorted({(rnd.getrandbits(7) << 57 | rnd.getrandbits(3) << 30 | rnd.getrandbits(4) << 11 | rnd.getrandbits(1)) for _ in range(260)})
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    docs = spark.createDataFrame([(i, s) for i, s in enumerate(signed)], "doc_id long, fp long")
    got = {r.fp: r.component_id for r in S.fingerprint_groups(docs, params).collect()}
    assert [got[s] for s in signed] == brute_components(list(enumerate(fps)), params.max_bits)


def test_join_hot_is_a_join(spark, monkeypatch):
    from gridsmith.llm import common
    monkeypatch.setattr(common, "HOT_LEAST", 5)
    rnd = random.Random(2)
    rows = [(i, rnd.choice([1, 1, 1, 1, *range(2, 40), None])) for i in range(900)]
    table = [(k, k * 10) for k in range(1, 30)]
    got = common.join_hot(spark.createDataFrame(rows, "id long, k long"), spark.createDataFrame(table, "k long, v long"), "k")
    assert sorted(tuple(r) for r in got.select("id", "k", "v").collect()) == sorted((i, k, 10 * k) for i, k in rows if k and k < 30)


def test_keep_one_with_repeated_ids(spark):
    """Ids that several rows have, with equal and other texts, and null ids: of each component one row stays."""
    a, b, c, d = ("alpha beta gamma delta epsilon", "one two three four five six", "red green blue black white", "uno dos tres cuatro cinco")
    rows = [(1, a, {"x": 1}), (1, b, {"x": 2}), (1, b, {"x": 2}), (2, b, {"x": 3}), (3, c, {}), (4, c, {}), (None, c, {}), (None, d, {}), (None, d, {}), (5, a, {})]
    docs = spark.createDataFrame(rows, "doc_id long, text string, d map<string,int>")
    kept = S.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted([(1, a), (1, b), (3, c), (None, d)], key=str)
