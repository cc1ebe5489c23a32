"""Alignment against whole-text encodings and sets of byte places; matrix products against dense ones."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from gridsmith.llm import token_alignment as A
from gridsmith.llm.queries import QUERIES

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def encoders():
    return A.Encoders(*PATHS)


def dense(m):
    out = np.zeros((len(m.indptr) - 1, m.columns), dtype=np.int64)
    out[m.rows(), m.indices] = m.data
    return out


def test_products_equal_dense_ones():
    rng = np.random.default_rng(0)
    for _ in range(30):
        n, k, m = rng.integers(1, 9, 3)
        x, y = (rng.integers(0, 3, s) * (rng.random(s) < 0.4) for s in ((n, k), (k, m)))
        mats = []
        for d in (x, y):
            row, col = np.nonzero(d)
            mats.append(A.Csr(np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(d)))]), col, d[row, col], d.shape[1]))
        assert (dense(mats[0] @ mats[1]) == x @ y).all()
        assert (dense(mats[0].transpose()) == x.T).all()


def whole(e, text):
    """(a ids, b ids) of a text by the tokenizers on the whole of it; None if bytes differ."""
    if not text:
        return None
    a, b = e.a.encode(" " + text, add_special_tokens=False).ids, e.b.encode(text)
    data = (" " + text).encode()
    ok = b"".join(e.a_bytes[i] for i in a) == data == b"".join(e.b_bytes[i] for i in b)
    return (a, b) if ok else None


def brute(e, texts):
    """Rows as the contract states them, from sets of end places."""
    rows, corpus = [], Counter()
    for t in texts:
        ids = whole(e, t)
        if not ids:
            rows.append(None)
            continue
        ends = [np.cumsum([len(s[i]) for i in x]).tolist() for x, s in zip(ids, (e.a_bytes, e.b_bytes))]
        links = [(x, y) for x, i in zip(ids[0], ends[0]) for y, j in [(y, j) for y, j in zip(ids[1], ends[1]) if j == i]]
        cuts = sorted(set(ends[0]) & set(ends[1]))
        groups, low = [], 0
        for c in cuts:
            groups.append("|".join(",".join(str(i) for i, x in zip(s, n) if low < x <= c) for s, n in zip(ids, ends)))
            low = c
        corpus.update(links)
        rows.append((len(ids[0]), len(ids[1]), len(cuts), links, ";".join(groups)))
    top = {}
    for (_, y), n in corpus.items():
        top[y] = max(top.get(y, 0), n)
    return [(0, 0, 0, 0, 0, 0, "") if r is None else
            (*r[:3], len(r[3]), sum(corpus[x] == top[x[1]] for x in r[3]), sum(corpus[x] for x in r[3]), r[4]) for r in rows]


ODD = ["word", " lead", "  two", "trail ", "trail  ", "a  b   c", "a \n b\n  c\t d", "\n", " ", "  ", "▁x", "x ▁ y", "<s> </s> <unk> <0x41>",
       "<|endoftext|> x", "don't I'll 'tis", "Straße 東京 \U0001f600 é", " nbsp em 　x", "a\x1c b\x00c", "123 456,789.0", "x" * 3000,
       "...!!! ??", "ﬁ ① Ａ", "a\r\n b", "tab\t x", "\u0085 y \u0085"]


def fuzz(n, seed):
    rng = random.Random(seed)
    signs = list("  aabcXYZ09.,'-\n\t") + ["é", "▁", "中", "\U0001f600", " ", "\x1d", "the", " of", " 's", "<s>"]
    return ["".join(rng.choices(signs, k=rng.randint(1, 40))) for _ in range(n)]


def test_units_encode_as_the_whole_text(encoders):
    assert encoders.may_cut
    for t in ODD + fuzz(4000, 1):
        parts = [encoders.encode(u) for u in A.units_of(t)]
        got = None if None in parts else tuple([i for x in parts for i in x[k]] for k in (0, 1))
        assert got == whole(encoders, t), repr(t)


@pytest.mark.parametrize("p", [A.Params(), A.Params(broadcast_pairs=0), A.Params(units=3)])
def test_against_brute_force(spark, encoders, p):
    texts = [None, "", *ODD, *fuzz(150, 2), "the same again", "the same again"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r[0]: tuple(r)[1:] for r in A.align(df, *PATHS, p).collect()}
    assert [got[i] for i in range(len(texts))] == brute(encoders, texts)


def test_query_on_whole_documents(spark, encoders, documents):
    want = brute(encoders, documents.text.tolist())
    got = {r.doc_id: r for r in QUERIES["op12_token_alignment"](spark, "/root/testdata/sf0.001").collect()}
    assert len(got) == len(documents)
    for d, w in zip(documents.doc_id.tolist(), want):
        sha = hashlib.sha256(w[6].encode()).hexdigest() if w[0] else ""
        assert tuple(got[d]) == (d, *w[:6], sha)


def test_links_of_each_kind(spark, encoders):
    texts = ["hello tokenization, unbelievable 東京", None, "▁"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    a, b = whole(encoders, texts[0])
    spans = []
    for ids, s in ((a, encoders.a_bytes), (b, encoders.b_bytes)):
        e = np.cumsum([len(s[i]) for i in ids])
        spans.append([set(range(y - len(s[i]), y)) for i, y in zip(ids, e)])
    overlap = {(i, j): len(x & y) for i, x in enumerate(spans[0]) for j, y in enumerate(spans[1]) if x & y}
    end = {k for k in overlap if max(spans[0][k[0]]) == max(spans[1][k[1]])}
    cuts = sorted(max(spans[0][i]) for i, _ in end)
    group = {(i, j) for i, x in enumerate(spans[0]) for j, y in enumerate(spans[1])
             if np.searchsorted(cuts, max(x)) == np.searchsorted(cuts, max(y))}
    for kind, want in (("overlap", overlap), ("end", dict.fromkeys(end, 1)), ("group", dict.fromkeys(group, 1))):
        rows = A.link_rows(df, *PATHS, kind).collect()
        assert {(r.a, r.b): r.weight for r in rows} == want and {r.doc_id for r in rows} == {0}
        assert all((r.a_id, r.b_id) == (a[r.a], b[r.b]) for r in rows)


def test_odd_rows(spark, odd_docs, no_docs):
    rows = A.align(odd_docs, *PATHS).collect()
    assert len(rows) == odd_docs.count()
    assert {(r.n_a, r.n_b, r.groups) for r in rows if r.doc_id in (0, 1)} == {(0, 0, "")}
    assert A.align(no_docs, *PATHS).count() == 0
    assert A.align(no_docs, *PATHS, A.Params(broadcast_pairs=-1)).count() == 0
