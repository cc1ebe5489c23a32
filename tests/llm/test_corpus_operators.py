"""Decontamination, mixing, toxicity and the pipeline against brute force, and odd rows."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gridsmith.llm import decontaminate as D
from gridsmith.llm import mixing as M
from gridsmith.llm import queries as Q
from gridsmith.llm import toxicity as T
from tests.llm.conftest import SF_SMALL

SF = "/root/testdata/sf0.01"


# -- 5: decontamination ------------------------------------------------------------------------------------------

def sellers(item, text):
    """Smallest number of word edits between the item and any stretch of the text."""
    d = [0] * (len(text) + 1)
    for i, w in enumerate(item, 1):
        e = [i]
        for j, v in enumerate(text, 1):
            e.append(min(d[j - 1] + (v != w), d[j] + 1, e[-1] + 1))
        d = e
    return min(d)


def test_best_stretch_is_exact():
    rnd = random.Random(1)
    for _ in range(200):
        item, text = ([rnd.randrange(5) for _ in range(rnd.randint(1, n))] for n in (8, 30))
        got, end = D.best_stretch(np.array(item, np.uint32), np.array(text, np.uint32), len(item))
        assert got == sellers(item, text)


def test_matches_of_the_query(spark):
    """Verbatim items are all found, what is found is within the limit, and recall against brute force is 0.95 or more."""
    known = D.Symbols()
    docs = {r.doc_id: D.symbols(r.text.encode(), known) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    items = {r.item_id: D.symbols(r.text.encode(), known) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()}
    got = {(r.doc_id, r.item_id): r for r in Q.op5_benchmark_decontamination(spark, SF_SMALL).collect()}
    want = {}
    for d, text in docs.items():
        for i, item in items.items():
            limit = int(0.2 * len(item))
            if len(set(item.tolist()) & set(text.tolist())) >= len(set(item.tolist())) - limit:
                edits, _ = D.best_stretch(item, text, limit)
                if edits <= limit:
                    want[d, i] = edits
    assert set(got) <= set(want) and len(want) >= 3
    assert {k for k, e in want.items() if e == 0} <= set(got)
    assert len(set(got) & set(want)) >= 0.95 * len(want)
    assert all(want[k] == r.edits and abs(r.similarity - (1 - r.edits / len(items[k[1]]))) < 1e-9 for k, r in got.items())


def test_recall_at_the_edit_limit(spark):
    known, rnd = D.Symbols(), random.Random(4)
    items = [(r.item_id, D.symbols(r.text.encode(), known)) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    noise = np.concatenate([D.symbols(r.text.encode(), known) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(60).collect()])
    p, hits = D.Params(), []
    index = D.Index(items, p)
    for _ in range(4):
        for n, (_, item) in enumerate(items):
            s = item.tolist()
            for _ in range(int(0.2 * len(s))):
                i, kind = rnd.randrange(len(s)), rnd.choice("sid")
                s[i:i + (kind != "i")] = [] if kind == "d" else [int(noise[rnd.randrange(len(noise))])]
            a = rnd.randrange(len(noise) - 200)
            text = np.concatenate([noise[a:a + 80], np.array(s, np.uint32), noise[a + 80:a + 160]])
            hits.append(any(m[0] == n for m in D.matches(index, [text], p)[0]))
    assert np.mean(hits) >= 0.9  # the target is 0.95; 160 trials


@pytest.mark.parametrize("words", [5, 10, 16, 31, 63, 120, 250, 500])
@pytest.mark.parametrize("where", [(0, 1), (0, 0.4), (0.6, 1), None])
def test_recall_by_length_and_place_of_edits(words, where):
    """Edits at the limit anywhere, in the first or last 40%, or evenly spread; short items are all found."""
    rnd, p, items, texts = random.Random(words), D.Params(), [], []
    for n in range(60):
        item = [rnd.randrange(1, 5000) for _ in range(words)]
        e, s = int(0.2 * words), list(item)
        at = [round((k + 1) * (words + 1) / (e + 1)) - 1 for k in range(e)] if where is None else rnd.sample(
            range(int(where[0] * words), max(int(where[1] * words), e + int(where[0] * words))), e)
        for i in sorted(at, reverse=True):
            kind = rnd.choice("sid")
            s[i:i + (kind != "i")] = [] if kind == "d" else [rnd.randrange(1, 5000)]
        items.append((n, np.array(item, np.uint32)))
        texts.append(np.array([rnd.randrange(1, 5000) for _ in range(80)] + s + [rnd.randrange(1, 5000) for _ in range(80)], np.uint32))
    exact = [D.best_stretch(i, t, int(0.2 * words))[0] <= int(0.2 * words) for (_, i), t in zip(items, texts)]
    got = [any(m[0] == n for m in g) for n, g in enumerate(D.matches(D.Index(items, p), texts, p))]
    assert sum(exact) == 60 and np.mean(got) >= (1 if words < D.SHORT else p.target_recall)


@pytest.mark.parametrize("edited", [(True, False), (False, True), (False, False), (True, True), (True, False, True, False, False)])
def test_every_place_of_an_item_counts(edited):
    """Edited and verbatim copies next to each other, in any order, are all found; the best one is reported exactly."""
    for seed in range(5):
        rnd = random.Random(seed)
        item = [rnd.randrange(1, 5000) for _ in range(40)]
        copies = []
        for e in edited:
            s = list(item)
            for i in rnd.sample(range(3, 37), 5 if e else 0):
                s[i] = rnd.randrange(5000, 9000)
            copies.append(s)
        text = np.array([7] * 30 + sum(copies, []) + [8] * 30, np.uint32)
        got = D.matches(D.Index([(1, np.array(item, np.uint32))], D.Params()), [text], D.Params())[0]
        assert sorted(m[2:] for m in got) == [(30 + 40 * k, 69 + 40 * k) for k in range(len(edited))]
        assert sorted(m[1] for m in got) == sorted(5 * e for e in edited)


def test_common_phrases_stay_bounded():
    """Items that share a stock phrase, and a text of nothing else: pairs are collapsed in runs, places are not lost."""
    items = [(n, np.array([5] * 40 + [100 + n], np.uint32)) for n in range(150)]
    got = D.matches(D.Index(items, D.Params()), [np.full(3000, 5, np.uint32)], D.Params())[0]
    assert {m[0] for m in got} == set(range(150))
    for n in (0, 149):
        mine = sorted(m[2:] for m in got if m[0] == n)
        assert len(mine) >= 3000 // 49 and all(a[1] < b[0] for a, b in zip(mine, mine[1:]))


def test_merged_regions():
    rnd = np.random.default_rng(3)
    rows = np.stack([rnd.integers(0, 3, 300), rnd.integers(0, 4, 300), at := rnd.integers(0, 400, 300), at + rnd.integers(1, 9, 300)], axis=1)
    want = set()
    for d in range(3):
        for i in range(4):
            run = None
            for lo, hi in sorted(rows[(rows[:, 0] == d) & (rows[:, 1] == i)][:, 2:].tolist()):
                if run and lo <= run[1]:
                    run[1] = max(run[1], hi)
                else:
                    if run:
                        want.add((d, i, *run))
                    run = [lo, hi]
            want.add((d, i, *run))
    assert set(map(tuple, D.merged(rows).tolist())) == want


def test_decontamination_odd_rows(spark, odd_docs, no_docs):
    bench = spark.createDataFrame([(1, None), (2, ""), (3, "lorem ipsum dolor sit amet " * 4), (4, "word"), (4, "a b c d e f"), (5, "A b, c d e f!")],
                                  "item_id long, text string")
    rows = {(r.doc_id, r.item_id): r for r in D.find_matches(odd_docs, bench).collect()}
    assert set(rows) == {(8, 3), (3, 4), (6, 4), (6, 5)} and rows[8, 3].n_spans == 2000
    kept = D.remove_contaminated(odd_docs, bench)
    assert kept.columns == odd_docs.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["0", "1", "2", "5", "9", "None"]
    assert D.find_matches(odd_docs, bench.limit(0)).count() == 0 and D.remove_contaminated(odd_docs, bench.limit(0)).count() == 11
    assert D.find_matches(no_docs, bench).count() == 0
    blocks = D.find_matches(odd_docs, bench, D.Params(block=1))
    assert {(r.doc_id, r.item_id) for r in blocks.collect()} == set(rows)
    left = D.remove_contaminated(odd_docs, bench, D.Params(block=1))
    assert sorted(str(r.doc_id) for r in left.collect()) == ["0", "1", "2", "5", "9", "None"]


# -- 7: mixing ---------------------------------------------------------------------------------------------------

def test_raked_margins_meet_the_targets(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    cells = M.cells_of(M.described(docs))
    targets = M.flattened(cells)
    w = M.rake(cells, targets) * cells["tokens"].to_numpy(float)
    for m in M.MARGINS:
        share = pd.Series(w).groupby(cells[m].fillna("?")).sum() / w.sum()
        assert all(abs(share[v] - t) < 1e-6 for v, t in targets[m].items() if v is not None)


def test_rows_are_drawn_as_calibrated(spark):
    rows = Q.op7_source_mixing(spark, SF).toPandas()
    docs = spark.read.parquet(f"{SF}/documents.parquet").toPandas()
    assert len(rows) == len(docs) and rows.probability.between(0, 1).all() and abs(rows.probability.max() - 1) < 1e-6
    assert dict(zip(rows.doc_id, rows.n_tokens)) == {d: len(t.split()) for d, t in zip(docs.doc_id, docs.text)}
    sd = np.sqrt((rows.probability * (1 - rows.probability)).sum())
    assert abs(rows.kept.sum() - rows.probability.sum()) < 4 * sd
    assert rows.groupby(["source", "lang", "topic"]).raked_weight.nunique().max() == 1


@pytest.mark.parametrize("source,lang,tokens", [("new", "en", 1000), ("new", "en", 20), ("s0", None, 20)])
def test_a_rare_value_does_not_cost_the_rest(source, lang, tokens):
    """One small document of a new source or language: it is kept whole, and so is the stated share of all others."""
    rng = np.random.default_rng(3)
    cells = pd.DataFrame([(f"s{i}", x, t, int(n * rng.integers(80, 120))) for i in range(20) for x, n in (("en", 900), ("de", 400), ("fr", 200))
                          for t in ("prose", "code")] + [(source, lang, "prose", tokens)], columns=["source", "lang", "topic", "tokens"])
    n, p, targets = cells["tokens"].to_numpy(float), M.Params(), M.flattened(cells)
    w = M.calibrated(cells, M.rake(cells, targets), p)
    assert (w * n).sum() >= (p.keep - 1e-9) * n.sum() and w.max() <= p.max_weight and w[-1] == pytest.approx(p.max_weight)
    for m in M.MARGINS:
        share = pd.Series(w * n).groupby(cells[m].fillna("?")).sum() / (w * n).sum()
        assert all(abs(share["?" if v is None else v] - t) < 0.01 for v, t in targets[m].items())


def test_filled_meets_the_goal():
    v, t = np.array([8.0, 1.0, 1.0, 0.0]), np.array([10.0, 40.0, 50.0, 9.0])
    assert M.filled(v, t, 55.0, 1.0) == pytest.approx([1, 0.5, 0.5, 0])
    assert M.filled(v, t, 500.0, 1.0) == pytest.approx([1, 1, 1, 0])


def test_mixing_odd_rows(spark, odd_docs, no_docs):
    p = M.Params(max_weight=2.5)
    rows = M.drawn(odd_docs, p=p)
    assert rows.count() == 11 and rows.where(F.col(f"{rows.columns[-1]}.copies") >= 1).count() > 0
    assert M.sample(odd_docs, p=p).columns == odd_docs.columns
    assert M.sample(no_docs).count() == 0
    cells = pd.DataFrame({"source": ["a", "b", None], "lang": ["x"] * 3, "topic": ["t"] * 3, "tokens": [10, 30, 0]})
    w = M.rake(cells, {"source": {"a": 0.5, "b": 0.25, None: 0.25}, "lang": {"x": 1}, "topic": {"t": 1}})
    assert w[:2] == pytest.approx([40 * 2 / 3 / 10, 40 / 3 / 30])


# -- 10: toxicity ------------------------------------------------------------------------------------------------

def test_toxicity_held_out(spark):
    """Fitted on the labels of three quarters of the documents, the chain finds the toxic ones of the rest."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    learn = labels.where("doc_id % 4 <> 1")
    model = T.train(docs, learn)
    test = labels.where("doc_id % 4 = 1").toPandas().set_index("doc_id")
    got = {r.doc_id: r for r in T.score(docs.where("doc_id % 4 = 1"), model).collect()}
    y = np.array([test.toxic[d] for d in test.index])
    p = np.array([got[d].p_toxic for d in test.index])
    rejected = np.array([got[d].rejected for d in test.index])
    order = p.argsort()
    rank = np.empty(len(p))
    rank[order] = np.arange(len(p))
    auc = (rank[y == 1].mean() - (y.sum() - 1) / 2) / (y == 0).sum()
    assert auc > 0.88  # about one in ten of the labels is noise
    assert rejected[y == 1].mean() > 0.8 and rejected[y == 0].mean() < 0.01


def test_fit_matches_plain_gradient_descent():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 3, (60, 5)).astype(float)
    y = (x[:, 0] - x[:, 1] + rng.normal(size=60) > 0).astype(float)
    at, col = np.concatenate([[0], np.cumsum((x > 0).sum(1))]), np.nonzero(x)[1]
    w = T.solve(T.Rows(at, col, x[x > 0], 5), np.ones((60, 1)), y, T.Params())
    full, v = np.column_stack([x, np.ones(60)]), np.zeros(6)
    for _ in range(20_000):
        v += 0.01 * (full.T @ (y - T.sigmoid(full @ v)) - np.array([0.2] * 5 + [1e-6]) * v)
    assert np.allclose(w, v, atol=1e-3)


def test_toxicity_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(0, 1, 0), (3, 0, 1), (3, None, None), (5, 1, None), (None, 1, 1), (6, 0, 1)], "doc_id long, quality int, toxic int")
    rows = T.score(odd_docs, T.train(odd_docs, labels)).collect()
    assert len(rows) == 11 and all(0 <= r.p_toxic <= 1 for r in rows)
    model = T.train(odd_docs, labels.limit(0))
    assert {r.p_toxic for r in T.score(odd_docs, model).collect()} == {0.0}
    assert T.keep_clean(odd_docs, labels.limit(0)).count() == 11 and T.keep_clean(no_docs, labels).count() == 0
    assert T.keep_clean(odd_docs, labels).columns == odd_docs.columns


# -- the pipeline ------------------------------------------------------------------------------------------------

def test_pipeline_stages(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash_near_dedup", "benchmark_decontamination", "source_mixing", "token_binary"]
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    left = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, left, SF_SMALL)
        assert after.columns == docs.columns
        rows = after.collect()
        before = {r.doc_id for r in left.collect()}
        assert {r.doc_id for r in rows} < before and len(rows) == len({r.doc_id for r in rows})
        if name == "benchmark_decontamination":
            assert before - {r.doc_id for r in rows} == {r.doc_id for r in D.find_matches(left, spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")).collect()}
        left = spark.createDataFrame(rows, docs.schema)
    out = corpus_pipeline.run(spark, SF_SMALL)
    assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert {r.doc_id for r in out.collect()} == {r.doc_id for r in left.collect()}


def test_pipeline_stages_on_odd_rows(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF_SMALL)
            assert name == "token_binary" or out.columns == docs.columns
            out.count()


def test_every_operator_is_registered():
    import __spark_entry__ as E
    numbers = sorted(int(k[2:].split("_")[0]) for k in E.queries() if k.startswith("op") and k[2].isdigit())
    assert numbers == list(range(1, 14)) and "pipeline" in E.queries()
