"""Packed products against plain ones, mining against a brute-force version over all rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridsmith.llm import hard_negatives as H
from gridsmith.llm.queries import QUERIES, ORACLE_SQL

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("low,high,wide", [(-256, 255, False), (0, 3, False), (-2**24, 2**24, True), (5, 5, False), (-7, -2, False)])
def test_scores_are_exact(low, high, wide):
    rng = np.random.default_rng(3)
    rows, anchors = rng.integers(low, high + 1, (131, 64)), rng.integers(low, high + 1, (17, 64))
    packed = H.Packed(rows, anchors)
    assert packed.wide == wide and packed.fields >= (1 if wide else 2)
    assert (packed.scores(anchors) == anchors @ rows.T).all()


def test_many_fields_in_wide_integers():
    packed = H.Packed(np.full((130, 64), 2**24), np.full((2, 64), -2**24))
    assert (packed.scores(np.full((2, 64), -2**24)) == -64 * 2**48).all()


def brute(rows, p):
    """rows: (vec_id, label, vec of ints, is_anchor)."""
    out = []
    for x, (a, label, v, is_anchor) in enumerate(rows):
        if not is_anchor:
            continue
        score = [(sum(i * j for i, j in zip(v, w)), i, lab, y) for y, (i, lab, w, _) in enumerate(rows)]
        pos = sorted((-s, i) for s, i, lab, y in score if lab == label and y != x)[:p.positives]
        for ps, pi in pos:
            neg = sorted((-s, i) for s, i, lab, _ in score if lab != label and p.low * -ps <= 100 * s <= p.high * -ps)
            out += [(a, pi, k, ni, -ps, -ns) for k, (ns, ni) in enumerate(neg[:p.negatives], 1)]
    return sorted(out)


@pytest.mark.parametrize("p", [H.Params(), H.Params(positives=2, negatives=3, anchor_block=3, row_block=7, scores=50)])
def test_against_brute_force(spark, p):
    """Few different vectors, so scores tie; one label has a third of the rows; ids repeat; vectors differ in length."""
    rng = np.random.default_rng(7)
    rows = [(int(i % 90), int(0 if i % 3 else i % 4), [int(x) for x in rng.integers(-3, 4, 5 if i % 10 else 3)], i % 9 == 0) for i in range(120)]
    df = spark.createDataFrame(rows, "vec_id long, label int, vec array<int>, asked boolean").repartition(4)
    got = sorted(map(tuple, H.mine(df, F.col("asked"), p).collect()))
    assert got == brute(rows, p) and len(got) > 50


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    good = [(i, i % 2, [0.5 - 0.3 * (i % 2), 0.25 * (i % 3)]) for i in range(8)]
    odd = [(None, 0, [1.0, 1.0]), (100, None, [1.0, 1.0]), (200, 0, None), (300, 0, [1.0, None]), (400, 0, [nan, 1.0]),
           (500, 1, [inf, 1.0]), (600, 1, []), (700, 1, [1e30, 0.0])]
    def mined(rows):
        df = spark.createDataFrame(rows, "vec_id long, label int, v array<double>").withColumn("vec", H.scaled("v", 256)).withColumn("row", F.lit(1))
        return sorted(map(tuple, H.mine(df, F.col("vec_id") % 100 == 0).collect()))
    assert mined(good + odd) == mined(good) != []
    assert mined(odd) == []
    assert H.mine(spark.createDataFrame([], "vec_id long, label int, vec array<int>"), F.lit(True)).count() == 0


def test_query_against_sql(spark):
    import duckdb
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from read_parquet('{SF}/embeddings.parquet')")
    want = sorted(con.execute(ORACLE_SQL["op13_hard_negatives"]).fetchall())
    df = QUERIES["op13_hard_negatives"](spark, SF)
    assert df.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, df.collect())) == want and want
