"""Plan-shape checks: column pruning and filter pushdown reach the scan,
small lookups are broadcast, aggregates are partial (map-side)."""

import __spark_entry__ as E
from tests.conftest import SF_SMALL


def _plan(df) -> str:
    jvm = df.sparkSession._jvm
    return jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_histogram_reads_two_columns(spark):
    p = _plan(E.queries()["class_histogram"](spark, SF_SMALL))
    assert "ReadSchema: struct<p_partkey:bigint,p_size:int>" in p
    assert p.count("HashAggregate") >= 2  # partial + final


def test_layer_query_pushes_time_and_bbox(spark):
    p = _plan(E.queries()["layer_query"](spark, SF_SMALL))
    assert "GreaterThanOrEqual(instant" in p and "LessThanOrEqual(gx" in p


def test_polygon_spans_broadcast(spark):
    p = _plan(E.queries()["mask_polygon"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in p and "LeftSemi" in p


def test_mosaic_single_aggregate_no_window(spark):
    p = _plan(E.queries()["mosaic_bright"](spark, SF_SMALL))
    assert "Window" not in p and "max_by" in p


def test_tile_mask_broadcasts_spans_and_runs_numpy(spark):
    p = _plan(E.queries()["mask_polygon_tiles"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in p and "MapInPandas" in p


def test_flagship_semi_joins_imagery_to_broadcast_pixels(spark):
    p = _plan(E.entry(spark))
    assert "BroadcastHashJoin LeftSemi" in p
    assert "ReadSchema: struct<p_partkey:bigint,p_size:int>" in p
