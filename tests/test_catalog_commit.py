"""The catalog's versions: what a reader sees while, before and after a write fails, meets another one or succeeds."""

import datetime as dt
import glob

import pytest
from pyspark.sql import functions as F

from gridsmith.operators.rasters import Grid
from gridsmith.session import shared_dir
from gridsmith.sources import catalog as cat

KEYS = ["gx", "gy", "instant"]


def cells(spark, rows):
    return spark.createDataFrame(rows, "gx long, gy long, instant string, value int").withColumn("instant", F.col("instant").cast("timestamp_ntz"))


def state(spark, root, layer="l", zoom=1):
    return (sorted(map(repr, cat.read_layer(spark, root, layer, zoom).collect())),
            sorted(map(repr, cat.read_meta(spark, root).collect())))


JANUARY = [(i, 2 * i, "2001-01-05 10:00:00.000001", i) for i in range(20)]
FEBRUARY = [(i + 100, i, "2001-02-07", i) for i in range(30)]


@pytest.mark.parametrize("write", ["write_layer", "upsert_layer"])
def test_a_crash_between_data_and_manifest_leaves_the_old_version(spark, monkeypatch, write):
    root = shared_dir(spark, "crash")
    args = (root, "l", 1, 8) + ((KEYS,) if write == "upsert_layer" else ())
    getattr(cat, write)(cells(spark, JANUARY), *args)
    before = state(spark, root)
    changed = cells(spark, [(x, y, t, v + 1) for x, y, t, v in JANUARY] + FEBRUARY)
    with monkeypatch.context() as m:
        m.setattr(cat, "_switch", lambda *a: (_ for _ in ()).throw(OSError("the driver is gone")))
        with pytest.raises(OSError):
            getattr(cat, write)(changed, *args)
    assert state(spark, root) == before
    getattr(cat, write)(changed, *args)
    assert cat.read_layer(spark, root, "l", 1).count() == 50 and state(spark, root) != before
    assert cat.read_meta(spark, root).first()["cells"] == 50


def test_a_writer_that_read_an_older_version_fails(spark):
    root = shared_dir(spark, "race")
    cat.write_layer(cells(spark, JANUARY), root, "l", 1, 8)
    old = cat._parts(spark, root, "l", 1)
    cat.write_layer(cells(spark, FEBRUARY), root, "l", 1, 8)
    before = state(spark, root)
    with pytest.raises(RuntimeError, match="another job"):
        cat._write(cells(spark, FEBRUARY[:1]), root, "l", 1, 8, "int32", 0, None, None, old)
    assert state(spark, root) == before


def test_months_keep_or_replace_and_metadata_follow(spark):
    """Metadata are of what is stored, also where the keys that set a bound are replaced."""
    root, grid = shared_dir(spark, "months"), Grid(0.0, 0.0, 1.0, 8)
    cat.write_layer(cells(spark, JANUARY), root, "l", 1, 8, grid=grid)
    cat.write_layer(cells(spark, FEBRUARY), root, "l", 1, 8, grid=grid)
    m = cat.read_meta(spark, root).first()
    assert (m.cells, m.col_max, m.instant_min) == (50, 129 // 8, dt.datetime(2001, 1, 5, 10, 0, 0, 1))
    cat.write_layer(cells(spark, FEBRUARY[:3]), root, "l", 1, 8, grid=grid)
    m = cat.read_meta(spark, root).first()
    assert (m.cells, m.col_max, m.x_max, m.y_min) == (23, 102 // 8, 104.0, -40.0)
    assert cat.read_layer(spark, root, "l", 1, [200102]).count() == 3
    assert {r.ym: r.cells for r in cat.read_manifest(spark, root).collect()} == {200101: 20, 200102: 3}


@pytest.mark.parametrize("write", ["write_layer", "upsert_layer"])
def test_a_conflict_leaves_the_layer_as_it_was(spark, write):
    root = shared_dir(spark, "conflict")
    args = (KEYS,) if write == "upsert_layer" else ()
    getattr(cat, write)(cells(spark, JANUARY), root, "l", 1, 8, *args)
    before = state(spark, root)
    with pytest.raises(Exception, match="differ in tile_size"):
        getattr(cat, write)(cells(spark, FEBRUARY), root, "l", 1, 16, *args)
    assert state(spark, root) == before


def test_z_order_as_text(spark):
    from gridsmith.functions import grid as g
    df = spark.range(500).selectExpr("(id * 7919) % 65537 as x", "(id * 104729) % 2097152 as y", "id % 4000 as t")
    bad = df.where((F.expr(g.morton_sql(["x", "y"], 31)) != g.morton2("x", "y", 31)) | (F.expr(g.morton_sql(["x", "y", "t"], 21)) != g.morton3("x", "y", "t")))
    assert bad.count() == 0


def test_old_versions_are_dropped(spark):
    root = shared_dir(spark, "drop")
    for batch in (JANUARY, FEBRUARY, JANUARY[:5]):
        cat.upsert_layer(cells(spark, batch), root, "l", 1, 8, KEYS)
    before = state(spark, root)
    assert cat.drop_old_versions(spark, root, "l", 1) == 3  # two manifests, and the first January
    assert state(spark, root) == before and cat.drop_old_versions(spark, root, "l", 1) == 0
    assert len(glob.glob(f"{root}/layer=l/zoom=1/written=*")) == 2


def test_empty_missing_and_undated(spark):
    root = shared_dir(spark, "empty")
    cat.write_layer(cells(spark, []), root, "none", 1, 8)
    got = cat.read_layer(spark, root, "none", 1)
    assert got.count() == 0 and got.columns == ["gx", "gy", "instant", "value"]
    assert cat.read_meta(spark, root).first()["cells"] == 0
    cat.upsert_layer(cells(spark, [(1, 1, None, 4), (1, 1, "2001-01-05", 5), (1, 1, None, 3)]), root, "none", 1, 8, KEYS)
    cat.upsert_layer(cells(spark, FEBRUARY), root, "none", 1, 8, KEYS)
    assert cat.read_layer(spark, root, "none", 1).count() == 32 and cat.read_meta(spark, root).first()["cells"] == 32
    with pytest.raises(LookupError):
        cat.read_layer(spark, root, "none", 2)
    with pytest.raises(ValueError):
        cat.write_layer(cells(spark, FEBRUARY), root, "a/b", 1, 8)
    still = spark.createDataFrame([(1, 2, 3)], "gx long, gy long, value int")
    cat.write_layer(still, root, "still", 1, 8)
    cat.write_layer(still.withColumn("value", F.lit(9)), root, "still", 1, 8)
    assert [r.value for r in cat.read_layer(spark, root, "still", 1).collect()] == [9]
