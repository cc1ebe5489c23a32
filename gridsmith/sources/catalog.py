"""Layer catalog on Parquet: write, read, query, upsert, metadata.

Layout: ``<root>/layer=<name>/zoom=<z>/written=<id>[/ym=<yyyymm>]/part-*.parquet``; rows are
range-partitioned and sorted by a Z-order key so Parquet min/max statistics
skip files for spatial queries.

A write never touches files that a reader may see.  It makes a folder of its own and then adds the next version of
the layer's manifest, ``<root>/_manifest/layer=<name>/zoom=<z>/v<number>.json``, by one rename that fails if another writer took the
number.  A version lists the layer's parts (one a month, or one in all): their folder, and the metadata of what was
written there (counts, key bounds, extent), read back from the files.  Layer metadata are an aggregate of those rows, so data and
metadata cannot part: a job that dies before the rename leaves the version before it whole.  (A store whose rename is no
single step, as some object stores', gives this for one writer at a time only.)  ``drop_old_versions`` frees what no
manifest needs any more.
"""

from __future__ import annotations

import json
import math
import re
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridsmith.functions.grid import days_since_epoch, morton_sql, ntz, tile_of
from gridsmith.operators import polygon
from gridsmith.session import cut_lineage

META_COLS = ["layer", "zoom", "tile_size", "cell_type", "nodata", "col_min", "col_max", "row_min", "row_max",
             "instant_min", "instant_max", "cells", "crs", "x_min", "y_min", "x_max", "y_max"]
#: What all batches of one layer and zoom must agree in.
FIXED_META = {"tile_size": "int", "cell_type": "string", "nodata": "int", "crs": "string"}
#: Columns of the stored files that are no columns of the layer.
STORED_ONLY = ["layer", "zoom", "written", "ym", "zkey"]
MANIFEST = ("layer string, zoom int, tile_size int, cell_type string, nodata int, col_min long, col_max long, row_min long, row_max long, "
            "instant_min timestamp_ntz, instant_max timestamp_ntz, cells long, crs string, x_min double, y_min double, x_max double, "
            "y_max double, version long, ym int, written string, columns string")
JSON_TIME = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def _tile_keys(df: DataFrame, tile_size: int):
    """(col, row) of each row: from the pixel key at cell grain, as stored
    at tile grain (``col``/``row`` + an array of cells)."""
    if "gx" in df.columns:
        return tile_of("gx", tile_size), tile_of("gy", tile_size)
    return F.col("col"), F.col("row")


def with_zkey(df: DataFrame, tile_size: int) -> DataFrame:
    """Z-order key of the tile (3-D with days for space-time layers)."""
    col, row = _tile_keys(df, tile_size)
    keys, bits = {"_zcol": col, "_zrow": row}, 31
    if "instant" in df.columns:
        keys, bits = keys | {"_zday": F.greatest(days_since_epoch("instant"), F.lit(0))}, 21
    return df.withColumns(keys).withColumn("zkey", F.expr(morton_sql(list(keys), bits))).drop(*keys)


def layer_meta(df: DataFrame, layer: str, zoom: int, tile_size: int, cell_type: str, nodata, grid=None,
               by: tuple[str, ...] = ()) -> DataFrame:
    """Collect layer metadata in one aggregate (D10).  ``cells`` counts the
    rows written (cells, or tiles for a tile-grain layer); merged metadata
    (D11) adds the batches' counts.  ``grid`` (a ``rasters.Grid``) gives the
    CRS and the extent of the key bounds; without one they are null.  ``by``:
    columns whose groups get a row each."""
    has_t = "instant" in df.columns
    col, row = _tile_keys(df, tile_size)
    aggs = [F.min(col).alias("col_min"), F.max(col).alias("col_max"), F.min(row).alias("row_min"),
            F.max(row).alias("row_max"),
            (F.min("instant") if has_t else F.lit(None).cast("timestamp_ntz")).alias("instant_min"),
            (F.max("instant") if has_t else F.lit(None).cast("timestamp_ntz")).alias("instant_max"),
            F.count("*").alias("cells")]
    m = df.groupBy(*by).agg(*aggs)
    side = None if grid is None else F.lit(grid.cell * tile_size)
    extent = {"x_min": lambda: F.lit(grid.x0) + F.col("col_min") * side, "y_min": lambda: F.lit(grid.y0) - (F.col("row_max") + 1) * side,
              "x_max": lambda: F.lit(grid.x0) + (F.col("col_max") + 1) * side, "y_max": lambda: F.lit(grid.y0) - F.col("row_min") * side}
    return m.select(F.lit(layer).alias("layer"), F.lit(zoom).alias("zoom"), F.lit(tile_size).alias("tile_size"),
                    F.lit(cell_type).alias("cell_type"), F.lit(nodata).cast("int").alias("nodata"), *m.columns,
                    F.lit(grid.crs if grid else None).cast("string").alias("crs"),
                    *[(f() if grid else F.lit(None)).cast("double").alias(c) for c, f in extent.items()])


def merge_meta(a: DataFrame, b: DataFrame) -> DataFrame:
    """Merge metadata rows of the same layer/zoom: bounds and extent union
    (D11).  Batches that differ in tile size, cell type, NoData or CRS raise
    when the result is read; a null says nothing and agrees with any."""
    return _merged(a.unionByName(b))


def _merged(rows: DataFrame) -> DataFrame:
    def same(c: str, kind: str):
        differs = F.concat(F.lit(f"batches of a layer differ in {c}: "), F.min(c).cast("string"), F.lit(", "), F.max(c).cast("string"))
        return F.when(F.min(c) != F.max(c), F.raise_error(differs).cast(kind)).otherwise(F.max(c)).alias(c)

    return rows.groupBy("layer", "zoom").agg(
        *[same(c, kind) for c, kind in FIXED_META.items()], F.min("col_min").alias("col_min"), F.max("col_max").alias("col_max"),
        F.min("row_min").alias("row_min"), F.max("row_max").alias("row_max"),
        F.min("instant_min").alias("instant_min"), F.max("instant_max").alias("instant_max"),
        F.sum("cells").alias("cells"), F.min("x_min").alias("x_min"), F.min("y_min").alias("y_min"),
        F.max("x_max").alias("x_max"), F.max("y_max").alias("y_max"))


def time_bucket(instant) -> Column:
    """Month bucket ``yyyymm`` of an instant: the catalog's time partition."""
    c = F.col(instant) if isinstance(instant, str) else instant
    return (F.year(c) * 100 + F.month(c)).cast("int")


def _folder(layer: str, zoom: int) -> str:
    if not re.fullmatch(r"[\w.-]+", layer):
        raise ValueError(f"layer names are letters, digits, '_', '.' and '-': {layer!r}")
    return f"layer={layer}/zoom={zoom}"


def read_manifest(spark: SparkSession, root: str) -> DataFrame:
    """The parts of the last version of every layer and zoom: one row a part."""
    m = spark.read.schema(MANIFEST).options(**JSON_TIME).json(root + "/_manifest")
    last = F.max("version").over(Window.partitionBy("layer", "zoom"))
    return m.withColumn("_last", last).where("version = _last").select(*T.StructType.fromDDL(MANIFEST).names)


def _parts(spark: SparkSession, root: str, layer: str, zoom: int) -> list[Row]:
    """A layer's parts (months, so a bounded number of rows); none if the layer or the catalog does not exist.  Any other error is
    raised, never taken for a missing layer."""
    try:
        return read_manifest(spark, root).where((F.col("layer") == layer) & (F.col("zoom") == zoom)).collect()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return []


def _manifest_rows(spark: SparkSession, parts: list[Row]) -> DataFrame:
    return spark.createDataFrame(parts, T.StructType.fromDDL(MANIFEST))


def _store(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _switch(spark: SparkSession, root: str, layer: str, zoom: int, version: int, parts: list[Row]) -> None:
    """Make ``parts`` what readers of the layer see: a hidden file is renamed to the version's name."""
    rows = _manifest_rows(spark, parts).withColumn("version", F.lit(version).cast("long"))
    lines = [r[0] for r in rows.select(F.to_json(F.struct("*"), JSON_TIME)).collect()]
    folder = f"{root}/_manifest/{_folder(layer, zoom)}"
    fs, draft = _store(spark, f"{folder}/.{uuid.uuid4().hex}")
    _, final = _store(spark, f"{folder}/v{version:010d}.json")
    out = fs.create(draft, False)
    out.write("\n".join(lines).encode())
    out.close()
    if fs.exists(final) or not fs.rename(draft, final):
        fs.delete(draft, False)
        raise RuntimeError(f"version {version} of layer {layer}, zoom {zoom} was written by another job meanwhile: read it and write again")


def write_layer(df: DataFrame, root: str, layer: str, zoom: int, tile_size: int, cell_type: str = "int32",
                nodata=0, partitions: int | None = None, grid=None) -> None:
    """Write one layer/zoom (A9), clustered by Z-order.  Space-time layers
    are also partitioned by month (``ym``): the months of ``df`` replace
    those stored, other months stay, so a monthly re-ingest rewrites one
    month.  A layer without time is replaced.  Metadata are those of the
    files written (D10), joined to the other months' (D11); a batch whose tile
    size, cell type, NoData or CRS differs from theirs raises, and the layer stays as it was."""
    _write(df, root, layer, zoom, tile_size, cell_type, nodata, partitions, grid, _parts(df.sparkSession, root, layer, zoom))


def _write(df: DataFrame, root: str, layer: str, zoom: int, tile_size: int, cell_type: str, nodata, partitions, grid,
           old: list[Row]) -> None:
    """``old``: the parts of the version that ``df`` was made for.  The new version is the next one."""
    spark, timed = df.sparkSession, "instant" in df.columns
    written = "w" + uuid.uuid4().hex
    path = f"{root}/{_folder(layer, zoom)}/written={written}"
    out = with_zkey(df, tile_size)
    if timed:
        out = out.withColumn("ym", time_bucket("instant"))
    # Range bounds over (zkey, gy, gx[, instant]): a hot tile holding a third
    # of all cells still spreads over many write tasks instead of one.
    order = (["zkey", "gy", "gx"] if "gx" in df.columns else ["zkey", "row", "col"]) + (["instant"] if timed else [])
    # Without an explicit count AQE sizes the range partitions (advisory
    # ~128 MB), so file sizes follow the data instead of a fixed number.
    ranged = out.repartitionByRange(partitions, *order) if partitions else out.repartitionByRange(*order)
    (ranged.sortWithinPartitions(*order).write.partitionBy(*(["ym"] if timed else [])).parquet(path))

    fields = [*out.drop("ym").schema.fields, *([T.StructField("ym", T.IntegerType())] if timed else [])]
    stored, version = spark.read.schema(T.StructType(fields)).parquet(path), old[0]["version"] + 1 if old else 1

    def described(by: tuple[str, ...], folder: str | None) -> list[Row]:
        meta = layer_meta(stored, layer, zoom, tile_size, cell_type, nodata, grid, by)
        return meta.select(*META_COLS, F.lit(version).cast("long").alias("version"), *(by or [F.lit(None).cast("int").alias("ym")]),
                           F.lit(folder).cast("string").alias("written"), F.lit(json.dumps(df.schema.jsonValue())).alias("columns")).collect()

    new = described(("ym",) if timed else (), written) or described((), None)  # no month at all: the layer exists and is empty
    replaced = {r["ym"] for r in new if r["written"]}
    kept = [r for r in old if timed and r["written"] and r["ym"] not in replaced]
    if kept:
        new = [r for r in new if r["written"]]
        _merged(_manifest_rows(spark, [*new, *kept]).select(*META_COLS)).collect()  # raises if they differ
    _switch(spark, root, layer, zoom, version, [*new, *kept])


def drop_old_versions(spark: SparkSession, root: str, layer: str, zoom: int) -> int:
    """Delete the manifests before the last one and the folders that it does not name; their number.  For times without a
    writer, and without a reader of an earlier version."""
    parts = _parts(spark, root, layer, zoom)
    if not parts:
        return 0
    needed = {f"written={r['written']}" for r in parts} | {f"v{parts[0]['version']:010d}.json"}
    dropped = 0
    for folder in (f"{root}/{_folder(layer, zoom)}", f"{root}/_manifest/{_folder(layer, zoom)}"):
        fs, p = _store(spark, folder)
        if fs.exists(p):
            for f in fs.listStatus(p):
                name = f.getPath().getName()
                if re.fullmatch(r"written=w\w+|v\d+\.json|\.\w{32}", name) and name not in needed:
                    dropped += bool(fs.delete(f.getPath(), True))
    return dropped


def read_meta(spark: SparkSession, root: str) -> DataFrame:
    """One metadata row per layer and zoom: the aggregate of its parts' rows."""
    return _merged(read_manifest(spark, root)).select(*META_COLS)


def layer_exists(spark: SparkSession, root: str, asked: DataFrame) -> DataFrame:
    """``asked(layer, zoom)`` + ``exists`` flag from the metadata."""
    meta = read_meta(spark, root).select("layer", "zoom", F.lit(True).alias("exists"))
    return asked.join(meta, ["layer", "zoom"], "left").select("layer", "zoom", F.coalesce("exists", F.lit(False)).alias("exists"))


def _scan(spark: SparkSession, root: str, layer: str, zoom: int, keep=lambda part: True) -> DataFrame:
    """The stored rows of a layer's parts, with their partition columns."""
    parts = _parts(spark, root, layer, zoom)
    if not parts:
        raise LookupError(f"no layer {layer!r} at zoom {zoom} in {root}")
    columns = T.StructType.fromJson(json.loads(parts[0]["columns"]))
    base = f"{root}/{_folder(layer, zoom)}"
    month = (lambda m: f"/ym={'__HIVE_DEFAULT_PARTITION__' if m is None else m}") if "instant" in columns.names else lambda m: ""
    paths = [f"{base}/written={r['written']}{month(r['ym'])}" for r in parts if r["written"] and keep(r)]
    if not paths:
        return spark.createDataFrame([], columns)
    return spark.read.schema(columns).option("basePath", base).parquet(*paths)


def _layer(df: DataFrame) -> DataFrame:
    return df.drop(*STORED_ONLY)


def read_layer(spark: SparkSession, root: str, layer: str, zoom: int, months: list[int] | None = None) -> DataFrame:
    """Layer scan by (name, zoom) (A1): the folders that the last version
    names, with the layer's own columns; a layer that does not exist raises
    LookupError.  ``months`` opens only those month parts of a space-time layer."""
    return _layer(_scan(spark, root, layer, zoom, lambda r: months is None or r["ym"] in months))


def query_layer(spark: SparkSession, root: str, layer: str, zoom: int, tile_size: int, edges: DataFrame | None = None,
                time_range=None, centres: bool = False) -> DataFrame:
    """Layer query (A2): zoom + time range + polygon; returns *whole tiles*
    that intersect the polygon (no cell masking); with ``centres`` only those
    with a cell centre inside.  The polygon's bounding
    box becomes literal ``gx/gy BETWEEN`` predicates, which Parquet min/max
    statistics use to skip row groups; the exact tile test is a semi join."""
    keep, c0, r0, c1, r1 = [], None, None, None, None
    if time_range is not None:
        t0, t1 = time_range
        # months outside the range are never opened
        keep.append(lambda p: p["ym"] is None or t0.year * 100 + t0.month <= p["ym"] <= t1.year * 100 + t1.month)
    if edges is not None:
        b = polygon.polygon_bounds(edges).agg(F.min("xmin").alias("x0"), F.min("ymin").alias("y0"),
                                              F.max("xmax").alias("x1"), F.max("ymax").alias("y1")).first()
        if b["x0"] is None:
            return read_layer(spark, root, layer, zoom).limit(0)
        n = tile_size
        # Boxes are closed: a bound on a tile's border belongs to the tile before it as well.
        c0, r0, c1, r1 = math.ceil(b["x0"] / n) - 1, math.ceil(b["y0"] / n) - 1, int(b["x1"] // n), int(b["y1"] // n)
        # nor are parts whose key bounds miss the box
        keep.append(lambda p: p["col_min"] is not None and p["col_min"] <= c1 and p["col_max"] >= c0 and p["row_min"] <= r1 and p["row_max"] >= r0)
    df = _layer(_scan(spark, root, layer, zoom, lambda p: all(k(p) for k in keep)))
    if time_range is not None:
        df = df.where(F.col("instant").between(ntz(t0), ntz(t1)))
    if edges is not None:
        within = polygon.tiles_intersecting if centres else polygon.tiles_touched
        if "gx" in df.columns:  # cell grain: pixel bbox literals, then the exact tile test
            df = df.where(F.col("gx").between(c0 * n, (c1 + 1) * n - 1) & F.col("gy").between(r0 * n, (r1 + 1) * n - 1))
            keyed = df.withColumn("col", tile_of("gx", n)).withColumn("row", tile_of("gy", n))
            df = within(keyed, edges, n).drop("col", "row")
        else:  # tile grain: key bbox literals
            df = df.where(F.col("col").between(c0, c1) & F.col("row").between(r0, r1))
            df = within(df, edges, n)
    return df


def upsert_layer(new: DataFrame, root: str, layer: str, zoom: int, tile_size: int, keys: list[str],
                 cell_type: str = "int32", nodata=0, grid=None) -> None:
    """Create the layer, or write the new rows over existing keys and merge
    the metadata (A10).  Old and new rows are unioned with a batch tag and
    the newest batch wins per key (``max_by``, partial-aggregated); of rows
    with one key in one batch the one with the largest hash of its values
    wins, on the create path too.  The merged result is checkpointed to the
    shared folder and written beside what it was read from; the next version
    of the manifest then names it, so a replay changes nothing, and a job that
    dies, or meets another writer, leaves the layer as it was.  Only a missing
    catalog or layer counts as none: any other error on reading the manifest
    is raised, never taken as leave to overwrite."""
    spark = new.sparkSession
    old = _parts(spark, root, layer, zoom)
    vals = [c for c in new.columns if c not in keys]

    def one_per_key(rows: DataFrame) -> DataFrame:
        order = F.struct("_batch", F.xxhash64(*vals)) if vals else F.struct("_batch")
        return rows.groupBy(*keys).agg(F.max_by(F.struct(*vals, "_batch"), order).alias("_v")).select(*keys, "_v.*").drop("_batch")

    rows = new.withColumn("_batch", F.lit(1))
    if old:
        months = None
        if "instant" in new.columns:
            # The months this batch touches: a handful of values, not data.
            months = [r[0] for r in new.select(time_bucket("instant")).distinct().collect()]
        stored = read_layer(spark, root, layer, zoom, months)
        rows = stored.select(*keys, *vals, F.lit(0).alias("_batch")).unionByName(new.select(*keys, *vals, F.lit(1).alias("_batch")))
        merge_meta(_manifest_rows(spark, old).select(*META_COLS),
                   layer_meta(new.limit(0), layer, zoom, tile_size, cell_type, nodata, grid)).collect()  # raises before any work
    _write(cut_lineage(one_per_key(rows)), root, layer, zoom, tile_size, cell_type, nodata, None, grid, old)
