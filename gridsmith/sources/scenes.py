"""Scene-list CSV and GeoJSON polygon sources (A3, A4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridsmith.operators.geometry import ring_to_edges

SCENE_CSV_SCHEMA = T.StructType([
    T.StructField("time", T.TimestampNTZType()), T.StructField("scene_id", T.StringType()),
    T.StructField("band", T.IntegerType()), T.StructField("path", T.StringType())])
SCENE_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def write_scene_csv(scenes: DataFrame, path: str) -> None:
    """Scene list as CSV with a header and quoted fields."""
    (scenes.select(F.date_format("time", SCENE_TIME_FORMAT).alias("time"), "scene_id", "band", "path")
        .write.mode("overwrite").option("header", True).option("quoteAll", True).csv(path))


def read_scene_csv(spark: SparkSession, path: str) -> DataFrame:
    """Header skipped, quotes stripped, time parsed as UTC wall time (A3)."""
    return (spark.read.schema(SCENE_CSV_SCHEMA).option("header", True)
            .option("timestampNTZFormat", SCENE_TIME_FORMAT).option("mode", "FAILFAST").csv(path))


#: Geometries are kept as JSON text and parsed by their type.
GEOJSON_SCHEMA = "id string, type string, geometry string, coordinates string, features array<struct<id:string,geometry:string>>"
_RINGS = "array<array<array<double>>>"


def write_geojson(edges_rings: DataFrame, path: str) -> None:
    """``(poly_id, ring)`` -> one GeoJSON FeatureCollection per line."""
    fc = edges_rings.select(
        F.col("poly_id").cast("string").alias("id"), F.lit("FeatureCollection").alias("type"),
        F.array(F.struct(F.lit("Feature").alias("type"),
                         F.struct(F.lit("Polygon").alias("type"), F.array("ring").alias("coordinates")).alias("geometry")))
        .alias("features"))
    fc.write.mode("overwrite").json(path)


def read_geojson_polygons(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Polygons of GeoJSON files -> edge table (A4): FeatureCollections (their first feature), Features and bare
    geometries, one per line, or one per file over several lines with ``multi_line``.  Every ring of a Polygon or MultiPolygon
    gives edges; inside and outside follow by the even-odd rule, so holes and parts need no marks.  ``poly_id`` is the
    collection's id, else the feature's, else "0"."""
    raw = spark.read.option("multiLine", multi_line).schema(GEOJSON_SCHEMA).json(path)
    bare = F.to_json(F.struct("type", "coordinates"))
    one = lambda i, g: F.struct(i.alias("id"), g.alias("geometry"))
    shapes = F.when(F.col("features").isNotNull(), F.transform(F.slice("features", 1, 1), lambda f: one(F.coalesce(F.col("id"), f["id"]), f["geometry"]))) \
        .when(F.col("geometry").isNotNull(), F.array(one(F.col("id"), F.col("geometry")))) \
        .otherwise(F.array(one(F.col("id"), bare)))
    g = raw.select(F.explode(shapes).alias("g")).select(F.coalesce("g.id", F.lit("0")).alias("poly_id"), "g.geometry")
    kind, at = F.get_json_object("geometry", "$.type"), F.get_json_object("geometry", "$.coordinates")
    parts = F.when(kind == "Polygon", F.array(F.from_json(at, _RINGS))).when(kind == "MultiPolygon", F.from_json(at, f"array<{_RINGS}>"))
    rings = g.select("poly_id", F.explode(F.flatten(parts)).alias("ring"))
    return ring_to_edges(rings, "poly_id")
