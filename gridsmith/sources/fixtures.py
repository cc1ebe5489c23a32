"""Raster-shaped layers derived from the given tables (see FIXTURES.md).

Every fixture reads a whole table, so its work grows with the data:

* ``landsat``  (F1) cell grain, space-time: ``instant, gx, gy, blue, green, red, nir, qa``
* ``classes``  (F2) cell grain, spatial:    ``gx, gy, value, nlcd``
* ``dem``      (F3) cell grain, spatial:    ``gx, gy, elev`` (from 8x8 tiles)
* ``dem_tiles``(F3) tile grain:             ``col, row, cells ARRAY<BIGINT>``
* ``scenes``   (F4) scene list:             ``time, scene_id, cloud, lon10, lat10, n_cols, n_rows, path, present``
* ``band_rows``(F5) single-band rows:       ``scene, band, v``
* ``aoi_edges``(F6) polygon edge table, ``crop_labels`` (F7) code lookup: literals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridsmith.sources.tables import read_table

# Fixed values of the derived world (FIXTURES.md §2).
WORLD = 32          # F1/F2 world is WORLD x WORLD pixels
TILE = 8            # cells per tile side in every fixture
DEM_TILES_X = 16    # F3: tiles per grid row
CLOUD_QA = 53248    # QA value with bits 14-15 set (cloud)
CLEAR_QA = 20480    # QA value with bit 14 only


def quarter_start(ts: Column) -> Column:
    """First instant of the quarter, as TIMESTAMP_NTZ (no session-zone use)."""
    return F.make_timestamp_ntz(F.year(ts), (F.quarter(ts) - 1) * 3 + 1, F.lit(1), F.lit(0), F.lit(0), F.lit(0))


def landsat(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem",
                    ["l_shipdate", "l_partkey", "l_orderkey", "l_extendedprice", "l_quantity", "l_discount"])
    p = F.floor("l_extendedprice").cast("bigint")
    q = F.col("l_quantity").cast("bigint")
    d = F.round(F.col("l_discount") * 100).cast("bigint")
    return (li.select(quarter_start(F.col("l_shipdate")).alias("instant"),
                      (F.col("l_partkey") % WORLD).alias("gx"),
                      (F.col("l_orderkey") % WORLD).alias("gy"),
                      p.alias("p"), q.alias("q"), d.alias("d"))
            .groupBy("instant", "gx", "gy")
            .agg(F.max(3000 + F.col("p") % 3600).alias("blue"),
                 F.max(3200 + (F.col("p") * 7) % 3400).alias("green"),
                 F.max(3100 + (F.col("p") * 13) % 3500).alias("red"),
                 F.max(3000 + (F.col("p") * 17 + F.col("q") * 101) % 15000).alias("nir"),
                 F.min(F.when(F.col("d") >= 8, F.lit(CLOUD_QA)).otherwise(F.lit(CLEAR_QA))).alias("qa")))


def classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    pk = F.col("p_partkey")
    return (read_table(spark, sf_dir, "part", ["p_partkey", "p_size"])
            .select((pk % WORLD).alias("gx"), (F.floor(pk / WORLD) % WORLD).alias("gy"),
                    F.when(pk % 11 == 0, F.lit(0)).otherwise(F.col("p_size")).alias("v"),
                    F.when(pk % 17 == 0, F.lit(22)).when(pk % 5 == 0, F.lit(11)).otherwise(F.lit(82)).alias("n"))
            .groupBy("gx", "gy")
            .agg(F.max("v").alias("value"), F.min("n").alias("nlcd")))


def dem_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tile grain: each embedding is one 8x8 tile, row-major."""
    e = read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding"])
    return e.select((F.col("vec_id") % DEM_TILES_X).alias("col"),
                    F.floor(F.col("vec_id") / DEM_TILES_X).alias("row"),
                    F.transform("embedding", lambda x: F.floor(1000 * (1 + x.cast("double")))).alias("cells"))


def dem(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding"])
    t = e.select("vec_id", F.posexplode("embedding").alias("pos", "e"))
    return t.select(((F.col("vec_id") % DEM_TILES_X) * TILE + F.col("pos") % TILE).alias("gx"),
                    (F.floor(F.col("vec_id") / DEM_TILES_X) * TILE + F.floor(F.col("pos") / TILE)).alias("gy"),
                    F.floor(1000 * (1 + F.col("e").cast("double"))).alias("elev"))


def scenes(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus"])
    ok, ck = F.col("o_orderkey"), F.col("o_custkey")
    return o.select(
        F.col("o_orderdate").alias("time"),
        F.concat(F.lit("SC"), F.lpad(ok.cast("string"), 8, "0")).alias("scene_id"),
        (ok % 100).alias("cloud"),
        (F.lit(-1350) + (ck * 37) % 720).alias("lon10"),
        (F.lit(200) + (ok * 13) % 330).alias("lat10"),
        (F.lit(1000) + ok % 2000).alias("n_cols"),
        (F.lit(900) + ck % 1500).alias("n_rows"),
        F.concat(F.lit("s3://bucket-"), (ok % 7).cast("string"), F.lit("/scenes/"), ok.cast("string"),
                 F.lit("_B1.TIF")).alias("path"),
        (F.col("o_orderstatus") != "P").alias("present"))


def band_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole lineitem: scene = order, band = line number (1..7)."""
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_quantity"])
    return li.select(F.col("l_orderkey").alias("scene"), F.col("l_linenumber").alias("band"),
                     F.col("l_quantity").cast("bigint").alias("v"))


# The three test polygons of FIXTURES.md F6, pixel units.
AOI_EDGES = [
    (1, 2.3, 1.7, 29.1, 9.4), (1, 29.1, 9.4, 11.2, 30.6), (1, 11.2, 30.6, 2.3, 1.7),
    (2, 4.0, 4.0, 28.0, 4.0), (2, 28.0, 4.0, 28.0, 12.0), (2, 28.0, 12.0, 12.0, 12.0),
    (2, 12.0, 12.0, 12.0, 28.0), (2, 12.0, 28.0, 4.0, 28.0), (2, 4.0, 28.0, 4.0, 4.0),
    (3, 6.0, 6.0, 26.0, 6.0), (3, 26.0, 6.0, 26.0, 26.0), (3, 26.0, 26.0, 6.0, 26.0), (3, 6.0, 26.0, 6.0, 6.0),
    (3, 12.0, 12.0, 20.0, 12.0), (3, 20.0, 12.0, 20.0, 20.0), (3, 20.0, 20.0, 12.0, 20.0), (3, 12.0, 20.0, 12.0, 12.0),
]
EDGE_SCHEMA = T.StructType([T.StructField("poly_id", T.IntegerType()),
                            *[T.StructField(c, T.DoubleType()) for c in ("x1", "y1", "x2", "y2")]])

# The crop-code lookup as published with the crop layer (code, name, is_crop, rgba 0xRRGGBBAA).
# Code 0 has no colour; 251 to 253 have a colour and no name.
CROP_LABELS = [
    (0, "Background", False, None),
    (1, "Corn", True, 0xffd300ff),
    (2, "Cotton", True, 0xff2626ff),
    (3, "Rice", True, 0x00a8e5ff),
    (4, "Sorghum", True, 0xff9e0cff),
    (5, "Soybeans", True, 0x267000ff),
    (6, "Sunflower", True, 0xffff00ff),
    (10, "Peanuts", True, 0x70a500ff),
    (11, "Tobacco", True, 0x00af4cff),
    (12, "Sweet Corn", True, 0xdda50cff),
    (13, "Pop or Orn Corn", True, 0xdda50cff),
    (14, "Mint", True, 0x7fd3ffff),
    (21, "Barley", True, 0xe2007cff),
    (22, "Durum Wheat", True, 0x896354ff),
    (23, "Spring Wheat", True, 0xd8b56bff),
    (24, "Winter Wheat", True, 0xa57000ff),
    (25, "Other Small Grains", True, 0xd69ebcff),
    (26, "Dbl Crop WinWht/Soybeans", False, 0x707000ff),
    (27, "Rye", True, 0xad007cff),
    (28, "Oats", True, 0xa05989ff),
    (29, "Millet", True, 0x700049ff),
    (30, "Speltz", True, 0xd69ebcff),
    (31, "Canola", True, 0xd1ff00ff),
    (32, "Flaxseed", True, 0x7f99ffff),
    (33, "Safflower", True, 0xd6d600ff),
    (34, "Rape Seed", True, 0xd1ff00ff),
    (35, "Mustard", True, 0x00af4cff),
    (36, "Alfalfa", True, 0xffa5e2ff),
    (37, "Other Hay/Non Alfalfa", True, 0xa5f28cff),
    (38, "Camelina", True, 0x00af4cff),
    (39, "Buckwheat", True, 0xd69ebcff),
    (41, "Sugarbeets", True, 0xa800e5ff),
    (42, "Dry Beans", True, 0xa50000ff),
    (43, "Potatoes", True, 0x702600ff),
    (44, "Other Crops", True, 0x00af4cff),
    (45, "Sugarcane", True, 0xb27fffff),
    (46, "Sweet Potatoes", True, 0x702600ff),
    (47, "Misc Vegs & Fruits", True, 0xff6666ff),
    (48, "Watermelons", True, 0xff6666ff),
    (49, "Onions", True, 0xffcc66ff),
    (50, "Cucumbers", True, 0xff6666ff),
    (51, "Chick Peas", True, 0x00af4cff),
    (52, "Lentils", True, 0x00ddafff),
    (53, "Peas", True, 0x54ff00ff),
    (54, "Tomatoes", True, 0xf2a377ff),
    (55, "Caneberries", True, 0xff6666ff),
    (56, "Hops", True, 0x00af4cff),
    (57, "Herbs", True, 0x7fd3ffff),
    (58, "Clover/Wildflowers", True, 0xe8bfffff),
    (59, "Sod/Grass Seed", False, 0xafffddff),
    (60, "Switchgrass", False, 0x00af4cff),
    (61, "Fallow/Idle Cropland", False, 0xbfbf77ff),
    (63, "Forest", False, 0x93cc93ff),
    (64, "Shrubland", False, 0xc6d69eff),
    (65, "Barren", False, 0xccbfa3ff),
    (66, "Cherries", True, 0xff00ffff),
    (67, "Peaches", True, 0xff8eaaff),
    (68, "Apples", True, 0xba004fff),
    (69, "Grapes", True, 0x704489ff),
    (70, "Christmas Trees", False, 0x007777ff),
    (71, "Other Tree Crops", False, 0xb29b70ff),
    (72, "Citrus", False, 0xffff7fff),
    (74, "Pecans", True, 0xb5705bff),
    (75, "Almonds", True, 0x00a582ff),
    (76, "Walnuts", True, 0xead6afff),
    (77, "Pears", True, 0xb29b70ff),
    (81, "Clouds/No Data", False, 0xf2f2f2ff),
    (82, "Developed", False, 0x9b9b9bff),
    (83, "Water", False, 0x4c70a3ff),
    (87, "Wetlands", False, 0x7fb2b2ff),
    (88, "Nonag/Undefined", False, 0xe8ffbfff),
    (92, "Aquaculture", False, 0x00ffffff),
    (111, "Open Water", False, 0x4c70a3ff),
    (112, "Perennial Ice/Snow ", False, 0xd3e2f9ff),
    (121, "Developed/Open Space", False, 0x9b9b9bff),
    (122, "Developed/Low Intensity", False, 0x9b9b9bff),
    (123, "Developed/Med Intensity", False, 0x9b9b9bff),
    (124, "Developed/High Intensity", False, 0x9b9b9bff),
    (131, "Barren", False, 0xccbfa3ff),
    (141, "Deciduous Forest", False, 0x93cc93ff),
    (142, "Evergreen Forest", False, 0x93cc93ff),
    (143, "Mixed Forest", False, 0x93cc93ff),
    (152, "Shrubland", False, 0xc6d69eff),
    (176, "Grassland/Pasture", False, 0xe8ffbfff),
    (190, "Woody Wetlands", False, 0x7fb2b2ff),
    (195, "Herbaceous Wetlands", False, 0x7fb2b2ff),
    (204, "Pistachios", True, 0x00ff8cff),
    (205, "Triticale", True, 0xd69ebcff),
    (206, "Carrots", True, 0xff6666ff),
    (207, "Asparagus", True, 0xff6666ff),
    (208, "Garlic", True, 0xff6666ff),
    (209, "Cantaloupes", True, 0xff6666ff),
    (210, "Prunes", True, 0xff8eaaff),
    (211, "Olives", True, 0x334933ff),
    (212, "Oranges", True, 0xe57026ff),
    (213, "Honeydew Melons", True, 0xff6666ff),
    (214, "Broccoli", True, 0xff6666ff),
    (216, "Peppers", True, 0xff6666ff),
    (217, "Pomegranates", True, 0xb29b70ff),
    (218, "Nectarines", True, 0xff8eaaff),
    (219, "Greens", True, 0xff6666ff),
    (220, "Plums", True, 0xff8eaaff),
    (221, "Strawberries", True, 0xff6666ff),
    (222, "Squash", True, 0xff6666ff),
    (223, "Apricots", True, 0xff8eaaff),
    (224, "Vetch", True, 0x00af4cff),
    (225, "Dbl Crop WinWht/Corn", False, 0xffd300ff),
    (226, "Dbl Crop Oats/Corn", False, 0xffd300ff),
    (227, "Lettuce", True, 0xff6666ff),
    (229, "Pumpkins", True, 0xff6666ff),
    (230, "Dbl Crop Lettuce/Durum Wht", False, 0x896354ff),
    (231, "Dbl Crop Lettuce/Cantaloupe", False, 0xff6666ff),
    (232, "Dbl Crop Lettuce/Cotton", False, 0xff2626ff),
    (233, "Dbl Crop Lettuce/Barley", False, 0xe2007cff),
    (234, "Dbl Crop Durum Wht/Sorghum", False, 0xff9e0cff),
    (235, "Dbl Crop Barley/Sorghum", False, 0xff9e0cff),
    (236, "Dbl Crop WinWht/Sorghum", False, 0xa57000ff),
    (237, "Dbl Crop Barley/Corn", False, 0xffd300ff),
    (238, "Dbl Crop WinWht/Cotton", False, 0xa57000ff),
    (239, "Dbl Crop Soybeans/Cotton", False, 0x267000ff),
    (240, "Dbl Crop Soybeans/Oats", False, 0x267000ff),
    (241, "Dbl Crop Corn/Soybeans", False, 0xffd300ff),
    (242, "Blueberries", True, 0x000099ff),
    (243, "Cabbage", True, 0xff6666ff),
    (244, "Cauliflower", True, 0xff6666ff),
    (245, "Celery", True, 0xff6666ff),
    (246, "Radishes", True, 0xff6666ff),
    (247, "Turnips", True, 0xff6666ff),
    (248, "Eggplants", True, 0xff6666ff),
    (249, "Gourds", True, 0xff6666ff),
    (250, "Cranberries", True, 0xff6666ff),
    (251, None, False, 0xffd300ff),
    (252, None, False, 0x267000ff),
    (253, None, False, 0xa57000ff),
    (254, "Dbl Crop Barley/Soybeans", False, 0x267000ff),
]
LABEL_SCHEMA = T.StructType([T.StructField("code", T.IntegerType()), T.StructField("name", T.StringType()),
                             T.StructField("is_crop", T.BooleanType()), T.StructField("rgba", T.LongType())])


# Land-cover class labels (code -> name) as published with the
# land-cover layer; NoData of that layer is -128 (code 0 is a label only).
NLCD_LABELS = [
    (0, "NoData"), (11, "Open Water"), (12, "Perennial Ice/Snow"), (21, "Developed, Open Space"),
    (22, "Developed, Low Intensity"), (23, "Developed, Medium Intensity"), (24, "Developed High Intensity"),
    (31, "Barren Land (Rock/Sand/Clay)"), (41, "Deciduous Forest"), (42, "Evergreen Forest "),
    (43, "Mixed Forest"), (52, "Shrub/Scrub"), (71, "Grassland/Herbaceous"), (81, "Pasture/Hay"),
    (82, "Cultivated Crops"), (90, "Woody Wetlands"), (95, "Emergent Herbaceous Wetlands"),
]
NLCD_NODATA = -128


def nlcd_labels(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(NLCD_LABELS, "code int, name string")


def aoi_edges(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(AOI_EDGES, EDGE_SCHEMA)


def crop_labels(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CROP_LABELS, LABEL_SCHEMA)
