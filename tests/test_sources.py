"""Scene CSV and GeoJSON sources on hand-written files."""

import datetime as dt
import json

from gridsmith.session import shared_dir
from gridsmith.sources import scenes as sc


def test_scene_csv_header_quotes_and_time(spark):
    path = shared_dir(spark, "csv-test")
    import os
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/scenes.csv", "w") as f:
        f.write('"time","scene_id","band","path"\n')
        f.write('"2016-06-03 17:05:11","LC80270312016155","4","s3://b/x/LC8_B4.TIF"\n')
        f.write('"2016-06-19 17:05:20","LC80270312016171","5","s3://b/x/LC8_B5.TIF"\n')
    rows = sorted(sc.read_scene_csv(spark, path).collect())
    assert rows[0].time == dt.datetime(2016, 6, 3, 17, 5, 11)
    assert rows[0].scene_id == "LC80270312016155" and rows[0].band == 4 and rows[1].band == 5


def test_geojson_first_feature_polygon_ring(spark):
    path = shared_dir(spark, "geojson-test")
    import os
    os.makedirs(path, exist_ok=True)
    poly = {"type": "FeatureCollection", "id": "a", "features": [
        {"type": "Feature", "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [4, 0], [4, 3], [0, 0]]]}},
        {"type": "Feature", "geometry": {"type": "Polygon", "coordinates": [[[9, 9], [9, 8], [8, 8], [9, 9]]]}}]}
    point = {"type": "FeatureCollection", "id": "b", "features": [
        {"type": "Feature", "geometry": {"type": "Point", "coordinates": None}}]}
    with open(f"{path}/fc.json", "w") as f:
        f.write(json.dumps(poly) + "\n" + json.dumps(point) + "\n")
    e = sorted(tuple(r) for r in sc.read_geojson_polygons(spark, path).collect())
    assert e == [("a", 0.0, 0.0, 4.0, 0.0), ("a", 4.0, 0.0, 4.0, 3.0), ("a", 4.0, 3.0, 0.0, 0.0)]
