"""The whole crop lookup: sizes, and histograms that keep every crop."""

from gridsmith.operators import zonal
from gridsmith.plans import crops
from gridsmith.sources import fixtures as fx


def test_crop_lookup_is_whole():
    codes = [c for c, *_ in fx.CROP_LABELS]
    assert codes == sorted(set(codes)) and len(codes) == 135
    assert sum(n is not None for _, n, _, _ in fx.CROP_LABELS) == 132
    assert sum(crop for _, _, crop, _ in fx.CROP_LABELS) == 86
    assert sum(rgba is not None for *_, rgba in fx.CROP_LABELS) == 134


def test_every_named_class_of_the_layer_has_its_label(spark):
    names = {c: n for c, n, _, _ in fx.CROP_LABELS}
    sf = "/root/testdata/sf0.01"
    rows = crops.q_label_lookup(spark, sf).collect()
    assert {r.value for r in rows if r.name is not None} == {r.value for r in rows if names.get(r.value)}
    assert sum(r.name is not None for r in rows) == 40  # of the codes 1 to 50
    kept = {r.value for r in crops.q_class_whitelist(spark, sf).select("value").distinct().collect()}
    assert {3, 12, 27, 43, 49} <= kept and 26 not in kept


def test_last_code_of_a_name_wins_in_the_lookup(spark):
    got = {r.name: r.code for r in zonal.label_to_code(fx.crop_labels(spark).where("name is not null").select("code", "name")).collect()}
    assert (got["Shrubland"], got["Barren"], len(got)) == (152, 131, 130)
