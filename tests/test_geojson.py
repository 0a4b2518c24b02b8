"""GeoJSON files that are read by many tasks."""

import json
import random

import pytest

from pavestone.sources import geojson


def collection(n, seed):
    r = random.Random(seed)
    words = ["plain", 'a "quote"', "}, {", "back\\slash\\", '\\"}', "ä€😀", "[", "", "{" * 7, '"type":"Feature"']
    feature = lambda i: {"type": "Feature", "geometry": {"type": "Point", "coordinates": [i / 2, -i / 4]}, "properties": {"id": i, "name": r.choice(words) + r.choice(words) * r.choice([1, 1, 40]), "list": [{"x": [1, {"y": "}"}]}]}}
    return {"type": "FeatureCollection", "crs": {"type": "name", "properties": {"name": "x}"}}, "features": [feature(i) for i in range(n)], "more": [{"a": {"type": "Feature"}}]}


@pytest.mark.parametrize(("split", "piece"), [("2000b", 64), ("5000b", 1), ("128m", 1 << 22)])
def test_features_over_splits(spark, tmp_path, split, piece):
    want = []
    for k, (n, indent) in enumerate([(60, None), (20, 2), (0, None), (1, None)]):
        c = collection(n, k)
        (tmp_path / f"{k}.geojson").write_text(json.dumps(c, indent=indent, ensure_ascii=k != 1), encoding="utf-8")
        want += [(f["properties"]["id"], f["properties"]["name"], *f["geometry"]["coordinates"]) for f in c["features"]]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        got = [tuple(r) for r in geojson.read_geojson(spark, str(tmp_path), {"id": "long", "name": "string"}, piece).collect()]
        texts = geojson.features(spark, str(tmp_path), piece).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(got) == sorted(want)
    # every text is whole JSON, also that of objects that stand as deep as features
    assert all(isinstance(json.loads(r.feature), dict) for r in texts)
