"""Catalogue fields outside the schema: nothing is lost, paths are typed."""

import json

from relcast.sources.catalog import (
    DATASET_EXTRA,
    DATASET_FIELDS,
    DISTRIBUTION_EXTRA,
    DISTRIBUTION_FIELDS,
    extra,
    extra_fields,
    flatten_catalog,
    flatten_open_catalog,
    read_catalog,
    read_open_catalog,
)

CATALOG = {"dataset": [
    {"accessLevel": "public", "bureauCode": ["009:38"], "keyword": ["a", "b"], "contactPoint": {"fn": "X", "hasEmail": None}, "x y": {"": [1, {"z": 2.5}]}, "big": 12345678901234567890,
     "distribution": [{"title": "t1", "mediaType": "text/csv", "size": 10, "checksum": {"algorithm": "sha"}}, {"title": "t2", "size": "large", "format": None}, {"downloadURL": "u", "flag": True}]},
    {"description": "no extras", "distribution": [{"title": "t3"}]}, {"bureauCode": "none", "distribution": []}, {"keyword": [], "modified": "2024-01-01"},
]}


def test_no_field_is_lost(spark, tmp_path):
    (tmp_path / "data.json").write_text(json.dumps(CATALOG))
    flat = flatten_open_catalog(read_open_catalog(spark, str(tmp_path / "data.json")))
    assert flat.select(*DATASET_FIELDS, *DISTRIBUTION_FIELDS).exceptAll(flatten_catalog(read_catalog(spark, str(tmp_path / "data.json")))).count() == 0
    flat.write.parquet(str(tmp_path / "t"))  # a round trip through a table
    rows = spark.read.parquet(str(tmp_path / "t")).selectExpr(f"to_json({DATASET_EXTRA}) AS d", f"to_json({DISTRIBUTION_EXTRA}) AS x").collect()
    want = []
    for d in CATALOG["dataset"]:
        for x in d.get("distribution", []):
            want.append(({k: v for k, v in d.items() if k not in (*DATASET_FIELDS, "distribution")}, {k: v for k, v in x.items() if k not in DISTRIBUTION_FIELDS}))
    same = lambda pairs: sorted(json.dumps(p, sort_keys=True) for p in pairs)
    assert same((json.loads(r.d), json.loads(r.x)) for r in rows) == same(want)


def test_paths_and_types(spark, tmp_path):
    (tmp_path / "data.json").write_text(json.dumps(CATALOG))
    flat = flatten_open_catalog(read_open_catalog(spark, str(tmp_path / "data.json")))
    got = {r.title: r for r in flat.select("title", extra("size", "int").alias("size"), extra("checksum.algorithm", "string").alias("sum"), extra("keyword[1]", "string", DATASET_EXTRA).alias("word"),
                                           extra("flag", "boolean").alias("flag")).collect()}
    assert (got["t1"].size, got["t1"].sum, got["t1"].word) == (10, "sha", "b") and got["t2"].size is None and got[""].flag is True and got["t3"].word is None
    types = {(r.level, r.field): (r.type, r.n) for r in extra_fields(flat).collect()}
    assert types[("distribution", "size")] == ("VARIANT", 2) and types[("distribution", "flag")] == ("BOOLEAN", 1) and types[("dataset", "keyword")] == ("ARRAY<STRING>", 3)
    assert types[("dataset", "big")][0] == "DECIMAL(20,0)" and ("dataset", "x y") in types
    assert extra_fields(flat.where("false")).count() == 0
