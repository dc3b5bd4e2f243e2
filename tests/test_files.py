"""Scans of real files, broken and missing ones included."""

import json
import os

import pytest

from evidence_atlas.sources import files as C

COLUMNS = {"名称": "name", "緯度": "lat", "経度": "lon"}


def put(path, text, encoding="utf-8"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding=encoding, newline="") as f:
        f.write(text)


def test_csv(spark, tmp_path):
    put(f"{tmp_path}/pref=01/a.csv", "id,緯度,名称,経度\n1,35,山,135\n2,36\n3,36,川,136,more\n4,bad,谷,137\n5,91,海,137\n", "utf-8-sig")
    put(f"{tmp_path}/pref=02/b.csv", 'id,緯度,名称,経度\r\n6,35,"a ""b"", c",135\r\n')
    raw = C.scan_csv(spark, str(tmp_path), COLUMNS, ["pref"])
    assert raw.columns == ["name", "lat", "lon", "pref", "_corrupt", "_file", "_modified"]
    rows = {(r["name"], r.pref, r._corrupt) for r in raw.collect()}
    assert rows == {("山", "01", None), (None, "01", "2,36"), ("川", "01", "3,36,川,136,more"), ("谷", "01", None), ("海", "01", None), ('a "b", c', "02", None)}
    kept = C.scan_addresses(spark, str(tmp_path), COLUMNS, ["pref"]).collect()
    assert {(r["name"], r.lat) for r in kept} == {("山", 35.0), ("川", 36.0), ('a "b", c', 35.0)}
    report = {os.path.basename(r._file): (r.rows, r.filled, r.corrupt) for r in C.scan_report(raw, "name").collect()}
    assert report == {"a.csv": (5, 4, 2), "b.csv": (1, 1, 0)}


def test_csv_headers(spark, tmp_path):
    put(f"{tmp_path}/a.csv", "名称,緯度\n山,35\n")
    with pytest.raises(ValueError, match="lacks 経度"):
        C.scan_csv(spark, str(tmp_path), COLUMNS)
    put(f"{tmp_path}/two/a.csv", "名称,緯度,経度\n山,35,135\n")
    put(f"{tmp_path}/two/b.csv", "名称,経度,緯度\n山,135,35\n")
    with pytest.raises(Exception, match="header"):
        C.scan_csv(spark, f"{tmp_path}/two", COLUMNS).collect()


def test_missing(spark, tmp_path):
    none = f"{tmp_path}/none"
    assert C.scan_csv(spark, none, COLUMNS, ["pref"]).collect() == [] and C.scan_addresses(spark, none, COLUMNS).count() == 0
    assert C.scan_modern_index(spark, none, COLUMNS).count() == 0 and C.scan_monuments(spark, none, {"ID": "id"}).count() == 0
    assert C.scan_pages(spark, none, {"pid": "string"}, "coordjson").count() == 0 and C.scan_texts(spark, none).count() == 0
    assert C.load_elements(spark, none).count() == 0 and C.load_sources(spark, none).count() == 0
    meta = spark.createDataFrame([("a.txt", "s")], "document string, source_id string")
    assert [(r.text, r.missing) for r in C.scan_documents(spark, none, meta).collect()] == [(None, True)]


def test_modern_index(spark, tmp_path):
    put(f"{tmp_path}/i.csv", '名称,緯度,経度\n" a\nb ", ,135\n　,35,x\n')
    rows = C.scan_modern_index(spark, str(tmp_path), COLUMNS, multi_line=True).collect()
    assert [(r["name"], r.lat, r.lon) for r in rows] == [("a\nb", None, 135.0), (None, 35.0, None)] and all(r._corrupt is None for r in rows)


def test_monuments(spark, tmp_path):
    feature = lambda i, at: {"type": "Feature", "properties": {"ID": i, "碑名": f" 碑{i} ", "建立年": "  "}, "geometry": {"coordinates": at}}
    put(f"{tmp_path}/a.geojson", json.dumps({"type": "FeatureCollection", "features": [feature("1", [140.96034, 41.891005]), feature("2", []), feature("3", [1]), {"properties": None, "geometry": {"coordinates": [1, 2, 3]}}, 7, None]}, indent=2, ensure_ascii=False))
    put(f"{tmp_path}/b.geojson", '{"features": [{"properties"')
    put(f"{tmp_path}/c.geojson", '{"features": "none"}')
    rows = C.scan_monuments(spark, str(tmp_path), {"ID": "id", "碑名": "name", "建立年": "year"}).collect()
    assert sorted(((r.id, r["name"], r.year, r.lat, r.lon) for r in rows), key=str) == [("1", "碑1", None, 41.891005, 140.96034), (None, None, None, 2.0, 1.0)]
    assert [r.n for r in C.scan_json(spark, str(tmp_path), "features variant").selectExpr("count(_corrupt) as n", "count(features) as f").collect()] == [1]


def test_pages(spark, tmp_path):
    block = {"contenttext": "山", "xmin": "1", "xmax": 3, "ymin": 2, "ymax": 5.5}
    lines = [{"pid": "1", "frame": 1, "coordjson": [block, {**block, "contenttext": ""}, {**block, "xmin": None}, 7]}, {"pid": "1", "frame": 2, "coordjson": json.dumps([block])}, {"pid": "2", "coordjson": "{"}, {"pid": "3", "coordjson": {"a": 1}}, {"pid": "4"}]
    put(f"{tmp_path}/p.jsonl", "\n".join(json.dumps(x) for x in lines) + "\nbroken {\n")
    rows = C.scan_pages(spark, str(tmp_path), {"pid": "string", "frame": "int"}, "coordjson").collect()
    assert [(r.pid, r.frame, r.block_ord, r.text, r.x, r.y, r.width, r.height) for r in rows] == [("1", 1, 0, "山", 1.0, 2.0, 2.0, 3.5), ("1", 2, 0, "山", 1.0, 2.0, 2.0, 3.5)]


def test_documents(spark, tmp_path):
    put(f"{tmp_path}/local/a b+%20.txt", "一行\n 12 \n二行\n12345\n")
    put(f"{tmp_path}/other.txt", "not asked for")
    meta = spark.createDataFrame([("local/a b+%20.txt", "s1"), ("gone.txt", "s2")], "document string, source_id string")
    got = {r.source_id: (r.text, r.missing) for r in C.scan_documents(spark, str(tmp_path), meta).collect()}
    assert got == {"s1": ("一行\n二行\n12345\n", False), "s2": (None, True)}


def test_dictionary_files(spark, tmp_path):
    good = {"id": "ume", "label": "ウメ", "meaning": "埋", "surfaces": ["梅", "埋"], "readings": ["ウメ"], "hazard_types": ["landslide"], "specificity": 0.5, "substitution_of": "埋", "source_ids": ["s"]}
    items = [good, {"id": "kubo", "label": "クボ", "meaning": "窪", "specificity": 1.5}, {"id": "x", "specificity": 0.1}, "none"]
    for name, payload in (("bare", items), ("mapped", {"elements": items, "more": 1}), ("empty", {"elements": None}), ("nothing", {})):
        put(f"{tmp_path}/{name}.json", json.dumps(payload, ensure_ascii=False, indent=1))
    for name in ("bare", "mapped"):
        rows = C.load_elements(spark, f"{tmp_path}/{name}.json").orderBy("element_ord").collect()
        assert [(r.element_id, r.element_ord, r.surfaces, r.hazards, r.source_ids, r.problem) for r in rows] == [("ume", 0, ["梅", "埋"], ["landslide"], ["s"], None), ("kubo", 1, [], [], [], "specificity is not between 0 and 1"), ("x", 2, [], [], [], "id, label or meaning is missing")]
    assert C.load_elements(spark, f"{tmp_path}/empty.json").count() == 0 and C.load_elements(spark, f"{tmp_path}/nothing.json").count() == 0
    put(f"{tmp_path}/s.json", json.dumps({"sources": [{"id": "a", "type": "book", "title": "T", "year": 1900}, {"id": "b", "type": "scroll", "title": "U"}, {"type": "web"}]}))
    rows = C.load_sources(spark, f"{tmp_path}/s.json").orderBy("source_ord").collect()
    assert [(r.source_id, r.year, r.problem) for r in rows] == [("a", 1900, None), ("b", None, "no known type"), (None, None, "id or title is missing")]


def test_extraction_cache(spark, tmp_path):
    """The last write of a key counts; the cache side of the join is not shuffled; the table opens again by its path."""
    import contextlib
    import io

    from pyspark.sql import functions as F

    from evidence_atlas.functions import text as X
    from evidence_atlas.sources import tables as S

    items = spark.range(200).select(F.col("id").alias("item_id"), F.lit("s").alias("source_id"), F.lit("m").alias("signature"), F.col("id").cast("string").alias("prompt"))
    keyed = items.withColumn("key", X.cache_key("source_id", "signature", "prompt"))
    name = S.open_cache(spark, "cache_one", f"{tmp_path}/cache", 8)
    S.write_cache(spark, name, keyed.where("item_id < 100").select("key", F.lit('{"a":1}').alias("payload"), F.lit("2024-01-01").alias("written_at")))
    S.write_cache(spark, name, keyed.where("item_id % 2 = 0").select("key", F.when(F.col("item_id") % 4 == 0, '{"a":2}').otherwise("not json").alias("payload"), F.lit("2024-01-02").alias("written_at")))
    S.open_cache(spark, "cache_again", f"{tmp_path}/cache", 8)
    for table in ("cache_one", "cache_again"):
        got = {r.item_id: r.payload for r in S.extraction_lookup(items, spark.table(table)).collect()}
        assert got == {i: '{"a":2}' if i % 4 == 0 else None if i % 2 == 0 or i >= 100 else '{"a":1}' for i in range(200)}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with contextlib.redirect_stdout(io.StringIO()) as plan:
            S.extraction_lookup(items, spark.table("cache_one")).explain()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.getvalue().count("Exchange") == 1 and plan.getvalue().count("Join") == 1
