"""Framed files, builds and their manifest."""

import glob
import json
import random

from pyspark.sql import functions as F

from evidence_atlas.sources import publish as P


def features(spark, rows):
    return spark.createDataFrame([(k, o, json.dumps({"type": "Feature", "properties": {"id": o, "name": f"沢,]}} {o}"}})) for k, o in rows], "pref_code string, ord int, feature string")


def files(root, name):
    out = {}
    for path in glob.glob(f"{root}/build-*/{name}/key=*/part-*"):
        doc = json.load(open(path, encoding="utf-8"))
        out.setdefault(path.split("key=")[1].split("/")[0], []).append([f["properties"]["id"] for f in doc["features"]])
    return out


def test_collections(spark, tmp_path):
    rows = [(random.Random(i).choice(["01", "02", None]), i) for i in range(200)] + [("13", 1000)]
    root = str(tmp_path)
    for tasks in (1, 7):
        P.publish(spark, root, lambda b, tasks=tasks: b.collection("candidates", features(spark, rows).repartition(5), tasks=tasks))
        found = files(root, "candidates")
        assert set(found) == {"00", "01", "02", "13"}
        for key, parts in found.items():
            assert sorted(parts)[0] and sorted(sum(parts, [])) == [i for k, i in rows if (k or "00") == key] and all(p == sorted(p) for p in parts)
        assert tasks > 1 or all(len(parts) == 1 for parts in found.values())
        items = P.read_items(spark, root, "candidates", keys=["02", "99"]).collect()
        assert sorted(json.loads(r.item)["properties"]["id"] for r in items) == [i for k, i in rows if k == "02"]
        assert P.read_items(spark, root, "candidates").count() == len(rows)
    assert P.read_items(spark, root, "nothing").count() == 0 and P.read_items(spark, f"{root}/none", "x").count() == 0


def test_large_key_is_split(spark, tmp_path):
    """One key with nearly all rows makes several files, each a valid collection."""
    rows = [("01", i) for i in range(5000)] + [("02", 1)]
    P.publish(spark, str(tmp_path), lambda b: b.collection("areas", features(spark, rows), tasks=4))
    parts = files(str(tmp_path), "areas")
    assert len(parts["01"]) > 1 and sorted(sum(parts["01"], [])) == list(range(5000))


def test_stale_keys_go(spark, tmp_path):
    root = str(tmp_path)
    first = P.publish(spark, root, lambda b: b.collection("areas", features(spark, [("01", 1), ("02", 2)])))
    assert first.count() == 0
    broken = P.Build(spark, root)
    broken.collection("areas", features(spark, [("77", 1)]))  # never published
    assert {r.key for r in P.manifest(spark, root).collect()} == {"01", "02"} and P.read_items(spark, root, "areas", keys=["77"]).count() == 0
    gone = P.publish(spark, root, lambda b: b.collection("areas", features(spark, [("02", 2), ("03", 3)])))
    assert [tuple(r) for r in gone.collect()] == [("areas", "01")]
    assert set(files(root, "areas")) == {"02", "03"} and len(glob.glob(f"{root}/build-*")) == 1
    kept = {(r.collection, r.key): r.bytes for r in P.manifest(spark, root).collect()}
    assert set(kept) == {("areas", "02"), ("areas", "03")} and all(kept.values())


def test_documents_and_records(spark, tmp_path):
    elements = spark.createDataFrame([("ume", 1, ["梅"], None), ("kubo", 0, [], 0.2)], "id string, ord int, surfaces array<string>, specificity double")
    root = str(tmp_path)
    P.publish(
        spark, root,
        lambda b: b.document("elements", elements, "elements", ["ord"], {"hazardLabels": {"flood": "洪水"}, "evidenceLevelLabels": {"1": "x"}}),
        lambda b: b.document("sources", elements.where("false"), "sources", ["ord"]),
        lambda b: b.records("details", spark.range(50).select("id", F.concat(F.lit("{\"n\":"), F.col("id").cast("string"), F.lit("}")).alias("document")), "id", "document", 8),
    )
    [path] = glob.glob(f"{root}/build-*/elements/key=all/part-*")
    doc = json.load(open(path, encoding="utf-8"))
    assert [e["id"] for e in doc["elements"]] == ["kubo", "ume"] and doc["elements"][1]["specificity"] is None
    assert doc["hazardLabels"] == {"flood": "洪水"} and doc["evidenceLevelLabels"] == {"1": "x"}
    assert {(r.id, json.loads(r.document)["n"]) for r in P.read_records(spark, root, "details", [7, 49, 50], 8).collect()} == {("7", 7), ("49", 49)}
