"""Cases of the fifth round: each failed before its finding was mended."""

import random
import re
import time

import numpy as np
from pyspark.sql import functions as F

from evidence_atlas.operators import geo as G
from evidence_atlas.operators import match as M

from test_round4 import linking, made


def close_by(spark, points, monuments, radius, keep):
    """What ``nearby`` gives, by pairing all."""
    p, m = points.select("point_id", F.col("lat").alias("a"), F.col("lon").alias("b")), monuments
    out = {}
    for r in p.crossJoin(m).select("point_id", "monument_id", G.haversine_km("a", "b", "lat", "lon").alias("km")).where(F.col("km") <= radius).collect():
        out.setdefault(r.point_id, []).append((r.km, r.monument_id))
    return {(i, m, rank + 1) for i, hits in out.items() for rank, (_, m) in enumerate(sorted(hits)[:keep])}


def test_nearby_in_dense_cells(spark, monkeypatch):
    """F8: a dense cell does not pair each point with all within the radius, and no answer is lost or added."""
    dice = random.Random(8)
    spot = lambda n, wide: [(i, 35 + dice.random() * wide, 135 + dice.random() * wide) for i in range(n)]
    m = spot(4000, 0.2) + [(4000 + i, 36 + i / 9, 136.0) for i in range(40)] + [(5000 + i, 35.1, 135.1) for i in range(60)]
    p = spot(150, 0.25) + [(200 + i, 36 + i / 20, 136.02) for i in range(40)] + [(300 + i, 35.1, 135.1) for i in range(30)] + [(400, None, 135.0)]
    points = spark.createDataFrame(p, "point_id int, lat double, lon double")
    monuments = spark.createDataFrame(m, "monument_id int, lat double, lon double")
    want = close_by(spark, points, monuments, 30.0, 5)
    for most in (1 << 21, 500):
        monkeypatch.setattr(G, "TASK_PAIRS", most)
        out = G.nearby(points, monuments, 30.0)
        assert {(r.point_id, r.monument_id, r["rank"]) for r in out.collect()} == want
    assert made(G.nearby(points, monuments, 30.0), "Join") < 0.2 * len(m) * len(p)


def test_nearby_at_the_pole(spark):
    """F8: near a pole the radius spans more columns than were looked into."""
    points = spark.createDataFrame([(1, 89.9, 0.0), (2, 90.0, 10.0)], "point_id int, lat double, lon double")
    monuments = spark.createDataFrame([(1, 89.9, 60.0), (2, 89.9, -150.0), (3, 89.0, 0.0)], "monument_id int, lat double, lon double")
    got = {(r.point_id, r.monument_id, r["rank"]) for r in G.nearby(points, monuments, 30.0).collect()}
    assert got == close_by(spark, points, monuments, 30.0, 5) and len(got) == 4


def test_corroborate_from_dense_cells(spark):
    """the monuments of a record, in their order, from cells whose pairs are not all made."""
    dice = random.Random(9)
    spot = lambda n: [(i, 35 + dice.random() / 5, 135 + dice.random() / 5) for i in range(n)]
    points, monuments = spark.createDataFrame(spot(100), "point_id int, lat double, lon double"), spark.createDataFrame(spot(3000), "monument_id int, lat double, lon double")
    near = G.nearby(points, monuments, 30.0)
    out = G.corroborate(points.withColumnRenamed("point_id", "record_id"), near, points.select("point_id", F.lit(True).alias("flood")), "2024-01-01")
    want = close_by(spark, points, monuments, 30.0, 5)
    assert {(r.record_id, m, i + 1) for r in out.collect() for i, m in enumerate(r.monument_ids)} == want
    assert made(near, "Join") < 0.2 * 100 * 3000


def ring_frame(spark, rings):
    rows = [(i, 0, [dict(lon=float(x), lat=float(y)) for x, y in r] if r is not None else None) for i, r in enumerate(rings)]
    return spark.createDataFrame(rows, "area_key long, ring_ord int, ring array<struct<lon:double,lat:double>>")


def test_border_points_are_spread_and_counted_once(spark):
    """rings of one small file are dealt out before their points are, and a border meets its points once."""
    square = lambda x, y: [(x, y), (x + 1, y), (x + 1, y + 1), (x, y + 1), (x, y)]
    rings = [square(x, y) for x in range(12) for y in range(12)]
    areas = ring_frame(spark, rings).coalesce(1)
    want = {}
    for r in rings:
        for a, b in zip(r[:-1], r[1:], strict=True):
            want.setdefault(a, set()).add(b)
            want.setdefault(b, set()).add(a)
    corners = G.border_corners(areas)
    assert {(r.lon, r.lat) for r in corners.collect()} == {p for p, near in want.items() if len(near) != 2}
    edges = sum(len(near) for near in want.values())
    assert made(G.border_corners(areas), "Generate") <= 4 * len(rings) + edges
    plan = G.simplify_rings(areas, shared=True)._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_COL" in plan


def test_rings_thinned_together(spark):
    """all rings of a batch at once, each as by itself."""
    dice = np.random.default_rng(12)
    rings = [dice.integers(0, 6, (n, 2)) / 4 for n in [*range(0, 12), *dice.integers(3, 60, 200)]]
    rings = [np.concatenate([r, r[:1]]) if i % 3 else r for i, r in enumerate(rings)] + [np.array([(0, 0), (1, np.nan), (2, 1), (2, 3), (0, 3), (0, 0)])]
    sizes = np.array([len(r) for r in rings])
    for tolerance in (0.0, 0.3, 1.0):
        stay = G._staying(np.concatenate(rings), sizes, tolerance)
        for r, mask in zip(rings, np.split(stay, np.cumsum(sizes)[:-1]), strict=True):
            alone = G._thin(r, tolerance) if len(r) > 4 else r
            np.testing.assert_array_equal(r[mask], alone if len(alone) >= 4 else r)
    df = ring_frame(spark, [r.tolist() for r in rings[:-1]] + [None])
    got = {r.area_key: (r.before, [tuple(p) for p in r.ring]) for r in G.simplify_rings(df, 0.3).collect()}
    for i, r in enumerate(rings[:-1]):
        thin = [tuple(p) for p in (G._thin(r, 0.3) if len(r) > 4 else r).tolist()]
        thin = thin if len(thin) >= 4 else [tuple(p) for p in r.tolist()]
        thin = [p for j, p in enumerate(thin) if j == 0 or p != thin[j - 1]]
        thin += thin[:1] if thin and thin[0] != thin[-1] else []
        assert got.get(i) == ((len(r), thin) if len(thin) >= 4 else None)
    assert len(got) and len(rings) - 1 not in got


def test_long_ring_is_rounded_in_linear_time(spark):
    """rounding worked each point out again for every other point of the ring."""
    rings = ring_frame(spark, [[(i % 100 / 7, i / 70000) for i in range(6000)]]).localCheckpoint()
    start = time.time()
    assert rings.select(F.size(G.round_ring("ring")).alias("n")).first().n == 6001
    assert time.time() - start < 20


def test_findings_are_shuffled_once(spark, monkeypatch):
    """children go with the entries; those of places with very many names are found all the same."""
    f = [(i, e, n) for i, (e, n) in enumerate((e, n) for e in (1, 2, 3, 4, 9, None) for n in ("a", "b", "ヶ", "x y", "n7", "n8", "zz", None))]
    e = [(1, 10, "a"), (2, 20, "h"), (3, 10, None), (4, None, "a"), (5, 20, "b")]
    c = [(10, 101, "b"), (10, 100, "b"), (10, 102, "が"), (10, 103, None), (None, 104, "a"), *[(20, 200 + i, f"n{i}") for i in range(9)], (20, 300, "xy")]
    findings, entries = spark.createDataFrame(f, "finding_id int, entry_id int, name string"), spark.createDataFrame(e, "entry_id int, place_id int, heading string")
    children = spark.createDataFrame(c, "place_id int, child_id int, child_name string")
    fold = lambda n: n and n.replace(" ", "").replace("ヶ", "ケ").replace("が", "ケ")
    own, head = {x: p for x, p, _ in e}, {x: fold(h) for x, _, h in e}
    kids = {}
    for p, i, n in c:
        if p is not None and n is not None:
            kids[p, fold(n)] = min(i, kids.get((p, fold(n)), i))
    want = {}
    for i, x, n in f:
        same = n is not None and head.get(x) == fold(n) and own[x] is not None
        want[i] = own[x] if same else kids.get((own.get(x), fold(n)))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = M.resolve_finding_place(findings, entries, children)._jdf.queryExecution().executedPlan().toString()
        assert not re.search(r"hashpartitioning\(own#\d+, k#", plan)
        for most in (64, 3):
            monkeypatch.setattr(M, "LISTED_CHILDREN", most, raising=False)
            out = M.resolve_finding_place(findings, entries, children).collect()
            assert len(out) == len(f) and {r.finding_id: r.place_id for r in out} == want
            assert all((r.reason == "unknown_place") == (r.place_id is None) for r in out)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_cells_of_pairs_are_dealt_to_enough_tasks(spark, monkeypatch):
    """the tasks that make pairs grow with the pairs, not with the small tables they come from."""
    m, p, want = linking(spark, 10, 400, 60)
    monkeypatch.setattr(M, "PLACES_CELL", 10)
    monkeypatch.setattr(M, "SOURCES_CELL", 10)
    out = M.link_statuses(m, p, max_km=150.0)
    assert out.rdd.getNumPartitions() > 10
    got = out.collect()
    assert len(got) == len(want) and {(r.place_id, r.mention_id): r.status for r in got} == want
    assert max(out.groupBy(F.spark_partition_id()).count().toPandas()["count"]) < 0.5 * len(want)
