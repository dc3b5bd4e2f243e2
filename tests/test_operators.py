"""Rules of single operators on hand-made rows."""

from pyspark.sql import functions as F

from evidence_atlas.functions import text as X
from evidence_atlas.operators import browse as B
from evidence_atlas.operators import evidence as E
from evidence_atlas.operators import geo as G
from evidence_atlas.operators import holding as H
from evidence_atlas.operators import layout as L
from evidence_atlas.operators import match as M
from evidence_atlas.operators import merge as D
from evidence_atlas.operators.report import Stage, stage_report
from evidence_atlas.sources import tables as S


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def cases():
    return [
        (X.strip_spaces(F.lit("蛇 抜　沢\t")), "蛇抜沢"),
        (X.normalize_reading(F.lit("ｼﾞﾔﾇｹ さわ")), "ジヤヌケサワ"),
        (X.normalize_reading(F.lit("㌔ ㈱⑩ﬁかﾞ")), "キロ(株)10fiガ"),
        (X.normalize_name(F.lit("瀧 澤")), "滝沢"),
        (X.comparison_key(F.lit("梅が久保")), "梅ケ久保"),
        (X.comparison_key(F.lit("梅ヶ久保")), "梅ケ久保"),
        (X.display_width(F.lit("a沢ｱ")), 4),
        (X.collapse_folded(F.lit("伝わり、 1953年の 水害 と")), "伝わり、 1953年の水害と"),
        (X.collapse_folded(F.lit("伝わり、 1953年"), True), "伝わり、1953年"),
        (X.kanji_number(F.lit("12")), "十二"),
        (X.kanji_number(F.lit("10")), "十"),
        (X.kanji_number(F.lit("５")), "五"),
        (X.strip_qualifier(F.lit("平井町の一部の内")), "平井町"),
        (X.first_oaza(F.lit("梅田町５丁目の一部、平井町")), "梅田町五丁目"),
        (X.first_oaza(F.lit("新宿１～３丁目")), "新宿一丁目"),
        (X.pref_code(F.lit("群馬")), "10"),
        (X.pref_code(F.lit("どこか")), None),
        (X.split_address(F.lit("長野県木曽郡南木曽町読書"))["municipality"], "木曽郡南木曽町"),
        (X.date_in_label(F.lit("西日本水害(1953年6月28日)")), "1953年6月28日"),
        (X.tolerant_int(F.lit(" 12.9 ")), 12),
        (X.tolerant_int(F.lit("x")), None),
        (X.verify_quote(F.lit("山 崩れ"), F.lit("昔、山崩れがあった")), True),
        (X.verify_quote(F.lit(""), F.lit("x")), False),
        (X.names_disaster(F.lit("天皇崩ず")), False),
        (X.level_for(F.lit("disaster"), F.lit("洪水により")), 2),
        (X.level_for(F.lit("terrain"), F.lit("洪水により")), 1),
        (X.level_for(F.lit("person"), F.lit("洪水")), None),
        (X.classify_description(F.lit("崖が崩れた。土石流（1910）があった。町村制で合併した。"))["level"], 3),
        (X.classify_description(F.lit("湿地が多い。"))["level"], 1),
        (X.classify_description(F.lit("町村制により合併し洪水。"))["level"], None),
        (F.size(X.chunks(F.repeat(F.lit("x"), 9001))), 2),
        (X.record_relation(F.array(F.lit("nearby_record"), F.lit("named_after"))), "named_after"),
        (X.primary_hazard(F.array(F.lit("wind"), F.lit("flood")), ["flood", "wind"]), "flood"),
        (X.plausible_name(F.lit("薬師堂")), True),
        (X.plausible_name(F.lit("薬師堂1")), False),
    ]


def test_expressions(spark):
    got = spark.range(1).select(*[c.alias(f"c{i}") for i, (c, _) in enumerate(cases())]).first()
    assert [(i, x) for i, x in enumerate(got)] == [(i, w) for i, (_, w) in enumerate(cases())]


ELEMENTS = [
    {"id": "ume", "surfaces": ["梅", "埋"], "readings": ["ウメ"], "hazards": ["landslide"], "specificity": 0.5},
    {"id": "kubo", "surfaces": ["窪", "久保"], "readings": ["クボ"], "hazards": ["flood"], "specificity": 0.2},
    {"id": "januke", "surfaces": ["蛇抜"], "readings": ["ジャヌケ"], "hazards": ["debris_flow"], "specificity": 0.95},
]


def test_match_elements(spark, monkeypatch):
    elements = S.dictionary_tables(spark, ELEMENTS)
    names = spark.createDataFrame([(1, "埋ヶ窪", None), (2, "蛇 拔 久保", None), (3, "無", "じゃぬけ"), (4, "川", "ク")], "name_id int, name string, reading string")
    want = {(1, "ume", "埋", "surface"), (1, "kubo", "窪", "surface"), (2, "januke", "蛇抜", "surface"), (2, "kubo", "久保", "surface"), (3, "januke", "ジャヌケ", "reading")}
    pick = lambda df: {(r.name_id, r.element_id, r.surface, r.matched_on) for r in df.collect()}
    assert pick(M.match_elements(names, elements)) == want
    assert pick(M.match_elements(names, elements, surface_only=True)) == {w for w in want if w[3] == "surface"}
    best = {r.name_id: (list(r.elements), list(r.hazards)) for r in M.best_matches(M.match_elements(names, elements)).collect()}
    assert best[2] == (["januke", "kubo"], ["debris_flow", "flood"])
    for few, block in ((0, 500_000), (0, 2), (200, 1)):
        monkeypatch.setattr(H, "FEW", few)
        monkeypatch.setattr(H, "AUTOMATON_WORDS", block)
        assert pick(M.match_elements(names, elements)) == want


def test_scores(spark):
    ids = spark.createDataFrame([(i,) for i in range(1, 7)], "id int")
    e = spark.createDataFrame(
        [(1, "gazetteer", "supports", 1, "llm"), (1, "gazetteer", "disputes", 3, "human"), (2, "legend", "supports", 3, "human"), (3, "map", "supports", 2, "human"), (4, "news", "supports", 2, "llm"), (5, "manual", "disputes", 2, "human")],
        "id int, kind string, stance string, level int, extracted_by string",
    )
    r = spark.createDataFrame([(1, "nearby_record"), (3, "named_after"), (4, "same_place_record")], "id int, relation string")
    got = {x.id: (x.origin_level, x.evidence_level, x.disputed) for x in D.score(ids, e, r).collect()}
    assert got == {1: (1, 1, True), 2: (2, 3, False), 3: (0, 0, False), 4: (2, 3, False), 5: (0, 0, True), 6: (0, 0, False)}


MENTION = "mention_id int, ord int, municipality string, name string, lat double, lon double, hazards array<string>, source_id string, locator string"
PLACE = "place_id int, municipality string, names array<string>, lat double, lon double, hazards array<string>"


def link_by_force(mentions, places, had, max_km, cap):
    """Mention after mention, place after place, with the counters."""
    import math

    def km(a, b, c, d):
        h = math.sin(math.radians(c - a) / 2) ** 2 + math.cos(math.radians(a)) * math.cos(math.radians(c)) * math.sin(math.radians(d - b) / 2) ** 2
        return 2 * 6371 * math.asin(math.sqrt(min(1, h)))

    out, n = {p[0]: [(s, loc) for q, s, loc in had if q == p[0]] for p in places}, dict.fromkeys("mentions unmatched too_far produced demoted".split(), 0)
    links = set()
    for i, _, town, name, lat, lon, hazards, source, locator in sorted(mentions, key=lambda m: (m[1], m[0])):
        n["mentions"] += 1
        targets = [p for p in places if p[1] == town and name in p[2]]
        n["unmatched"] += not targets
        for p in targets:
            far = None if lat is None or p[3] is None else km(p[3], p[4], lat, lon)
            if far is not None and far > max_km:
                n["too_far"] += 1
            elif len(out[p[0]]) < cap and (source, locator) not in out[p[0]]:
                out[p[0]].append((source, locator))
                same = not hazards or not p[5] or bool(set(hazards) & set(p[5]))
                n["produced"] += 1
                n["demoted"] += not same
                links.add((p[0], i, None if far is None else round(far, 2), "same_place_record" if same else "nearby_record"))
    return links, n


def test_link_records(spark, monkeypatch):
    import random

    rng = random.Random(2)
    spots = [(33.0 + k / 40, 130.0) for k in range(6)] + [(None, None)]
    kinds = [[], ["flood"], ["tsunami"], ["flood", "slide"]]
    mentions = [(i, rng.randint(0, 40), rng.choice("ABC"), rng.choice("xyz"), *rng.choice(spots), rng.choice(kinds), rng.choice("stu"), rng.choice(["1", "2", None])) for i in range(300)]
    places = [(i, rng.choice("AB"), rng.sample("xyw", rng.randint(1, 3)), *rng.choice(spots), rng.choice(kinds)) for i in range(25)]
    had = [(rng.randint(0, 24), rng.choice("stu"), rng.choice(["1", None])) for _ in range(30)]
    had = [h for h in dict.fromkeys(had)]
    m, p = spark.createDataFrame(mentions, MENTION).repartition(5), spark.createDataFrame(places, PLACE)
    for existing, cap, tries in (([], 6, 8), ([], 2, 1), (had, 3, 1), (had, 6, 8)):
        monkeypatch.setattr(M, "FIRST_TRIES", tries)
        stage = Stage("link")
        e = spark.createDataFrame(existing, "place_id int, source_id string, locator string") if existing else None
        got = {tuple(r) for r in M.link_records(m, p, e, cap=cap, stage=stage).collect()}
        want, counted = link_by_force(mentions, places, existing, 10.0, cap)
        assert got == want and stage.counters() == counted
        assert {tuple(r) for r in M.link_records(m, p, e, cap=cap).collect()} == want
    assert M.link_records(m.where("false"), p).count() == 0 and M.link_records(m, p.where("false")).count() == 0


def test_link_records_by_hand(spark):
    p = spark.createDataFrame([(1, "うきは市", ["大村"], 33.33, 130.75, ["debris_flow"])], PLACE)
    rows = [(1, "うきは市", "大村", 33.331, 130.751, ["debris_flow"], "s", "a"), (2, "うきは市", "大村", 33.331, 130.751, ["debris_flow"], "s", "a"), (3, "別市", "大村", 33.331, 130.751, [], "s", "b"), (4, "うきは市", "大村", 34.0, 131.5, [], "s", "c"), (5, "うきは市", "大村", None, None, ["tsunami"], "s", None)]
    m = spark.createDataFrame([(i, i, *rest) for i, *rest in rows], MENTION)
    assert {r.mention_id: r.relation for r in M.link_records(m, p).collect()} == {1: "same_place_record", 5: "nearby_record"}
    had = spark.createDataFrame([(1, "s", "a"), (1, "t", "x")], "place_id int, source_id string, locator string")
    assert M.link_records(m, p, had, cap=2).count() == 0


def test_rescore_linked(spark):
    places = spark.createDataFrame([(1, 1), (2, 2), (3, 1)], "id int, evidence_level int")
    evidence = spark.createDataFrame([(i, "gazetteer", "supports", 1, "llm") for i in (1, 2, 3)], "id int, kind string, stance string, level int, extracted_by string")
    records = spark.createDataFrame([(1, "same_place_record"), (1, "nearby_record"), (2, "nearby_record")], "id int, relation string")
    stage = Stage("scores")
    rows = {r.id: (r.level_before, r.evidence_level, r.raised) for r in D.rescore_linked(places, evidence, records, stage).collect()}
    assert rows == {1: (1, 3, True), 2: (2, 1, False)} and stage.counters() == {"places_with_records": 2, "raised": 1}
    [row] = stage_report(spark, [stage]).collect()
    assert (row.stage, row.produced, row.skipped, row.detail) == ("scores", 0, 0, {"places_with_records": 2, "raised": 1})


def test_merge_order(spark):
    levels = [1, 0, 2, 2, 3, 1]
    r = spark.createDataFrame([("x", i, v) for i, v in enumerate(levels)], "id string, ord int, level int")
    win, ev = D.merge_records(r, r.select("id", "ord", F.lit(0).alias("pos")))
    best, merged = None, []  # the direct loop
    for i, v in enumerate(levels):
        if best is None or v > levels[best]:
            best, merged = i, [i, *merged]
        else:
            merged.append(i)
    assert win.first().ord == best
    assert [x.ord for x in ev.orderBy("merged_pos").collect()] == merged


def test_learn_char_map(spark):
    p = spark.createDataFrame([(0, "豐田", "豊田"), (1, "豐岡", "豊岡"), (2, "灣岸", "湾岸"), (3, "入灣", "入湾"), (4, "一沢", "一澤"), (5, "長い", "短")], "ord int, old string, new string")
    assert {(r.old_char, r.new_char) for r in D.learn_char_map(p).collect()} == {("豐", "豊"), ("灣", "湾")}


def test_heading_lookup(spark):
    places = spark.createDataFrame(
        [(1, 0, "豊後", "速見郡", "守江", [], ["モリエ"]), (2, 1, "肥後", None, "守江", [], []), (3, 2, "豊後", "速見郡", "八坂郷", [], []), (4, 3, "豊後", "国東郡", "守江", [], ["モリウエ"])],
        "place_id int, ord int, province string, district string, name string, old_forms array<string>, readings array<string>",
    )
    h = spark.createDataFrame([(1, "豊後", "速見郡", "守江", ""), (2, "豊後", None, "八坂〓", ""), (3, "豊後", None, "守江", "モリウエ"), (4, "肥後", "x", "守江", ""), (5, "豊後", None, "無", "")], "heading_id int, province string, district string, heading string, reading string")
    got = {r.heading_id: (r.place_id, r.candidates) for r in M.heading_lookup(h, M.place_keys(places), places).collect()}
    assert got == {1: (1, 1), 2: (3, 1), 3: (4, 2), 4: (2, 1)}


def test_rings(spark):
    ring = F.array(*[F.struct(F.lit(float(x)).alias("lon"), F.lit(float(y)).alias("lat")) for x, y in ((0, 0), (2, 0), (2, 2), (0, 2), (0, 0))])
    assert value(spark, G.ring_area2(ring)) == 8.0
    twice = F.concat(F.slice(ring, 1, 1), F.slice(ring, 1, 4))
    assert value(spark, F.size(G.round_ring(twice))) == 5
    pts = [(x / 100, 0.0) for x in range(50)] + [(0.5, 0.5), (0.0, 0.5), (0.0, 0.0)]
    df = spark.createDataFrame([(1, 0, [{"lon": x, "lat": y} for x, y in pts]), (2, 0, [])], "area_key long, ring_ord int, ring array<struct<lon:double,lat:double>>")
    got = {r.area_key: (r.before, r.after) for r in G.simplify_rings(df).collect()}
    assert got == {1: (53, 5)}  # the empty ring encloses nothing


SQUARE = [(139.0, 36.0), (139.5, 36.0), (140.0, 36.0), (140.0, 36.5), (140.0, 37.0), (139.5, 37.0), (139.0, 37.0), (139.0, 36.5), (139.0, 36.0)]


def rings_of(spark, rings, **options):
    rows = [(a, o, [{"lon": x, "lat": y} for x, y in ring]) for a, o, ring in rings]
    df = spark.createDataFrame(rows, "area_key long, ring_ord int, ring array<struct<lon:double,lat:double>>")
    return {(r.area_key, r.ring_ord): [(p.lon, p.lat) for p in r.ring] for r in G.simplify_rings(df, **options).collect()}


def test_simplified_rings(spark):
    dense = [(139.0 + i * 0.00001, 36.0) for i in range(200)] + [(140.0, 37.0), (139.0, 36.0)]
    triangle = [(0.0, 0.0), (1.0, 0.0), (0.0, 1.0), (0.0, 0.0)]
    near = [(139.000001, 36.000001), (139.000002, 36.000002), (140.0, 36.0), (140.0, 37.0), (139.000001, 36.000001)]
    got = rings_of(spark, [(1, 0, SQUARE), (1, 1, [(139.0, 36.0)] * 4), (2, 0, triangle), (3, 0, dense), (4, 0, near), (5, 0, SQUARE[:-1])], tolerance=0.001)
    assert set(got[1, 0]) == {(139.0, 36.0), (140.0, 36.0), (140.0, 37.0), (139.0, 37.0)} and got[1, 0][0] == got[1, 0][-1]
    assert (1, 1) not in got and got[2, 0] == triangle and len(got[3, 0]) < 100
    assert got[4, 0][0] == (139.0, 36.0) == got[4, 0][-1] and len(got[4, 0]) < len(near)
    assert got[5, 0][0] == got[5, 0][-1]
    assert len(rings_of(spark, [(1, 0, SQUARE)], tolerance=100.0)[1, 0]) >= 4


def test_shared_borders(spark):
    """Three areas around one point, an island, a ring in a ring and a ring of few points: borders stay together."""
    import math
    import random

    rng = random.Random(4)

    def border(a, b, n=60):
        xs = [(a[0] + (b[0] - a[0]) * i / n + rng.uniform(-0.002, 0.002), a[1] + (b[1] - a[1]) * i / n + rng.uniform(-0.002, 0.002)) for i in range(1, n)]
        return [a, *xs, b]

    hub, rim = (0.0, 0.0), [(math.cos(t), math.sin(t)) for t in (0.3, 2.4, 4.5)]
    spokes, outer = [border(hub, p) for p in rim], [border(rim[i], rim[(i + 1) % 3]) for i in range(3)]
    areas = [(i, 0, spokes[i] + outer[i][1:] + spokes[(i + 1) % 3][::-1][1:]) for i in range(3)]
    circle = [(5 + math.cos(k / 50 * math.tau), math.sin(k / 50 * math.tau)) for k in range(50)]
    turned = circle[20:] + circle[:20]
    areas += [(7, 0, circle + circle[:1]), (8, 0, (turned + turned[:1])[::-1]), (9, 0, [(9.0, 9.0), (9.0, 9.5), (9.5, 9.0), (9.0, 9.0)])]
    got = rings_of(spark, areas, tolerance=0.02, shared=True)
    for i in range(3):
        mine, next_ = set(got[i, 0]), set(got[(i + 1) % 3, 0])
        on_spoke = {(round(x, 5), round(y, 5)) for x, y in spokes[(i + 1) % 3]}
        assert mine & on_spoke == next_ & on_spoke and 2 <= len(mine & on_spoke) < 30
        assert (0.0, 0.0) in mine and got[i, 0][0] == got[i, 0][-1]
    assert set(got[7, 0]) == set(got[8, 0]) and 4 < len(got[7, 0]) < 40 and len(got[9, 0]) == 4


def test_tiles(spark):
    t = lambda la, lo, z: tuple(value(spark, G.tile_pixel(F.lit(la), F.lit(lo), z)))
    assert t(85.0511, -180.0, 0)[:2] == (0, 0)
    assert t(0.0, 0.0, 1) == (1, 1, 0, 0)


LAYOUT = """山  崩                      目次の前の文章がここに入る。
梅田村・・・・・3
                     12
        梅   田   村（ウメダムラ）
      （梅田町１～２丁目の一部、
             高沢町３丁目、 * 町別小字表２参照）
   字      小    字     地 名 語 源（寛文の
                               （１６７３）の水帳の字による）
 ｼﾞﾔ       ｸｽﾞﾚ
蛇     崩                  大蛇が出た崩壊地名である。
                            土石流の跡が残る。
                  前      田    村の前にある広い田をいう。
大 きな 谷 久保   下 の 前 田 原    長い名は広い間で二つに分ける。
久安年間(1462)新町            文であり名ではない。
"""


def test_layout_dictionary():
    rows = L.parse_layout(LAYOUT)
    assert [(r["name"], r["level"], r["aza"]) for r in rows] == [("蛇崩", "koaza", None), ("前田", "aza", None), ("大きな谷久保", "koaza", "下の前田原")]
    assert {(r["village"], r["village_reading"], r["page"], r["area"]) for r in rows} == {("梅田村", "ウメダムラ", 12, "梅田町１～２丁目の一部、高沢町３丁目")}
    assert rows[0]["reading"] == "ジヤクズレ" and rows[1]["reading"] is None
    assert rows[0]["description"] == "大蛇が出た崩壊地名である。土石流の跡が残る。"
    assert L.parse_layout("") == [] and L.parse_layout("蛇     崩                  大蛇が出た崩壊地名である。") == []


def test_province_in_both_ways(spark, monkeypatch):
    t = spark.createDataFrame([(1, "昔の武蔵国の村"), (2, "国蔵武"), (3, "無"), (4, None), (5, ""), (6, "下総と武蔵国")], "text_id int, text string")
    p = spark.createDataFrame([("武蔵",), ("武蔵国",), ("下総",), ("",), (None,)], "province string")
    want = {1: "武蔵国", 2: "武蔵国", 3: None, 4: None, 5: None, 6: "武蔵国"}
    for few, block in ((200, 500_000), (0, 500_000), (0, 1)):
        monkeypatch.setattr(H, "FEW", few)
        monkeypatch.setattr(H, "AUTOMATON_WORDS", block)
        assert {r.text_id: r.province for r in M.province_in(t, p).collect()} == want


def test_partitions(spark, tmp_path):
    rows = spark.createDataFrame([(i, None if i == 5 else str(i % 3)) for i in range(9)], "id long, pref_code string")
    B.write_partitions(rows, f"{tmp_path}/t")
    read = lambda *codes: {r.id for r in B.load_partition(spark, f"{tmp_path}/t", list(codes), "id long, pref_code string").collect()}
    assert read("1") == {1, 4, 7} and read("00", "7") == {5} and read("7") == set()


def test_large_dictionary(spark):
    """200,000 surfaces against names: brute force, in a plan without nested loops."""
    import contextlib
    import io
    import random

    rng = random.Random(1)
    signs = [chr(0xAC00 + i) for i in range(300)]  # no folding changes them
    surfaces = list({"".join(rng.choices(signs, k=rng.randint(2, 4))) for _ in range(235_000)})
    assert len(surfaces) > 200_000
    names = ["".join(rng.choices(signs, k=rng.randint(0, 9))) for _ in range(3000)] + ["", None]
    elements = spark.createDataFrame([(f"e{i}", i, [w], [], [], 0.5) for i, w in enumerate(surfaces)], "element_id string, element_ord int, surfaces array<string>, readings array<string>, hazards array<string>, specificity double")
    found = M.match_elements(spark.createDataFrame(list(enumerate(names)), "name_id int, name string"), elements, surface_only=True)
    with contextlib.redirect_stdout(io.StringIO()) as plan:
        found.explain()
    assert "NestedLoop" not in plan.getvalue() and "Cartesian" not in plan.getvalue()
    known = {w: f"e{i}" for i, w in enumerate(surfaces)}
    want = {(i, known[n[a : a + k]]) for i, n in enumerate(names) if n for a in range(len(n)) for k in (2, 3, 4) if n[a : a + k] in known}
    assert want and {(r.name_id, r.element_id) for r in found.collect()} == want


def test_holding(spark, monkeypatch):
    t = spark.createDataFrame([(1, "abcab"), (1, "abcab"), (2, None), (3, ""), (4, "xyz")], "id int, text string")
    w = spark.createDataFrame([("ab",), ("bc",), ("b",), ("",), (None,), ("ab",), ("yz",)], "word string")
    want = sorted([(1, x) for x in ("ab", "b", "bc")] * 2 + [(4, "yz")])
    for few, block in ((200, 500_000), (0, 500_000), (0, 1)):
        monkeypatch.setattr(H, "FEW", few)
        monkeypatch.setattr(H, "AUTOMATON_WORDS", block)
        assert sorted((r.id, r.word) for r in H.holding(t, "text", w, "word").collect()) == want
    assert H.holding(t, "text", w.where("false"), "word").count() == 0


def test_verified_quotes_both_ways(spark, monkeypatch):
    q = spark.createDataFrame([(1, "山 崩れがあった"), (2, "無い文"), (3, ""), (4, None), (5, "崩")], "quote_id int, quote string")
    s = spark.createDataFrame([(1, "昔、山崩れが あった。"), (2, None)], "source_id int, text string")
    want = {(1, 1), (5, 1)}
    for few in (200, 0):
        monkeypatch.setattr(H, "FEW", few)
        assert {(r.quote_id, r.source_id) for r in E.verified_quotes(q, s).collect()} == want


def test_html_text(spark):
    page = "<head><title>t</title></head><body><p>a &amp;lt; b<script>x</script><br>c　 d</p><!-- no --></body>"
    assert value(spark, S.html_to_text(F.lit(page))) == "a < b\nc d"
    other = "<dl><dt>&eacute;&#x5c71;</dt><dd>&amp;hellip;&nbsp;</dd></dl>&amp;amp &copy"
    assert value(spark, S.html_to_text(F.lit(other))) == "é山\n…\n& ©"


def test_same_result_for_any_number_of_partitions(spark):
    from evidence_atlas.plans import catalog

    out = []
    for n in ("1", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        out.append(sorted(map(tuple, catalog.QUERIES["link_records"](spark, "/root/testdata/sf0.001").collect()), key=repr))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert out[0] == out[1]


def nearest_by_force(points, addresses, step=0.1, rings=3, limit=25.0, exact=False):
    import math

    out = {}
    for i, lat, lon in points:
        r, c = int(lat / step), int(lon / step)
        found = []
        for a, o, y, x in addresses:
            dr, dc = int(y / step) - r, int(x / step) - c
            ring = max(abs(dr), abs(dc))
            if ring <= rings:
                e = (x - lon) * math.cos(math.radians(lat))
                found.append((111.0 * math.sqrt((y - lat) ** 2 + e * e), ring, dr, dc, o, a))
        if not found:
            continue
        last = rings if exact else max(min(f[1] for f in found), 1)
        best = min(f for f in found if f[1] <= last)
        if best[0] <= limit:
            out[i] = (best[5], round(best[0], 6))
    return out


def test_nearest_address(spark, monkeypatch):
    """Dense cells, lonely points, ties and the cells around zero, against every pair."""
    import random

    rng = random.Random(8)
    near = lambda y, x, d: (y + rng.uniform(-d, d), x + rng.uniform(-d, d))
    addresses = [near(35.05, 135.05, 0.05) for _ in range(900)] + [near(0.0, 0.0, 0.2) for _ in range(300)] + [near(36.5, 137.5, 0.5) for _ in range(60)] + [(35.0625, 135.0625)] * 3 + [(35.0, 135.1), (35.1, 135.0)]
    addresses = [(i, 5000 - i, y, x) for i, (y, x) in enumerate(addresses)]
    points = [near(35.05, 135.05, 0.06) for _ in range(200)] + [near(0.0, 0.0, 0.3) for _ in range(100)] + [near(36.5, 137.5, 0.9) for _ in range(150)] + [(35.0625, 135.0625), (35.05, 135.05), (50.0, 10.0)]
    points = [(i, y, x) for i, (y, x) in enumerate(points)]
    a = spark.createDataFrame(addresses, "address_id int, ord int, lat double, lon double").repartition(5)
    p = spark.createDataFrame(points + [(-1, None, 1.0)], "point_id int, lat double, lon double")
    for cell, exact in ((12, False), (1, False), (10**6, False), (12, True)):
        monkeypatch.setattr(G, "CELL_ADDRESSES", cell)
        got = {r.point_id: (r.address_id, round(r.km, 6)) for r in G.nearest_address(p, a, exact=exact).collect()}
        assert got == nearest_by_force(points, addresses, exact=exact)
    monkeypatch.setattr(G, "CELL_ADDRESSES", 12)
    here = p.where("lat is not null").selectExpr("point_id", "lat as plat", "lon as plon", "cast(lat / 0.1 as int) as r", "cast(lon / 0.1 as int) as c")
    there = a.selectExpr("address_id", "ord", "lat", "lon", "cast(lat / 0.1 as int) as ar", "cast(lon / 0.1 as int) as ac")
    settled = G._fine(here, there, 0.1).where("point_id < 200").count()
    assert settled > 100  # more than half of the 200 points among the dense addresses end in the first round


def test_geocode_parts(spark):
    """The first large section that the name holds, by brute force."""
    import random

    rng = random.Random(9)
    word = lambda n: "".join(rng.choices("山川谷沢", k=n))
    addresses = [(i, "P", rng.choice("AB"), word(rng.randint(1, 3)), "", f"c{i}", float(i), 0.0) for i in range(40)]
    records = [(i, "P", rng.choice("ABC"), word(rng.randint(1, 6)), None, None) for i in range(200)] + [(900, None, "A", "山", None, None), (901, "P", "A", None, None, None)]
    tables = M.address_tables(spark.createDataFrame(addresses, "ord int, pref string, municipality string, oaza string, koaza string, code string, lat double, lon double"))
    r = spark.createDataFrame(records, "record_id int, pref string, municipality string, name string, oaza string, koaza string")
    got = {x.record_id: (x.lat, x.precision) for x in M.geocode_lookup(r, tables).collect()}
    want = {}
    for i, pref, town, name, _, _ in records:
        own = [a for a in addresses if pref and a[2] == town]
        whole, part = [a for a in own if a[3] == name], [a for a in own if name and a[3] in name]
        if whole or part:
            want[i] = ((whole or part)[0][6], "oaza")
        elif own:
            want[i] = (sum(a[6] for a in own) / len(own), "municipality")
    assert {k: (round(v[0], 6), v[1]) for k, v in got.items()} == {k: (round(v[0], 6), v[1]) for k, v in want.items()}


def test_attach_areas(spark):
    areas = spark.createDataFrame([(1, 0, "P", "A", "山"), (2, 1, "P", "A", "川"), (3, 2, "P", "A", "山"), (4, 3, "P", "B", "谷")], "area_key int, ord int, pref string, municipality string, name string")
    records = spark.createDataFrame([(10, "P", "A", "川", "山", "x"), (11, "P", "A", None, "山", "x"), (12, "P", "A", "", None, "山"), (13, "P", "A", None, None, "谷"), (14, None, "B", None, None, "谷")], "record_id int, pref string, municipality string, oaza string, koaza string, name string")
    stage = Stage("areas")
    found, covered = M.attach_areas(records, areas, stage)
    assert {r.record_id: r.area_key for r in found.collect()} == {10: 2, 11: 1, 12: 1, 13: None, 14: None}
    assert stage.counters() == {"produced": 3, "skipped": 2}
    assert sorted((r.area_key, r.covers) for r in covered.collect()) == [(1, 11), (1, 12), (2, 10)]
