"""Distances, nearest points, tiles and rings."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .match import first_rows
from .report import Stage, watched

#: Kilometres: radius of the earth, and one degree of a meridian as the grid search counts it.
RADIUS_KM, DEGREE_KM = 6371.0, 111.0


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    a, b = F.radians(_c(lat1)), F.radians(_c(lat2))
    h = F.pow(F.sin((b - a) / 2), 2) + F.cos(a) * F.cos(b) * F.pow(F.sin(F.radians(_c(lon2) - _c(lon1)) / 2), 2)
    return 2 * RADIUS_KM * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def flat_km(lat1, lon1, lat2, lon2) -> Column:
    """Equirectangular distance at the first point."""
    x = (_c(lon2) - _c(lon1)) * F.cos(F.radians(_c(lat1)))
    return DEGREE_KM * F.sqrt(F.pow(_c(lat2) - _c(lat1), 2) + x * x)


def far_pairs(left: DataFrame, right: DataFrame, keys: list[str], max_km: float, steps: tuple[float, float] = (1.0, 0.25)) -> DataFrame:
    """One row, n: how many pairs of left and right rows of the same keys lie farther apart than ``max_km``; exact.

    Cells of ``steps`` degrees (the second divides the first) are paired first:
    where the distance of their middles, give or take both their radii, tells,
    their rows are multiplied; only points of cells at the very distance meet.
    """
    slack = 0.01  # km, more than the arithmetic is off by

    def spots(t: DataFrame, side: str) -> DataFrame:
        cell = lambda step: F.floor((F.col("lat") + 90) / step) * (1 << 20) + F.floor((F.col("lon") + 180) / step)
        n = t.where("lat is not null and lon is not null").groupBy(*keys, "lat", "lon").agg(F.count("*").alias(f"n{side}"))
        return n.select(*keys, cell(steps[0]).alias(f"{side}0"), cell(steps[1]).alias(f"{side}1"), F.col("lat").alias(f"{side}lat"), F.col("lon").alias(f"{side}lon"), f"n{side}")

    def told(pair: DataFrame, i: int) -> tuple[DataFrame, DataFrame]:
        step = steps[i]
        middle = lambda c: ((F.shiftright(c, 20) + 0.5) * step - 90, (F.pmod(F.col(c), F.lit(1 << 20)) + 0.5) * step - 180)
        off = RADIUS_KM * math.radians(step) * math.sqrt(2) + slack  # of both cells together
        d = haversine_km(*middle(f"a{i}"), *middle(f"b{i}"))
        return pair.where(d - off > max_km), pair.where((d - off <= max_km) & (d + off > max_km)).select(*keys, f"a{i}", f"b{i}")

    a, b = spots(left, "a"), spots(right, "b")
    by = lambda t, side, *cells: t.groupBy(*keys, *cells).agg(F.sum(f"n{side}").alias(f"n{side}"))
    far, still = told(by(a, "a", "a0").join(by(b, "b", "b0"), keys), 0)
    far_1, still = told(still.join(by(b, "b", "b0", "b1"), [*keys, "b0"]).join(by(a, "a", "a0", "a1"), [*keys, "a0"]), 1)
    far_2 = still.join(b, [*keys, "b1"]).join(a, [*keys, "a1"]).where(haversine_km("blat", "blon", "alat", "alon") > max_km)
    sums = [t.agg(F.sum(F.col("na") * F.col("nb")).alias("n")) for t in (far, far_1, far_2)]
    return sums[0].union(sums[1]).union(sums[2]).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))


#: Addresses that a cell of the fine index holds at most on average, and the most times a cell is halved.
CELL_ADDRESSES, MOST_HALVINGS = 12, 12

#: What makes one address better than another at the same distance: ring and cell in their order, then its own.
_TIES = ["km", "ring", "dr", "dc", "ord"]


def _best(pairs: DataFrame, *before: str) -> DataFrame:
    """(point_id, address_id, km): the best of each point's pairs, by the columns ``before`` first."""
    return pairs.groupBy("point_id").agg(F.min_by(F.struct("address_id", "km"), F.struct(*before, *[t for t in _TIES if t not in before])).alias("_b")).select("point_id", "_b.*")


def _rings(points: DataFrame, there: DataFrame, first: int, last: int) -> DataFrame:
    """Pairs of points and the addresses in rings ``first`` to ``last`` of cells around them."""
    around = [(dr, dc) for dr in range(-last, last + 1) for dc in range(-last, last + 1) if max(abs(dr), abs(dc)) >= first]
    cells = F.array(*[F.struct(F.lit(a).alias("dr"), F.lit(b).alias("dc")) for a, b in around])
    spread = points.withColumn("_d", F.explode(cells)).select("point_id", "plat", "plon", "_d.*", (F.col("r") + F.col("_d.dr")).alias("ar"), (F.col("c") + F.col("_d.dc")).alias("ac"))
    near = spread.join(there, ["ar", "ac"]).withColumn("ring", F.greatest(F.abs("dr"), F.abs("dc")))
    return near.withColumn("km", flat_km("plat", "plon", "lat", "lon"))


def _parts_around(points: DataFrame, there: DataFrame, step: float, many: int) -> tuple[DataFrame, DataFrame]:
    """Points in dense cells by the four parts nearest to them, and what is searched by part: to be joined on level, fr, fc.

    points(plat, plon, r, c, ...); there(lat, lon, ar, ac, ...). A cell of
    more than ``many`` is halved until a part holds at most so many on average.
    margin: km within which a point misses nothing in its four parts.
    """
    count = there.groupBy("ar", "ac").agg(F.count("*").alias("n"))
    halvings = F.least(F.ceil(F.log(4.0, F.col("n") / many)), F.lit(MOST_HALVINGS)).cast("int")
    dense = count.select(F.col("ar").alias("r"), F.col("ac").alias("c"), halvings.alias("level")).where("level > 0")
    size = F.lit(step) / F.pow(F.lit(2.0), F.col("level"))
    asking = points.join(dense, ["r", "c"]).withColumn("size", size)
    # the corner of the finer grid nearest to the point: the four parts that meet there
    y, x = F.round(F.col("plat") / F.col("size")), F.round(F.col("plon") / F.col("size"))
    margin = DEGREE_KM * F.least((1 - F.abs(F.col("plat") / F.col("size") - y)) * F.col("size"), (1 - F.abs(F.col("plon") / F.col("size") - x)) * F.col("size") * F.cos(F.radians("plat")))
    parts = F.array(*[F.struct((y + a).cast("long").alias("fr"), (x + b).cast("long").alias("fc")) for a in (-1, 0) for b in (-1, 0)])
    asking = asking.select(*points.columns, "level", (margin * (1 - 1e-9)).alias("margin"), F.explode(parts).alias("_f")).select("*", "_f.*").drop("_f")
    # what is searched stands in the grid of every level that a neighbouring cell may ask for
    offsets = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in (-1, 0, 1) for b in (-1, 0, 1)])
    wanted = dense.withColumn("_o", F.explode(offsets)).select((F.col("r") + F.col("_o.a")).alias("ar"), (F.col("c") + F.col("_o.b")).alias("ac"), "level").distinct()
    index = there.join(wanted, ["ar", "ac"]).withColumns({"fr": F.floor(F.col("lat") / size).cast("long"), "fc": F.floor(F.col("lon") / size).cast("long")})
    return asking, index


def _fine(points: DataFrame, there: DataFrame, step: float) -> DataFrame:
    """(point_id, address_id, km) of points in dense cells that are settled by the cells of a finer index.

    A cell of many addresses is halved until a part holds a dozen. A point
    looks into the four parts nearest to it, and is settled if its best
    address is nearer than any that lies outside them could be.
    """
    asking, index = _parts_around(points, there, step, CELL_ADDRESSES)
    pairs = asking.join(index, ["level", "fr", "fc"]).withColumns({"km": flat_km("plat", "plon", "lat", "lon"), "dr": F.col("ar") - F.col("r"), "dc": F.col("ac") - F.col("c")})
    pairs = pairs.where("km < margin").withColumn("ring", F.greatest(F.abs("dr"), F.abs("dc")))
    return _best(pairs)


def nearest_address(points: DataFrame, addresses: DataFrame, step: float = 0.1, rings: int = 3, limit_km: float = 25.0, exact: bool = False) -> DataFrame:
    """(point_id, address_id, km): the nearest address in the cells around a point.

    points(point_id, lat, lon); addresses(address_id, ord, lat, lon). Cells of
    ``step`` degrees are numbered by cutting toward zero. Rings of cells are
    taken from the inside; the first ring from 1 on by which anything was
    found is the last (``exact`` takes all rings). Ties go to the cell that
    comes first by latitude and longitude, then the first address.

    Points go outward in rounds, those without an answer only: the finer
    index of dense cells, the rings 0 and 1, then the rings beyond. Each round
    is an equality join on a cell.
    """
    cell = lambda x: (F.col(x) / step).cast("int")
    here = points.where("lat is not null and lon is not null").select("point_id", F.col("lat").alias("plat"), F.col("lon").alias("plon"), cell("lat").alias("r"), cell("lon").alias("c"))
    there = addresses.select("address_id", "ord", "lat", "lon", cell("lat").alias("ar"), cell("lon").alias("ac"))
    if exact:
        out = _best(_rings(here, there, 0, rings))
    else:
        out = _fine(here, there, step)
        rest = here.join(out.select("point_id"), "point_id", "left_anti")
        inner = _best(_rings(rest, there, 0, 1))
        beyond = rest.join(inner.select("point_id"), "point_id", "left_anti")
        outer = _rings(beyond, there, 2, rings)
        out = out.union(inner).union(_best(outer, "ring"))
    return out.where(F.col("km") <= limit_km)


#: Pairs that one task of ``nearby`` makes and sorts at most on average.
TASK_PAIRS = 1 << 21


def _meet(asking: DataFrame, there: DataFrame, keys: list[str]) -> DataFrame:
    """The join of both by equal keys, in as many tasks as its rows need: tables that are small as files may make many pairs."""
    n = asking.groupBy(*keys).agg(F.count("*").alias("na")).join(there.groupBy(*keys).agg(F.count("*").alias("nb")), keys).agg(F.sum(F.col("na") * F.col("nb")).alias("n")).first().n or 0
    tasks = max(int(asking.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n // TASK_PAIRS))
    return asking.repartition(tasks, *keys).join(there.repartition(tasks, *keys), keys)


def nearby(points: DataFrame, monuments: DataFrame, radius_km: float = 3.0, keep: int = 5, step: float | None = None) -> DataFrame:
    """(point_id, monument_id, km, rank): the nearest monuments within a radius.

    Points of one spot are one question, and of the monuments of one spot only
    the first ``keep`` can be an answer. In cells of many monuments a point
    looks into the nearest parts of the cell, and is settled if ``keep`` are
    nearer than any outside could be; the others look through all cells within
    the radius. Those are ``step`` degrees high and wide (half the radius, if
    not given); a point looks into as many columns as the radius spans at its
    latitude, so no pair is missed.
    """
    from .match import _stored

    reach = radius_km / DEGREE_KM
    step = step or reach / 2
    spot = ["plat", "plon"]
    spots = _stored(points.where("lat is not null and lon is not null").select(F.col("lat").alias("plat"), F.col("lon").alias("plon")).distinct(), "spots")
    there = _stored(first_rows(monuments.where("lat is not null and lon is not null").select("monument_id", "lat", "lon"), ["lat", "lon"], "monument_id", n=keep), "there")

    def nearest(pairs: DataFrame) -> DataFrame:
        pairs = pairs.select(*spot, "monument_id", haversine_km("plat", "plon", "lat", "lon").alias("km"), *[c for c in pairs.columns if c == "margin"]).where(F.col("km") <= radius_km)
        pairs = pairs.where("km < margin") if "margin" in pairs.columns else pairs
        rank = Window.partitionBy(*spot).orderBy("km", "monument_id")
        return pairs.select(*spot, "monument_id", "km", F.row_number().over(rank).alias("rank")).where(F.col("rank") <= keep)

    square = min(reach, 1.0)  # degrees: beyond a few of them the margin of a part would not hold
    at = lambda x: (F.col(x) / square).cast("int")
    asking, index = _parts_around(spots.select(*spot, at("plat").alias("r"), at("plon").alias("c")), there.select("*", at("lat").alias("ar"), at("lon").alias("ac")), square, CELL_ADDRESSES * keep)
    got = nearest(_meet(asking, index, ["level", "fr", "fc"]))
    got = _stored(got.withColumn("n", F.max("rank").over(Window.partitionBy(*spot))).where(F.col("n") == keep).drop("n"), "near")

    rows = math.ceil(reach / step)
    phi = F.radians("plat")
    sine = F.lit(math.sin(math.radians(min(reach, 90.0)))) / F.greatest(F.cos(phi), F.lit(1e-9))
    span = F.when((sine >= 1) | (F.abs("plat") + reach >= 90), F.lit(180.0)).otherwise(F.degrees(F.asin(F.least(sine, F.lit(1.0)))))
    cell = lambda x: F.floor(F.col(x) / step).cast("int")
    wide = F.ceil(span / step).cast("int")
    rest = spots.join(got.where("rank = 1"), spot, "left_anti")
    spread = rest.select(*spot, F.explode(F.sequence(cell("plat") - rows, cell("plat") + rows)).alias("cr"), F.sequence(cell("plon") - wide, cell("plon") + wide).alias("cols"))
    spread = spread.select(*spot, "cr", F.explode("cols").alias("cc"))
    outer = nearest(_meet(spread, there.select("*", cell("lat").alias("cr"), cell("lon").alias("cc")), ["cr", "cc"]))
    both = got.union(outer)
    return points.select("point_id", F.col("lat").alias("plat"), F.col("lon").alias("plon")).join(both, spot).select("point_id", "monument_id", "km", "rank")


def tile_pixel(lat, lon, zoom: int, size: int = 256) -> Column:
    """struct(x, y, px, py): Web-Mercator tile and pixel."""
    n = float(2**zoom)
    s = F.radians(_c(lat))
    x = (_c(lon) + 180.0) / 360.0 * n
    y = (1.0 - F.ln(F.tan(s) + 1.0 / F.cos(s)) / math.pi) / 2.0 * n
    inside = lambda v: F.least(F.greatest(F.floor(v), F.lit(0)), F.lit(int(n) - 1))
    pixel = lambda v, t: F.least(F.greatest(F.floor((v - t) * size), F.lit(0)), F.lit(size - 1)).cast("int")
    tx, ty = inside(x), inside(y)
    return F.struct(tx.cast("int").alias("x"), ty.cast("int").alias("y"), pixel(x, tx).alias("px"), pixel(y, ty).alias("py"))


def sample_zones(points: DataFrame, tiles: DataFrame, layers: list[str], zoom: int, size: int = 256, least_alpha: int = 16) -> DataFrame:
    """point_id and a flag for each layer: true where the pixel shows, false without a tile, null if it is unreadable.

    tiles(layer, x, y, status, alpha): alpha of the pixels, row by row.
    """
    at = points.select("point_id", tile_pixel("lat", "lon", zoom, size).alias("t")).select("point_id", "t.*").withColumn("layer", F.explode(F.array(*[F.lit(x) for x in layers])))
    seen = at.join(tiles, ["layer", "x", "y"], "left")
    shows = F.try_element_at("alpha", F.col("py") * size + F.col("px") + 1) > least_alpha
    flag = F.when(F.col("status").isNull(), F.lit(False)).when(F.col("status") == "ok", F.coalesce(shows, F.lit(False)))
    return seen.withColumn("flag", flag).groupBy("point_id").pivot("layer", layers).agg(F.first("flag"))


def corroborate(records: DataFrame, near: DataFrame, zones: DataFrame, sampled_at: str, stage: Stage | None = None) -> DataFrame:
    """Located records with the monuments near them and the zones they lie in.

    ``stage`` counts as skipped those without a location, as produced the
    others, and of these in_any_zone and with_monument.
    """
    layers = [c for c in zones.columns if c != "point_id"]
    records = watched(records, stage, skipped=F.col("lat").isNull() | F.col("lon").isNull())
    ids = near.groupBy("point_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "monument_id"))), lambda x: x["monument_id"]).alias("monument_ids"))
    located = records.where("lat is not null and lon is not null").withColumn("point_id", F.col("record_id"))
    out = located.join(ids, "point_id", "left").join(zones, "point_id", "left").withColumn("monument_ids", F.coalesce("monument_ids", F.array().cast("array<long>")))
    out = out.withColumn("sampled_at", F.lit(sampled_at)).drop("point_id")
    flagged = F.coalesce(F.greatest(F.lit(False), *[F.coalesce(F.col(c), F.lit(False)) for c in layers]), F.lit(False))
    return watched(out, stage, produced=F.lit(1), in_any_zone=flagged, with_monument=F.size("monument_ids") > 0)


def ring_area2(ring) -> Column:
    """Twice the area of a ring, array<struct<lon, lat>>, by the shoelace sum."""
    r = _c(ring)
    nxt = F.concat(F.slice(r, F.lit(2), F.size(r)), F.slice(r, 1, 1))
    terms = F.zip_with(r, nxt, lambda a, b: a["lon"] * b["lat"] - b["lon"] * a["lat"])
    return F.abs(F.aggregate(terms, F.lit(0.0), lambda acc, x: acc + x))


def ring_box(ring) -> Column:
    r = _c(ring)
    span = lambda f, k: f(F.transform(r, lambda p: p[k]))
    return F.struct(span(F.array_min, "lon").alias("west"), span(F.array_min, "lat").alias("south"), span(F.array_max, "lon").alias("east"), span(F.array_max, "lat").alias("north"))


def largest_rings(rings, keep: int = 8, digits: int | None = None) -> Column:
    """The rings of largest area, largest first (equal ones in their order).

    With ``digits`` areas that agree so far after the decimal point are equal:
    sums of floating point tell rings of one area apart by their last bits.
    """
    area = ring_area2 if digits is None else lambda r: F.round(ring_area2(r), digits)
    ranked = F.transform(_c(rings), lambda r, i: F.struct((-area(r)).alias("a"), i.alias("i"), r.alias("r")))
    return F.transform(F.slice(F.array_sort(ranked), 1, keep), lambda x: x["r"])


def _named(x, f) -> Column:
    """f(x), x worked out once however often f uses it."""
    return F.transform(F.array(x), f)[0]


def round_ring(ring, digits: int = 5) -> Column:
    """Rounded half to even, without repeated points in a row, closed."""
    near = F.transform(_c(ring), lambda p: F.struct(F.bround(p["lon"], digits).alias("lon"), F.bround(p["lat"], digits).alias("lat")))
    kept = _named(near, lambda n: F.filter(n, lambda p, i: (i == 0) | (p != F.try_element_at(n, i))))
    closed = lambda k: F.when((F.size(k) > 0) & (F.try_element_at(k, F.lit(1)) != F.try_element_at(k, F.lit(-1))), F.concat(k, F.slice(k, 1, 1))).otherwise(k)
    return _named(kept, closed)


def rings_from_parts(points, parts) -> Column:
    """Cut a flat list of points at the starts in ``parts``; rings of fewer than four points go."""
    p, s = _c(points), _c(parts)
    cut = F.transform(s, lambda a, i: F.slice(p, a + 1, F.coalesce(F.try_element_at(s, i + 2), F.size(p)) - a))
    return F.filter(cut, lambda r: F.size(r) >= 4)


def _thin(points, tolerance: float):
    """The points of a line that stay: its ends, and those farther than the tolerance from the line through the ends of their stretch."""
    import numpy as np

    keep = np.zeros(len(points), bool)
    keep[[0, -1]] = True
    todo = [(0, len(points) - 1)]
    while todo:
        a, b = todo.pop()
        if b - a < 2:
            continue
        d, rest = points[b] - points[a], points[a + 1 : b] - points[a]
        size = np.hypot(*d)
        off = np.abs(d[0] * rest[:, 1] - d[1] * rest[:, 0]) / size if size else np.hypot(rest[:, 0], rest[:, 1])
        far = int(off.argmax())
        if off[far] > tolerance:
            keep[a + 1 + far] = True
            todo += [(a, a + 1 + far), (a + 1 + far, b)]
    return points[keep]


def _staying(points, sizes, tolerance: float):
    """Which points stay of rings that follow one another, all thinned together as ``_thin`` does one; those of at most four points, and left with fewer, stay whole."""
    import numpy as np

    ring = np.repeat(np.arange(len(sizes)), sizes)
    start = np.cumsum(sizes) - sizes
    keep = (sizes <= 4)[ring]
    a = start[sizes > 4]
    b = a + sizes[sizes > 4] - 1
    keep[a] = keep[b] = True
    while len(a):
        a, b = a[b - a > 1], b[b - a > 1]
        if not len(a):
            break
        inner = b - a - 1
        first = np.cumsum(inner) - inner
        of = np.repeat(np.arange(len(a)), inner)
        at = np.arange(len(of)) - first[of] + a[of] + 1
        d, rest = points[b] - points[a], points[at] - points[a][of]
        size = np.hypot(d[:, 0], d[:, 1])
        with np.errstate(all="ignore"):
            line = np.abs(d[of, 0] * rest[:, 1] - d[of, 1] * rest[:, 0]) / size[of]
        off = np.where(size[of] != 0, line, np.hypot(rest[:, 0], rest[:, 1]))
        top = np.maximum.reduceat(off, first)
        hit = np.nonzero((off == top[of]) & (top > tolerance)[of])[0]
        parted, i = np.unique(of[hit], return_index=True)  # the first of those that are equally far
        far = at[hit[i]]
        keep[far] = True
        a, b = np.concatenate([a[parted], far]), np.concatenate([far, b[parted]])
    few = np.bincount(ring[keep], minlength=len(sizes)) < 4
    return keep | few[ring]


def _thin_arcs(points, corners, tolerance: float):
    """A closed ring cut at its corners, each arc thinned in the direction that begins with the smaller point.

    What becomes of an arc thus depends on its own points only, and is the
    same for the ring on its other side. A ring without corners is cut at its
    smallest point.
    """
    import numpy as np

    ring = points[:-1] if len(points) > 1 and (points[0] == points[-1]).all() else points
    if len(ring) < 3:
        return points
    at = np.nonzero(corners[: len(ring)])[0]
    if not len(at):
        at = np.array([np.lexsort((ring[:, 1], ring[:, 0]))[0]])
    ring = np.roll(ring, -at[0], axis=0)
    ends = [*(at - at[0]).tolist(), len(ring)]
    closed = np.concatenate([ring, ring[:1]])
    out = []
    for a, b in zip(ends[:-1], ends[1:], strict=True):
        arc = closed[a : b + 1]
        turned = tuple(arc[-1].tolist() + arc[-2].tolist()) < tuple(arc[0].tolist() + arc[1].tolist())
        arc = arc[::-1] if turned else arc
        if (arc[0] == arc[-1]).all() and len(arc) > 3:  # an arc that comes back has no line through its ends: halve it at its farthest point
            far = int(np.hypot(*(arc - arc[0]).T).argmax())
            thin = np.concatenate([_thin(arc[: far + 1], tolerance)[:-1], _thin(arc[far:], tolerance)])
        else:
            thin = _thin(arc, tolerance)
        out.append((thin[::-1] if turned else thin)[:-1])
    whole = np.concatenate([*out, closed[:1]])
    return whole if len(whole) >= 4 else closed


def border_corners(areas: DataFrame) -> DataFrame:
    """(lon, lat) of the points of all rings at which borders part: those with more or fewer than two neighbours."""
    ring = F.when((F.size("ring") > 1) & (F.try_element_at("ring", F.lit(1)) == F.try_element_at("ring", F.lit(-1))), F.slice("ring", 1, F.size("ring") - 1)).otherwise(F.col("ring"))
    following = F.concat(F.slice("_r", F.lit(2), F.size("_r")), F.slice("_r", 1, 1))
    edges = areas.where(F.size("ring") > 2).select(ring.alias("_r")).select(F.explode(F.arrays_zip(F.col("_r").alias("a"), following.alias("b"))).alias("e")).where("e.a <> e.b")
    edge = lambda a, b: F.struct(F.col(a).alias("a"), F.col(b).alias("b"))
    once = edges.select(F.when(F.col("e.a") < F.col("e.b"), edge("e.a", "e.b")).otherwise(edge("e.b", "e.a")).alias("e")).select("e.*").distinct()
    return once.select(F.explode(F.array("a", "b")).alias("a")).groupBy("a").agg(F.count("*").alias("n")).where("n <> 2").select("a.lon", "a.lat")


def simplify_rings(areas: DataFrame, tolerance: float = 1e-4, digits: int = 5, area: str = "area_key", shared: bool = False) -> DataFrame:
    """(area_key, ring_ord, ring, before, after) of areas(area_key, ring_ord, ring): fewer vertices, rounded, closed.

    A vertex goes if it lies within the tolerance of the line through the ends
    of its stretch. Rings of at most four points, and those of which fewer
    than four points would be left, are not thinned. Rings that are left with
    fewer than four points by the rounding enclose nothing and go.

    With ``shared`` rings are cut where borders part (``border_corners``), and
    a stretch of border between two areas is thinned to the same points for
    both, so that no gaps open between neighbours. Points are compared
    exactly for that. Rings are spread over tasks and worked on as arrays.
    """
    import numpy as np
    import pyarrow as pa

    def run(batches):
        for b in batches:
            rings = b.column("ring")
            sizes = np.asarray(rings.value_lengths().fill_null(0), np.int64)
            points = np.column_stack([rings.flatten().field(c).to_numpy(zero_copy_only=False) for c in ("lon", "lat")])
            if shared:
                corners = b.column("_corners")
                marks = corners.flatten().to_numpy(zero_copy_only=False).astype(bool)
                starts = lambda n: np.cumsum(n) - n
                from_ = starts(np.asarray(corners.value_lengths().fill_null(0), np.int64))
                out = [_thin_arcs(points[a : a + n], marks[m : m + n], tolerance) if n > 4 else points[a : a + n] for a, n, m in zip(starts(sizes), sizes, from_, strict=True)]
                left, points = np.array([len(r) for r in out], np.int64), np.concatenate([points[:0], *out])
            else:
                stay = _staying(points, sizes, tolerance)
                left, points = np.bincount(np.repeat(np.arange(len(sizes)), sizes)[stay], minlength=len(sizes)), points[stay]
            at = pa.array(np.concatenate([[0], np.cumsum(left)]), pa.int32())
            ring = pa.ListArray.from_arrays(at, pa.StructArray.from_arrays([pa.array(points[:, 0]), pa.array(points[:, 1])], ["lon", "lat"]))
            yield pa.RecordBatch.from_arrays([b.column(area), b.column("ring_ord"), ring, pa.array(sizes, pa.int32())], [area, "ring_ord", "ring", "before"])

    rows = areas.select(F.col(area).cast("long").alias(area), F.col("ring_ord").cast("int").alias("ring_ord"), "ring")
    if shared:
        rows = rows.repartition(area, "ring_ord")  # a small file may make large rings: their points are spread before they are counted
        corners = border_corners(rows).withColumn("_c", F.lit(True))
        flags = rows.select(area, "ring_ord", F.posexplode("ring").alias("_i", "p")).select(area, "ring_ord", "_i", "p.lon", "p.lat").join(corners, ["lon", "lat"], "left")
        flags = flags.groupBy(area, "ring_ord").agg(F.transform(F.array_sort(F.collect_list(F.struct("_i", F.coalesce("_c", F.lit(False)).alias("c")))), lambda x: x["c"]).alias("_corners"))
        rows = rows.join(flags, [area, "ring_ord"], "left")
    thin = rows.mapInArrow(run, f"{area} long, ring_ord int, ring array<struct<lon:double,lat:double>>, before int")
    # exploded, so that the filter on what is left does not round each ring again; fewer than three points never make four
    near = thin.where(F.size("ring") >= 3).select(area, "ring_ord", F.explode(F.array(round_ring("ring", digits))).alias("ring"), "before")
    return near.withColumn("after", F.size("ring")).where("after >= 4").select(area, "ring_ord", "ring", "before", "after")
