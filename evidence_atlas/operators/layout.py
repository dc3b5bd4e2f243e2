"""Page layout and running text: roles, headings, entries, lines."""

from __future__ import annotations

import re
import unicodedata

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as X
from ..functions.text import full_kana


def classify_blocks(blocks: DataFrame, page: list[str], katakana: str = "^[ァ-ヶー゙゚・〓]+$", kanji: str = "^[一-龥々〆ヶ〓]+$") -> DataFrame:
    """``blocks``(text, x, width, height) with role: running, ruby, heading or body; blank ones go.

    The glyph size of a page is the median of its positive widths (56 without
    any). The margin is what lies within half of it from the outermost column;
    it counts only if all its texts have at most six characters.
    """
    w = Window.partitionBy(*page)
    rows = blocks.where("text is not null and text <> ''")
    rows = rows.withColumn("_m", F.coalesce(F.median(F.when(F.col("width") > 0, F.col("width"))).over(w), F.lit(56.0)))
    rows = rows.withColumn("_in", F.col("x") >= F.max("x").over(w) - 0.5 * F.col("_m"))
    rows = rows.withColumn("_has", F.bool_and(~F.col("_in") | (F.length("text") <= 6)).over(w))
    ratio = X.glyph_ratio("height", "text")
    heading = (F.length("text") >= 2) & (ratio >= 55) & (F.col("width") >= 1.05 * F.col("_m")) & F.rlike("text", F.lit(kanji))
    role = F.when(F.col("_has") & F.col("_in"), "running").when(F.rlike("text", F.lit(katakana)) & (ratio < 45), "ruby").when(heading, "heading").otherwise("body")
    return rows.withColumn("role", role).drop("_m", "_in", "_has")


def reading_beside(headings: DataFrame, rubies: DataFrame, page: list[str], reach: float = 2.5) -> DataFrame:
    """(heading_id, reading): rubies to the right within ``reach`` widths that overlap in height, top down."""
    r = rubies.select(*page, F.col("x").alias("rx"), F.col("y").alias("ry"), F.col("height").alias("rh"), F.col("text").alias("rt"))
    pair = headings.join(r, page).where("rx > x and rx - x <= width * " + str(reach)).where("ry < y + height and ry + rh > y")
    return pair.groupBy("heading_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ry", "rx", "rt"))), lambda s: s["rt"]), "").alias("reading"))


def sticky_context(pages: DataFrame, volume: str = "pid", frame: str = "frame") -> DataFrame:
    """``pages`` with province and district carried forward from running heads.

    Each page has pb (province named by one block), pj (province found in the
    joined margin), db (district named after the last province block) and rx
    (district found in the joined margin). A province stays until another is
    named; a change drops the district. One row for each page and volume.
    """
    w = Window.partitionBy(volume).orderBy(frame)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = pages.withColumn("province", F.last(F.coalesce("pj", "pb"), ignorenulls=True).over(upto))
    rows = rows.withColumn("_mid", F.coalesce("pb", F.lag("province").over(w)))
    rows = rows.withColumn("_change", F.col("pj").isNotNull() & ~F.col("pj").eqNullSafe(F.col("_mid")))
    rows = rows.withColumn("_seg", F.sum((F.col("pb").isNotNull() | F.col("_change")).cast("int")).over(upto))
    part = Window.partitionBy(volume, "_seg").orderBy(frame).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    kept = F.when(~F.col("_change"), F.col("db"))
    rows = rows.withColumn("district", F.coalesce(F.last(kept, ignorenulls=True).over(part), F.first("rx", ignorenulls=True).over(part)))
    return rows.drop("_mid", "_change", "_seg")


def entries_from_blocks(blocks: DataFrame, volume: str = "pid", longest: int = 3000) -> DataFrame:
    """(volume, entry_ord, place_id, frame, body) from blocks(volume, ord, frame, role, text, place_id, has_province).

    A heading with a place opens an entry, to which the body blocks after it
    belong, over pages; any other heading, and a page without a province,
    close it.
    """
    w = Window.partitionBy(volume).orderBy("ord").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    marks = (F.col("role") == "heading") | ~F.col("has_province")
    rows = blocks.withColumn("_e", F.sum(marks.cast("int")).over(w))
    opener = F.max_by(F.when((F.col("role") == "heading") & F.col("has_province"), F.col("place_id")), F.when(marks, F.col("ord")))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.when((F.col("role") == "body") & F.col("has_province"), F.struct("ord", "text")))), lambda s: s["text"]), "")
    first = F.min(F.when(marks, F.struct("ord", "frame")))
    out = rows.groupBy(volume, "_e").agg(opener.alias("place_id"), first.alias("first"), text.alias("body"))
    return out.where("place_id is not null").select(volume, F.col("first.ord").alias("entry_ord"), "place_id", F.col("first.frame").alias("frame"), F.substring("body", 1, longest).alias("body"))


def split_fields(lines: DataFrame) -> DataFrame:
    """(line_id, pos, column, text): runs without spaces and the display column of their start."""
    return lines.select("line_id", F.posexplode(X.fields_of("line")).alias("pos", "x")).select("line_id", "pos", "x.column", "x.text")


#: Layout of a column dictionary.
NAME_COLUMN, LONGEST_NAME, AREA_LINES, LEAST_PROSE = 17, 10, 6, 6
_HEADER = re.compile("^(.{1,14}?(?:村|町|宿|新田))（([ァ-ヶー]{2,24})）$")
_COLUMNS = re.compile("^字小字地名")
_NUMBER = re.compile(r"^[\s　]*(\d{1,3})[\s　]*$")
_READING = re.compile(r"^[｡-ﾟ\s　]+$")
_CONTENTS = re.compile("・{3,}")
_AREA_NOTE = re.compile(r"[＊*]\s*町別小字表[^）)]*参照|[＊*][^）)]*参照")
_RUNNING_HEAD = re.compile(r"^[（(]\s*[０-９\d]{4}\s*[）)]の水帳|水帳の字による")
#: A plausible name: at most ten characters, at least one of them kana or kanji, and none that ends a phrase, brackets or counts.
_PLACE = re.compile(r"(?=.*[぀-ヿ㐀-䶿一-鿿])[^。、，,；;：:（）()｛｝\[\]・～~＊*／/｜|＜＞<>\d０-９\n]{1,10}")
_GAP = re.compile(r"[\s　]{3,}")

_ENTRY_SCHEMA = "doc_id long, entry_ord int, village string, village_reading string, area string, level string, name string, aza string, reading string, page int, description string"


def _width(s: str) -> int:
    return sum(2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in s)


def _name_and_prose(line: str) -> tuple[list[tuple[int, str]], str]:
    """The (column, text) runs before the prose, and the prose without spaces.

    Names are letter-spaced, prose is set solid: it is what follows the last
    gap of three spaces, from the name column on, if it has six characters.
    """
    gaps = [m.end() for m in _GAP.finditer(line)]
    runs = [(m.start(), _width(line[: m.start()]), m[0]) for m in re.finditer(r"[^\s　]+", line)]
    tail = next((at for at, column, _ in runs if column >= NAME_COLUMN and at >= (gaps[-1] if gaps else 0)), None)
    if tail is None or len(line[tail:].strip()) < LEAST_PROSE:
        return [], ""
    return [(column, t) for at, column, t in runs if at < tail], "".join(t for at, _, t in runs if at >= tail)


def _split_by_column(names: list[tuple[int, str]]) -> tuple[str, str]:
    """What stands left of the name column (small section) and from it on (section).

    A left part longer than a name can be holds both; the widest of the
    distances between its columns parts them, the first of equal ones.
    """
    columns = np.array([column for column, _ in names])
    words = [word for _, word in names]
    left = int(np.searchsorted(columns, NAME_COLUMN))
    if left > 1 and len("".join(words[:left])) > LONGEST_NAME:
        left = 1 + int(np.diff(columns[:left]).argmax())
    return "".join(words[:left]), "".join(words[left:])


def parse_layout(text: str) -> list[dict]:
    """Entries of one document of a column dictionary, line by line.

    A village header names the village and its reading; parentheses right
    after it, over at most six lines, its area; nothing is an entry before the
    first column header. A number alone is the page from there on, a line of
    half-width katakana the reading of the next name, a name with prose an
    entry, and an indented line of prose alone goes on with the entry before.
    """
    entries: list[dict] = []
    place = {"village": None, "village_reading": None, "area": None}
    page = reading = area = None  # area: the lines of an open bracket
    started = False
    for line in text.replace("\f", "").split("\n"):
        bare = re.sub(r"\s+", "", line)
        if not bare or _CONTENTS.search(line):
            continue
        if m := _NUMBER.match(line):
            page = int(m[1])
            continue
        columns = _COLUMNS.match(bare)
        if area is not None and (columns or not _HEADER.match(bare)):
            more = not columns and (area or bare[0] in "（(")
            area += [bare] if more else []
            whole = "".join(area)
            if not more or len(area) >= AREA_LINES or sum(c in "（(" for c in whole) <= sum(c in "）)" for c in whole):
                place["area"] = _AREA_NOTE.sub("", whole).strip("（）() 　、,") or None
                area = None
            if more:
                continue
        if columns:
            started = True
        elif m := _HEADER.match(bare):
            place, area = {"village": m[1], "village_reading": full_kana(m[2]), "area": None}, []
        elif _READING.match(line):
            reading = full_kana(line)
        elif started:
            names, prose = _name_and_prose(line)
            if names:
                small, large = _split_by_column(names)
                if _PLACE.fullmatch(small or large):
                    entries.append({**place, "level": "koaza" if small else "aza", "name": small or large, "aza": large if small and large not in ("", small) else None, "reading": reading, "page": page, "description": prose})
                reading = None
            elif entries and line[0].isspace() and not _GAP.search(line.strip()) and not _RUNNING_HEAD.search(bare):
                entries[-1]["description"] += bare
    return entries


def layout_dictionary(docs: DataFrame) -> DataFrame:
    """Entries of all documents(doc_id, text) of a column dictionary; documents are parsed side by side."""

    def run(batches):
        names = [part.split(" ")[0] for part in _ENTRY_SCHEMA.split(", ")]
        for pdf in batches:
            rows = [{"doc_id": d, "entry_ord": i, **e} for d, t in zip(pdf["doc_id"], pdf["text"], strict=True) for i, e in enumerate(parse_layout(t or ""))]
            frame = pd.DataFrame(rows, columns=names)
            yield frame.astype({"page": "Int32"})

    return docs.select("doc_id", "text").mapInPandas(run, _ENTRY_SCHEMA)
