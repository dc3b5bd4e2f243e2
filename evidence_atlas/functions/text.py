"""Column expressions on names, addresses, readings and passages."""

from __future__ import annotations

import re
import sys
import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from . import vocabulary as V

_JAPANESE = "぀-ヿ㐀-䶿一-鿿。、）」（「・"
_BEFORE, _AFTER = "぀-ヿ㐀-䶿一-鿿。、）」", "぀-ヿ㐀-䶿一-鿿「（"
#: Digits as kanji, and words for a part of a block.
_DIGITS, _KANJI = "0123456789１２３４５６７８９", "〇一二三四五六七八九一二三四五六七八九"
_PART_OF = "(?:の一部|の大部分|の内|の残り|分|一部|大部分)+$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _translated(c: Column, table: dict[str, str]) -> Column:
    return F.translate(c, "".join(table), "".join(table.values()))


def strip_spaces(c) -> Column:
    """Without white space of any kind."""
    return F.regexp_replace(_col(c), r"(?U)\s+", "")


@lru_cache
def _compatibility() -> tuple[list[tuple[str, str]], dict[str, str]]:
    """Voiced half-width pairs, and single characters, that compatibility folding changes."""
    half = [chr(c) for c in range(0xFF66, 0xFF9E)]
    pairs = [(k + m, n) for k in half for m in "ﾞﾟ" if len(n := unicodedata.normalize("NFKC", k + m)) == 1]
    wide = [chr(c) for c in [*range(0xFF01, 0xFFA0), 0x2126, 0x212A, 0x212B, *range(0x2460, 0x2469)]]
    single = {c: n for c in wide if len(n := unicodedata.normalize("NFKC", c)) == 1 and n != c}
    hiragana = {chr(c): chr(c + 0x60) for c in range(0x3041, 0x3097)}
    return pairs, {**single, **hiragana}


#: Characters that the table of ``_compatibility`` folds right, whatever stands beside them.
_TABLED = "^[\\x00-\\x7f　ぁ-ゖァ-ー、。・々〆〓一-鿿！-～ｦ-ﾝｰ]*$"


def full_kana(s: str) -> str:
    """One reading in compatibility form, without spaces, hiragana as katakana."""
    folded = unicodedata.normalize("NFKC", re.sub(r"\s+", "", s))
    return "".join(chr(ord(c) + 0x60) if "ぁ" <= c <= "ゖ" else c for c in folded)


@lru_cache
def _full_kana():
    @F.pandas_udf("string")
    def udf(c: pd.Series) -> pd.Series:
        return c.map(full_kana, na_action="ignore")

    return udf


def normalize_reading(c) -> Column:
    """Full-width katakana without spaces, in compatibility form (NFKC).

    Kana, kanji and wide or half-width letters are folded by a table. Readings
    with anything else (squared words, circled numbers, ligatures, loose voice
    marks) go to Python by batch; for all others it gets nulls.
    """
    out = strip_spaces(c)
    pairs, single = _compatibility()
    for a, b in pairs:
        out = F.replace(out, F.lit(a), F.lit(b))
    other = F.when(~F.rlike(out, F.lit(_TABLED)), _col(c))
    return F.coalesce(_full_kana()(other), _translated(out, single))


def normalize_name(c) -> Column:
    """Without spaces and with modern kanji."""
    return _translated(strip_spaces(c), V.VARIANTS)


def comparison_key(c) -> Column:
    """normalize_name with one form for each connecting character; for equality and containment."""
    return _translated(strip_spaces(c), {**V.VARIANTS, **V.CONNECTIVES})


@lru_cache
def _wide_class() -> str:
    """A character class of all wide and full-width code points."""
    parts, start, last = [], None, None
    for p in [*(i for i in range(sys.maxunicode + 1) if not 0xD800 <= i < 0xE000 and unicodedata.east_asian_width(chr(i)) in "WF"), None]:
        if start is None:
            start = last = p
        elif p is not None and p == last + 1:
            last = p
        else:
            parts.append(f"\\x{{{start:x}}}-\\x{{{last:x}}}")
            start = last = p
    return "".join(parts)


def display_width(c) -> Column:
    """Cells: two for wide characters, else one."""
    return (F.length(_col(c)) + F.length(F.regexp_replace(_col(c), f"[^{_wide_class()}]", ""))).cast("int")


def has_small_ke(c) -> Column:
    return F.contains(_col(c), F.lit("ヶ"))


def collapse_folded(c, broad: bool = False) -> Column:
    """Without ASCII spaces between Japanese characters, or (broad) next to one."""
    pattern = f"(?<=[{_JAPANESE}]) +| +(?=[{_JAPANESE}])" if broad else f"(?<=[{_BEFORE}]) +(?=[{_AFTER}])"
    return F.regexp_replace(_col(c), pattern, "")


def kanji_number(c) -> Column:
    """A block number of one or two digits in kanji."""
    c = _col(c)
    plain = F.translate(c, _DIGITS, _KANJI)
    tail = F.substring(plain, 2, 1)
    ten = (F.length(c) == 2) & F.substring(c, 1, 1).isin("1", "１")
    return F.when(ten & (tail == "〇"), F.lit("十")).when(ten, F.concat(F.lit("十"), tail)).otherwise(plain)


def strip_qualifier(c) -> Column:
    return F.regexp_replace(_col(c), _PART_OF, "")


def _blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def first_oaza(c) -> Column:
    """The first block of a listing of present-day blocks."""
    head = F.regexp_replace(F.element_at(F.split(F.coalesce(_col(c), F.lit("")), "[、,／/]"), 1), r"(?U)^\s+|\s+$", "")
    block = r"^([^、,。／/0-9０-９]{1,14}?)([0-9０-９]{1,2})(?:[～~〜\-][0-9０-９]{1,2})?丁目"
    town = _blank_to_null(strip_qualifier(F.regexp_extract(head, block, 1)))
    numbered = F.concat(town, kanji_number(F.regexp_extract(head, block, 2)), F.lit("丁目"))
    return F.coalesce(numbered, _blank_to_null(strip_qualifier(F.regexp_extract(head, "^([^、,。／/0-9０-９]{1,16})", 1))))


def pref_code(c, names: list[str] = V.PREFECTURES) -> Column:
    """Two-digit code: the name itself, else the first of which it is a prefix or that is a prefix of it."""
    c = _col(c)
    exact = F.coalesce(*[F.when(c == n, F.lit(f"{i:02d}")) for i, n in enumerate(names, 1)])
    prefix = F.coalesce(*[F.when(F.startswith(F.lit(n), c) | F.startswith(c, F.lit(n)), F.lit(f"{i:02d}")) for i, n in enumerate(names, 1)])
    return F.when(c != "", F.coalesce(exact, prefix))


def _joined(parts: list, sep: str) -> Column:
    return F.concat_ws(sep, *[F.coalesce(_col(p), F.lit("")) for p in parts])


def toponym_id(code, name, municipality, oaza, koaza, salt=None) -> Column:
    """Prefecture code, or 00, and ten hex digits of a digest over the folded parts."""
    keys = [comparison_key(F.coalesce(_col(p), F.lit(""))) for p in (name, municipality, oaza, koaza)]
    digest = F.sha2(F.concat_ws("|", *keys, F.coalesce(_col(salt), F.lit("")) if salt is not None else F.lit("")), 256)
    return F.concat(F.coalesce(_blank_to_null(_col(code)), F.lit("00")), F.lit("-"), F.substring(digest, 1, 10))


def cache_key(*parts) -> Column:
    return F.substring(F.sha2(_joined(list(parts), " "), 256), 1, 24)


def series_key(name, pref, municipality, suffix: str = r"(?:[一二三四五六七八九十〇0-9]+丁目|[北南東西][一二三四五六七八九十〇0-9]+条)+$") -> Column:
    """One key for all numbered blocks of a district."""
    folded = comparison_key(name)
    base = F.coalesce(_blank_to_null(F.regexp_replace(folded, suffix, "")), folded)
    return F.concat_ws("|", F.coalesce(_col(pref), F.lit("None")), F.coalesce(_col(municipality), F.lit("None")), base)


def modernise(c, mapping: dict[str, str]) -> Column:
    """Apply a learned character map; pass a mapping of a few hundred characters."""
    return _translated(_col(c), mapping) if mapping else _col(c)


def fold_reading(c) -> Column:
    return F.regexp_replace(F.coalesce(_col(c), F.lit("")), "[^ァ-ヴ]", "")


def split_address(c, pattern: str = "^(.{2,4}?[都道府県])(.+?[市区町村])") -> Column:
    c = _col(c)
    return F.struct(_blank_to_null(F.regexp_extract(c, pattern, 1)).alias("pref"), _blank_to_null(F.regexp_extract(c, pattern, 2)).alias("municipality"))


def date_in_label(c, unit: str = "年") -> Column:
    """The part in parentheses that holds a year of three or four digits."""
    return _blank_to_null(F.regexp_extract(_col(c), rf"[(（]([^)）]*[0-9]{{3,4}}{unit}[^)）]*)[)）]", 1))


def locator_parts(c, pattern: str = r"([0-9]+)巻\s*([0-9]+)頁") -> Column:
    """Volume and page, and the heading in parentheses that follows them."""
    c = _col(c)
    number = lambda i: F.regexp_extract(c, pattern, i).try_cast("int")
    heading = _blank_to_null(F.trim(F.regexp_extract(c, r"[(（]([^)）]*)[)）]", 1)))
    return F.struct(number(1).alias("volume"), number(2).alias("page"), heading.alias("parent"))


def citation_url(book, frame, base: str) -> Column:
    return F.format_string(f"{base}%s/1/%d", _col(book), _col(frame))


def article_url(title, base: str) -> Column:
    return F.concat(F.lit(base), F.url_encode(F.replace(_col(title), F.lit(" "), F.lit("_"))))


def glyph_ratio(height, text) -> Column:
    return _col(height) / F.greatest(F.length(_col(text)), F.lit(1))


def render_prompt(template: str, **values) -> Column:
    """The template with each {name} replaced by its column (null: empty)."""
    out = F.lit(template)
    for name, c in values.items():
        out = F.replace(out, F.lit("{" + name + "}"), F.coalesce(_col(c).cast("string"), F.lit("")))
    return out


def claim_sentence(title, name, level, markers) -> Column:
    """One sentence that says what a citation establishes."""
    words = F.array_join(F.slice(_col(markers), 1, 3), "・")
    parts = {3: "について、年号を伴う災害の記録を示す", 2: "を災害由来の地名と明記する", 1: "を地形由来と説明する"}
    tail = F.when(_col(level) >= 3, parts[3]).when(_col(level) == 2, parts[2]).otherwise(parts[1])
    return F.concat(F.lit("『"), _col(title), F.lit("』が"), _col(name), tail, F.lit("（"), words, F.lit("）"))


def label_map(labels: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])


def hazard_labels(codes, labels: dict[str, str] = V.HAZARDS) -> Column:
    """Labels of codes; an unknown code stays."""
    names = label_map(labels)
    return F.transform(_col(codes), lambda x: F.coalesce(F.try_element_at(names, x), x))


def origin_summary(name, hazards, labels: dict[str, str] = V.HAZARDS) -> Column:
    """A short origin out of the first two hazards."""
    known = F.array_join(F.slice(hazard_labels(hazards, labels), 1, 2), "・")
    return F.when(known != "", F.concat(_col(name), F.lit("："), known, F.lit("に関わる地名。"))).otherwise(F.concat(_col(name), F.lit("の由来。")))


def designated_zones(flags: dict[str, Column]) -> Column:
    """Names of the flags that are true (not unknown)."""
    return F.array_compact(F.array(*[F.when(_col(c), F.lit(n)) for n, c in flags.items()]))


def tolerant_double(c) -> Column:
    return F.trim(_col(c)).try_cast("double")


def tolerant_int(c) -> Column:
    """By way of a double, cut off; what is no number is null."""
    return F.trim(_col(c)).try_cast("double").try_cast("int")


def record_relation(relations) -> Column:
    """The strongest relation of an array, or null."""
    return F.coalesce(*[F.when(F.array_contains(_col(relations), r), F.lit(r)) for r in V.RELATIONS])


def primary_hazard(codes, order: list[str] | None = None) -> Column:
    """The first code; with an order, the first of it that is there, else other."""
    if order is None:
        return F.try_element_at(_col(codes), F.lit(1))
    listed = F.filter(F.array(*[F.lit(x) for x in order]), lambda x: F.array_contains(_col(codes), x))
    return F.coalesce(F.try_element_at(listed, F.lit(1)), F.lit("other"))


def variant_names(heading, old_forms, name, about_itself) -> Column:
    """Heading and old forms without the name, sorted; empty unless the finding is about the entry."""
    every = F.concat(F.array(_col(heading)), F.coalesce(_col(old_forms), F.array().cast("array<string>")))
    kept = F.array_sort(F.array_distinct(F.filter(every, lambda x: x.isNotNull() & (x != "") & (x != _col(name)))))
    return F.when(_col(about_itself), kept).otherwise(F.array().cast("array<string>"))


def precision_map(attribute, table: dict[str, str]) -> Column:
    return F.coalesce(F.try_element_at(label_map(table), _col(attribute)), F.lit("feature"))


def matched_hazards(matches) -> Column:
    """Distinct hazards of an array of matches, in order."""
    return F.array_distinct(F.flatten(F.transform(_col(matches), lambda m: m["hazards"])))


def max_specificity(matches) -> Column:
    return F.coalesce(F.array_max(F.transform(_col(matches), lambda m: m["specificity"])), F.lit(0.0))


# predicates


def in_bounds(lat, lon) -> Column:
    return _col(lat).between(20.0, 46.5) & _col(lon).between(122.0, 154.0)


def plausible_name(c, longest: int = 10, forbidden: str = "[。、，,；;：:（）()｛｝\\[\\]・～~＊*／/｜|＜＞<>0-9０-９]", script: str = "[぀-ヿ㐀-䶿一-鿿]") -> Column:
    c = _col(c)
    return (F.length(c) <= longest) & ~F.rlike(c, F.lit(forbidden)) & F.rlike(c, F.lit(script))


def verify_quote(quote, text) -> Column:
    """A non-empty quote that stands in the text, white space aside."""
    q = strip_spaces(F.coalesce(_col(quote), F.lit("")))
    return (q != "") & F.contains(strip_spaces(F.coalesce(_col(text), F.lit(""))), q)


def names_any(c, words: list[str]) -> Column:
    return F.rlike(F.coalesce(_col(c), F.lit("")), F.lit("|".join(map(re.escape, words))))


def names_landform(c) -> Column:
    return names_any(c, V.LANDFORM_WORDS)


def names_disaster(c) -> Column:
    return names_any(c, V.DISASTER_WORDS)


def is_natural_disaster(quote, hazards, words: list[str] = V.DISASTER_WORDS) -> Column:
    return names_any(quote, words) | F.exists(_col(hazards), lambda h: h != "other")


def hazards_compatible(a, b) -> Column:
    """Either is empty, or they share a hazard."""
    return (F.size(_col(a)) == 0) | (F.size(_col(b)) == 0) | F.arrays_overlap(_col(a), _col(b))


def finding_reason(name, quote, text, role=None) -> Column:
    """Why a finding is refused; null if it is kept."""
    reason = F.when(F.coalesce(_col(name), F.lit("")) == "", "no_name").when(F.length(_col(name)) > 12, "long_name")
    if role is not None:
        reason = reason.when(F.coalesce(_col(role), F.lit("")) != "affected", "other_role")
    reason = reason.when(F.length(F.coalesce(_col(quote), F.lit(""))) < 8, "short_quote")
    return reason.when(~verify_quote(quote, text), "not_verbatim")


# classification


def sentences(c, stop: str = "。") -> Column:
    """The parts that end in a full stop, trimmed, without blank ones."""
    parts = F.transform(F.split(_col(c), f"(?<={re.escape(stop)})"), lambda s: F.regexp_replace(s, r"(?U)^\s+|\s+$", ""))
    return F.filter(parts, lambda s: s != "")


def markers_in(c, markers: list[str]) -> Column:
    """The markers that stand in the text, in their order."""
    return F.filter(F.array(*[F.lit(m) for m in markers]), lambda m: F.contains(_col(c), m))


def hazards_from_text(c, keywords: list[tuple[str, str]] = V.HAZARD_KEYWORDS) -> Column:
    pairs = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(h).alias("h")) for k, h in keywords])
    text = F.coalesce(_col(c), F.lit(""))
    return F.array_distinct(F.transform(F.filter(pairs, lambda p: F.contains(text, p["k"])), lambda p: p["h"]))


def _let(value: Column, then) -> Column:
    """``then`` of a value that is worked out once, however often it is used."""
    return F.element_at(F.transform(F.array(value), then), 1)


def classify_description(
    c, disaster: list[str] = V.DISASTER_MARKERS, terrain: list[str] = V.TERRAIN_MARKERS, admin: list[str] = V.ADMIN_MARKERS,
    keywords: list[tuple[str, str]] = V.HAZARD_KEYWORDS, stop: str = "。", dated: str = "[（(][０-９0-9]{3,4}[）)]",
) -> Column:
    """struct(level, markers, hazards, quote, summary) of an explanation; null if it supports nothing."""
    def claim(told: Column, body: Column, found: Column) -> Column:
        bad, ground = found["bad"], found["ground"]
        is_bad = F.size(bad) > 0
        pick = lambda words: F.substring(F.array_join(F.slice(F.filter(told, lambda s: names_any(s, words)), 1, 2), ""), 1, 220)
        made = _let(F.when(is_bad, pick(disaster)).otherwise(pick(terrain)), lambda quote: F.struct(
            F.when(~is_bad, 1).when(F.rlike(quote, F.lit(dated)), 3).otherwise(2).alias("level"), F.when(is_bad, bad).otherwise(ground).alias("markers"),
            hazards_from_text(body, keywords).alias("hazards"), quote.alias("quote"), F.substring(body, 1, 140).alias("summary"),
        ))
        return F.when((F.size(told) > 0) & (is_bad | (F.size(ground) > 0)), made)

    def judged(told: Column) -> Column:
        return _let(F.array_join(told, ""), lambda body: _let(
            F.struct(markers_in(body, disaster).alias("bad"), markers_in(body, terrain).alias("ground")), lambda found: claim(told, body, found)
        ))

    return _let(F.filter(sentences(c, stop), lambda s: ~names_any(s, admin)), judged)


def level_for(kind, text, disaster: list[str] = V.DISASTER_WORDS, landform: list[str] = V.LANDFORM_WORDS) -> Column:
    """The level that the words of a passage support for the kind of origin that was claimed."""
    kind = _col(kind)
    bad, ground = names_any(text, disaster), names_any(text, landform)
    return F.when(kind.isin("disaster", "substitution") & bad, 2).when(kind.isin("terrain", "disaster", "substitution") & (bad | ground), 1)


def chunks(c, size: int = 9000, overlap: int = 400) -> Column:
    """Overlapping parts of a text; a short text is one part, the last may be overlap only."""
    c = _col(c)
    at = F.sequence(F.lit(1), F.greatest(F.length(c), F.lit(1)), F.lit(size - overlap))
    return F.when(F.length(c) <= size, F.array(c)).otherwise(F.transform(at, lambda i: F.substring(c, i, F.lit(size))))


def strip_page_numbers(c) -> Column:
    """Without lines that hold only a number of one to four digits."""
    lines = F.filter(F.split(_col(c), "\n"), lambda s: ~F.rlike(s, F.lit("^[ \t　]*[0-9]{1,4}[ \t　]*$")))
    return F.array_join(lines, "\n")


def fields_of(line) -> Column:
    """array<struct<column, text>>: runs without spaces and the display column at which each starts."""
    line = _col(line)
    runs = F.regexp_extract_all(line, F.lit(r"[^ 　\t]+"), F.lit(0))
    gaps = F.split(line, r"[^ 　\t]+", -1)
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<column:int,text:string>>").alias("out")).cast("struct<at:int,out:array<struct<column:int,text:string>>>")

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + display_width(x["gap"])
        row = F.struct(start.alias("column"), x["run"].alias("text"))
        return F.struct((start + display_width(x["run"])).alias("at"), F.array_append(acc["out"], row).alias("out")).cast("struct<at:int,out:array<struct<column:int,text:string>>>")

    return F.aggregate(F.arrays_zip(F.slice(gaps, F.lit(1), F.size(runs)).alias("gap"), runs.alias("run")), zero, step, lambda acc: acc["out"])
