"""Main text of web pages by wrapper induction over the pages of a host."""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, stored, text_or_empty

#: How HTML elements behave.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
RAW = set("script style noscript template svg iframe object canvas textarea title xmp noembed".split())
SKIPPED = RAW | set("head nav footer aside form button select input menu dialog".split())
#: Which open elements a start tag closes, and where the search for them stops.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "option": {"select"}}
#: Words in a class or id that mark what is not the article.
BOILER = set(
    "ad ads adbox advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation menu breadcrumb breadcrumbs"
    " header masthead topbar footer sidebar aside widget cookie cookies consent notice notices alert gdpr newsletter subscribe subscription signup login"
    " share sharing social related recommended recommendations comment comments reply replies disqus popup modal overlay search pagination pager toolbar skip".split()
)
#: Words in a class or id, and elements, that mark the article.
ARTICLE = set("article articlebody post postbody entry story maincontent".split())

#: Of these, words that an article's own parts carry too. Inside an article such a part is none of it only if it
#: repeats over the host's pages or is mostly links.
DOUBTFUL = set(
    "alert notice notices header masthead topbar banner promotion share sharing social related recommended recommendations"
    " search signup login skip toolbar menu pager pagination breadcrumb breadcrumbs footer aside widget".split()
)
#: And words of a reader comment: inside an article it is told by its structure. (What bears the plural holds several.)
COMMENT = {"comment", "reply"}

#: A text on at least this share of a host's pages, and on so many, is template.
CONSTANT_SHARE, CONSTANT_PAGES = 0.5, 3

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?>[^>\"']+|\"[^\"]*\"|'[^']*')*)>|<[!?/][^>]*>", re.S)
_MARK = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_SPLIT = re.compile(r"[^a-z0-9]+")


class Node:
    __slots__ = ("children", "marks", "shape", "slot", "tag")

    def __init__(self, tag: str, marks: frozenset):
        self.tag, self.marks, self.children, self.slot, self.shape = tag, marks, [], -1, None


def parse(page: str) -> Node:
    """The DOM tree: nodes and, as plain strings, their texts (undecoded)."""
    root = Node("#", frozenset())
    open_ = [root]
    count = {"#": 1}  # of open elements by tag, so that no search for one is in vain
    at, size = 0, len(page)

    def close(i: int) -> None:
        for node in open_[i:]:
            count[node.tag] -= 1
        del open_[i:]

    for_end = None
    while at < size:
        m = for_end if for_end else _TOKEN.search(page, at)
        for_end = None
        if not m:
            open_[-1].children.append(page[at:])
            break
        if m.start() > at:
            open_[-1].children.append(page[at : m.start()])
        at = m.end()
        tag = m[2]
        if not tag:
            continue
        tag = tag.lower()
        if m[1]:
            if count.get(tag):
                close(next(i for i in range(len(open_) - 1, 0, -1) if open_[i].tag == tag))
            continue
        if tag in BLOCK and count.get("p"):
            for i in range(len(open_) - 1, 0, -1):
                if open_[i].tag == "p":
                    close(i)
                    break
                if open_[i].tag in BLOCK:
                    break
        if tag in CLOSES and any(count.get(x) for x in CLOSES[tag]):
            for i in range(len(open_) - 1, 0, -1):
                if open_[i].tag in SCOPE[tag]:
                    break
                if open_[i].tag in CLOSES[tag]:
                    close(i)
                    if tag != "tr":
                        break
        words: set[str] = set()
        if m[3] and "=" in m[3]:
            for k, a, b, c in _MARK.findall(m[3]):
                words.update(w for w in _SPLIT.split((a or b or c).lower()) if w)
                if k.lower() == "role":
                    words.add("role")
        node = Node(tag, frozenset(words))
        open_[-1].children.append(node)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
            at = end.end() if end else size
        elif tag not in VOID and not m[3].endswith("/") or tag in BLOCK and tag not in VOID:
            open_.append(node)
            count[tag] = count.get(tag, 0) + 1
    return root


Skeleton = tuple  # (signature, (child skeletons))


def _structure(node: Node) -> list[Node]:
    """The children that carry structure: inline elements do not."""
    return [c for c in node.children if isinstance(c, Node) and (c.tag in BLOCK or c.tag in RAW)]


def skeleton(root: Node) -> Skeleton:
    """The tree without texts, a run of equal siblings given once; noted at every node.

    Equal subtrees are one object, so that they are compared by identity.
    """
    order, known = [root], {}
    for node in order:  # grows: parents stand before their children
        order += _structure(node)
    for node in reversed(order):
        parts: list[Skeleton] = []
        for child in _structure(node):
            if not parts or parts[-1] is not child.shape:
                parts.append(child.shape)
        marks = " ".join(sorted(w for w in node.marks if not w.isdigit()))
        made = (f"{node.tag}.{marks}" if marks else node.tag, tuple(parts))
        node.shape = known.setdefault((made[0], *map(id, parts)), made)
    return root.shape


def preorder(s: Skeleton) -> list[tuple[int, Skeleton]]:
    """(depth, subtree) of every node, in the order in which nodes are numbered."""
    out, stack = [], [(0, s)]
    while stack:
        depth, x = stack.pop()
        out.append((depth, x))
        stack += [(depth + 1, child) for child in reversed(x[1])]
    return out


def flat(s: Skeleton) -> str:
    """A shape as lines of depth and signature, in preorder."""
    return "\n".join(f"{depth} {x[0]}" for depth, x in preorder(s))


def unflat(text: str) -> Skeleton:
    rows = [line.split(" ", 1) for line in text.split("\n")]
    below: dict[int, list[Skeleton]] = {}
    for depth, signature in reversed(rows):  # children stand after their parents
        made = (signature, tuple(reversed(below.pop(int(depth) + 1, []))))
        below.setdefault(int(depth), []).append(made)
    return below[0][0]


def _row(x: Skeleton, b: Skeleton, row: list[int], memo: dict) -> list[int]:
    new = [0]
    for j, y in enumerate(b[1]):
        new.append(max(row[j + 1], new[j], row[j] + (memo[id(x), id(y)] if x[0] == y[0] else 0)))
    return new


def weigh(a: Skeleton, b: Skeleton, memo: dict) -> int:
    """Simple tree matching: most nodes that match in order, level by level.

    memo holds what is known of pairs by identity, while both trees live.
    """
    if a[0] != b[0]:
        return 0
    stack = [(a, b, False)]
    while stack:
        x, y, ready = stack.pop()
        if (id(x), id(y)) in memo:
            continue
        if not ready:
            stack.append((x, y, True))
            stack += [(u, v, False) for u in x[1] for v in y[1] if u[0] == v[0] and (id(u), id(v)) not in memo]
            continue
        row = [0] * (len(y[1]) + 1)
        for u in x[1]:
            row = _row(u, y, row, memo)
        memo[id(x), id(y)] = 1 + row[-1]
    return memo[id(a), id(b)]


def _firsts(s: Skeleton) -> list[list[int]]:
    """For every node by number, the numbers of its children."""
    out, at = [], {}
    for i, (depth, _) in enumerate(preorder(s)):
        out.append([])
        at[depth] = i
        if depth:
            out[at[depth - 1]].append(i)
    return out


def matched(a: Skeleton, b: Skeleton, memo: dict) -> dict[int, int]:
    """Number of a node of a -> number of the node of b that it is matched with."""
    if not weigh(a, b, memo):
        return {}
    out, below_a, below_b = {}, _firsts(a), _firsts(b)
    stack = [(a, b, 0, 0)]
    while stack:
        x, y, m, n = stack.pop()
        out[m] = n
        table = [[0] * (len(y[1]) + 1)]
        for u in x[1]:
            table.append(_row(u, y, table[-1], memo))
        i, j = len(x[1]), len(y[1])
        while i and j:
            if table[i][j] == table[i - 1][j]:
                i -= 1
            elif table[i][j] == table[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                stack.append((x[1][i], y[1][j], below_a[m][i], below_b[n][j]))
    return out


def align(a: Skeleton, b: Skeleton, memo: dict, number: dict[tuple, int], out: dict[tuple, int]) -> None:
    """Note at out[path in a] the number of the node of b that it is matched with."""
    paths, order = list(numbered(a)), {n: p for p, n in number.items()}
    out.update({paths[m]: number[order[n]] for m, n in matched(a, b, memo).items()})


def numbered(s: Skeleton) -> dict[tuple, int]:
    """Path -> number, in preorder."""
    out: dict[tuple, int] = {}
    stack: list[tuple[tuple, Skeleton]] = [((), s)]
    while stack:
        path, x = stack.pop()
        out[path] = len(out)
        stack += [((*path, i), child) for i, child in reversed(list(enumerate(x[1])))]
    return out


class Aligner:
    """Slots of a page's nodes in the reference page of its host; remembers shapes."""

    def __init__(self):
        self.known: dict[tuple[str, str], dict[int, int]] = {}

    def slots(self, shape: Skeleton, reference: str) -> dict[int, int]:
        key = (flat(shape), reference)
        if key not in self.known:
            if len(self.known) > 20_000:
                self.known.clear()
            self.known[key] = matched(shape, unflat(reference), {})
        return self.known[key]

    def mark(self, root: Node, reference: str | None) -> None:
        if not reference:
            return
        shape = skeleton(root)
        slots, below = self.slots(shape, reference), _firsts(shape)
        stack = [(root, 0)]
        while stack:
            node, number = stack.pop()
            node.slot = slots.get(number, -1)
            i, last = -1, None
            for child in _structure(node):
                if child.shape is not last:
                    i, last = i + 1, child.shape
                stack.append((child, below[number][i]))


def _records(node: Node) -> set[tuple]:
    """(tag, marks) that two or more children of a node share, of those with a word of comments."""
    seen, twice = set(), set()
    for c in node.children:
        if not isinstance(c, str) and c.marks & COMMENT:
            key = (c.tag, c.marks)
            (twice if key in seen else seen).add(key)
    return twice


def _comments(node: Node, records: set[tuple]) -> bool:
    """A reader's comment: one of several like records, or a part that holds further elements with a word of comments."""
    if (node.tag, node.marks) in records:
        return True
    below = [c for c in node.children if not isinstance(c, str)]
    below += [g for c in below for g in c.children if not isinstance(g, str)]
    return any(c.marks & COMMENT for c in below)


def _boiler(node: Node, in_article: bool, records: set[tuple] = frozenset()) -> bool:
    if node.tag in SKIPPED or (node.tag in ("header", "label") and not in_article):
        return True
    words = node.marks & BOILER
    if in_article and words <= DOUBTFUL | COMMENT:
        return bool(words & COMMENT) and _comments(node, records)
    if words and node.tag not in ("html", "body"):
        return not (node.marks & ARTICLE and not node.marks & {"comment", "comments", "related", "ad", "ads"})
    return False


class Block(NamedTuple):
    text: str
    slot: int
    #: in an element that marks the article; in one that may be a notice there
    inside: bool
    doubtful: bool
    #: share of the text that is in links
    links: float


def blocks(root: Node) -> list[Block]:
    """Every block of text outside menus, forms and the like, in page order."""
    found: list[Block] = []
    parts: list[str] = []
    linked = [0]

    def flush(slot: int, inside: bool, doubtful: bool) -> None:
        text = " ".join(entities.unescape("".join(parts)).split())
        if text:
            found.append(Block(text, slot, inside, doubtful, min(1.0, linked[0] / max(1, len(text)))))
        parts.clear()
        linked[0] = 0

    stack: list[tuple] = [(iter(root.children), root.slot, False, False, False, False, _records(root))]
    while stack:
        children, slot, inside, doubtful, link, last, records = stack[-1]
        child = next(children, None)
        if child is None:
            stack.pop()
            if last:
                flush(slot, inside, doubtful)
            continue
        if isinstance(child, str):
            parts.append(child)
            if link:
                linked[0] += len(child.strip())
            continue
        if child.tag == "br":
            parts.append(" ")
            continue
        if _boiler(child, inside, records):
            if child.tag in BLOCK:
                flush(slot, inside, doubtful)
            continue
        within = inside or child.tag in ("article", "main") or bool(child.marks & ARTICLE) or child.marks >= {"role", "main"}
        notice = doubtful or (inside and bool(child.marks & DOUBTFUL))
        if child.tag in BLOCK:
            flush(slot, inside, doubtful)
            stack.append((iter(child.children), child.slot if child.slot >= 0 else slot, within, notice, link, True, _records(child)))
        else:
            stack.append((iter(child.children), slot, within, notice, link or child.tag == "a", False, _records(child)))

    flush(root.slot, False, False)
    return found


def main_text(root: Node, constant: set[tuple[int, int]]) -> str:
    """Blocks that are content, in page order: those whose slots vary over the host's pages.

    A block that repeats in its slot is template, wherever it stands, and one
    that is mostly links is a menu. What a page marks as its article breaks
    ties: it is taken alone if at least half as much varies in it as outside
    it, else it counts like the rest. If half of it or more repeats, other
    pages tell the same article; then only possible notices in it are template.
    """
    got = blocks(root)
    fresh = [(b.slot, _hash(b.text)) not in constant for b in got]
    size = lambda on: sum(len(b.text) for b, f in zip(got, fresh, strict=True) if on(b, f))
    told = 2 * size(lambda b, f: b.inside and not f) >= size(lambda b, f: b.inside)
    keep_in = [b.inside and (f or (told and not b.doubtful)) and not (b.doubtful and b.links >= 0.5) for b, f in zip(got, fresh, strict=True)]
    keep_out = [not b.inside and f and b.links < 0.5 for b, f in zip(got, fresh, strict=True)]
    weight = lambda on: sum(len(b.text) for b, k in zip(got, on, strict=True) if k)
    if any(keep_in) and 2 * weight(keep_in) >= weight(keep_out):
        keep_out = [False] * len(got)
    return "\n".join(b.text for b, i, o in zip(got, keep_in, keep_out, strict=True) if i or o)


def _hash(text: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - 2**63


def extract_pages(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """Every column of ``pages`` plus text, the main text of the whole page.

    Pages are grouped by the host of their url (a null or odd url counts as a
    host of its own name). The most frequent shape of a host's DOM trees is
    its reference; every page is aligned with it by simple tree matching, so
    that its blocks fall into slots of the reference. A text that stands in
    the same slot on at least half of a host's different pages (three at
    least) is template; what varies is content (see ``main_text``), unless its
    element is a menu, header, footer, sidebar, advert, form or comment. Inside
    an article a class word alone takes nothing away but adverts and the like:
    a part that may be a header, notice or share bar goes if it repeats or is
    mostly links, comments go by their repeated records.
    Statistics cover all pages and are sums by host, slot and text, so a host
    with most of the pages is no single group. Of shapes that are equally
    frequent the greatest text of a shape is the reference. Whole pages are
    read, however long or deep. Null html is an empty page with empty text;
    repeated rows are returned as often; an empty table gives an empty result;
    a column named text is replaced, other columns stay.
    """
    small_batches(pages.sparkSession)
    kept = [c for c in pages.columns if c != "text"]
    host = F.coalesce(F.regexp_extract(F.col(url).cast("string"), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1), F.lit(""))
    rows = pages.select(*[F.col(f"`{c}`") for c in kept], F.lower(host).alias("_host"), text_or_empty(html).alias("_html"))

    @F.pandas_udf("string")
    def shape(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: flat(skeleton(parse(t))))

    # a page that stands more than once tells no more about its host than once
    page = F.xxhash64("_html").alias("page")
    shapes = rows.groupBy("_host", page, shape("_html").alias("shape")).agg(F.lit(1).alias("one")).groupBy("_host", "shape").agg(F.count("*").alias("n"))
    hosts = stored(shapes.groupBy("_host").agg(F.max_by("shape", F.struct("n", "shape")).alias("_reference"), F.sum("n").alias("_pages")), "html-hosts")

    @F.pandas_udf("array<struct<slot:int,hash:long>>")
    def filled(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        aligner = Aligner()
        for texts, references in batches:
            out = []
            for t, r in zip(texts, references, strict=True):
                root = parse(t)
                aligner.mark(root, r)
                out.append([{"slot": s, "hash": h} for s, h in {(b.slot, _hash(b.text)) for b in blocks(root)}])
            yield pd.Series(out)

    texts = rows.join(hosts, "_host").select("_host", page, F.explode(filled("_html", "_reference")).alias("x"))
    often = texts.select("_host", "page", "x.slot", "x.hash").distinct().groupBy("_host", "slot", "hash").agg(F.count("*").alias("n")).where(F.col("n") >= CONSTANT_PAGES)
    template = often.join(hosts, "_host").where(F.col("n") >= CONSTANT_SHARE * F.col("_pages"))
    constant = template.groupBy("_host").agg(F.collect_list(F.struct("slot", "hash")).alias("_constant"))  # at most 1 / share for each slot
    wrappers = stored(hosts.join(constant, "_host", "left").select("_host", "_reference", "_constant"), "html-wrappers")

    @F.pandas_udf("string")
    def article(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        aligner = Aligner()
        for texts, references, constants in batches:
            out = []
            for t, r, c in zip(texts, references, constants, strict=True):
                root = parse(t)
                aligner.mark(root, r)
                out.append(main_text(root, {(x["slot"], x["hash"]) for x in c} if c is not None else set()))
            yield pd.Series(out, dtype=object)

    out = rows.join(wrappers, "_host", "left")
    return out.select(*[F.col(f"`{c}`") for c in kept], article("_html", "_reference", "_constant").alias("text"))


def op7_html(spark, sf_dir):
    """The main text of every page and its length."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return extract_pages(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
