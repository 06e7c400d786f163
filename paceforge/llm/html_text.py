"""Main text of web pages, with a site style tree per host.

The pages of a host are laid over each other by the style of their elements (tag and class, from
the root down). A place in that tree has two importances, both entropies over the distinct pages that have it:
of presentation, how differently its children are laid out, and of content, how differently its
own blocks of text are filled. A branch in which neither reaches ``THRESHOLD`` anywhere is furniture that
every page repeats, and is taken out of each page. What HTML itself names as furniture (``nav``, ``aside``,
``form``, a class of ``sidebar`` or ``comments``) goes whatever its importance, as menus and comments
often differ from page to page. The paragraphs of an article are one place of the tree, so a sentence
that many articles share stays. Outside ``article`` and ``main``, text stays at the places the tree has found important;
where it knows too few pages, text outside goes unless it is a title or more than the articles hold.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paceforge.llm.common import chunks, map_chunks, stored, strings

#: Importance below which a branch goes, weight of a layout with one more child, and pages a place
#: needs before its entropy says anything.
THRESHOLD, GAMMA, LEAST_PAGES = 0.3, 0.9, 5
#: Deeper elements count as beside each other, as in browsers; their text stays.
DEPTH = 256

# fixed values: HTML's own names
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style title textarea xmp iframe noembed noframes noscript template svg select option button object".split())
BLOCK = set(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements that stand in text; importance doesn't take them out of an article.
FLOW = set("p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd blockquote pre table thead tbody tfoot tr td th caption figure figcaption article main body html".split())
NOISE_TAGS = set("nav footer aside form fieldset menu dialog head search".split())
NOISE_ROLES = set("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form toolbar note".split())
NOISE_NAMES = set(
    "nav navbar navigation menu menubar masthead topbar footer sidebar aside rail ad ads adv advert adverts advertisement advertising "
    "adsense sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices notification alert newsletter subscribe subscription "
    "signup login share sharing social related recommended breadcrumb breadcrumbs pagination pager comment comments disqus reply replies "
    "respond popup modal overlay toolbar skip copyright disclaimer".split()
)
ABOUT = {"has", "with", "no", "without", "is", "not"}
CLOSES = {"li": ("li", {"ul", "ol", "menu", "dir"}), "dt": ("dt dd", {"dl"}), "dd": ("dt dd", {"dl"}), "td": ("td th", {"tr", "table"}), "th": ("td th", {"tr", "table"}), "tr": ("tr", {"table"})}

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
WORD = re.compile(r"[a-z]+")


class Open:
    """An open element: its place in the style tree, and what holds for the text in it."""

    __slots__ = ("flow", "level", "noise", "path", "tag", "up", "weak")

    def __init__(self, tag: str, path: int, up: tuple, noise: bool, weak: bool, level: int, flow: bool):
        self.tag, self.path, self.up, self.noise, self.weak, self.level, self.flow = tag, path, up, noise, weak, level, flow


def _signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


def _furniture(tag: str, attributes: dict[str, str], inside: int) -> bool:
    """Whether the element names itself as something beside the main text."""
    if tag in ("html", "body", "main"):
        return False
    names: set[str] = set()
    for token in f"{attributes.get('class', '')} {attributes.get('id', '')}".lower().split():
        parts = WORD.findall(token)
        if parts and parts[0] not in ABOUT:  # "has-sidebar" is no sidebar
            names.update(parts)
    if tag == "article":
        return bool(names & {"comment", "comments", "reply"})
    if tag in NOISE_TAGS or names & NOISE_NAMES or attributes.get("role", "").lower() in NOISE_ROLES:
        return True
    if not inside and (tag == "header" or "header" in names):
        return True
    return "hidden" in attributes or attributes.get("aria-hidden") == "true" or "display:none" in attributes.get("style", "").replace(" ", "").lower()


def walk(page: str, weak: frozenset | set = frozenset(), layouts: dict | None = None) -> tuple[list[tuple[Open, str]], int]:
    """Blocks of text in page order, each with its element, and the best level met (2 article, 1 main).

    weak: places of the style tree that the site repeats. layouts: gets (place: ancestors, children's styles).
    """
    root = Open("", 0, (), False, False, 0, True)
    stack, count, found, text, best = [root], {}, [], [], 0

    def flush() -> None:
        if text:
            whole = " ".join(html.unescape("".join(text)).split())
            text.clear()
            if whole:
                found.append((stack[-1], whole))

    def shut(upto: int) -> None:
        for e in stack[upto:]:
            count[e.tag] -= 1
        del stack[upto:]

    at, end = 0, len(page)
    while at < end:
        m = TOKEN.search(page, at)
        stop = m.start() if m else end
        if stop > at and not stack[-1].noise:
            text.append(page[at:stop])
        if not m:
            break
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        if m[1] or m[4]:
            if count.get(tag):
                if tag in BLOCK:
                    flush()
                k = len(stack) - 1
                while stack[k].tag != tag:
                    k -= 1
                if any(e.tag in BLOCK for e in stack[k:]):
                    flush()
                shut(k)
            elif tag in BLOCK:
                flush()
            continue
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*+(?:>|\Z)", re.I).search(page, at)
            if close:
                at = close.end()
            elif tag in ("script", "style", "title", "textarea", "xmp", "iframe", "noembed", "noframes"):
                at = end
            continue
        block = tag in BLOCK
        if block:
            flush()
            if count.get("p"):
                k = len(stack) - 1
                while stack[k].tag != "p":
                    k -= 1
                shut(k)
            if tag in CLOSES:
                ends, bounds = CLOSES[tag]
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].tag in bounds:
                        break
                    if stack[k].tag in ends.split():
                        shut(k)
                        break
        if tag in VOID:
            continue
        if len(stack) > DEPTH:
            shut(len(stack) - 1)
        top = stack[-1]
        attributes = {}
        if m[3] or m[6]:
            attributes = {a[1].lower(): html.unescape(a[2] or a[3] or a[4] or "") for a in ATTRIBUTE.finditer(m[3] or m[6])}
        noise = top.noise or _furniture(tag, attributes, top.level)
        if noise and not top.noise and not block:
            text.append(" ")
        level = top.level
        if not noise and (mine := 2 if tag == "article" else 1 if tag == "main" or attributes.get("role") == "main" else 0) > level:
            level = mine
            best = max(best, level)
        path, up = top.path, top.up
        if block or noise and not top.noise:
            style = re.sub(r"\d+", "0", f"{tag}.{'.'.join(sorted(attributes.get('class', '').lower().split()))}")
            if layouts is not None:
                layouts.setdefault(top.path, (top.up, []))[1].append(style)
            path, up = _signed(xxhash.xxh64_intdigest(style, path % (1 << 64))), (*top.up, top.path)
            if layouts is not None and not noise:
                layouts.setdefault(path, (up, []))
        spared = level > 0 and tag in FLOW
        element = Open(tag, path, up, noise, top.weak or (path in weak and not spared and block), level, tag in FLOW)
        stack.append(element)
        count[tag] = count.get(tag, 0) + 1
    flush()
    return found, best


def main_text(page: str, weak: frozenset | set = frozenset(), rich: frozenset | set = frozenset()) -> str:
    """Blocks of the main text, one to a line. If a page is all furniture to its site, that counts for nothing.

    rich: places of the style tree with enough pages to judge by, that are important.
    """
    blocks, best = walk(page, weak)
    own = [(e, t) for e, t in blocks if not e.noise]
    if best:
        within = sum(len(t) for e, t in own if e.level)
        outside = sum(len(t) for e, t in own if not e.level and not e.weak)
        if best < 2 or not 0 < within < outside:
            own = [(e, t) for e, t in own if e.level or e.path in rich or e.tag == "h1"]
    return "\n".join([t for e, t in own if not e.weak] or [t for _, t in own])


def places(host: str, page: str) -> Iterator[tuple]:
    """(host, page, place, ancestors, children, kind, feature): a row for the layout of each place of the page (kind 0)
    and for each distinct block of text there (kind 1)."""
    layouts: dict = {}
    blocks, _ = walk(page, layouts=layouts)
    this = _signed(xxhash.xxh64_intdigest(page))
    for path, (up, styles) in layouts.items():
        run = [s for k, s in enumerate(styles) if not k or styles[k - 1] != s]
        yield host, this, path, list(up), len(run), 0, _signed(xxhash.xxh64_intdigest("\n".join(run)))
    for path, up, feature in {(e.path, e.up, _signed(xxhash.xxh64_intdigest(t))) for e, t in blocks}:
        yield host, this, path, list(up), 0, 1, feature


PLACES = "host string, page long, place long, up array<long>, children int, kind int, feature long"


def _host(url: str) -> Column:
    """Host of an address in lower case, null without one."""
    found = F.regexp_extract(F.lower(F.col(url)), r"^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.when(found != "", found)


def importances(pages: DataFrame, url: str = "url", html_col: str = "html") -> DataFrame:
    """(host, at, most, judged): the importance of every place of a host, and whether it has enough pages itself.

    A page counts once for a host, however many copies of it there are. Counts are aggregated before
    and after the shuffle by host, place and feature, so that a host with most pages is spread over
    all tasks; what is brought together for a host is a row for each place of its templates.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in PLACES.split(", ")]
        types = [pa.string(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int32(), pa.int32(), pa.int64()]
        for piece in chunks(batches):
            rows = [r for h, p in zip(piece.column(0).to_pylist(), strings(piece.column(1))) for r in places(h, p)]
            columns = list(zip(*rows)) if rows else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    source = pages.select(_host(url).alias("host"), F.col(html_col).alias("html")).where("host is not null and html is not null")
    rows = source.mapInArrow(run, PLACES)
    once = rows.groupBy("host", "place", "kind", "feature", "page").agg(F.first("up").alias("up"), F.max("children").alias("children"))
    shared = once.groupBy("host", "place", "kind", "feature").agg(F.count("*").alias("k"), F.first("up").alias("up"), F.max("children").alias("children"))
    layout, content = F.col("kind") == 0, F.col("kind") == 1
    k = F.col("k").cast("double")
    node = shared.groupBy("host", "place").agg(
        F.sum(F.when(layout, k)).alias("m"),
        F.sum(F.when(layout, k * F.log(k))).alias("same_layout"),
        F.sum(F.when(content, F.log(k))).alias("same_content"),
        F.count(F.when(content, 1)).alias("features"),
        F.max("children").alias("children"),
        F.first("up").alias("up"),
    )
    span = F.log("m")
    by_layout = (1 - F.pow(F.lit(GAMMA), F.col("children"))) * (1 - F.col("same_layout") / (F.col("m") * span))
    by_content = F.when(F.col("features") > 0, 1 - F.col("same_content") / (F.col("features") * span)).otherwise(0.0)
    own = F.when(F.col("m") >= LEAST_PAGES, F.greatest(by_layout, by_content)).otherwise(1.0)
    enough = F.col("m") >= LEAST_PAGES
    weighed = node.where("m is not null").select("host", "place", enough.alias("enough"), F.explode(F.concat(F.array("place"), "up")).alias("at"), own.alias("own"))
    return weighed.groupBy("host", "at").agg(F.max("own").alias("most"), F.max(F.col("enough") & (F.col("at") == F.col("place"))).alias("judged"))


def repeated_places(pages: DataFrame, url: str = "url", html_col: str = "html") -> DataFrame:
    """(host, weak array<long>): the places of low importance of every host that has some."""
    weak = importances(pages, url, html_col).where(F.col("most") < THRESHOLD)
    return weak.groupBy("host").agg(F.sort_array(F.collect_list("at")).alias("weak"))


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every row. A null or empty page has an empty text; a page without
    a readable host is taken on its own. Repeated rows are all returned."""
    low = F.col("most") < THRESHOLD
    judged = importances(pages, url, html_col).where(low | F.col("judged"))
    weak = stored(judged.groupBy("host").agg(F.collect_list(F.when(low, F.col("at"))).alias("weak"), F.collect_list(F.when(~low, F.col("at"))).alias("rich")))
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html_col).alias("html"), _host(url).alias("host"))
    with_site = rows.join(weak, "host", "left").select("page_id", "url", "html", "weak", "rich")
    kind = dict(rows.dtypes)["page_id"]

    def work(piece: pa.RecordBatch) -> pa.RecordBatch:
        texts = [main_text(p, frozenset(w or ()), frozenset(r or ())) for p, w, r in zip(strings(piece.column(2)), piece.column(3).to_pylist(), piece.column(4).to_pylist())]
        return pa.RecordBatch.from_arrays([piece.column(0), piece.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return map_chunks(with_site, work, f"page_id {kind}, url string, text string, n_chars long")
