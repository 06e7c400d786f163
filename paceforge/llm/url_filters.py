"""URL filters: rules first, then a path-template tree per host.

Each distinct address (host and path) counts once. Its path is cut into segments, and forms that carry an identifier become
wildcards: runs of digits ``{n}``, hexadecimal names ``{id}``. The tree of a host grows level by level:

- where a node has many children of a few addresses each, such as titles, the rare ones become one wildcard ``*``;
- children that lean the same way (mostly blocked, mostly allowed, both, or without labels) and are followed by the same kinds of segments, by
  a chi-square test against all children of their leaning, become one branch ``{block}``, ``{allow}``, ``{mixed}`` or ``{none}``;
- a node whose labelled addresses are enough, and at least half of all it has, is judged: its template is rejected if the
  smoothed share of blocked ones reaches ``PURITY``.

An address without a rule gets the verdict of the deepest judged node on its path. Nodes of fewer than ``SUPPORT`` addresses are not split
further, so the number of rounds is the depth that so many addresses share. All of it is built from DataFrame functions. A
node of a host that holds a third of all rows is met by broadcast: keys with a thousandth of the rows or more, of which there can be
a thousand at most. All other keys are shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paceforge.llm.common import stored

ALLOW, BLOCK = "allow", "block"
#: Children a node has, and addresses that each has in the mean, below which the rare ones are one wildcard; how rare, in means.
KINDS, MEAN, RARE = 10, 3, 3
#: Labelled addresses of a node that is judged; smoothed share of blocked ones that rejects it; addresses of a node that is split further.
LABELLED, PURITY, SUPPORT = 5, 0.8, 5
#: Share that makes children lean one way, and the chi-square at which they differ (six degrees of freedom, one in a thousand).
LEANING, DIFFERENT = 0.8, 22.46
#: What follows a child: nothing, a slash at the end, a number, an identifier, a word, a number with an ending, anything else.
FOLLOWERS = (r"", r"/", r"\{n\}", r"\{id\}", r"\p{L}+", r"\{n\}\.\p{L}+")
LEANINGS = (BLOCK, ALLOW, "mixed", "none")
#: A key is hot with this share of all rows; so many hot keys are broadcast at most.
HOT = 1_000
SUMS = ("n", "blocked", "allowed", *[f"after_{i}" for i in range(len(FOLLOWERS) + 1)])

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def address(url: Column) -> tuple[Column, Column]:
    """Host, with A-Z in lower case, and path of a URL; both '' for a missing one and for one without ``://``."""
    start = F.instr(url, "://")
    rest = F.when(start > 0, F.substr(url, start + 3)).otherwise("")
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), F.lit(""))


def ruled(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, NULL without one; of two for one place the blocking one.

    A rule ``example.net/en/`` is for the host, all its subdomains and paths that start with ``/en/``. Rules are an argument, not a
    table: each is an expression of the plan.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, own in sorted(rules, key=lambda r: (len(r[0]), r[1] == BLOCK, r[0])):
        name, _, start = text.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(f"/{start}")
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(own)).otherwise(verdict)
    return rule, verdict


def segments(host: Column, path: Column) -> Column:
    """Host and path segments with identifiers as wildcards; a slash at the end is a segment of its own."""
    names = F.when(path == "", F.array().cast("array<string>")).otherwise(F.split(F.substr(path, F.lit(2)), "/"))

    def form(s: Column) -> Column:
        named = s.rlike("^[0-9A-Fa-f-]{8,}$") & s.rlike("[0-9]") & s.rlike("[A-Fa-f]")
        return F.when(s == "", "/").when(named, "{id}").otherwise(F.regexp_replace(s, "[0-9]+", "{n}"))

    return F.concat(F.array(host), F.transform(names, form))


def _spread(left: DataFrame, right: DataFrame, key: str, rows: str) -> DataFrame:
    """``left`` with the columns of the one row of ``right`` that has its key; ``rows`` of it are how many rows of ``left`` have the key.

    A key of a thousandth of all rows is broadcast, so no task gets all rows of a hot one.
    """
    total = right.agg(F.sum(rows).alias("total")).scalar()
    hot = F.col(rows) * HOT >= total
    heavy = F.broadcast(right.where(hot).drop(rows))
    light = right.where(~hot).drop(rows)
    return left.join(heavy, key).unionByName(left.join(heavy.select(key), key, "left_anti").join(light, key))


def _key(parent: Column, segment: Column) -> Column:
    return F.md5(F.concat(parent, F.lit("/"), segment).cast("binary"))


def _templates(urls: DataFrame) -> DataFrame:
    """Addresses of one form in one row: (key, segs, rows, n, blocked, allowed)."""
    flags = urls.groupBy("host", "path").agg(F.count(F.lit(1)).alias("rows"), F.max(F.col("label") == BLOCK).alias("b"), F.max(F.col("label") == ALLOW).alias("a"))
    blocked = F.coalesce("b", F.lit(False))
    allowed = F.coalesce("a", F.lit(False)) & ~blocked
    return (
        flags.groupBy(segments(F.col("host"), F.col("path")).alias("segs"))
        .agg(F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("n"), F.count_if(blocked).alias("blocked"), F.count_if(allowed).alias("allowed"))
        .withColumn("form", F.md5(F.array_join("segs", "/").cast("binary")))
    )


def _children(level: DataFrame, k: int) -> DataFrame:
    """One row for each child of the open nodes: sums, what follows, and the leaning of its labels."""
    after = F.get("segs", F.lit(k + 1))
    known = F.lit(False)
    places = [F.when(after.isNull(), F.col("n")).otherwise(0)]
    for pattern in FOLLOWERS[1:]:
        here = after.isNotNull() & after.rlike(f"^{pattern}$")
        places.append(F.when(here & ~known, F.col("n")).otherwise(0))
        known = known | here
    places.append(F.when(after.isNotNull() & ~known, F.col("n")).otherwise(0))
    sums = [F.col("n"), F.col("blocked"), F.col("allowed"), *places]
    labelled, n = F.col("blocked") + F.col("allowed"), F.col("n")
    leaning = (
        F.when(labelled * 2 < n, "none")
        .when(F.col("blocked") >= LEANING * labelled, BLOCK)
        .when(F.col("allowed") >= LEANING * labelled, ALLOW)
        .otherwise("mixed")
    )
    return (
        level.groupBy("node", F.get("segs", F.lit(k)).alias("seg"))
        .agg(F.count(F.lit(1)).alias("forms"), *[F.sum(c).alias(name) for c, name in zip(sums, SUMS)])
        .withColumns({"leaning": leaning, "child": _key(F.col("node"), F.col("seg"))})
    )


def _named(children: DataFrame) -> DataFrame:
    """(child, alias, next, ...): children with the branch they belong to; without an alias it is their own."""
    pools = [F.sum(F.when(F.col("leaning") == own, F.col(name))).alias(f"{own}_{name}") for own in LEANINGS for name in ("n", *SUMS[3:])]
    members = [F.count_if(F.col("leaning") == own).alias(f"{own}_members") for own in LEANINGS]
    parents = stored(children.groupBy("node").agg(F.count(F.lit(1)).alias("kinds"), F.sum("n").alias("total"), *pools, *members))
    parents = parents.withColumn("children", F.col("kinds"))
    met = _spread(children, parents, "node", "children")

    def of(name: str) -> Column:
        return F.coalesce(*[F.when(F.col("leaning") == own, F.col(f"{own}_{name}")) for own in LEANINGS])

    expected = [F.col("n") * of(name) / of("n") for name in SUMS[3:]]
    chi = reduce(Column.__add__, [F.when(e > 0, (F.col(name) - e) * (F.col(name) - e) / e).otherwise(0.0) for name, e in zip(SUMS[3:], expected)])
    rare = (F.col("kinds") >= KINDS) & (F.col("total") < MEAN * F.col("kinds")) & (F.col("n") * F.col("kinds") <= RARE * F.col("total"))
    alike = (of("members") > 1) & (chi < DIFFERENT)
    alias = F.when(rare, "*").when(alike, F.concat(F.lit("{"), F.col("leaning"), F.lit("}")))
    return met.select(*children.columns, alias.alias("alias"))


def _grown(level: DataFrame, k: int) -> DataFrame:
    """Rows of the open nodes one level deeper, with the verdict of the node they come to where that is judged."""
    children = stored(_children(level, k))
    named = children.withColumn("alias", F.lit(None).cast("string")) if k == 0 else _named(children)
    named = stored(named.withColumn("next", _key(F.col("node"), F.coalesce("alias", "seg"))))
    blocked, labelled = F.sum("blocked"), F.sum("blocked") + F.sum("allowed")
    judged = (labelled >= LABELLED) & (labelled * 2 >= F.sum("n"))
    nodes = stored(
        named.groupBy("next").agg(
            F.count(F.lit(1)).alias("children"),
            F.when(judged, (blocked + 1) / (labelled + 2)).alias("share"),
            (F.sum("n") >= SUPPORT).alias("open"),
        )
    )
    found = stored(_spread(named, nodes, "next", "children").select("child", "alias", "next", "share", "open", "forms"))
    here = F.get("segs", F.lit(k))
    met = _spread(level.withColumn("child", _key(F.col("node"), here)), found.withColumnsRenamed({"share": "own_share", "open": "own_open"}), "child", "forms")
    return met.select(
        "form",
        "segs",
        "rows",
        "n",
        "blocked",
        "allowed",
        F.concat("aliases", F.array("alias")).alias("aliases"),
        F.col("next").alias("node"),
        F.coalesce("own_share", "share").alias("share"),
        F.col("own_open").alias("open"),
    )


def templates(urls: DataFrame) -> DataFrame:
    """(form, rows, aliases, share, whole) of every form of address in ``urls`` (host, path, label).

    aliases: for each level of the tree the wildcard or branch in place of the segment, if there is one; share: smoothed share of blocked
    addresses at the deepest judged node, NULL without one; whole: whether the tree follows the form to its end.
    """
    level = _templates(urls).select("*", F.array().cast("array<string>").alias("aliases"), F.lit("").alias("node"), F.lit(None).cast("double").alias("share"), F.lit(True).alias("open"))
    level, done = stored(level), []
    for k in count():
        going = F.col("open") & (F.size("segs") > k)
        done.append(level.where(~going).select("form", "rows", "aliases", "share", (F.size("segs") == F.size("aliases")).alias("whole")))
        level = level.where(going)
        if not level.head(1):
            return reduce(DataFrame.unionByName, done)
        level = stored(_grown(level, k))


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]] = (), page_id: str = "page_id", url: str = "url", label: str | None = None) -> DataFrame:
    """(page_id, host, path, rule, verdict, template, blocked_share) of every row.

    rules: (host/path, allow or block) each. Labels are the rules' verdicts and, where no rule fits, the column ``label`` (allow or
    block) if there is one; an address that is labelled both ways counts as blocked. A page without a host (a null url, or one without
    ``://``) is in no tree and allowed, unless a rule is for it. Repeated rows are returned each and count once; a missing page_id stays missing.
    template: host and path as the tree sees them, ending in ``**`` where a node is not split further.
    """
    host, path = address(F.col("url"))
    own = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), (F.col(label) if label else F.lit(None)).cast("string").alias("label"))
    split = own.select("page_id", host.alias("host"), path.alias("path"), "label")
    rule, verdict = ruled(F.col("host"), F.col("path"), rules)
    known = split.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("ruled"), F.coalesce(verdict, F.col("label")).alias("label"))
    addressed = F.col("host") != ""
    tree = stored(templates(known.where(addressed).select("host", "path", "label")))
    segs = segments(F.col("host"), F.col("path"))
    formed = known.where(addressed).withColumn("segs", segs).withColumn("form", F.md5(F.array_join("segs", "/").cast("binary")))
    met = _spread(formed, tree, "form", "rows")
    shown = F.zip_with("aliases", F.slice("segs", F.lit(1), F.size("aliases")), lambda a, s: F.coalesce(a, F.when(s == "/", "").otherwise(s)))
    text = F.concat(F.array_join(shown, "/"), F.when(F.col("whole"), "").otherwise("/**"))
    judged = F.when(F.col("share") >= PURITY, BLOCK).otherwise(ALLOW)
    found = met.select("page_id", "host", "path", "rule", F.coalesce("ruled", judged).alias("verdict"), text.alias("template"), F.col("share").alias("blocked_share"))
    nowhere = known.where(~addressed)
    return found.unionByName(
        nowhere.select("page_id", "host", "path", "rule", F.coalesce("ruled", F.lit(ALLOW)).alias("verdict"), F.lit(None).cast("string").alias("template"), F.lit(None).cast("double").alias("blocked_share"))
    )
