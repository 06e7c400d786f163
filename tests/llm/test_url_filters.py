import random
import re
from collections import defaultdict

import pytest

from paceforge.llm import url_filters
from paceforge.llm.common import table
from paceforge.llm.queries import QUERIES, URL_RULES

SCHEMA = "page_id long, url string, label string"


def plain_address(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    path = re.split("[?#]", rest[len(host) :], maxsplit=1)[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def plain_rule(host, path, rules):
    fits = []
    for text, verdict in rules:
        name, _, start = text.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + start):
            fits.append((len(text), verdict == "block", text, verdict))
    return max(fits)[2:] if fits else (None, None)


def plain_segments(path):
    found = []
    for s in path[1:].split("/") if path else []:
        if s == "":
            found.append("/")
        elif re.fullmatch("[0-9A-Fa-f-]{8,}", s) and re.search("[0-9]", s) and re.search("[A-Fa-f]", s):
            found.append("{id}")
        else:
            found.append(re.sub("[0-9]+", "{n}", s))
    return found


def plain_after(segs):
    if not segs:
        return 0
    for k, pattern in enumerate(("/", r"\{n\}", r"\{id\}", "[^\\W\\d_]+", r"\{n\}\.[^\\W\\d_]+"), 1):
        if re.fullmatch(pattern, segs[0]):
            return k
    return 6


def plain_judge(rows, rules):
    """Verdict, template and share of each row, by walking each host's tree from the top."""
    seen = defaultdict(set)
    split = []
    for page, url, label in rows:
        host, path = plain_address(url)
        rule, verdict = plain_rule(host, path, rules)
        split.append((page, host, path, rule, verdict))
        if host:
            seen[host, path].add(verdict or label)
    addresses = defaultdict(list)
    for (host, path), labels in seen.items():
        addresses[host].append((tuple(plain_segments(path)), "block" if "block" in labels else "allow" if "allow" in labels else None))
    place = {}

    def totals(group):
        return len(group), sum(x == "block" for _, x in group), sum(x == "allow" for _, x in group)

    def grow(host, group, depth, shown, share):
        """``group``: addresses of one node, whose segments before ``depth`` are ``shown``."""
        n, blocked, allowed = totals(group)
        if blocked + allowed >= 5 and 2 * (blocked + allowed) >= n:
            share = (blocked + 1) / (blocked + allowed + 2)
        going = [g for g in group if len(g[0]) > depth]
        for segs, _ in group:
            if len(segs) <= depth or n < 5:
                place[host, segs] = ("/".join("" if s == "/" else s for s in shown) + ("" if len(segs) <= depth else "/**"), share)
        if n < 5 or not going:
            return
        children = defaultdict(list)
        for g in going:
            children[g[0][depth]].append(g)
        kinds, total = len(children), len(going)
        leaning, after = {}, {}
        for seg, own in children.items():
            m, b, a = totals(own)
            leaning[seg] = "none" if 2 * (a + b) < m else "block" if b >= 0.8 * (a + b) else "allow" if a >= 0.8 * (a + b) else "mixed"
            after[seg] = [sum(plain_after(g[0][depth + 1 :]) == k for g in own) for k in range(7)]
        branches = defaultdict(list)
        for seg, own in children.items():
            alike = [s for s in children if leaning[s] == leaning[seg]]
            pool = [sum(after[s][k] for s in alike) for k in range(7)]
            expected = [len(own) * p / sum(pool) for p in pool]
            chi = sum((x - e) ** 2 / e for x, e in zip(after[seg], expected) if e)
            if kinds >= 10 and total < 3 * kinds and len(own) * kinds <= 3 * total:
                name = "*"
            else:
                name = "{" + leaning[seg] + "}" if len(alike) > 1 and chi < 22.46 else seg
            branches[name] += own
        for name, own in branches.items():
            grow(host, own, depth + 1, [*shown, name], share)

    for host, group in addresses.items():
        grow(host, group, 0, [host], None)
    out = []
    for page, host, path, rule, verdict in split:
        template, share = place[host, tuple(plain_segments(path))] if host else (None, None)
        out.append((page, host, path, rule, verdict or ("block" if share is not None and share >= 0.8 else "allow"), template, share))
    return out


def same(got, want):
    got, want = (sorted(map(tuple, x), key=repr) for x in (got, want))
    assert [r[:6] for r in got] == [r[:6] for r in want]
    assert [r[6] for r in got] == [pytest.approx(r[6]) if r[6] is not None else None for r in want]


def test_query_against_brute_force(spark):
    path = "/root/testdata/sf0.01"
    rows = [(r.page_id, r.url, None) for r in table(spark, path, "pages").collect()]
    df = QUERIES["op13_url_filters"](spark, path)
    assert df.columns[:5] == ["page_id", "host", "path", "rule", "verdict"]
    same(df.collect(), plain_judge(rows, URL_RULES))


def site(seed):
    rng = random.Random(seed)
    rows = []

    def add(url, label=None):
        rows.append((len(rows), url, label))

    for k in range(400):
        # one host has half of the pages; its ads are labelled in part, in both of its branches
        kind = rng.choice(["ads", "promo", "news", "shop"])
        label = rng.choice(["block"] * 6 + [None]) if kind in ("ads", "promo") else rng.choice(["allow", None, None, "block"] if kind == "shop" else ["allow", None])
        add(f"http://Big.example.com/{kind}/{k}" + rng.choice(["", "/", ".html"]), label)
    for k in range(150):
        title = "-".join(rng.choices(["red", "blue", "old", "new", "cat", "dog", "sun"], k=5))
        add(f"https://blog.example.org/{title}/{rng.choice(['page', 'print'])}/{k}?x=1", "block" if "/print/" in rows[-1][1] else None)
    for k in range(60):
        add(f"https://h{k % 20}.example.net/a/{k:08x}f/b{k}", rng.choice(["block", None]))
    for k in range(40):
        add("https://deep.example.com" + "/d" * 7 + f"/{k % 7}", "block")
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_labelled_sites_against_brute_force(spark, seed, monkeypatch):
    if seed == 2:
        monkeypatch.setattr(url_filters, "HOT", 10)
    rows = site(seed)
    rules = [("example.net/", "allow"), ("net/a/", "block"), ("example.net/a/", "allow"), ("example.net/a/", "block")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = url_filters.judge(df, rules, label="label").collect()
    same(got, plain_judge(rows, rules))
    by = {r.page_id: r for r in got}
    unlabelled = [r[0] for r in rows if r[2] is None and "/ads/" in r[1]]
    assert unlabelled and {by[k].verdict for k in unlabelled} == {"block"}
    assert {by[r[0]].verdict for r in rows if "/news/" in r[1]} == {"allow"}
    assert any("*" in (r.template or "") for r in got) and any("{block}" in (r.template or "") for r in got)


def test_rows_of_all_kinds(spark):
    long = "http://long.example.com/" + "a/" * 3_000
    rows = [(1, None, None), (2, "", "block"), (3, "no scheme/en/", None), (4, "http://", None), (5, "HTTP://A.NET", None), (6, "x://A.Net/", None), (7, "a://b.net://c/?q=://d.net/", "odd")]
    rows += [(8, "http://example.net/en", None), (8, "http://example.net/en", None), (None, "http://x.example.net/en/1#://", None), (9, "http://notexample.com/de/", None), (10, "http://é.example.com/de/ÀÉ\n?", None)]
    rows += [(20 + k, long + str(k), "block") for k in range(4)] + [(30, "http://u@host.net:80/x", None), (31, "http://host.net?x/", None)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'h' as host", "1 as path", "2 as rule", "3 as form", "4 as n", "5 as key")
    got = url_filters.judge(df, URL_RULES, label="label").collect()
    same(got, plain_judge(rows, URL_RULES))
    assert {r.page_id: (r.rule, r.verdict) for r in got}[10] == ("example.com/de/", "block")
    assert [(r.page_id, r.verdict, r.template) for r in got if not r.host] == [(k, "allow", None) for k in (1, 2, 3, 4)]
    assert url_filters.judge(df.limit(0), URL_RULES).collect() == []
