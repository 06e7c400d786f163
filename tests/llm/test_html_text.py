from paceforge.llm.html_text import extract, main_text, places, repeated_places

SCHEMA = "page_id long, url string, html string"


def page(body, head="<title>t</title><style>p{}</style><script>var a='</p>';</script>"):
    return f"<!DOCTYPE html><html><head>{head}</head><body>{body}</body></html>"


def test_main_text():
    body = (
        '<header><h1>Site</h1></header><nav><ul><li><a href="/a">A</a></li></ul></nav><!-- ad --><div class="ad">buy</div>'
        "<article><h1>Head &amp; more</h1><p><b>One  two\n three.<br><p>Fish &lt;b&gt; &#233;</p><ul><li>x<li>y</ul>"
        '<div class="share-box">Share</div><form>name <input></form><section class="comments"><p>nice!</p></section>'
        "<aside>see also</aside><p>last</article><footer>&copy; me</footer>"
    )
    assert main_text(page(body)) == "Head & more\nOne two three.\nFish <b> é\nx\ny\nlast"


def test_pages_that_are_broken_or_odd():
    assert main_text("") == ""
    assert main_text("plain words") == "plain words"
    assert main_text("<p>a < b &am <p>c") == "a < b &am\nc"
    assert main_text("<article><p>kept") == "kept"
    assert main_text("<article></article><p>beside</p>") == ""
    assert main_text("<main><p>a</p><div>b</div></main><div>c</div>") == "a\nb"
    assert main_text("<p title='x>y'>q</p><script>never closed <p>z") == "q"
    assert main_text("<div>" * 5_000 + "deep") == "deep"
    assert main_text("<a " * 20_000) == ""
    assert main_text("<p>one<!-- <p>two") == "one"
    assert main_text('<body class="has-sidebar"><p>in</p><div hidden>no</div></body>') == "in"
    assert main_text("</p></div>x<i>y</i>z") == "xyz"
    assert main_text('<div class="content with-sidebar no-ads"><p>kept</p><div class="side-bar sidebar-left">no</div></div>') == "kept"


def site(n, shared="Same words on every page"):
    return [(k, f"http://Site.example/{k}", page(f'<div class="x{k}">{shared}</div><div class="body"><p>Own text {k}</p><p>A line all share</p></div>')) for k in range(n)]


def test_site_style_tree(spark):
    rows = site(8)
    found = {r.page_id: r.text for r in extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert found == {k: f"Own text {k}\nA line all share" for k in range(8)}
    alone = extract(spark.createDataFrame(rows[:2], SCHEMA)).collect()
    assert all("Same words" in r.text for r in alone)  # two pages say nothing about a site


def test_copies_count_once_and_articles_stay(spark):
    copies = [(k, "https://a.example/x", page("<article><h1>T</h1><p>Copied</p></article>")) for k in range(50)]
    frame = spark.createDataFrame(copies, SCHEMA)
    assert repeated_places(frame).collect() == []
    assert {r.text for r in extract(frame).collect()} == {"T\nCopied"}
    near = [(k, "https://a.example/x", page(f"<article><h1>T</h1><p>Same</p></article><div>{k % 2}</div>")) for k in range(50)]
    assert {r.text for r in extract(spark.createDataFrame(near, SCHEMA)).collect()} == {"T\nSame"}


def test_nulls_repeats_and_other_columns(spark):
    rows = [(1, None, None), (1, None, None), (None, "http://h.example/", "<p>a</p>"), (2, "not an address", ""), (3, "http://h.example/", "<nav>m</nav>")]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' as text", "1 as host", "2 as weak")
    got = sorted((str(r.page_id), str(r.url), r.text, r.n_chars) for r in extract(frame).collect())
    assert got == sorted([("1", "None", "", 0), ("1", "None", "", 0), ("None", "http://h.example/", "a", 1), ("2", "not an address", "", 0), ("3", "http://h.example/", "", 0)])
    assert extract(spark.createDataFrame([], SCHEMA)).collect() == []


def test_importance_by_brute_force(spark):
    """The places below the threshold, from the rows of places alone."""
    from collections import defaultdict
    from math import log

    rows = site(9) + [(50 + k, f"http://b.example/{k}", page(f"<div><p>{k // 3}</p></div><div class=z>{k}</div>")) for k in range(9)]
    seen, up, wide = defaultdict(set), {}, defaultdict(int)
    for k, url, text in rows:
        host = url.split("/")[2].lower()
        for h, this, place, above, children, kind, feature in places(host, text):
            seen[h, place, kind, feature].add(this)
            up[h, place] = above
            wide[h, place] = max(wide[h, place], children)
    best = defaultdict(float)
    for (h, place), above in up.items():
        layout = [len(v) for key, v in seen.items() if key[:3] == (h, place, 0)]
        content = [len(v) for key, v in seen.items() if key[:3] == (h, place, 1)]
        m = sum(layout)
        own = 1.0
        if m >= 5:
            own = (1 - 0.9 ** wide[h, place]) * -sum(k / m * log(k / m, m) for k in layout)
            own = max(own, 1 - sum(log(k, m) for k in content) / len(content) if content else 0)
        for at in [place, *above]:
            best[h, at] = max(best[h, at], own)
    want = {key for key, most in best.items() if most < 0.3}
    got = {(r.host, at) for r in repeated_places(spark.createDataFrame(rows, SCHEMA)).collect() for at in r.weak}
    assert want and got == want


def test_text_outside_articles(spark):
    """Title and lead beside an article stay, and a teaser doesn't stand for the page."""
    assert main_text("<main><h1>Title</h1><p>lead</p><article><p>long text</p></article></main><p>out</p>") == "Title\nlead\nlong text"
    assert main_text("<h1>Title</h1><article><p>long text</p></article>") == "Title\nlong text"
    assert main_text('<div><p>The text of the page itself</p></div><article class="card">Teaser</article>') == "The text of the page itself\nTeaser"
    rows = [(k, f"http://c.example/{k}", page(f'<p class="lead">Lead {k}</p><article><p>A longer text {k}</p></article><div class="x">Same on all</div>')) for k in range(8)]
    found = {r.page_id: r.text for r in extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert found == {k: f"Lead {k}\nA longer text {k}" for k in range(8)}
