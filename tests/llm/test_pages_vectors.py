"""Operators on pages and embeddings: brute force and edge cases."""

import random
import time
from collections import Counter, defaultdict

import numpy as np
import pytest

from tokenmill.llm import html_extract, knn_join, line_dedup, tables

PAGES = "page_id long, url string, html string, host string, text string, lines string, drop string, n int"
VECTORS = "vec_id long, embedding array<float>, label int, id long, task long, v string, score double"


def pages(spark, rows):
    tables.ready(spark)
    return spark.createDataFrame([(*r, "h", "t", "l", "d", 1) for r in rows], PAGES)


def vectors(spark, rows):
    tables.ready(spark)
    return spark.createDataFrame([(i, v, 0, 7, 8, "v", 0.5) for i, v in rows], VECTORS)


PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{margin:0}</style><script>var t="</p><p>no</p>";</script></head>
<body class="page menu-open"><header>Site <a href="/">Home</a></header><nav><ul><li><a href=/a>A</a><li><a href=/b>B</a></ul></nav>
<!-- <p>no</p> --><div class="cookie-notice">We use cookies on this site, do you agree with that or do you not?</div>
<article><header><h1>The &lt;Title&gt; &amp; more</h1></header><p>First <b>bold</b>ed   text,
 next line.<br>after break<p>Unclosed &eacute;&#233;&#xe9; &amp;amp;</p><aside>side</aside><div class="ad">Buy</div>
<blockquote>Quote</blockquote><table><tr><td>c1<td>c2</table><form><input name=q><button>Go</button></form><p>.</p></article>
<section id="comments"><p>A reader says that this is very good and very long, so that it could be an article, but is none.</p></section>
<footer>&copy; me</footer></body></html>"""
TEXT = "The <Title> & more\nFirst bolded text, next line. after break\nUnclosed ééé &amp;\nQuote\nc1\nc2\n."


def test_main_text_of_a_marked_article():
    assert html_extract.main_text(PAGE) == TEXT


def test_main_text_without_a_marked_article():
    long = "This is a paragraph of the story, and it is long enough to be seen as one by its length alone, we hope."
    page = (f"<body><div id=header>My site</div><div class='side-bar sidebar'><p>{long}</p></div><ul><li><a href=1>{long}</a></ul>"
            f"<div><h2>Title</h2><p>{long}</p><p>Short.</p><p>{long} End</p></div><div class=footer>{long}</div>")
    assert html_extract.main_text(page) == f"Title\n{long}\nShort.\n{long} End"


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("   ", ""), ("<html></html>", ""), ("plain words", "plain words"), ("<article></article><p>x</p>", "x"),
    ("<article><p>cut off here &am", "cut off here &am"), ("<article><p>a < b <b", "a < b"), ("<article>one</p></div> two</article>", "one\ntwo"),
    ("<article><p>x<script>never closed <p>y", "x"), ("<nav>only</nav>", ""), ("<article><p title='a>b'>q</p></article>", "q"),
    ("<article><p class=notice>n<p>kept</article>", "kept"), ("<main>&nbsp;a&nbsp; b</main>", "a b")])
def test_main_text_cases(page, text):
    assert html_extract.main_text(page) == text


def test_surge_and_dive():
    gap = ("", 0, False)
    line = lambda n: ("x" * n, n, False)
    lines = [line(20), gap, gap, gap, line(30), line(200), line(5), line(300), gap, gap, gap, line(40)]
    assert html_extract.main_lines(lines) == ["x" * 30, "x" * 200, "x" * 5, "x" * 300]


STORY = "A sentence of the story that is long enough to stand in a block of its own, with a number to tell it: "


def story(a, b):
    return [f"{STORY}{n}" for n in range(a, b)]


def paragraphs(lines):
    return "".join(f"<p>{x}</p>" for x in lines)


def test_block_sums_decide_beside_a_small_article():
    body = paragraphs(story(0, 4))
    teaser = "<article class='teaser'><h3>Other</h3><p>Read on</p></article>"
    assert html_extract.main_text(f"<body><div>{body}</div>{teaser}") == "\n".join(story(0, 4))
    assert html_extract.main_text(f"<body>{teaser}<div>{body}</div>{teaser}") == "\n".join(story(0, 4))
    said = "".join(f"<li><article class='comment'><p>Reader {n}</p></article>" for n in range(9))
    assert "\n".join(story(0, 4)) in html_extract.main_text(f"<body><div>{body}</div><ul>{said}</ul>")
    links = "<ul><li><a href=1>One</a><li><a href=2>Two</a><li><a href=3>Three</a></ul>"
    assert (html_extract.main_text(f"<body><div>My site</div><article>{body}{links}</article><div>Imprint</div>")
            == "\n".join([*story(0, 4), "One", "Two", "Three"]))
    assert html_extract.main_text("<article><a href=1>Only a link</a></article>") == "Only a link"


@pytest.mark.parametrize("wrapper", [
    "class='content has-sidebar'", "class='no-comments'", "class='layout with-nav'", "id='searchResults'", "class='post withoutSidebar'",
    "class='sidebar-layout'", "role='search'"])
def test_names_are_only_a_hint(wrapper):
    body, text = paragraphs(story(0, 4)), "\n".join(story(0, 4))
    ad = f"<div class='ad'><p>{STORY}</p></div>"
    assert html_extract.main_text(f"<body><p>Site</p><ul><li><a>1</a><li><a>2</a><li><a>3</a></ul><div {wrapper}>{body}{ad}</div>") == text
    assert html_extract.main_text(f"<body><div {wrapper}><article>{body}{ad}</article></div><div class=footer>{STORY}</div>") == text
    assert html_extract.main_text(f"<body><div {wrapper}><div><article><p>Short.</p></article></div></div>") == "Short."
    assert html_extract.main_text(f"<body><div class='ad'>{STORY}</div><article><p>Short.</p></article>") == "Short."


@pytest.mark.parametrize("tag", ["div", "body", "section", "td"])
def test_a_gap_in_a_container_does_not_cut_off_the_end(tag):
    long, text = paragraphs(story(0, 20)), "\n".join(story(0, 20))
    links = "<ul><li><a href=1>One</a></li><li><a href=2>Two</a></li><li><a href=3>Three</a></li></ul>"
    advert = f"<aside><nav>{links}</nav><form><button>Buy</button></form><aside>x</aside></aside>"
    named = "<div class=ad><p>Buy</p><div class=ads><p>this</p></div><p>now</p><p>here</p></div>"
    page = lambda end: f"<{tag}>{long}{end}</{tag}>" if tag != "section" else f"<div><section>{long}</section><section>{end}</section></div>"
    assert html_extract.main_text(page(f"{links}<p>The end.</p>")) == f"{text}\nOne\nTwo\nThree\nThe end."
    for gap in (advert, named, advert * 4):
        assert html_extract.main_text(page(f"{gap}<p>The end.</p>")) == f"{text}\nThe end."
    assert html_extract.main_text(page(f"{links}<p>{STORY * 2}</p>")).endswith("Three\n" + " ".join((STORY * 2).split()))


def test_text_of_other_containers_needs_a_block_of_its_own():
    links = "<ul><li><a href=1>One</a><li><a href=2>Two</a><li><a href=3>Three</a></ul>"
    page = f"<body><div><p>Site</p><p>Motto</p></div>{links}<div>{paragraphs(story(0, 20))}</div>{links}<div><p>{STORY}</p><p>x</p></div>"
    assert html_extract.main_text(page) == "\n".join([*story(0, 20), STORY.strip(), "x"])


def test_a_dropped_subtree_is_one_empty_line():
    lines, _ = html_extract.lines_of("<p>a</p><aside><nav>x</nav><form><nav>y</nav></form></aside><p>b</p>")
    assert [line[0] for line in lines] == ["a", "", "b"]


def test_long_page_is_not_quadratic():
    assert len(html_extract.main_text("<article>" + "<p>w x</p>" * 50_000).split("\n")) == 50_000
    assert html_extract.main_text("<" * 100_000 + "a") is not None


def test_extract_query(spark):
    df = pages(spark, [(1, "http://a/", PAGE), (1, "http://a/", PAGE), (2, None, None), (None, "u", "<p>hé</p>")])
    got = Counter(tuple(r) for r in html_extract.extract(df).collect())
    assert got == Counter({(1, "http://a/", TEXT, len(TEXT)): 2, (2, None, "", 0): 1, (None, "u", "hé", 2): 1})
    assert html_extract.extract(pages(spark, [])).count() == 0


def test_line_dedup(spark):
    r, rows = random.Random(1), []
    for k in range(60):
        host = r.choice(["a.com", "A.com", "b.org:80", "c.net"])
        body = [f"<p>own {k} text</p>", "<li>Home</li>"] + (["<p>half</p>"] if k % 2 else []) + ["<div>twice</div>"] * (2 if k % 5 == 0 else 0)
        rows.append((k, f"https://u@{host}/p/{k}?x#y" if k % 7 else None, "<head><title>t</title></head>" + "".join(body)))
    rows += [(100, "https://d.io", "<p>Home</p>"), (101, "https://d.io/x", "<p>Home</p>"), (102, "http://e.io", None), (103, "bad", ""),
             (104, None, "<script>x</script><!-- y --><p> a\n b </p>"), (0, rows[0][1], rows[0][2])]
    got = line_dedup.dedup_lines(pages(spark, rows))
    by, lines = defaultdict(list), {}
    for n, (i, url, page) in enumerate(rows):
        import re
        page = re.sub(r"(?is)<head.*?</head>|<script.*?</script>|<!--.*?-->", " ", page or "")
        x = [" ".join(re.sub(r"<[^>]*>", "", p).split()) for p in re.split(r"</?(?:p|li|div)[^>]*>", page)]
        lines[n] = [p for p in x if p]
        m = re.match(r"[a-zA-Z]+://(?:[^/?#@]*@)?([^/?#:]+)", url or "")
        by[m[1].lower() if m else ""].append(n)
    want = []
    for host, pages_of in by.items():
        count = Counter(x for n in pages_of for x in set(lines[n]))
        drop = {x for x, c in count.items() if c >= 3 and c / len(pages_of) > 0.5}
        want += [(rows[n][0], host, "\n".join(x for x in lines[n] if x not in drop), len(lines[n]),
                  sum(x in drop for x in lines[n])) for n in pages_of]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert sum(w[4] for w in want) > 40
    assert line_dedup.dedup_lines(pages(spark, [])).count() == 0


def brute_top(rows, k=5, every=50):
    ok = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(np.float32(x)) for x in v):
            ok[(i, tuple(int(np.floor(256 * float(np.float32(x)))) for x in v))] = 1
    want = []
    for q, x in ok:
        if q % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in ok if i != q and len(y) == len(x))
            want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return sorted(want)


@pytest.mark.parametrize("seed, spread", [(1, 0.05), (2, 1.0), (3, 0.0)])
def test_top_k(spark, monkeypatch, seed, spread):
    """Clusters, ties, one vector that many rows share, bad rows, other lengths."""
    monkeypatch.setattr(knn_join, "CHUNK_ROWS", 64)
    monkeypatch.setattr(knn_join, "BLOCK_QUERIES", 4)
    r = np.random.default_rng(seed)
    centers = r.normal(size=(6, 8))
    rows = [(int(i), (centers[r.integers(6)] + spread * r.normal(size=8)).astype(np.float32).tolist()) for i in r.permutation(900)]
    rows += [(1000 + i, [0.5] * 8) for i in range(400)]
    rows += [(50, rows[0][1] if rows[0][0] == 50 else dict(rows)[50])]  # a repeated row
    rows += [(2000, None), (2050, [float("nan")] * 8), (2100, [1.0, None] + [0.0] * 6), (2150, [float("inf")] * 8), (None, [1.0] * 8),
             (2200, [0.25, -0.5]), (2201, [1.0, 1.0]), (2250, []), (-50, [3.0] * 8)]
    got = sorted(map(tuple, knn_join.top_k(vectors(spark, rows)).collect()))
    assert got == brute_top(rows)


@pytest.mark.parametrize("case", ["query row repeated", "other row repeated", "other vectors of the query's id"])
def test_top_k_of_rows_repeated_in_an_isolated_cluster(spark, case):
    from pyspark.sql import functions as F

    r = np.random.default_rng(7)
    by_hash = spark.range(1, 20_000).orderBy(F.xxhash64("id", F.lit("pivot")))
    query = by_hash.where("id % 50 = 0").first().id  # a pivot of its own
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(r.normal(size=(400, 4)), 20_001) if i % 50]
    alone = [40.0, 0.0, 0.0, 0.0]
    rows += [(query, alone)]
    if case == "query row repeated":
        rows += [(query, alone)] * 300
    elif case == "other row repeated":
        rows += [(by_hash.where("id % 50 = 1").first().id, alone)] * 300
    else:
        rows += [(query, [40.0, k / 256, 0.0, 0.0]) for k in range(1, 9)]
    want = brute_top(rows)
    got = sorted(map(tuple, knn_join.top_k(vectors(spark, rows)).collect()))
    if case.startswith("other vectors"):  # the SQL ranks the rows of a query id together
        best = sorted(((-s, i) for _, _, i, s in want))[:5]
        want = [(query, n, i, -s) for n, (s, i) in enumerate(best, 1)]
    assert got == want and len(got) == 5


def test_top_k_of_huge_components_is_exact(spark):
    rows = [(50 * k, [1e7 + 1000 * k, 3.0]) for k in range(4)] + [(k, [1e7, float(k)]) for k in range(1, 9)]
    assert sorted(map(tuple, knn_join.top_k(vectors(spark, rows)).collect())) == brute_top(rows)


def test_top_k_of_nothing(spark):
    assert knn_join.top_k(vectors(spark, [])).count() == 0
    assert knn_join.top_k(vectors(spark, [(1, [1.0])])).count() == 0
    assert knn_join.top_k(vectors(spark, [(50, [1.0])])).count() == 0


def test_groups_far_away_are_not_replicated():
    pivots = np.array([[100.0, 0.0], [0.0, 100.0]])
    groups = [{"cell": c, "asked": 2, "radius": 1.0, "norm": 101.0} for c in range(2)]
    cells = [{"cell": c, "n": 50, "radius": 2.0, "norm": 102.0} for c in range(2)]
    sample = [{"id": 10 * c + i, "v": pivots[c]} for c in range(2) for i in range(6)]
    p = knn_join.Plan(pivots, groups, cells, sample, 5)
    assert p.open.tolist() == [[True, False], [False, True]]
    x = np.array([[100.0, 1.0], [96.0, 0.0]])
    g, r = p.needed(x, np.zeros(2, int), np.linalg.norm(x, axis=1))
    assert list(zip(g, r)) == [(0, 0)]  # the second cannot reach what six vectors are sure of
    few = knn_join.Plan(pivots, groups, cells, sample[:5], 5)
    assert few.open.all()


def test_bounds_leave_out_most_of_clustered_vectors(spark, monkeypatch):
    """Clusters of different norms: each group gets little but its own; results equal brute force."""
    monkeypatch.setattr(knn_join, "MIN_PIVOTS", 48)
    r = np.random.default_rng(4)
    centers = r.normal(size=(12, 32))
    centers *= (r.uniform(1, 3, 12) / np.linalg.norm(centers, axis=1))[:, None]
    rows = [(i, (centers[r.integers(12)] + 0.01 * r.normal(size=32)).astype(np.float32).tolist()) for i in range(2400)]
    df = vectors(spark, rows)
    (dim, groups, n, sent), = knn_join.replicas(df)
    assert (dim, n) == (32, 2400) and groups >= 6 and sent < n * groups / 3
    assert sorted(map(tuple, knn_join.top_k(df).collect())) == brute_top(rows)


def test_top_k_of_components_without_a_long(spark):
    """Such vectors take no part; scores beyond 64 bits count as the last long."""
    rows = [(50, [1e30, 1.0]), (100, [1e16, 0.0]), (1, [1e16, 0.0]), (2, [-1e16, 1.0]), (3, [2e16, 5.0])]
    got = sorted(map(tuple, knn_join.top_k(vectors(spark, rows)).collect()))
    assert got == [(100, 1, 1, 2 ** 63 - 1), (100, 2, 3, 2 ** 63 - 1), (100, 3, 2, -2 ** 63 + 1)]


@pytest.mark.parametrize("code", ["for(var i=0;i<n;i++){f()}", "if(a<b&&c>d){}", "x='</p><!--';", "<!-- a<b"])
def test_code_in_raw_elements_is_no_markup(code):
    body = "".join(f"<p>{STORY}</p>" for _ in range(4))
    clean = html_extract.main_text(f"<html><head></head><body><article>{body}{body}</article></body></html>")
    assert clean
    for tag in ("script", "style"):
        raw = f"<{tag}>{code}</{tag} >"
        page = f"<html><head>{raw}</head><body><article>{body}{raw}{body}</article></body></html>"
        assert html_extract.main_text(page) == clean


def test_listed_names_do_not_cut_words_of_a_sentence():
    body = f"<p>{STORY}</p>" * 4
    text = html_extract.main_text(f'<article>{body}<p><span class="search-term">python</span> is <em class="notice">not</em> all</p>'
                                  f'<p><a class="share" href=1>Share</a> | <span class="ad">Ad</span></p><p>x</p></article>')
    assert text.split("\n")[-2:] == ["python is not all", "x"]


@pytest.mark.parametrize("piece", ["<div>", "<b>", "<div class=ad>", "<li>", "<article>", "<ul><li>", "<!--", "<script>", "<a title='", "<p <"])
def test_deep_and_broken_markup_takes_one_pass(piece):
    start = time.time()
    html_extract.main_text(piece * (1_000_000 // len(piece) // 4) + "x")
    assert time.time() - start < 6


@pytest.mark.parametrize("piece", ["<!--", "<script>", "<style>", "<noscript>", "<template>", "<head>", "<p", "<", "</script ", "<p <"])
def test_line_dedup_reads_broken_markup_once(spark, piece):
    from pyspark.sql import functions as F
    start = time.time()
    page = "<p>first</p>" + piece * (1_000_000 // len(piece))
    got = spark.createDataFrame([(page,)], "html string").select(line_dedup.page_lines(F.col("html")).alias("x")).first().x
    assert got[0] == "first" and time.time() - start < 8
