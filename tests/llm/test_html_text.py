from __future__ import annotations

import html
import random
import re

import numpy as np

from tierline.llm import html_text, queries


def article(page):
    """The generated pages' article by plain patterns."""
    inner = re.search(r"<article>(.*?)</article>", page, re.S).group(1)
    blocks = re.sub(r"<[^>]*>", " ", re.sub(r"<(/?p|/?h1)>", "\x01", inner)).split("\x01")
    return "\n".join(b for b in (re.sub(r"\s+", " ", html.unescape(x)).strip() for x in blocks) if b)


def test_query(spark, sf):
    got = {r.page_id: r for r in queries.QUERIES["op10_html_text"](spark, sf).collect()}
    for row in spark.read.parquet(f"{sf}/pages.parquet").collect():
        found = got.pop(row.page_id)
        assert (found.url, found.text, found.n_chars) == (row.url, article(row.html), len(article(row.html)))
    assert not got


def test_suffix_array_finds_windows_on_other_pages():
    rng = random.Random(2)
    for _ in range(200):
        pages = [[rng.choice("abc") for _ in range(rng.randint(0, 25))] for _ in range(rng.randint(1, 6))]
        tokens = np.array([ord(x) for p in pages for x in p], dtype=np.uint64)
        number = np.array([i for i, p in enumerate(pages) for _ in p], dtype=np.int64)
        want = []
        for i, page in enumerate(pages):
            for j in range(len(page)):
                w = page[j : j + 4]
                want.append(len(w) == 4 and any(q[a : a + 4] == w for k, q in enumerate(pages) if k != i for a in range(len(q))))
        assert html_text.repeated_starts(tokens, number, 4, 2).tolist() == want


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><p>no";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li>Home<li>News</ul></nav><div class="cookie-notice">We use cookies</div>
<main><div>open part</div><article class="post"><header><h1>Head &amp; line</h1></header><p>First <b>bold</b>
 text&nbsp;here.<p>Second<br>line <!-- hidden --> &lt;tag&gt; &#233;<aside>Related</aside><div class="ad-box">Buy</div>
<form><input name=q><label>Search</label></form><p>Third</p><section id="comments"><p>Nice post</p></section></article></main>
<div hidden>secret</div><footer>Copyright</footer></body></html>"""


def test_zones():
    found = html_text.blocks_of(PAGE)
    assert [t for z, t in found if z == html_text.ARTICLE] == ["Head & line", "First bold text here.", "Second line <tag> é", "Third"]
    assert "open part" in [t for z, t in found if z == html_text.OPEN]
    assert "T" not in [t for _, t in found] and "no" not in " ".join(t for _, t in found)


def test_layout_names_around_an_article():
    page = '<body class="home"><div class="content has-sidebar"><article><h1>A</h1><p class="ad">x</p></article><p>side</p></div>'
    assert html_text.blocks_of(page) == [(html_text.ARTICLE, "A"), (html_text.CHROME, "x"), (html_text.CHROME, "side")]
    page = '<div id="comments"><article><p>reader</p></article></div><nav><article>n</article></nav><main class="x">m</main>'
    assert [z for z, _ in html_text.blocks_of(page)] == [html_text.CHROME, html_text.CHROME, html_text.ARTICLE]


def test_broken_markup():
    assert html_text.blocks_of(None) == [] and html_text.blocks_of("") == []
    assert html_text.blocks_of("a < b and <b>c") == [(html_text.OPEN, "a < b and c")]
    assert html_text.blocks_of("<p>x<!-- never closed <p>y") == [(html_text.OPEN, "x")]
    assert html_text.blocks_of('<p>a<a href="unclosed>b</a><p>c') is not None
    assert html_text.blocks_of("<div>" * 5000 + "deep") == [(html_text.OPEN, "deep")]
    assert html_text.blocks_of("</p></div>x</article>") == [(html_text.OPEN, "x")]


def pages_without_article(spark):
    def page(i):
        return (
            f"<body><div>Welcome to our site, please read all the news</div><p>Story number {i} tells about topic{i} alone</p>"
            f"<p>Second part of {i}: fact{i} fact{i + 1000} and fact{i + 2000}</p><div>All rights reserved by the owner of this place</div>"
        )

    rows = [(i, f"http://h{i % 2}.example.com/{i}", page(i)) for i in range(40)]
    rows += [(100, "http://alone.example.com/1", page(100)), (101, None, page(101)), (102, "no scheme", None), (103, "http://h0.example.com/x", "")]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_boilerplate_goes_whatever_the_parts(spark, monkeypatch):
    results = []
    for size in (8 << 20, 900):
        monkeypatch.setattr(html_text, "PART_BYTES", size)
        results.append({r.page_id: (r.text, r.n_repeated) for r in html_text.extract_text(pages_without_article(spark)).collect()})
    assert results[0] == results[1]
    found = results[0]
    assert found[7] == ("Story number 7 tells about topic7 alone\nSecond part of 7: fact7 fact1007 and fact2007", 2)
    assert found[100][1] == 0 and found[100][0].startswith("Welcome") and found[102] == ("", 0) == found[103]


def test_empty(spark):
    assert html_text.extract_text(pages_without_article(spark).limit(0)).count() == 0


def test_repeated_and_clashing(spark):
    from pyspark.sql import functions as F

    df = pages_without_article(spark).filter("page_id < 4")
    df = df.unionAll(df).withColumn("text", F.lit("x")).withColumn("__host", F.lit(1))
    assert html_text.extract_text(df).count() == 8


def test_unique_runs_of_a_block_stay(spark):
    many = "Read more of our daily news about the town and"
    rows = [(i, f"http://h.example.com/{i}", f"<p>{many} fact{i} alone{i}</p><p>own{i} words{i} all rights reserved by the owner</p>") for i in range(10)]
    found = html_text.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.page_id: (r.text, r.n_repeated) for r in found} == {i: (f"fact{i} alone{i}\nown{i} words{i}", 2) for i in range(10)}


def test_skipped_elements_end():
    def texts(page):
        return [t for z, t in html_text.blocks_of(page) if z == html_text.ARTICLE]

    for skipped in (
        '<svg viewBox="0 0 1 1"/>', "<svg/>", "<button-group>", "<title-bar>x</title-bar>", "<select-menu>", "<svg>", "<button>Go",
        "<title>Never closed", "<svg><path/></svg>", "<select><option>a", "<script>var a = '</article><article>no';</script>",
    ):
        assert texts(f"<body><div>{skipped}</div><article><p>Kept</p></article><svg></svg><button>b</button></body>") == ["Kept"], skipped
        assert texts(f"<article><p>One</p><div>{skipped}</div></article><p>after</p>")[0] == "One"
    assert texts("<article><p>a<svg/> b</p><p>c <button>Go</p><p>d</p></article>") == ["a b", "c", "d"]


def test_sections_named_by_chrome_words_stay(spark):
    names = ['id="discussion"', 'id="copyright-law"', 'class="market-share"', 'class="table-footer"', 'class="notice"']
    body = "".join(f"<section {n}><p>own{i} text</p></section>" for i, n in enumerate(names))
    gone = '<div class="ad-box">Buy</div><div class="x share-buttons">Share</div><div id="comments">c</div>'
    boiler = '<p class="notice">This notice stands on every page of the whole host</p>'
    page = "<article><h1>Head {0}</h1>" + body.replace("own", "own{0}x") + gone + boiler + "<p>End {0}</p></article>"
    rows = [(i, f"http://h.example.com/{i}", page.format(i)) for i in range(8)]
    for r in html_text.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect():
        assert r.text.split("\n") == [f"Head {r.page_id}", *(f"own{r.page_id}x{j} text" for j in range(5)), f"End {r.page_id}"]


def test_copies_and_shared_passages_stay(spark, monkeypatch):
    body = "<p>Story {0} tells about topic{0} and no other story ever does</p><p>Its second part{0} has facts{0} of its own to tell</p>"
    footer = "<div>All rights reserved by the owner of this place</div>"
    quote = "<p>A passage that two documents of the host quote word by word</p>"
    rows = [(i, "http://twice.example.com/1", body.format("x") + footer) for i in range(2)]  # one page, delivered twice
    rows += [(10 + i, f"http://c.example.com/{i}", body.format("copied") + footer) for i in range(50)]
    rows += [(100 + i, f"http://c.example.com/own{i}", body.format(i).replace("and no other story ever does", f"and{i}").replace("of its own to tell", f"own{i}") + (quote if i < 2 else "") + footer) for i in range(9)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    story = "Story {0} tells about topic{0} and no other story ever does\nIts second part{0} has facts{0} of its own to tell"
    for size in (8 << 20, 900):
        monkeypatch.setattr(html_text, "PART_BYTES", size)
        got = {r.page_id: r.text for r in html_text.extract_text(df).collect()}
        assert len(got) == len(rows)
        assert got[0] == got[1] == story.format("x") + "\nAll rights reserved by the owner of this place"
        assert {got[10 + i] for i in range(50)} == {story.format("copied")}
        for i in range(9):
            kept = f"Story {i} tells about topic{i} and{i}\nIts second part{i} has facts{i} own{i}"
            assert got[100 + i] == kept + ("\nA passage that two documents of the host quote word by word" if i < 2 else "")


def texts_of(page):
    return [t for z, t in html_text.blocks_of(page) if z in (html_text.ARTICLE, html_text.DOUBT)]


PROSE = "This part of the story is long enough to be read as prose by anyone who opens the page and it goes on for many more words than any box of links or any notice would ever have, which is what tells the two apart in the end."


def test_boxes_named_by_one_chrome_word_inside_the_article():
    names = ['class="comment"', 'class="menu"', 'class="notice"', 'class="footer"', 'class="share"', 'class="promo"', 'class="related"',
             'id="comment-12"', 'class="reply depth-2"']
    for name in names:
        page = f"<article><h1>Head</h1><p>{PROSE}</p><div {name}><p>Not the article</p></div><p>End</p></article>"
        assert texts_of(page) == ["Head", PROSE, "End"], name
        assert texts_of(page.replace("div", "ul")) == ["Head", PROSE, "End"], name
    links = " ".join(f'<a href="/{i}">A story of more than a few words here</a>' for i in range(9))
    assert texts_of(f'<article><p>One</p><div class="related">{links}</div></article>') == ["One"]
    # prose in a box of that name is the article's, what readers wrote never is
    assert texts_of(f'<article><h1>Head</h1><div class="menu"><p>{PROSE}</p></div></article>') == ["Head", PROSE]
    assert texts_of(f'<article><h1>Head</h1><div class="comment"><p>{PROSE}</p></div></article>') == ["Head"]
    # inline elements, headings and sections of such a name stay
    assert texts_of('<article><p>a <span class="comment"># b</span></p><h2 id="discussion">Discussion</h2></article>') == ["a # b", "Discussion"]


def test_nested_and_sibling_articles():
    main = f"<article><h1>Head</h1><p>{PROSE}</p>%s</article>"
    assert texts_of(main % '<article class="comment"><p>Nice post</p></article>') == ["Head", PROSE]
    assert texts_of(main % "<article><p>Nested part</p></article>") == ["Head", PROSE, "Nested part"]
    teaser = '<article class="teaser"><h2>Other</h2><p>Read more</p></article>'
    assert texts_of(f"<main>{teaser}{main % ''}{teaser}</main>") == ["Head", PROSE]
    both = "<article><p>First post of the day</p></article><article><p>Second post of it</p></article>"
    assert texts_of(both) == ["First post of the day", "Second post of it"]


def test_one_page_with_ever_other_content_is_spread(spark, monkeypatch):
    from pyspark.sql import functions as F

    rows = [(1, "http://hot.example.com/1", f"<p>Edition {i:04} tells of nothing but topic{i:04}</p>") for i in range(300)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    monkeypatch.setattr(html_text, "PART_BYTES", 900)
    monkeypatch.setattr(html_text, "REPEAT_SHARE", 1.1)  # nothing counts as boilerplate here
    found = html_text.extract_text(df)
    assert sorted(r.text for r in found.collect()) == [f"Edition {i:04} tells of nothing but topic{i:04}" for i in range(300)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tasks = html_text.extract_text(df).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(tasks) > 4 and max(r["count"] for r in tasks) < 150
