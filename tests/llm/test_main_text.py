from gaugeworks.llm import main_text, queries

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><article>no";</script></head><body class="has-sidebar">
<header><h1>Site</h1></header><nav><ul><li><a href="/a">Menu</a></li></ul></nav><!-- x > y --><div class="cookie-notice"><p>We use cookies</p></div>
<div class='ad'>Buy <b>now</b></div><article data-x="a > b"><header><h1>A &amp; B</h1></header><p>First&nbsp; line<br>of   text.</p><p><b>Second &lt;p&gt;
one</p><form><input name=q>Search</form><ul><li>item 1<li>item 2</ul><aside>Related</aside><div id="comments"><p>nice post</p></div></article>
<div class="sidebar"><p>links</p></div><footer>&copy; site</footer>"""


def test_article_without_the_rest():
    assert main_text.main_text(PAGE) == "A & B\nFirst line of text.\nSecond <p> one\nitem 1\nitem 2"


def test_text_between_surge_and_dive_where_nothing_is_marked():
    link = "<div><a href=x>%s</a></div>"
    body = [f"<p>{'word ' * 40}{i}</p>" for i in range(4)]
    page = "".join([link % f"menu {i}" for i in range(8)] + body + [link % f"more {i}" for i in range(8)])
    assert main_text.main_text(page).split("\n") == [("word " * 40 + str(i)) for i in range(4)]


def test_odd_pages(spark):
    pages = [(1, "u", None), (2, None, ""), (3, "u", "no markup"), (4, "u", "<p>open <b>tags"), (5, "u", "<nav>never closed <p>text"), (6, "u", "<script>x"), (7, "u", "a < b & c &nosuch; &#x41;"), (8, "u", "<p>" + "long " * 50_000)]
    df = spark.createDataFrame([(*p, "clash") for p in [*pages, pages[2]]], "page_id long, url string, html string, text string")
    got = {r.page_id: r for r in main_text.extract(df, df.columns).collect()}
    assert [got[i].text for i in range(1, 8)] == ["", "", "no markup", "open tags", "never closed\ntext", "", "a < b & c &nosuch; A"]
    assert got[8].n_chars == 250_000 - 1 and main_text.extract(df).count() == 9
    assert main_text.extract(df.limit(0)).count() == 0


def test_query_finds_each_article(spark, sf_small):
    import re
    from html import unescape

    html = {r.page_id: r.html for r in spark.read.parquet(f"{sf_small}/pages.parquet").collect()}
    for r in queries.op6_main_text(spark, sf_small).collect():
        inner = re.search("<article>(.*?)</article>", html[r.page_id], re.S)[1].replace("<br>", " ")
        blocks = [" ".join(unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1|h2|ul|li|div|table|tr|td|pre)\b[^>]*>", inner)]
        assert r.text == "\n".join(b for b in blocks if b)


def test_marks_are_evidence_and_the_lines_decide(spark, sf_small):
    """With the main elements renamed, surge and dive find the same text on nearly all pages."""
    import re

    pages = [r.html for r in spark.read.parquet(f"{sf_small.replace('0.001', '0.01')}/pages.parquet").collect()]
    renamed = [re.sub(r"<(/?)(article|main)\b", r"<\1div", h) for h in pages]
    assert sum(main_text.main_text(a) == main_text.main_text(b) for a, b in zip(pages, renamed, strict=True)) >= 0.95 * len(pages)


def test_comments_tags_and_shares_inside_the_article_go():
    inside = "".join(f'<div class="{c}"><p>{"noise " * 30}</p></div>' for c in ("comment-body", "post-tags", "entry-share", "ad-content", "article comments"))
    page = f'<article class="post no-sidebar"><div class="post-header"><h1>Title</h1></div><p>{"word " * 40}</p>{inside}<p class="text-warning">Last.</p></article>'
    assert main_text.main_text(page) == "Title\n" + "word " * 39 + "word\nLast."


def test_links_between_paragraphs_and_stretches_of_text_stay():
    link, long = "<p><a href=x>a paragraph that is one link</a></p>", f"<p>{'word ' * 30}</p>"
    menu = "".join(f"<div><a href=x>entry {i}</a></div>" for i in range(9))
    want = ["word " * 29 + "word", "a paragraph that is one link", "word " * 29 + "word"]
    assert main_text.main_text(menu + long + link + long + menu).split("\n") == want
    closing = "closing words " * 8
    assert main_text.main_text(long + menu + f"<p>{closing}</p>").split("\n") == [want[0], closing.strip()]
    assert main_text.main_text(f"{menu}<p>Only a few words.</p>{menu}") == "Only a few words."


def test_long_odd_markup_takes_linear_time():
    import time

    for page in ("<a " * 700_000, "<nav>" * 400_000, '<a x="' * 300_000 + ">", "<div class=ad>" * 150_000, "x" * 2_000_000, "<!--" * 500_000):
        start = time.process_time()
        main_text.main_text(page)
        assert time.process_time() - start < 5
