"""Article text by density, against scores that are worked out anew for each element."""

import random

from pyspark.sql import functions as F

from siltstone.sources.density import Blocks, dense_text, extracted_pages, html_dense_text
from siltstone.sources.html import LINES, REMOVED, Node, parse


def letters(node, links_only=False, within=False):
    """Letters below an element, or those of them inside links."""
    if isinstance(node, str):
        return len("".join(node.split())) if within or not links_only else 0
    if any(node.matches(s) for s in REMOVED):
        return 0
    return sum(letters(c, links_only, within or node.tag == "a") for c in node.children)


def block_count(node, top=True):
    if isinstance(node, str) or any(node.matches(s) for s in REMOVED):
        return 0
    return (1 if top or node.tag in LINES else 0) + sum(block_count(c, False) for c in node.children)


def plain_scores(root):
    """(element, score) in the order of the page."""
    out = []

    def visit(node, within):
        if isinstance(node, str) or any(node.matches(s) for s in REMOVED):
            return
        within = within or node.tag == "a"
        own = sum(letters(c) for c in node.children if isinstance(c, str))
        score = 0.0 if within else float(own)
        for c in node.children:
            if isinstance(c, Node) and not any(c.matches(s) for s in REMOVED):
                score += (letters(c) - letters(c, True, within)) / block_count(c)
        out.append((node, score))
        for c in node.children:
            visit(c, within)

    visit(root, False)
    return out


def test_scores_equal_a_plain_computation():
    rng = random.Random(2)
    for _ in range(60):
        html = "".join(rng.choice(["<div>", "</div>", "<p>", "</p>", "<b>", "</b>", "<a href='x'>", "</a>", "<nav>", "</nav>", "<table>", "</table>", "<tr>", "<td>", "</td>", "some words ", "x", "é 日本 ", "<script>var a</script>", "<div class='sidebar'>"]) for _ in range(50))
        root = parse(html)
        blocks, expected = Blocks(root), plain_scores(root)
        assert [id(n) for n in blocks.nodes] == [id(n) for n, _ in expected]
        assert all(abs(a - b) < 1e-9 for a, (_, b) in zip(blocks.score, expected, strict=True)), html
        best = max(s for _, s in expected)
        assert abs(blocks.score[blocks.best()] - best) < 1e-9


ARTICLE = "<p>" + "words of the first paragraph " * 8 + "</p><p>" + "and of a second one " * 9 + "</p>"


def test_articles():
    menu = "".join(f'<li><a href="/{k}">an entry of the menu {k}</a></li>' for k in range(60))
    table = "<table><thead><tr><th>a</th><th></th><th>b</th></tr></thead><tr><td>1</td><td><p>2</p><p>3</p></td></tr></table>"
    page = f"<body><ul>{menu}</ul><div><div><div>{ARTICLE}{table}<div class='ad'>buy</div><ul>{menu}</ul><p>see <a href='x'>more</a> of it</p></div></div></div><footer>{ARTICLE * 3}</footer></body>"
    lines = dense_text(page).split("\n")
    assert lines[0].startswith("words of the first") and lines[2:] == ["a | b", "1 | 2 3", "see more of it"]
    assert dense_text(None) == dense_text("") == "" and dense_text("plain text") == "plain text"
    assert dense_text("<nav>only a menu</nav>") == ""
    assert dense_text("<div>" * 3000 + "deep words") == "deep words"


def test_pages_with_two_extractors(spark):
    rows = [("u1", f"<body><article>{ARTICLE}</article></body>"), ("u2", f"<body><p>menu</p><div><div>{ARTICLE}</div></div></body>"), ("u3", None), ("u4", "<p>short</p>")]
    got = {r["page_url"]: r for r in extracted_pages(spark.createDataFrame(rows, "page_url string, html string")).collect()}
    assert got["u1"]["full_text"] == got["u1"]["fallback_text"] and got["u2"]["full_text"].startswith("menu\nwords") and got["u2"]["fallback_text"].startswith("words")
    assert got["u3"]["full_text"] is got["u3"]["fallback_text"] is got["u4"]["fallback_text"] is None
    assert spark.createDataFrame(rows, "page_url string, html string").select(html_dense_text(F.col("html")).alias("t")).where("t = 'short'").count() == 1


def test_plain_tags_are_read_as_the_parser_reads_them(monkeypatch):
    """The short way for plain tags gives the tree that html.parser's own way gives, and parts of raw elements stay text."""
    from siltstone.sources import html

    pages = ['<div class="ad x" id="a-b"><p>one<p>two</p></div><br><a href="/x?a=1">l</a>', '<script>if (a<b) "</p>"</script>t<title>a<b>c</title>', '<p a="&amp;" B="c" a="d">x</p ><i/><b x="1"/>', '<li>x<li>y</ul></li><td x="<">z', "<!-- <p> --><p>\r\nx</p"]
    shape = lambda n: (n.tag, n.attrs, [shape(c) if isinstance(c, html.Node) else c for c in n.children])
    short = [shape(html.parse(p)) for p in pages]
    calls = []
    real = html.HTMLParser.parse_starttag
    with monkeypatch.context() as m:
        m.setattr(html.HTMLParser, "parse_starttag", lambda self, i: calls.append(i) or real(self, i))
        html.parse('<div><p class="a">x</p></div>' * 50)
        assert not calls  # every tag goes the short way
        m.setattr(html, "PLAIN_START", html.re.compile("(?!)"))
        m.setattr(html, "PLAIN_END", html.re.compile("(?!)"))
        assert [shape(html.parse(p)) for p in pages] == short and calls
    assert [html.any_of(("nav", ".ad", '[id*="-"]'))(n) for n in html.parse(pages[0]).walk()] == [False, True, False, False, False, False]


def test_pages_reach_python_in_bounded_batches(spark):
    """Pages of 100 KB: no batch holds more than about 4 MB of them, and a page is parsed once for all that is read from it."""
    import pandas as pd

    from siltstone.sources import density, html

    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, str(64 << 20))
        pages = spark.range(200, numPartitions=1).select(F.col("id").cast("string").alias("page_url"), F.concat(F.lit("<article><p>"), F.repeat(F.lit("words "), 17_000), F.lit("</p></article>")).alias("html"))
        got = density.extracted_pages(pages)
        assert int(spark.conf.get(name)) <= 4 << 20
        assert got._jdf.queryExecution().optimizedPlan().toString().count("run(") <= 3  # one function's parts, named thrice
        rows = got.select(F.length("full_text"), F.length("fallback_text"), "image_urls").distinct().collect()
        assert [tuple(r) for r in rows] == [(50_000, 50_000, None)]

        @F.pandas_udf("long")
        def rows_of_batch(texts: pd.Series) -> pd.Series:
            return pd.Series([len(texts)] * len(texts))

        assert pages.select(rows_of_batch("html").alias("n")).agg(F.max("n")).first()[0] <= 60
        spark.conf.set(name, "1m")
        html.html_text(F.col("html"))
        assert spark.conf.get(name) == "1m"
    finally:
        spark.conf.set(name, before)
