"""Captured bodies, notes, state files and pages."""

import json
import re

import pytest
from pyspark.sql import functions as F

from siltstone.operators.dedupe import dedupe_report, dedupe_summary
from siltstone.schemas import CURSORS
from siltstone.sources import feeds, notes, stores
from siltstone.sources.cards import Page, post_cards, post_rows, status_cards, status_rows, thread_rows
from siltstone.sources.html import html_images, html_links, html_status, html_text, page_content, parse

NOW = "2026-05-14 00:00:00"


def now():
    return F.lit(NOW).cast("timestamp")


def status(i, user="testuser", **legacy):
    return {"rest_id": str(i), "core": {"user_results": {"result": {"legacy": {"screen_name": user}}}}, "legacy": {"full_text": "Hello world", "created_at": "Wed May 13 01:00:00 +0000 2026"} | legacy}


def entry(i, result, direct=False):
    return {"entryId": f"tweet-{i}", "content": {"result": result} if direct else {"itemContent": {"tweet_results": {"result": result}}}}


def timeline(entries, new=False, kind="TimelineAddEntries", more=()):
    inner = {"timeline": {"instructions": [{"type": kind, "entries": entries}, *more]}}
    return json.dumps({"data": {"bookmark_timeline_v2": inner} if new else {"user": {"bookmark_timeline": inner}}})


def responses(spark, *bodies, source="x"):
    return spark.createDataFrame([(k, source, "https://x/voyager/api", 200, b) for k, b in enumerate(bodies)], "seq long, source string, url string, status int, body string")


def test_timelines(spark):
    end = {"entryId": "cursor-bottom-0", "content": {"value": "next=="}}
    bodies = [
        timeline([entry(1, status(1)), end]),
        timeline([entry(2, status(2), direct=True)], new=True, more=[{"type": "TimelineTerminateTimeline", "direction": "Bottom"}]),
        timeline([{"entryId": "other-1"}, entry(3, {})]),
        "{bad json",
        "{}",
        None,
        timeline([entry(4, status(4))], kind="Anything"),
    ]
    rows = responses(spark, *bodies)
    got = feeds.bookmarks_from_statuses(feeds.statuses(rows), now()).orderBy("seq").collect()
    assert [r["url"] for r in got] == [f"https://x.com/testuser/status/{i}" for i in (1, 2, 4)]
    assert got[0]["title"] == got[0]["post_text"] == "Hello world"
    assert str(got[0]["published_at"]) == "2026-05-13 01:00:00" and got[0]["saved_at"] is None and got[0]["external_urls"] is None
    assert feeds.last_cursor(rows).first()["cursor"] == "next=="


def test_status_details(spark):
    full = status(
        9,
        full_text="short",
        entities={"urls": [{"expanded_url": u} for u in ("https://example.com/a", "https://x.com/o/status/5", "https://pic.x.com/z", "https://netflix.com/status/1", "", "https://twitter.com/o/status/5?s=1", "https://x.com/testuser/status/9")], "media": [{"media_url_https": "https://i/1.jpg", "type": "photo"}]},
        extended_entities={"media": [{"media_url_https": "https://i/1.jpg", "type": "photo"}, {"media_url": "https://i/2.jpg"}, {"media_url": "https://i/3", "type": "poll"}]},
    )
    full["note_tweet"] = {"note_tweet_results": {"result": {"text": "L" * 200}}}
    full["quoted_status_result"] = {"result": status(7, user="quoted")}
    body = timeline([entry(9, {"tweet": full}), entry(8, {"rest_id": "8", "legacy": {}})])
    a, b = feeds.bookmarks_from_statuses(feeds.statuses(responses(spark, body)), now()).orderBy("position").collect()
    assert a["title"] == "L" * 120 and a["post_text"] == "L" * 200
    assert a["external_urls"] == ["https://example.com/a", "https://netflix.com/status/1"]
    assert a["referenced_tweet_urls"] == ["https://x.com/o/status/5", "https://x.com/quoted/status/7"]
    assert a["image_urls"] == ["https://i/1.jpg", "https://i/2.jpg"]
    assert b["url"] == "https://x.com/unknown/status/8" and b["title"] == "Post by @unknown" and b["post_text"] is None


def test_visible_statuses(spark):
    schema = "seq long, url string, text string, author string, published_at string, external_urls array<string>, referenced_tweet_urls array<string>, image_urls array<string>"
    rows = spark.createDataFrame([(0, "https://x.com/a/status/1?s=20", "", "a", "2026-05-13T01:00:00.000Z", ["https://netflix.com/z", "https://x.com/y", "https://e.org/status/1/x", "https://e.org"], ["https://twitter.com/b/status/2", "junk", "https://x.com/a/status/1"], ["data:1", "https://i/1"]), (1, "", "t", "a", None, None, None, None)], schema)
    (r,) = feeds.bookmarks_from_visible_statuses(rows, now()).collect()
    assert r["url"] == "https://x.com/a/status/1" and r["title"] == "Post by @a" and r["post_text"] is None
    assert r["external_urls"] == ["https://netflix.com/z", "https://e.org"] and r["referenced_tweet_urls"] == ["https://x.com/b/status/2"] and r["image_urls"] == ["https://i/1"]


def test_post_shapes(spark):
    card = {"navigationUrl": "https://www.linkedin.com/posts/me-activity-11-x", "commentary": {"text": "card text"}, "actor": {"name": "Ann"}, "createdAt": 1747094400000}
    bodies = [
        {"data": {"data": {"cluster": {"elements": [{"items": [card]}], "metadata": {"paginationToken": "tok"}}}}},
        {"data": {"elements": [{"content": {"data": {"url": "/feed/update/urn:li:activity:12", "text": "t", "author": {"firstName": "A", "lastName": "B"}, "savedAt": "2026-05-14T02:00:00Z"}}}], "paging": {"nextCursor": "nc"}}},
        {"elements": [{"permalink": "https://www.linkedin.com/x", "author": "plain"}]},
        {"included": [{"value": {"com.linkedin.voyager.feed.UpdateV2": {"shareUrl": "https://www.linkedin.com/s", "commentary": {"value": {"text": "deep"}}}}}]},
        [{"url": "https://www.linkedin.com/top", "createdAtText": "1d"}],
        {"elements": [{"text": "no address"}]},
        {"elements": []},
    ]
    rows = responses(spark, *map(json.dumps, bodies), "{bad", source="linkedin")
    got = {r["seq"]: r for r in feeds.bookmarks_from_posts(feeds.posts(feeds.post_elements(rows)), now()).collect()}
    assert {k: r["url"] for k, r in got.items()} == {
        0: "https://www.linkedin.com/feed/update/urn:li:activity:11",
        1: "https://www.linkedin.com/feed/update/urn:li:activity:12",
        2: "https://www.linkedin.com/x",
        3: "https://www.linkedin.com/s",
        4: "https://www.linkedin.com/top",
    }
    assert got[0]["post_text"] == "card text" and str(got[0]["published_at"]) == "2025-05-13 00:00:00"
    assert got[1]["title"] == "t" and str(got[1]["saved_at"]) == "2026-05-14 02:00:00"
    assert got[2]["title"] == "Post by plain" and got[3]["post_text"] == "deep"
    assert str(got[4]["published_at"]) == "2026-05-13 00:00:00"
    assert {r["seq"]: r["cursor"] for r in feeds.post_cursors(rows).collect()} == {0: "tok", 1: "nc"}
    assert feeds.service_responses(rows).count() == rows.count()
    assert feeds.session_holds(rows).first()["holds"] is True


def test_printed_text_and_links(spark):
    post = {"url": "https://www.linkedin.com/a", "text": "{'dir': 'x', 'text': 'Inner words'}", "refs": [{"u": "https://e.org/a?x=1"}, {"u": "https://e.org/a?x=2"}, "https://www.linkedin.com/b", {"img": {"rootUrl": "https://media.licdn.com/1"}}], "description": "and https://f.org/z, too"}
    rows = feeds.posts(feeds.post_elements(responses(spark, json.dumps({"elements": [post]}), source="linkedin")))
    (r,) = feeds.bookmarks_from_posts(rows, now()).collect()
    assert r["post_text"] == "Inner words"
    assert sorted(r["external_urls"]) == ["https://e.org/a?x=1", "https://f.org/z,", "https://media.licdn.com/1"]
    assert r["image_urls"] == ["https://media.licdn.com/1"]


def test_notes(spark, tmp_path):
    (tmp_path / "x").mkdir()
    (tmp_path / "linkedin").mkdir()
    (tmp_path / "x/rich.md").write_text("---\ntitle: Rich\nurl: https://example.com/a?utm_source=x\n---\nbody")
    (tmp_path / "x/rich.json").write_text(json.dumps({"enrichment": {"takeaway": "t"}, "content": {"full_text": "full", "external_articles": [{}], "image_urls": ["i"]}}))
    (tmp_path / "linkedin/thin.md").write_text("---\ntitle: Thin\nurl: 'https://example.com/a'\n---\n")
    (tmp_path / "linkedin/thin.json").write_text(json.dumps({"enrichment": None, "content": {"post_text": "thin"}}))
    (tmp_path / "x/headless.md").write_text("no head")
    (tmp_path / "x/broken.json").write_text("{bad")
    found = notes.read_notes(spark, str(tmp_path))
    assert found.count() == 3
    assert [r[0] for r in notes.note_urls(found).collect()] == ["https://example.com/a"]
    scored = {r["path"].rsplit("/", 1)[1]: r for r in notes.notes_with_sidecars(found, notes.read_sidecars(spark, str(tmp_path))).collect()}
    assert (scored["rich.md"]["has_enrichment"], scored["rich.md"]["has_sidecar"], scored["rich.md"]["richness"]) == (1, 1, 604)
    assert (scored["thin.md"]["has_enrichment"], scored["thin.md"]["has_sidecar"], scored["thin.md"]["richness"]) == (0, 1, 4)
    rows = notes.notes_with_sidecars(found, notes.read_sidecars(spark, str(tmp_path)))
    assert dedupe_summary(rows).first().asDict() == {"scanned": 2, "duplicate_groups": 1, "moved": 1}
    assert dedupe_report(rows).first()["kept"].endswith("x/rich.md")


def test_yaml_heads(spark):
    texts = ["---\ntitle: 'A: b'\ntags: [x, y]\nn: 3\n---\nbody", "no head", "---\n- list\n---\n", "---\n: : [\n---\n", "---\nopen", None]
    rows = spark.createDataFrame(list(enumerate(texts)), "k int, text string")
    got = [r["h"] for r in rows.select("k", notes.yaml_head(F.col("text")).alias("h")).orderBy("k").collect()]
    assert got == [{"title": '"A: b"', "tags": '["x", "y"]', "n": "3"}, None, None, None, None, None]
    assert [r["t"] for r in rows.select("k", notes.head_value(F.col("text"), "title").alias("t")).orderBy("k").collect()][:2] == ["A: b", None]


def test_state_files(spark, tmp_path):
    (tmp_path / "rows.jsonl").write_text('{"a": 1}\nbroken\n{"a": 2}\n')
    assert [r["a"] for r in notes.read_json_lines(spark, str(tmp_path / "rows.jsonl"), "a int").collect()] == [1, 2]
    (tmp_path / "dead.jsonl").write_text('{"error": "good"}\n{bad json\n\n{"error": "also_good"}\n')
    assert [r["error"] for r in notes.read_dead_letters(spark, str(tmp_path / "dead.jsonl")).collect()] == ["good", "also_good"]
    (tmp_path / "c.txt").write_text("# comment\n.e.org\tTRUE\t/\tFALSE\t12\tname\tvalue\nshort\tline\n.e.org\tTRUE\t/\tTRUE\tx\tn\tv\n\n")
    assert [(r["secure"], r["expires"], r["name"]) for r in notes.read_tab_separated(spark, str(tmp_path / "c.txt")).collect()] == [(False, 12, "name"), (True, -1, "n")]


PAGE = """<html><head><meta property="og:image" content="https://i.org/og.png"><script>var t="</p>";</script></head>
<body><nav>menu</nav><div class="ad">buy</div><article><h1>Title &amp; more</h1><p>First <b>bold</b><br>line<p>{long}
<a href="https://e.org/a">a</a><a href="https://www.linkedin.com/b">b</a><a href="https://e.org/help/1">c</a>
<img src="https://i.org/1.jpg"><img src="https://i.org/avatar.jpg"></article><footer>end</footer></body></html>""".replace("{long}", "word " * 60)


def test_pages(spark):
    rows = spark.createDataFrame([(0, "u", PAGE), (1, "u", None), (2, "u", ""), (3, "u", "<p>no body")], "k int, url string, html string")
    got = [r["t"] for r in rows.select("k", html_text(F.col("html")).alias("t")).orderBy("k").collect()]
    assert got[0].startswith("Title & more\nFirst bold\nline\nword word") and "menu" not in got[0] and "buy" not in got[0] and "end" not in got[0]
    assert got[1:] == ["", "", "no body"]
    assert [r["t"] for r in rows.select("k", html_links(F.col("html")).alias("t")).orderBy("k").collect()] == [["https://e.org/a"], [], [], []]
    assert rows.select("k", html_images(F.col("html")).alias("t")).orderBy("k").first()["t"] == ["https://i.org/1.jpg", "https://i.org/og.png"]
    contents = rows.select("k", page_content(F.col("url"), F.col("html")).alias("c")).orderBy("k").collect()
    assert contents[0]["c"]["full_text"].startswith("Title & more") and contents[3]["c"]["full_text"] is None
    cards = spark.createDataFrame([('<body><div><li><a href="/posts/a-1?x=1">l</a> text</li></div><li>none</li><p class="entity-result">Status is online<br><a href="https://l/activity/2">second</a> 2w •</p></body>',)], "html string")
    assert [tuple(c) for c in post_rows(cards, []).collect()] == [("https://www.linkedin.com/posts/a-1?x=1", "l", "unknown", None, []), ("https://l/activity/2", "second", "unknown", "2w", [])]
    deep = spark.createDataFrame([("<div dir='ltr'>" * 3000 + '<a href="https://e.org/1">x</a>',)], "html string")
    assert deep.select(html_links(F.col("html")).alias("l")).first()["l"] == ["https://e.org/1"]


def test_texts_of_single_pages(spark):
    rows = [
        '<div data-testid="tweetText">a text of some length</div>',
        '<div data-testid="tweetText">short</div><article><b lang="en">words of an article</b></article>',
        '<article><b lang="en">few</b></article><div data-testid="tweet"><i lang="en">words of a card</i></div>',
        '<div data-testid="tweet"><i lang="en">words of a card</i></div>',
        "",
        None,
    ]
    df = spark.createDataFrame([(k, r) for k, r in enumerate(rows)], "k int, html string").orderBy("k")
    assert [r["t"] for r in df.select(html_status(F.col("html")).alias("t")).collect()] == ["a text of some length", "words of an article", None, "words of a card", None, None]


def test_selectors():
    node = parse('<a href="/in/x" class="b c" data-x="1"></a>').children[0]
    for selector, expected in {"a": True, "b": False, ".b": True, ".d": False, '[data-x="1"]': True, "[data-x=1]": True, '[href*="/in/"]': True, 'a[href*="/in/"]': True, "i[href]": False, '[class*="b"]': True, "#b": False}.items():
        assert node.matches(selector) is expected, selector


def test_stores(spark, tmp_path):
    at = str(tmp_path / "cursors")
    assert stores.load(spark, at, CURSORS).count() == 0
    row = "source string, cursor string, mode string, last_run timestamp"
    stores.save_cursors(spark.createDataFrame([("x", "a", "delta", None), ("y", "b", "delta", None)], row), at)
    stores.save_cursors(spark.createDataFrame([("x", "c", "delta", None)], row), at)
    (tmp_path / "cursors" / "versions" / "000000000009.json.x.part").write_text("{")  # a run that died while saving
    assert sorted((r["source"], r["cursor"]) for r in stores.load(spark, at, CURSORS).collect()) == [("x", "c"), ("y", "b")]
    (tmp_path / "processed_urls.json").write_text('{"urls": {"https://E.org/a/?utm_source=x": {"first_seen": "2026-01-01T00:00:00+00:00", "source": "x"}}}')
    (tmp_path / "bad.json").write_text("{broken")
    (tmp_path / "cursors.json").write_text('{"x": {"cursor": null, "mode": "delta", "last_run": "2026-01-01T00:00:00+00:00"}}')
    (tmp_path / "frontiers.json").write_text('{"x": {"updated_at": "2026-01-01T00:00:00+00:00", "recent_urls": ["https://e.org/b/", "https://E.org/c"]}}')
    assert [(r["norm_url"], r["source"], r["first_seen"].year) for r in stores.processed_from_json(spark, str(tmp_path / "processed_urls.json")).collect()] == [("https://e.org/a", "x", 2026)]
    assert [(r["source"], r["cursor"], r["mode"]) for r in stores.cursors_from_json(spark, str(tmp_path / "cursors.json")).collect()] == [("x", None, "delta")]
    assert [r["recent_urls"] for r in stores.frontiers_from_json(spark, str(tmp_path / "frontiers.json")).collect()] == [["https://e.org/b", "https://e.org/c"]]
    for read in (stores.processed_from_json, stores.cursors_from_json, stores.frontiers_from_json):
        assert read(spark, str(tmp_path / "bad.json")).count() == 0 and read(spark, str(tmp_path / "none.json")).count() == 0


# Cards as rows -------------------------------------------------------------------------------------------------------


def test_lookups_of_a_page_equal_searches_in_the_tree():
    """Lengths, texts, first elements and ages of every element, against the tree walked again for each of them."""
    import random

    from siltstone.sources import cards

    rng = random.Random(5)
    for _ in range(40):
        html = "".join(rng.choice(["<div>", "</div>", "<p>", "</p>", "<b>", "</b>", "<a href='/posts/1'>", "</a>", "<img src='http://i'>", "<br>", "word", "3d •", " ", "\n", "x 1", "2 days  •", "\u00a0", "é\u3000日"]) for _ in range(60))
        page = Page(html)
        links = page.places("a[href]")
        for i, node in enumerate(page.nodes):
            text = node.text([])
            assert page.text(i) == text and page.chars(i) == len(text), html
            below = list(node.below("a[href]"))
            assert [page.nodes[k] for k in page.below(links, i)] == below
            assert (page.first(links, i) is None) == (not below) and (not below or page.nodes[page.first(links, i)] is below[0])
            found = cards.AGE.search(text)
            assert page.age(i) == (" ".join(found[0].replace("•", "").split()) if found else None), (html, text)


def test_cards_take_time_in_proportion_to_the_page():
    import time

    many = "<div>" + "".join(f'<p><a href="/posts/a-{k}">link</a> {"some words of a post " * 6}<img src="http://i/{k}"></p>' for k in range(1000)) + "</div>"
    one_card = "<div>" + "".join(f'<a href="/posts/a-{k}">link</a>' for k in range(1000)) + "</div>"
    nested = "".join(f'<article><a href="/u/status/{k}">s</a>' for k in range(600)) + "</article>" * 600
    unmatched = "<div>" * 4000 + "</span>" * 4000
    for f, html, n in ((post_cards, many, 1000), (post_cards, one_card, 1000), (status_cards, nested, 600), (status_cards, unmatched, 0)):
        began = time.process_time()
        assert sum(1 for _ in f(html)) == n
        assert time.process_time() - began < 1.5


def test_rows_of_cards_beside_their_pages(spark):
    """Pages without a card have no row; the lateral join shuffles nothing."""
    html = '<article><a href="/ann/status/7">a</a><div data-testid="tweetText">one</div></article><div data-testid="tweet"><div data-testid="User-Name"><a href="/Ann?s=1">n</a></div><div data-testid="tweetText">two words</div></div>'
    pages = spark.createDataFrame([(1, html, "own"), (2, None, None), (3, "", "x"), (1, html, "own")], "k int, page string, note string")
    rows = status_rows(pages, ["k", "note"], "page")
    assert sorted((r["k"], r["note"], r["url"], r["author"], r["text"]) for r in rows.collect()) == [(1, "own", "https://x.com/ann/status/7", "ann", "one")] * 2
    assert "Exchange" not in rows._jdf.queryExecution().executedPlan().toString()
    assert sorted(tuple(r) for r in thread_rows(pages, ["k"], "page").collect()) == [(1, 0, "ann", "two words")] * 2
    assert post_rows(pages, ["k"], "page").count() == 0


# The recursive walk --------------------------------------------------------------------------------------------------


def strings_of(value, depth, path=(), at=0):
    """(depth, path, text) as a walk in Python has them, keys by name."""
    if isinstance(value, str):
        yield at, list(path), value
    members = [v for _, v in sorted(value.items())] if isinstance(value, dict) else value if isinstance(value, list) else []
    for k, v in enumerate(members if at < depth else []):
        yield from strings_of(v, depth, (*path, k), at + 1)


def test_strings_of_json_at_any_depth(spark):
    import json
    import random

    rng = random.Random(3)

    def value(level):
        kind = rng.randrange(6) if level else 5
        if kind < 2:
            return {rng.choice("abcde") * rng.randrange(1, 3): value(level - 1) for _ in range(rng.randrange(4))}
        return [value(level - 1) for _ in range(rng.randrange(4))] if kind < 4 else rng.choice(["text", "http://a/b", "", 3, None, True, 1.5])

    bodies = [value(7) for _ in range(60)] + ["top", {}, [], None]
    rows = spark.createDataFrame([(k, json.dumps(b)) for k, b in enumerate(bodies)], "id long, body string").select("id", F.try_parse_json("body").alias("v"))
    sizes = []
    for depth in (0, 1, 6, 20):
        found = feeds.json_strings(rows, depth)
        sizes.append(len(found._jdf.queryExecution().optimizedPlan().toString()))
        expected = sorted((k, *x) for k, b in enumerate(bodies) for x in strings_of(b, depth))
        assert sorted((r["id"], r["depth"], r["path"], r["text"]) for r in found.collect()) == expected
    assert max(sizes) - min(sizes) < 20  # the same plan for any depth


def test_nested_links(spark):
    """Order, repeats with and without query, the site's own, texts, depths, pictures; repeated rows and a broken body."""
    import json

    post = {"a": {"href": "https://e.org/1?x=1"}, "b": ["https://e.org/1?x=2", "https://www.linkedin.com/in/z", "https://i.org/P.PNG"], "c": {"d": {"e": {"f": {"g": {"h": "https://e.org/deep"}}}}}, "text": "see https://e.org/t?q=1 and https://e.org/1 (https://www.linkedin.com/x)"}
    deep = {"l": "https://media.licdn.com/9"}
    for _ in range(7):
        deep = {"x": deep}
    rows = spark.createDataFrame([(1, json.dumps(post)), (1, json.dumps(post)), (2, json.dumps(deep)), (3, "broken {"), (4, "{}")], "k int, body string").select("k", F.try_parse_json("body").alias("post"))
    got = sorted((r["k"], r["external_urls"], r["image_urls"]) for r in feeds.with_nested_links(rows).collect())
    links = ["https://e.org/1?x=1", "https://i.org/P.PNG", "https://e.org/deep", "https://e.org/t?q=1"]
    assert got == [(1, links, ["https://i.org/P.PNG"])] * 2 + [(2, None, ["https://media.licdn.com/9"]), (3, None, None), (4, None, None)]
    shallow = {r["k"]: r["external_urls"] for r in feeds.with_nested_links(rows, depth=2, image_depth=2).collect()}
    assert shallow[1] == [links[0], links[1], links[3]]
    with pytest.raises(ValueError, match="row_id"):
        feeds.with_nested_links(rows.withColumn("row_id", F.lit(1)))


def test_scores_of_notes_move_no_texts(spark, tmp_path):
    (tmp_path / "a.md").write_text("---\nurl: https://example.org/1\n---\n\nbody")
    (tmp_path / "a.json").write_text('{"content": {"full_text": "abc"}, "enrichment": {"x": 1}}')
    found = notes.read_notes(spark, str(tmp_path)).withColumn("own", F.length("text"))
    rows = notes.notes_with_sidecars(found, notes.read_sidecars(spark, str(tmp_path)))
    few = rows.select("norm_url", "has_enrichment", "has_sidecar", "richness", "own")
    assert [tuple(r) for r in few.collect()] == [("https://example.org/1", 1, 1, 3, 40)]
    plan = few._jdf.queryExecution().optimizedPlan().toString().split("\n")
    at = next(k for k, line in enumerate(plan) if "Join LeftOuter" in line)
    depth = plan[at].index("Join")
    sides = [line for line in plan[at + 1 :] if line[depth : depth + 3] in (":- ", "+- ")]
    assert len(sides) == 2 and not any(re.search(r"(\[|, |AS )(text|sidecar|content)#\d+(, |\])", line) for line in sides), sides


def test_sidecars_of_moved_notes_do_not_grow_with_ids(spark, tmp_path, monkeypatch):
    from siltstone import queries

    rows = [(3_000_000 + k, f"text {k % 3}", "en", "s", 6) for k in range(8)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(queries, "new_path", lambda _, label: str(tmp_path / label))
    got = {r["note"]: r["kept"] for r in queries.moved_notes(spark, str(tmp_path)).collect()}
    last = {k: max(j for j in range(8) if j % 3 == k % 3) for k in range(8)}
    assert got == {f"s/{3_000_000 + k:08d}.md": "" if last[k] == k else f"s/{3_000_000 + last[k]:08d}.md" for k in range(8)}
    sizes = [p.stat().st_size for p in tmp_path.rglob("*.json") if p.name.startswith("0")]
    assert len(sizes) == 8 and max(sizes) < 1000
