"""Operators against small sequential versions of themselves."""

import random

from pyspark.sql import functions as F

from siltstone.schemas import DEAD_LETTER
from siltstone.operators import boundary, content, dedupe, delta, enrich, frontier
from siltstone.operators.skew import attach


def sequential_frontier(rows, stop_after):
    out, state = [], {}
    for group, order, known in sorted(rows):
        streak, stopped = state.get(group, (0, False))
        if stop_after > 0:
            streak = streak + 1 if known else 0
            stopped = stopped or streak >= stop_after
        if not known and not stopped:
            out.append((group, order))
        state[group] = (streak, stopped)
    return sorted(out)


def test_frontier_equals_a_walk(spark):
    rng = random.Random(3)
    for stop_after, p in ((0, 0.5), (1, 0.05), (2, 0.5), (3, 0.6), (5, 0.9)):
        rows = [(rng.choice("aaaab"), k, rng.random() < p) for k in range(400)]
        df = spark.createDataFrame(rows, "g string, o long, known boolean")
        got = sorted((r["g"], r["o"]) for r in frontier.before_known_sequence(df, "g", "o", "known", stop_after, blocks_of=7).collect())
        assert got == sequential_frontier(rows, stop_after)
    empty = spark.createDataFrame([], "g string, o long, known boolean")
    assert frontier.before_known_sequence(empty, "g", "o", "known", 2).count() == 0


def plain_walk(rows, stop_after, limit):
    """(feed, place) of rows (feed, place, url, known), feed by feed, row by row."""
    out = []
    for feed in {r[0] for r in rows if r[0] is not None}:
        recent, streak, stopped = [], 0, False
        for _, place, url, known in sorted((r for r in rows if r[0] == feed), key=lambda r: r[1]):
            if url not in recent:
                recent = [*recent, url][-limit:]
                streak = streak + 1 if known else 0
                stopped |= streak >= stop_after > 0
            if not known and not stopped:
                out.append((feed, place))
    return sorted(out)


def test_walk_of_feeds_with_repeats(spark):
    """Addresses that come back within and beyond what is remembered, feeds over many blocks, runs over borders."""
    rng = random.Random(9)
    for stop_after, limit, addresses, p in ((2, 3, 5, 0.6), (4, 5, 9, 0.7), (3, 20, 25, 0.5), (30, 4, 6, 0.97), (3, 1, 2, 0.5), (0, 3, 5, 0.5)):
        known = {k: rng.random() < p for k in range(addresses)}
        rows = []
        for k in range(500):
            a = rng.randrange(addresses)
            rows.append((rng.choice(["big"] * 6 + ["b", "c", None]), k, None if a == 0 else f"u{a}", known[a] or None if rng.random() < 0.1 else known[a]))
        # a run that begins in one block and is long enough only some blocks later
        rows += [("runs", 1000 + k, f"v{k % 7}" if k < 40 else f"w{k}", k >= 40) for k in range(140)]
        df = spark.createDataFrame([(*r, "x") for r in rows], "feed string, place long, url string, known boolean, walk_stop string")
        expected = plain_walk([(f, o, u, bool(n)) for f, o, u, n in rows], stop_after, limit)
        for blocks in (1, 11):
            got = boundary.before_known_walk(df, "feed", "place", "url", "known", stop_after, limit, blocks)
            assert sorted((r["feed"], r["place"]) for r in got.collect() if r["feed"] is not None) == expected, (stop_after, limit, blocks)
    assert boundary.before_known_walk(df.where("false"), "feed", "place", "url", "known", 2).count() == 0


def test_blocks_that_are_walked_again(spark, monkeypatch):
    """Only blocks of a single feed whose remembered addresses are others than before, and few rounds of them."""
    calls, real = [], boundary.summaries

    def counted(rows, entries, *rest):
        calls.append(sorted(entries))
        return real(rows, entries, *rest)

    monkeypatch.setattr(boundary, "summaries", counted)
    rows = [("big", k, f"u{k % 50}", k % 3 == 0) for k in range(3000)]
    df = spark.createDataFrame(rows, "feed string, place long, url string, known boolean")
    got = boundary.before_known_walk(df, "feed", "place", "url", "known", 5, 4, 12)
    assert sorted((r["feed"], r["place"]) for r in got.collect()) == plain_walk(rows, 5, 4)
    assert len(calls[0]) == 0 and 1 < len(calls) <= 4


def test_frontier_vector(spark):
    rows = [("x", 1, False), ("x", 2, True), ("x", 3, True), ("x", 4, False)]
    df = spark.createDataFrame(rows, "g string, o long, known boolean")
    assert [r["o"] for r in frontier.before_known_sequence(df, "g", "o", "known", 2).collect()] == [1]
    assert sorted(r["o"] for r in frontier.recent(df, "g", "o", 2).collect()) == [3, 4]


def test_attach_with_a_hot_key(spark):
    rows = [("hot", k) for k in range(500)] + [(f"k{k}", k) for k in range(300)] + [("none", 0)]
    df = spark.createDataFrame(rows, "k string, v long")
    groups = df.where("k <> 'none'").groupBy("k").agg(F.max("v").alias("top"), F.count("*").alias("rows_of_key"))
    got = attach(df, "k", groups).collect()
    assert len(got) == 800 and all(r["top"] == (499 if r["k"] == "hot" else int(r["k"][1:])) for r in got)
    assert attach(df, "k", groups, "left").count() == 801


def test_dedupe(spark):
    rows = [("a", 1, 5, "p/b"), ("a", 2, 5, "p/a"), ("a", 3, 4, "p/0"), ("b", 4, 1, "q"), (None, 5, 1, "r")]
    df = spark.createDataFrame(rows, "url string, seq int, score int, path string")
    assert sorted(r["seq"] for r in dedupe.first_seen(df, "url", "seq").collect()) == [1, 4, 5]
    assert [tuple(r) for r in dedupe.duplicate_groups(df, "url").collect()] == [("a", 3)]
    kept = dedupe.keep_richest(df, "url", [F.col("score")], dedupe.path_order(F.col("path")))
    assert sorted(r["seq"] for r in kept.collect()) == [2, 4, 5]


def test_the_report_is_in_order(spark):
    """By address, then by the parts of the path."""
    rows = [(f"u{k % 7}", p, 0, 1, k, 10) for k, p in enumerate(f"{d}/{n}" for d in ("b", "a b", "a", "a-b") for n in ("z.md", "y.md", "x-1.md", "x/1.md", "x.md", "q.md", "r.md"))]
    notes = spark.createDataFrame(rows, "norm_url string, path string, has_enrichment int, has_sidecar int, richness int, bytes int").withColumn("modified", F.lit("2026-01-01").cast("timestamp")).repartition(5)
    got = [(r["norm_url"], r["moved"].split("/")) for r in dedupe.dedupe_report(notes).collect()]
    assert len(got) == 21 and got == sorted(got)


def test_delta(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    known = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    assert sorted(str(r["k"]) for r in delta.new_rows(df, known, "k").collect()) == ["None", "b"]
    assert sorted((str(r["k"]), r["is_known"]) for r in delta.with_known_flag(df, known, "k").collect()) == [("None", False), ("a", True), ("b", False)]
    old = spark.createDataFrame([("a", 1), ("c", 1)], "k string, v int")
    new = spark.createDataFrame([("a", 2), ("b", 2)], "k string, v int")
    assert sorted(map(tuple, delta.insert_absent(old, new, "k").collect())) == [("a", 1), ("b", 2), ("c", 1)]
    assert sorted(map(tuple, delta.upsert(old, new, "k").collect())) == [("a", 2), ("b", 2), ("c", 1)]
    dimension = spark.createDataFrame([("a",), ("z",)], "k string")
    assert sorted(map(tuple, delta.counts_with_zeros(df, "k", dimension).collect())) == [("a", 1), ("z", 0)]


def test_threads(spark):
    long = [f"post number {k} of a long thread" for k in range(30)]
    rows = [("u", 2, "Me", long[1]), ("u", 1, "me", f" {long[0]}\n"), ("u", 3, "other", "not of the thread"), ("u", 4, None, long[2]), ("u", 5, "me", long[0]), ("u", 6, "me", "too short"), ("u", 7, "me", None)]
    df = spark.createDataFrame(rows + [("u", 10 + k, "me", long[k]) for k in range(3, 30)], "url string, ord int, author string, text string")
    assert content.thread_texts(df, "url", "ME").first()["thread_text"] == "\n\n---\n\n".join(long)


def bookmarks(spark):
    schema = "source string, url string, title string, post_text string, external_urls array<string>, referenced_tweet_urls array<string>, image_urls array<string>"
    rows = [("x", "https://x.com/u/status/1", "t", "post", ["https://e.org/1", "https://e.org/2", "https://e.org/3", "https://e.org/4"], ["https://x.com/v/status/9"], None), ("linkedin", "https://l/1", "t", "own", None, None, ["i0"]), ("linkedin", "https://l/2", "t", "own", None, None, None)]
    return spark.createDataFrame(rows, schema)


def test_content(spark):
    pages = [("https://e.org/1", "a" * 250, None, ["i"], None), ("https://e.org/2", "short", "b" * 9000, None, None), ("https://x.com/v/status/9", None, None, None, "thread"), ("https://l/1", "short", "c" * 60, ["i1"], None), ("https://x.com/u/status/1", None, None, None, "a longer thread")]
    pages = spark.createDataFrame(pages, "page_url string, full_text string, fallback_text string, image_urls array<string>, thread_text string")
    got = {r["bookmark"]["url"]: r["content"] for r in content.with_content(bookmarks(spark), pages).collect()}
    first = got["https://x.com/u/status/1"]
    assert first["full_text"].startswith("a longer thread\n\nReferenced links:\n- https://e.org/1\n") and first["full_text"].endswith("Referenced tweets:\n- https://x.com/v/status/9")
    assert [(a["url"], a["extraction_method"], len(a["text"] or "")) for a in first["external_articles"]] == [("https://x.com/v/status/9", "playwright_x_thread", 6), ("https://e.org/1", "playwright", 250), ("https://e.org/2", "trafilatura", 8000), ("https://e.org/3", "failed", 0)]
    assert got["https://l/1"]["extraction_method"] == "trafilatura" and got["https://l/1"]["image_urls"] == ["i0", "i1"]
    assert got["https://l/2"]["extraction_method"] == "post_only" and got["https://l/2"]["full_text"] is None


def test_enrichment_falls_back_and_fails_by_row(spark):
    pages = spark.createDataFrame([], "page_url string, full_text string, fallback_text string, image_urls array<string>, thread_text string")
    rows = content.with_content(bookmarks(spark), pages)

    def first(prompt):
        raise ValueError("down")

    def second(prompt):
        if "https://l/2" in prompt:
            return "  \n"
        return "  SUMMARY:\n- a\nTAKEAWAY: b\nTAGS: C"

    done = enrich.enrich(rows, [("one", first), ("two", second)], enrich.Schedule(wait=0))
    assert enrich.result_counts(done).first().asDict() == {"processed": 3, "enriched": 2, "dead_letter": 1}
    good, bad = enrich.split_failed(done)
    assert good.count() == 2 and bad.first()["error"] == "All models exhausted. Last error: empty answer"
    e = good.first()["enrichment"]
    assert e["model_used"] == "two" and len(e["summary_bullets"]) == 3 and e["tags"] == ["c"] and e["tokens"] == 7
    letters = enrich.dead_letters(done, F.lit("2026-01-01").cast("timestamp"))
    assert letters.first()["stage"] == "llm" and letters.first()["bookmark"]["url"] == "https://l/2"
    assert letters.columns == DEAD_LETTER.fieldNames()


def test_errors_of_extraction(spark):
    """A broken extraction is told apart from one without text; a bookmark whose own page broke off is not asked for."""
    schema = "page_url string, full_text string, fallback_text string, image_urls array<string>, thread_text string, error string"
    pages = spark.createDataFrame([("https://e.org/1", "a" * 250, None, None, None, "timeout"), ("https://x.com/v/status/9", None, None, None, "thread", "crash"), ("https://l/2", None, None, None, None, "gone")], schema)
    rows = content.with_content(bookmarks(spark), pages)
    got = {r["bookmark"]["url"]: r for r in rows.collect()}
    assert [(a["extraction_method"], a["text"]) for a in got["https://x.com/u/status/1"]["content"]["external_articles"]] == [("error_x_thread", None), ("error", None), ("failed", None), ("failed", None)]
    assert got["https://l/2"]["page_error"] == "gone" and got["https://l/1"]["page_error"] is None
    asked = enrich.enrich(rows, [("one", lambda prompt: prompt)])
    letter = enrich.dead_letters(asked, F.lit("2026-01-01").cast("timestamp")).collect()
    assert [(r["bookmark"]["url"], r["error"], r["stage"]) for r in letter] == [("https://l/2", "gone", "processing")]
    assert enrich.result_counts(asked).first().asDict() == {"processed": 3, "enriched": 2, "dead_letter": 1}


def test_contents_of_bookmarks_with_equal_or_no_addresses(spark):
    schema = bookmarks(spark).schema
    rows = [("x", "https://x.com/u/status/1", "t", "p", ["https://e.org/1"], None, None), ("x", "https://x.com/u/status/1", "t", "p", ["https://e.org/2"], None, None), ("x", None, "t", "p", ["https://e.org/3"], None, None)]
    pages = spark.createDataFrame([(f"https://e.org/{k}", f"{k}" * 300, None, None, None) for k in (1, 2, 3)], "page_url string, full_text string, fallback_text string, image_urls array<string>, thread_text string")
    got = content.with_content(spark.createDataFrame(rows, schema), pages).collect()
    assert sorted([a["text"][0] for a in r["content"]["external_articles"]] for r in got) == [["1"], ["2"], ["3"]]


class Clock:
    """Time that passes only while someone sleeps or asks."""

    def __init__(self):
        self.now, self.slept = 0.0, []

    def time(self):
        return self.now

    def sleep(self, seconds):
        self.slept.append(seconds)
        self.now += seconds


def test_waits_between_tries():
    clock, calls = Clock(), []

    def fails(prompt):
        calls.append(clock.now)
        clock.now += 0.5
        raise ValueError("down")

    def blank(prompt):
        calls.append(clock.now)
        return " \n"

    how = enrich.Schedule(clock=clock.time, sleep=clock.sleep)
    # waits of 1 and 2 seconds, none after the last try, none after a blank answer
    assert how.ask("q", [("a", fails), ("b", blank), ("c", lambda q: f" {q} ")]) == ("q", "c", None)
    assert clock.slept == [1.0, 2.0] and calls == [0.0, 1.5, 4.0, 4.5, 4.5, 4.5]
    clock.now, clock.slept, calls[:] = 0.0, [], []
    how = enrich.Schedule(tries=9, deadline=4.0, clock=clock.time, sleep=clock.sleep)
    assert how.ask("q", [("a", fails)]) == (None, None, "No answer within 4 s. Last error: down")
    assert calls == [0.0, 1.5] and clock.slept == [1.0, 2.0]
    assert how.ask("q", []) == (None, None, "All models exhausted. Last error: no endpoint")


def test_rows_are_asked_for_at_a_time_and_keep_their_order(spark):
    """No more than the pool has at a time; a slow row does not change the order."""
    import time

    running, most = [], [0]

    def slow(prompt):
        running.append(prompt)
        most[0] = max(most[0], len(running))
        time.sleep(0.02 if int(prompt) % 5 else 0.1)
        running.pop()
        return f"{prompt} of {most[0]}"

    df = spark.range(40, numPartitions=1).select(F.col("id").cast("string").alias("prompt"))
    got = [r["answer"].split(" of ") for r in enrich.ask(df, "prompt", [("m", slow)], enrich.Schedule(at_a_time=4)).collect()]
    assert [int(a) for a, _ in got] == list(range(40)) and max(int(n) for _, n in got) == 4


def test_rows_without_an_address_are_enriched(spark):
    """Each row is asked for by itself, whatever its address."""
    rows = spark.range(20).select(F.struct(F.lit("x").alias("source"), F.lit(None).cast("string").alias("url"), F.concat(F.lit("t"), "id").alias("title"), F.lit("p").alias("post_text"), F.array("id").cast("array<string>").alias("external_urls")).alias("bookmark"), F.struct(F.lit(None).cast("string").alias("full_text"), F.lit("post_only").alias("extraction_method")).alias("content"))
    done = enrich.enrich(rows, [("one", lambda prompt: "TAKEAWAY: " + str(prompt.count("\n")))])
    assert enrich.result_counts(done).first().asDict() == {"processed": 20, "enriched": 20, "dead_letter": 0}
    assert sorted(r["bookmark"]["title"] for r in done.collect()) == sorted(f"t{k}" for k in range(20))


def test_status_classes(spark):
    df = spark.createDataFrame([(200, False), (404, False), (503, False), (None, True), (302, False)], "s int, t boolean")
    assert [r[0] for r in df.select(enrich.classify_status(F.col("s"), F.col("t"))).collect()] == ["ok", "give up", "retry", "retry", "give up"]
    assert {r[0] for r in df.select(enrich.classify_status(F.col("s"), F.col("t"), F.lit(21))).collect()} == {"give up"}


def test_large_limits_for_groups(spark):
    df = spark.range(5000).select((F.col("id") % 2).alias("g"), F.col("id").alias("v"))
    got = delta.cap_per_group(df, "g", [F.col("v")], 1500)
    assert sorted(tuple(r) for r in got.collect()) == sorted((v % 2, v) for v in range(3000)) and got.columns == ["g", "v"]


def test_linked_pages_are_worked_out_once(spark):
    """Articles are made for each page before they are joined; pages with few and with many links, and null addresses."""
    from siltstone.operators.content import articles_of

    text = "enough words of an article " * 20
    rows = [(f"b{k}", ["https://hot.example/", None, f"https://e.org/{k % 300}"], None) for k in range(600)]
    marks = spark.createDataFrame(rows, "url string, external_urls array<string>, referenced_tweet_urls array<string>")
    pages = spark.createDataFrame([("https://hot.example/", text), *((f"https://e.org/{k}", f"{k} {text}") for k in range(0, 300, 2))], "page_url string, full_text string")
    none = F.lit(None).cast("string")
    found = articles_of(marks, pages.select("page_url", "full_text", none.alias("fallback_text"), F.array().cast("array<string>").alias("image_urls"), none.alias("thread_text")))
    assert "regexp" not in found._jdf.queryExecution().optimizedPlan().toString().lower()
    got = {r["url"]: [(a["url"], a["text"], a["extraction_method"]) for a in r["external_articles"]] for r in found.collect()}
    hot = ("https://hot.example/", text.strip(), "playwright")
    cold = lambda n: (f"https://e.org/{n}", f"{n} {text}".strip() if n % 2 == 0 else None, "playwright" if n % 2 == 0 else "failed")
    assert {u: [(a, t and t.strip(), m) for a, t, m in v] for u, v in got.items()} == {f"b{k}": [hot, cold(k % 300)] for k in range(600)}


def test_thread_pages_read_documents_once(spark, tmp_path):
    from siltstone.queries import thread_pages

    spark.createDataFrame([(1, "a text that is long enough", "fr", "src1"), (2, None, None, None)], "doc_id long, text string, lang string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    found = thread_pages(spark, str(tmp_path))
    assert found._jdf.queryExecution().optimizedPlan().toString().count("parquet") == 1
    assert {r["doc_id"] for r in found.collect()} >= {1}
