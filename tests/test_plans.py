"""Whole runs: rendering, writing, streams, and the registered queries against DuckDB."""

import json
import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from siltstone import queries
from siltstone.operators.enrich import Schedule
from siltstone.plans import ingest, render, sinks
from siltstone.schemas import FRONTIERS
from siltstone.sources import notes as note_files
from siltstone.sources import stores
from siltstone.sources.stores import load
from siltstone.streaming.frontier import ROCKSDB, new_before_known, run_in_order, save_state, state_of
from siltstone.streaming.ingest import once_per_url, run

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def now():
    return F.lit("2026-05-14 00:00:00").cast("timestamp")


def enriched(spark):
    bookmark = "struct<source:string,url:string,title:string,post_text:string,external_urls:array<string>,referenced_tweet_urls:array<string>,image_urls:array<string>,published_at:timestamp,saved_at:timestamp,retrieved_at:timestamp>"
    content = "struct<url:string,full_text:string,post_text:string,extraction_method:string,external_articles:array<struct<url:string,text:string,image_urls:array<string>,extraction_method:string>>,image_urls:array<string>>"
    enrichment = "struct<summary_bullets:array<string>,takeaway:string,tags:array<string>,model_used:string,tokens:int>"
    from datetime import datetime

    t = datetime(2026, 5, 13, 1)
    rows = [
        (("x", "https://x.com/u/status/5", 'A "quoted": title', "post", ["https://e.org"], None, ["https://i/1"], t, None, t), ("https://x.com/u/status/5", "thread text", "post", "playwright_x_thread", None, None), (["a", "b", "c"], "take", ["t1"], "m", 3)),
        (("linkedin", "https://l/1", "T", None, ["https://e.org"], None, None, None, None, t), ("https://l/1", None, None, "post_only", [("https://e.org", None, None, "failed"), ("https://x.com/v/status/1", "tt", ["i"], "playwright_x_thread")], None), None),
    ]
    return spark.createDataFrame(rows, f"bookmark {bookmark}, content {content}, enrichment {enrichment}")


def test_render_and_write(spark, tmp_path):
    rendered = render.notes(enriched(spark))
    sinks.write_notes(rendered, str(tmp_path))
    sinks.write_notes(rendered, f"file://{tmp_path}")  # the same again
    files = sorted(str(p.relative_to(tmp_path)) for p in tmp_path.rglob("*.*"))
    assert files[-2:] == ["x/a-quoted-title-5.json", "x/a-quoted-title-5.md"] and len(files) == 4
    text = (tmp_path / "x/a-quoted-title-5.md").read_text()
    assert text.startswith('---\ntitle: "A \\"quoted\\": title"\nsource: x\nurl: "https://x.com/u/status/5"\npublished: \'2026-05-13T01:00:00+00:00\'\n') and "saved:" not in text
    assert text.split("---\n\n", 1)[1] == "## Summary\n\n- a\n- b\n- c\n\n## Takeaway\n\ntake\n\n## Original\n\npost\n\n## Thread\n\nthread text\n\n## Images\n\n![](https://i/1)\n\n## Links\n\n- https://e.org\n"
    other = next(p for p in (tmp_path / "linkedin").glob("*.md")).read_text()
    assert "tags: []\nmodel: none" in other and "## Article: https://e.org\n\n(Extraction failed" in other and "## Referenced Tweet: https://x.com/v/status/1\n\ntt\n\n### Images\n\n![](i)" in other and "## Links" not in other
    assert json.loads((tmp_path / "x/a-quoted-title-5.json").read_text())["enrichment"]["takeaway"] == "take"
    back = note_files.read_notes(spark, str(tmp_path))
    assert sorted(r[0] for r in note_files.note_urls(back).collect()) == ["https://l/1", "https://x.com/u/status/5"]


def test_a_run_then_another(spark, tmp_path):
    bodies = queries.status_bodies(spark, SF).where("seq < 2").unionByName(queries.post_bodies(spark, SF).where("seq < 2"))
    none = spark.createDataFrame([], "norm_url string")
    options = ingest.Options(most_per_source=30)
    fresh = ingest.new_bookmarks(bodies, none, options, now())
    pages = spark.createDataFrame([], "page_url string, full_text string, fallback_text string, image_urls array<string>, thread_text string")
    calls = tmp_path / "calls"

    def counted(prompt):
        with open(calls, "a") as f:
            f.write("x")
        return queries.answer_or_fail(prompt)

    written, dead, processed, found = ingest.process(fresh, pages, [("m", counted)], now(), Schedule(wait=0))
    written.collect(), dead.collect(), processed.collect()
    assert len(calls.read_text()) == 60 + 2 * dead.count()  # each row once, failed ones three times, whoever reads the results
    assert found == {"processed": 60, "enriched": 60 - dead.count(), "dead_letter": dead.count()}
    assert ingest.run_result(spark, found, "c9").first()["new_cursor_x"] == "c9"
    counts = {r["source"]: r["n"] for r in sinks.manifest(fresh.select("source"), ["x", "linkedin", "none"]).collect()}
    assert counts == {"x": 30, "linkedin": 30, "none": 0}
    assert written.count() == processed.count() == 60 and 0 < dead.count() < 60
    again = ingest.would_process(bodies, processed.select("norm_url"), options, now())
    assert sorted(map(tuple, again.collect())) == [("linkedin", 40, 10), ("x", 40, 10)]
    only = ingest.bookmarks(bodies, ingest.Options(sources=("x",)), now())
    assert {r["source"] for r in only.collect()} == {"x"}
    assert ingest.new_bookmarks(bodies, none, ingest.Options(sources=()), now()).count() == 0
    assert ingest.new_bookmarks(bodies, none, ingest.Options(most_per_source=None), now()).count() == 80
    sinks.write_manifest(fresh, ["x", "linkedin", "none"], str(tmp_path), 30, now())
    told = json.loads((tmp_path / "manifest.json").read_text())
    assert (tmp_path / "README.md").read_text().startswith("# Export of saved posts\n\n- Exported at: 2026-05-14T00:00:00Z\n- Total: 60\n- linkedin: 30\n- none: 0\n- x: 30\n")
    assert told["total"] == 60 and told["by_source"] == {"linkedin": 30, "none": 0, "x": 30} and told["max_items_per_source"] == 30
    sinks.export_raw(fresh, str(tmp_path / "raw"))
    assert spark.read.json(str(tmp_path / "raw/raw")).count() == 60
    sinks.append_dead_letters(dead, str(tmp_path / "dead"))
    assert note_files.read_dead_letters(spark, str(tmp_path / "dead")).count() == dead.count()


def test_streams(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    rows = [[("x", 1, "n1", False), ("x", 2, "k1", True)], [("x", 3, "k1", True), ("x", 4, "n2", False), ("x", 5, "k2", True)], [("x", 6, "n3", False)]]
    schema = "source string, seq long, url string, is_known boolean"
    got = []
    for k, batch in enumerate(rows):  # three runs over a growing folder: the state outlives each of them
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        new_before_known(stream, 2).writeStream.option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start(path=str(tmp_path / "out"), format="parquet").awaitTermination()
        got = sorted(r["seq"] for r in spark.read.parquet(str(tmp_path / "out")).collect())
    # the repeated k1 neither lengthens nor breaks the run, n2 breaks it
    assert got == [1, 4, 6]


def test_state_between_store_and_stream(spark, tmp_path):
    """The stream remembers what the store had; what it remembers goes back; a source that brings nothing keeps its own."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    store, row = str(tmp_path / "store"), "source string, seq long, url string"
    for source in ("a", "b"):
        stores.save_frontiers(spark.createDataFrame([(source, k, f"https://e.org/{source}{k}") for k in range(6)], row), store, 4, F.lit("2026-01-01").cast("timestamp"))
    start = load(spark, store, FRONTIERS)
    # a3 and a5 are remembered, so they neither lengthen a run nor break it; a0 is not any more and breaks it
    rows = [("a", 10, "https://e.org/k1", True), ("a", 11, "https://e.org/a3", False), ("a", 12, "https://e.org/a5", True), ("a", 13, "https://e.org/a0", False), ("a", 14, "https://e.org/k2", True), ("a", 15, "https://e.org/k3", True), ("a", 16, "https://e.org/n", False), ("c", 1, "https://e.org/c", False)]
    df = spark.createDataFrame(rows, row + ", is_known boolean")
    run_in_order(df.where("seq < 14"), 2, str(tmp_path / "run"), recent_limit=4, initial=start)
    run_in_order(df.where("seq >= 14"), 2, str(tmp_path / "run2"), recent_limit=4, initial=state_of(spark, str(tmp_path / "run" / "state")))
    got = sorted((r["source"], r["seq"]) for k in ("run", "run2") for r in spark.read.parquet(str(tmp_path / k / "rows")).collect())
    assert got == [("a", 11), ("a", 13), ("c", 1)]
    at = str(tmp_path / "run2" / "state")
    state = {r["source"]: (r["matched"], r["recent_urls"]) for r in state_of(spark, at).collect()}
    assert state == {"a": (True, [f"https://e.org/{x}" for x in ("a0", "k2", "k3", "n")]), "b": (False, [f"https://e.org/b{k}" for k in range(2, 6)]), "c": (False, ["https://e.org/c"])}
    save_state(spark, at, store, F.lit("2026-01-02").cast("timestamp"))
    assert {r["source"]: r["recent_urls"] for r in load(spark, store, FRONTIERS).collect()} == {k: v for k, (_, v) in state.items()}


def test_a_long_feed_comes_in_blocks(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    known = {40, 80, 81, 120}
    rows = [("x", k, f"x{k}", k in known) for k in range(200)] + [("y", k, f"y{k}", False) for k in range(50)]
    df = spark.createDataFrame(rows[::-1], "source string, seq long, url string, is_known boolean").repartition(3)
    sizes = run_in_order(df, 2, str(tmp_path), block_rows=120)
    assert sum(sizes) == 250 and max(sizes) <= 120
    got = sorted((r["source"], r["seq"]) for r in spark.read.parquet(str(tmp_path / "rows")).collect())
    assert got == [("x", k) for k in range(80) if k not in known] + [("y", k) for k in range(50)]


def test_many_short_feeds_are_one_block(spark, tmp_path):
    """The number of micro-batches follows the longest feed, not the number of feeds; a long one without a name or seq is cut too."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    schema = "source string, seq long, url string, is_known boolean"
    short = [(f"s{k % 40}", k, f"u{k}", k >= 360) for k in range(400)]
    assert run_in_order(spark.createDataFrame(short, schema), 1, str(tmp_path / "short"), block_rows=50) == [400]
    long = [("x", k, f"x{k}", k in (10, 90)) for k in range(100)] + [("x", None, "none", False), ("y", 5, "y", False)]
    sizes = run_in_order(spark.createDataFrame(long + short, schema), 2, str(tmp_path / "long"), block_rows=50)
    assert len(sizes) == 4 and sizes[0] < 440 and max(sizes[1:]) <= 50 and sum(sizes) == 502
    got = {(r["source"], r["url"]) for r in spark.read.parquet(str(tmp_path / "long/rows")).collect()}
    assert got == {(s, u) for s, _, u, known in long + short if not known}


def test_a_run_at_intervals_goes_on(spark, tmp_path):
    """With an interval the query takes up what comes later, and ends only when it is stopped."""
    import time

    rows = lambda *urls: spark.createDataFrame([(u,) for u in urls], "url string").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    rows("https://e.org/a")
    stream = once_per_url(spark.readStream.schema("url string").parquet(str(tmp_path / "in"))).select("norm_url")
    query = run(stream, lambda df: (df, df.limit(0)), str(tmp_path / "good"), str(tmp_path / "bad"), str(tmp_path / "state"), every="1 second")
    try:
        query.processAllAvailable()
        rows("https://e.org/b", "https://e.org/a/")
        began = time.time()
        while spark.read.schema("norm_url string").option("recursiveFileLookup", "true").parquet(str(tmp_path / "good")).count() < 2:
            assert query.isActive and time.time() - began < 120
            time.sleep(1)
    finally:
        query.stop()
    found = spark.read.schema("norm_url string").option("recursiveFileLookup", "true").parquet(str(tmp_path / "good"))
    assert sorted(r[0] for r in found.collect()) == ["https://e.org/a", "https://e.org/b"]


def test_catch_up_run(spark, tmp_path):
    schema = "url string, fail boolean"
    for urls in (["https://e.org/a", "https://e.org/a/?utm_source=x"], ["https://E.org/a", "https://e.org/b"]):
        spark.createDataFrame([(u, u.endswith("b")) for u in urls], schema).write.mode("append").parquet(str(tmp_path / "in"))
        stream = once_per_url(spark.readStream.schema(schema).parquet(str(tmp_path / "in")))
        split = lambda df: (df.where("NOT fail"), df.where("fail"))
        run(stream, split, str(tmp_path / "good"), str(tmp_path / "bad"), str(tmp_path / "state")).awaitTermination()
    assert [r["norm_url"] for r in spark.read.parquet(str(tmp_path / "good")).collect()] == ["https://e.org/a"]
    assert spark.read.json(str(tmp_path / "bad")).count() == 1


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def compare(spark, duck, query, sql):
    df = query(spark, SF)
    columns = sorted(df.columns)
    got = sorted(repr(tuple(r[c] for c in columns)) for r in df.collect())
    found = duck.execute(sql)
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    assert got == sorted(repr(tuple(r[names.index(c)] for c in columns)) for r in found.fetchall())


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    compare(spark, duck, queries.queries()[name], queries.oracle_sql()[name])


@pytest.mark.parametrize("name", sorted(set(queries.queries()) - set(queries.oracle_sql())))
def test_query_runs(spark, name):
    assert queries.queries()[name](spark, SF).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert os.path.isdir(SF)
