"""The named-file sink and the feed source: what a crash leaves, and what the next run makes of it."""

import json
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from siltstone.plans import named_files, sinks
from siltstone.plans.named_files import STAGING, NamedFilesWriter, recover, write_named
from siltstone.sources import captured
from siltstone.sources.files import resolve
from siltstone.streaming.ingest import run


def files_of(folder):
    return {str(p.relative_to(folder)): p.read_text() for p in folder.rglob("*") if p.is_file() and not p.name.startswith(".") and STAGING not in p.parts}


# Named files ---------------------------------------------------------------------------------------------------------


def test_named_files(spark, tmp_path):
    rows = [(f"d{k % 3}/{k}.md", f"text {k} \u00e9") for k in range(50)] + [("top.bin", None)]
    write_named(spark.createDataFrame(rows, "path string, content string").repartition(4), str(tmp_path))
    assert files_of(tmp_path) == {p: c or "" for p, c in rows} and not list((tmp_path / STAGING).iterdir())
    # a second run adds and replaces; overwriting leaves its own files alone
    write_named(spark.createDataFrame([("d0/0.md", b"\x00new"), ("more.md", b"x")], "path string, content binary"), f"file://{tmp_path}")
    assert files_of(tmp_path)["d0/0.md"] == "\x00new" and len(files_of(tmp_path)) == 52
    write_named(spark.createDataFrame([("d0/0.md", "only")], "path string, content string"), str(tmp_path), "overwrite")
    assert files_of(tmp_path) == {"d0/0.md": "only"}
    write_named(spark.createDataFrame([], "path string, content string"), str(tmp_path))
    assert files_of(tmp_path) == {"d0/0.md": "only"}


@pytest.mark.parametrize("bad", ["../up.md", "/abs.md", "", None, "a//b.md", "_staging/x", "a/./b"])
def test_a_task_that_fails_leaves_the_folder_as_it_was(spark, tmp_path, bad):
    write_named(spark.createDataFrame([("a.md", "before")], "path string, content string"), str(tmp_path))
    rows = [("a.md", "after"), *((f"b{k}.md", "x") for k in range(30)), (bad, "x")]
    with pytest.raises(Exception, match="no name for a file"):
        write_named(spark.createDataFrame(rows, "path string, content string").repartition(3), str(tmp_path))
    assert files_of(tmp_path) == {"a.md": "before"} and not list((tmp_path / STAGING).iterdir())


def test_columns_are_checked(spark, tmp_path):
    named_files.register(spark)
    with pytest.raises(Exception, match="named_files wants"):
        spark.range(2).write.format("named_files").mode("append").save(str(tmp_path))


@pytest.mark.parametrize("moved", [0, 1, 3])
def test_a_driver_that_dies_while_publishing(tmp_path, moved, monkeypatch):
    """The run is taken to its end later, from however many files were moved; a run without a commit stays out."""
    at = tmp_path / STAGING / "run1"
    for attempt, names in (("000000-7", ["a.md", "sub/b.md", "a.md"]), ("000001-8", ["c.md"]), ("000001-9", ["c.md"])):
        (at / attempt).mkdir(parents=True)
        for k, name in enumerate(names, 1):
            (at / attempt / f"{k:08d}").write_text(f"{attempt} {k}")
        (at / attempt / "names").write_text("".join(json.dumps(n) + "\n" for n in names))
    other = tmp_path / STAGING / "run2" / "000000-1"
    other.mkdir(parents=True)
    (other / "00000001").write_text("half")
    (at / "commit").write_text(json.dumps({"attempts": ["000000-7", "000001-9"], "overwrite": False}))
    (tmp_path / "a.md").write_text("old")
    left = [moved]

    def dies(store, path, target, real=named_files.replace):
        if not left[0]:
            raise KeyboardInterrupt
        left[0] -= 1
        real(store, path, target)

    with monkeypatch.context() as m:
        m.setattr(named_files, "replace", dies)
        m.setattr(named_files, "MOVERS", 1)
        if moved < 3:
            with pytest.raises(KeyboardInterrupt):
                recover(str(tmp_path))
        else:
            assert recover(str(tmp_path)) == 1
    recover(str(tmp_path))
    assert files_of(tmp_path) == {"a.md": "000000-7 3", "sub/b.md": "000000-7 2", "c.md": "000001-9 1"}
    assert recover(str(tmp_path)) == 0 and (other / "00000001").exists()


def test_dead_letters_of_a_batch_that_is_done_again(spark, tmp_path):
    rows = spark.createDataFrame([("a",), ("b",)], "error string")
    for _ in range(2):
        sinks.append_dead_letters(rows, str(tmp_path), run="batch-3")
    sinks.append_dead_letters(rows.limit(1), str(tmp_path), run="batch-4")
    assert spark.read.option("recursiveFileLookup", "true").json(str(tmp_path)).count() == 3


# The feed ------------------------------------------------------------------------------------------------------------


def status_body(seq, cursor):
    entries = [{"entryId": f"tweet-{seq}-{k}", "content": {"itemContent": {"tweet_results": {"result": {"rest_id": str(10 * seq + k), "legacy": {"full_text": f"t{seq}"}}}}}} for k in range(2)]
    if cursor:
        entries.append({"entryId": "cursor-bottom-0", "content": {"value": cursor}})
    return json.dumps({"data": {"bookmark_timeline_v2": {"timeline": {"instructions": [{"entries": entries}]}}}})


def pages(spark, rows):
    """(source, seq, cursor) as responses."""
    made = [(s, n, "https://a/api", 200, status_body(n, c) if s == "x" else json.dumps({"elements": [], "paging": {"start": c}}) if c else "broken {") for s, n, c in rows]
    return spark.createDataFrame(made, "source string, seq long, url string, status int, body string")


def stream_once(spark, folder, out):
    run(captured.feed_stream(spark, folder), lambda rows: (rows.drop("body"), rows.where("status >= 400").select("url")), f"{out}/good", f"{out}/bad", f"{out}/log").awaitTermination()
    batches = spark.read.parquet(f"{out}/good").select("batch", "source", "seq", "cursor").collect()
    return {b: sorted((r["source"], r["seq"]) for r in batches if r["batch"] == b) for b in {r["batch"] for r in batches}}


def test_pages_become_batches_and_offsets_are_cursors(spark, tmp_path):
    folder, out = str(tmp_path / "feed"), str(tmp_path / "out")
    captured.capture(pages(spark, [("x", 0, "c0"), ("x", 1, "c1"), ("linkedin", 0, "t0")]), folder)
    assert stream_once(spark, folder, out) == {0: [("linkedin", 0), ("x", 0), ("x", 1)]}
    # a gap is waited for, a page without a cursor keeps the last one, a source may begin later
    captured.capture(pages(spark, [("x", 2, None), ("x", 4, "c4"), ("linkedin", 1, None)]), folder)
    assert stream_once(spark, folder, out)[1] == [("linkedin", 1), ("x", 2)]
    log = lambda: {r["source"]: (r["seq"], r["cursor"]) for r in captured.offset_log(spark, f"{out}/log").collect()}
    assert log() == {"x": (2, "c1"), "linkedin": (1, "t0")}
    captured.capture(pages(spark, [("x", 3, "c3"), ("third", 0, None)]), folder)
    assert stream_once(spark, folder, out)[2] == [("third", 0), ("x", 3), ("x", 4)]
    assert log() == {"x": (4, "c4"), "linkedin": (1, "t0"), "third": (0, None)}
    before = stream_once(spark, folder, out)
    assert len(before) == 3  # nothing new, no batch
    table = captured.feed_table(spark, folder)
    assert sorted((r["source"], r["seq"]) for r in table.collect()) == sorted(p for b in before.values() for p in b)
    assert table.where("source = 'x' AND seq = 3").first()["cursor"] == "c3"
    assert captured.feed_table(spark, str(tmp_path / "none")).count() == 0


def test_many_pages_are_many_tasks(tmp_path):
    root = tmp_path / "x"
    root.mkdir()
    for k in range(600):
        (root / f"{k:012d}.json").write_text(json.dumps({"cursor": f"c{k}"}))
    feeds = captured.Feeds(str(tmp_path), 16)
    assert feeds.latest() == {"x": {"seq": 599, "cursor": "c599"}}
    parts = feeds.between({"x": {"seq": 99, "cursor": "c99"}}, {"x": {"seq": 599, "cursor": "c599"}})
    assert [(p.first, p.last) for p in parts][:2] == [(100, 115), (116, 131)] and parts[-1].last == 599 and len(parts) == 32
    assert feeds.between({"x": {"seq": 599}}, {"x": {"seq": 599}}) == []


def test_a_large_feed_is_few_tasks_of_bounded_batches(spark, tmp_path, monkeypatch):
    """A task's start costs more than its pages: their number follows the batch, up to a limit, and what a task holds doesn't."""
    stream = captured.CapturedFeed({"path": str(tmp_path)}).streamReader(None)
    count = lambda n: len(stream.partitions({}, {s: {"seq": n - 1} for s in ("x", "linkedin")}))
    assert [count(n) for n in (16, 512, 8192, 150_000)] == [2, 64, 64, 1172]
    parts = stream.partitions({"x": {"seq": 4}}, {"x": {"seq": 99_999}})
    assert [k for p in parts for k in range(p.first, p.last + 1)] == list(range(5, 100_000))
    (tmp_path / "x").mkdir()
    made = [{"url": "u", "status": 200 if k else None, "body": "b" * 40 if k % 3 else None, "cursor": k % 2 == 0 or f"c{k}"} for k in range(10)]
    for k, page in enumerate(made):
        (tmp_path / "x" / f"{k:012d}.json").write_text(json.dumps(page))
    monkeypatch.setattr(captured, "BATCH_BYTES", 100)
    batches = list(captured.read_pages(str(tmp_path), captured.Pages("x", 0, 9)))
    assert [b.num_rows for b in batches] == [5, 4, 1]
    expected = [("x", k, "u", p["status"], p["body"], "true" if k % 2 == 0 else f"c{k}") for k, p in enumerate(made)]
    assert [tuple(r.values()) for b in batches for r in b.to_pylist()] == expected
    assert [tuple(r) for r in captured.feed_table(spark, str(tmp_path)).orderBy("seq").collect()] == expected


def test_cursors_of_odd_bodies_are_found_where_the_body_is(spark, tmp_path, monkeypatch):
    bottom = lambda k, **content: {"entryId": f"cursor-bottom-{k}", "content": content}
    steps = [
        [{"type": "Clear"}, {"entries": [bottom(0, value="a"), {"entryId": "tweet-1"}]}, {"entries": [bottom(1, itemContent={"value": "b"}), {"content": {}}]}],
        [{"entries": [bottom(0, value="a"), bottom(1, value="")]}],  # the last one has none
        [{"entries": "no list"}, "no step", {"entries": [{"entryId": 5}]}],
        [],
    ]
    bodies = [json.dumps({"data": {"bookmark_timeline_v2": {"timeline": {"instructions": s}}}}) for s in steps] + ["broken {", None]
    posts = [json.dumps({"data": {"c": {"elements": [], "metadata": {"paginationToken": "t"}}}}), json.dumps({"paging": {"start": 20}}), "[]", None]
    rows = [("x", k, "u", 200, b) for k, b in enumerate(bodies)] + [("linkedin", k, "u", 200, b) for k, b in enumerate(posts)] + [("third", 0, "u", 200, bodies[0])]
    given = []
    monkeypatch.setattr("siltstone.plans.named_files.write_named", lambda files, folder, real=write_named: (given.append(files), real(files, folder)))
    captured.capture(spark.createDataFrame(rows, "source string, seq long, url string, status int, body string"), str(tmp_path))
    assert "Exchange" not in given[0]._jdf.queryExecution().executedPlan().toString()  # bodies are not shuffled
    found = {(r["source"], r["seq"]): r["cursor"] for r in captured.feed_table(spark, str(tmp_path)).collect()}
    assert found == {**{("x", k): c for k, c in enumerate(["b", *[None] * 5])}, **{("linkedin", k): c for k, c in enumerate(["t", "20", None, None])}, ("third", 0): None}


def test_an_empty_wrapped_status_gives_way(spark):
    from siltstone.sources import feeds

    results = [{}, {"rest_id": "1"}, [], "{}", {"a": {}}]
    entries = [{"entryId": f"tweet-{k}", "content": {"itemContent": {"tweet_results": {"result": r}}, "result": {"rest_id": "direct"}}} for k, r in enumerate(results)]
    body = json.dumps({"data": {"bookmark_timeline_v2": {"timeline": {"instructions": [{"entries": entries}]}}}})
    found = feeds.statuses(spark.createDataFrame([(0, body)], "seq int, body string")).orderBy("position").select(F.to_json("raw").alias("raw")).collect()
    assert [json.loads(r["raw"]) for r in found] == [{"rest_id": "direct"}, *results[1:]]


def test_a_batch_that_fails_is_read_again(spark, tmp_path):
    """The batch whose work fails is planned from the offset log, with the same pages, though more have come meanwhile."""
    folder, out = str(tmp_path / "feed"), str(tmp_path / "out")
    captured.capture(pages(spark, [("x", 0, "c0"), ("x", 1, "c1")]), folder)

    def fails(rows):
        return rows.drop("body").withColumn("seq", F.when(F.col("seq") < 1, F.col("seq")).otherwise(F.raise_error(F.lit("worker lost")).cast("long"))), rows.select("url").limit(0)

    query = run(captured.feed_stream(spark, folder), fails, f"{out}/good", f"{out}/bad", f"{out}/log")
    with pytest.raises(Exception, match="worker lost"):
        query.awaitTermination()
    captured.capture(pages(spark, [("x", 2, "c2")]), folder)
    assert stream_once(spark, folder, out) == {0: [("x", 0), ("x", 1)], 1: [("x", 2)]}


KILLED = """
import os, sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
from siltstone.sources import captured
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
def dies(rows, number):
    rows.drop("body").write.mode("overwrite").parquet({out!r} + f"/good/batch={{number}}")
    if number == 1:
        os._exit(9)  # all is written, nothing is committed
from siltstone.plans.named_files import write_named
for lot in (0, 1):
    if lot:
        captured.capture(spark.createDataFrame([("x", 2, "u", 200, "no json"), ("x", 3, "u", 200, "no json")], "source string, seq long, url string, status int, body string"), {folder!r})
    captured.feed_stream(spark, {folder!r}).writeStream.foreachBatch(dies).option("checkpointLocation", {out!r} + "/log").trigger(availableNow=True).start().awaitTermination()
"""


def test_a_killed_run_loses_and_repeats_nothing(spark, tmp_path):
    from pathlib import Path

    folder, out = str(tmp_path / "feed"), str(tmp_path / "out")
    captured.capture(pages(spark, [("x", 0, "c0"), ("x", 1, "c1")]), folder)
    code = KILLED.format(repo=str(Path(__file__).resolve().parents[1]), folder=folder, out=out)
    ended = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
    assert ended.returncode == 9, ended.stderr[-2000:]
    captured.capture(pages(spark, [("x", 4, "c4")]), folder)
    assert stream_once(spark, folder, out) == {0: [("x", 0), ("x", 1)], 1: [("x", 2), ("x", 3)], 2: [("x", 4)]}
    assert captured.offset_log(spark, f"{out}/log").first()["cursor"] == "c4"


def test_paths(tmp_path):
    assert resolve(f"file://{tmp_path}")[1] == resolve(str(tmp_path))[1] == str(tmp_path)
    assert NamedFilesWriter("x", __import__("pyspark").sql.types.StructType.fromDDL("path string, content binary"), False).run


def test_notes_are_listed_and_published_by_tasks(spark, tmp_path):
    """Neither names nor files of a large folder are in the driver: its index has the listing's files, its commit moves nothing."""
    from siltstone.sources import notes

    rows = [(f"d{k % 3}/it's {k}.md", f"text {k}") for k in range(60)] + [(f"d0/it's {k}.json", "{}") for k in range(0, 60, 3)]
    same = spark.createDataFrame([(0, "same.md", "first"), (1, "same.md", "last")], "k int, path string, content string").repartitionByRange(2, "k").drop("k")
    write_named(spark.createDataFrame([*rows, ("empty.md", ""), (".hidden/a.md", "x")], "path string, content string").repartition(4).unionByName(same), str(tmp_path))
    found = notes.read_notes(spark, f"file://{tmp_path}")
    assert len(found.inputFiles()) < 20
    assert {r["path"].rpartition("/")[2]: r["text"] for r in found.collect()} == {f"it%27s%20{k}.md": f"text {k}" for k in range(60)} | {"same.md": "last"}
    assert found.join(notes.read_sidecars(spark, str(tmp_path)), "stem").count() == 20
    schema = spark.createDataFrame([], "path string, content string").schema
    at = tmp_path / STAGING / "later" / "000000-1"
    at.mkdir(parents=True)
    (at / "00000001").write_text("x")
    (at / "names").write_text('"late.md"\n')
    NamedFilesWriter(str(tmp_path), schema, False, "later").commit([named_files.Attempt("000000-1", 1)])
    assert not (tmp_path / "late.md").exists()
    write_named(spark.createDataFrame([("more.md", "y")], schema), str(tmp_path))
    assert (tmp_path / "late.md").read_text() == "x" and not list((tmp_path / STAGING).iterdir())


def test_files_are_moved_by_as_many_tasks_as_they_need(spark, tmp_path, monkeypatch):
    """Names are short, so Spark left to itself would have one task move all files."""
    monkeypatch.setattr(named_files, "FILES_OF_TASK", 10)
    jobs = []
    monkeypatch.setattr(type(spark.range(0)), "foreachPartition", lambda df, f: jobs.append(df.rdd.mapPartitions(lambda rows: [(n := list(rows)), f(iter(n))][:1]).map(len).collect()))
    write_named(spark.range(200).select(F.format_string("d/%d.md", "id").alias("path"), F.lit("x").alias("content")), str(tmp_path))
    assert sum(jobs[0]) == 200 and len(jobs[0]) == 20 and max(jobs[0]) < 40
    assert len(files_of(tmp_path)) == 200 and not list((tmp_path / STAGING).iterdir())


def test_a_batch_is_kept_on_disk(spark, tmp_path):
    """The first batch of a feed may be all of it; kept in the heap, it leaves its tasks no room."""
    folder, out, levels = str(tmp_path / "feed"), str(tmp_path / "out"), []
    captured.capture(pages(spark, [("x", 0, "c0"), ("x", 1, "c1")]), folder)
    run(captured.feed_stream(spark, folder), lambda rows: (levels.append(rows.storageLevel) or rows.drop("body"), rows.select("url")), f"{out}/good", f"{out}/bad", f"{out}/log").awaitTermination()
    assert [(level.useDisk, level.useMemory) for level in levels] == [(True, False)]
    assert spark.read.parquet(f"{out}/good").count() == spark.read.json(f"{out}/bad").count() == 2


def test_batches_leave_no_tables(spark, tmp_path, monkeypatch):
    from siltstone import tables
    from siltstone.streaming import ingest

    monkeypatch.setattr(tables, "shared_dir", lambda _: str(tmp_path / "shared"))
    spark.createDataFrame([("https://a/1", 200), ("https://a/2", 404)], "url string, status int").write.parquet(str(tmp_path / "in"))

    def process(rows):
        half = tables.materialize(rows.where("status < 400"), "half")
        assert list((tmp_path / "shared" / "siltstone").iterdir())
        return half, rows.where("status >= 400")

    stream = spark.readStream.schema("url string, status int").parquet(str(tmp_path / "in"))
    ingest.run(stream, process, str(tmp_path / "good"), str(tmp_path / "bad"), str(tmp_path / "log")).awaitTermination()
    assert not list((tmp_path / "shared" / "siltstone").iterdir())
    assert spark.read.parquet(str(tmp_path / "good")).count() == spark.read.json(str(tmp_path / "bad")).count() == 1
