"""Resolving duplicates: a run that stops anywhere ends with the same folder and report."""

import json

import pytest

from siltstone.plans import moves


def vault(root):
    """Three addresses: one with three notes, one with two (one of them without a sidecar), one alone."""
    at = root / "my vault" / "vault" / "bookmarks"
    for name, url, size in (("x/a1", "a", 1), ("x/a2", "a", 9), ("linkedin/a3", "a/?utm_source=z", 5), ("x/b1", "b", 3), ("x/b2", "b", 0), ("x/c", "c", 1)):
        path = at / f"{name}.md"
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(f"---\nurl: https://e.org/{url}\n---\n")
        if size:
            path.with_suffix(".json").write_text(json.dumps({"content": {"full_text": "t" * size}}))
    return at


def files(root):
    return sorted(str(p.relative_to(root)) for p in root.rglob("*") if p.suffix in (".md", ".json") and "_journal" not in p.parts and "dedupe_report" not in p.parts)


def report(spark, at):
    return [(r["url"], r["kept"].rsplit("/", 1)[1], [m["from"].rsplit("/", 1)[1] for m in r["moved"]]) for r in spark.read.json(at).orderBy("url").collect()]


EXPECTED = ["my vault/dedupe_backup/r/linkedin/a3.json", "my vault/dedupe_backup/r/linkedin/a3.md", "my vault/dedupe_backup/r/x/a1.json", "my vault/dedupe_backup/r/x/a1.md", "my vault/dedupe_backup/r/x/b2.md", "my vault/vault/bookmarks/x/a2.json", "my vault/vault/bookmarks/x/a2.md", "my vault/vault/bookmarks/x/b1.json", "my vault/vault/bookmarks/x/b1.md", "my vault/vault/bookmarks/x/c.json", "my vault/vault/bookmarks/x/c.md"]
LINES = [("https://e.org/a", "a2.md", ["a3.md", "a1.md"]), ("https://e.org/b", "b1.md", ["b2.md"])]


def test_duplicates_are_resolved(spark, tmp_path):
    at = vault(tmp_path)
    done = moves.resolve_duplicates(spark, str(at), "r")
    assert (done.scanned, done.duplicate_groups, done.moved) == (6, 2, 3) and files(tmp_path) == EXPECTED
    assert done.backup == str(tmp_path / "my vault" / "dedupe_backup" / "r") and report(spark, done.report) == LINES
    again = moves.resolve_duplicates(spark, f"file://{at}", "r2")
    assert (again.scanned, again.moved, again.backup, again.report) == (3, 0, None, None) and files(tmp_path) == EXPECTED
    assert moves.resolve_duplicates(spark, str(tmp_path / "none"), "r").scanned == 0
    assert moves.backup_root("/a/notes/") == "/a/dedupe_backup" and moves.backup_root("/a/vault/bookmarks") == "/a/dedupe_backup"


@pytest.mark.parametrize("done_before", [0, 1, 2, 4, 5])
def test_a_run_that_stops_is_taken_to_its_end(spark, tmp_path, monkeypatch, done_before):
    """After so many files of the plan; what is moved already is not looked for in the folder again."""
    at = vault(tmp_path)
    with monkeypatch.context() as m:
        m.setattr(moves, "replay", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            moves.resolve_duplicates(spark, str(at), "r")
    backup = tmp_path / "my vault" / "dedupe_backup" / "r"
    plan = spark.read.parquet(str(backup / "_journal" / "moves")).orderBy("moved").collect()
    moved = 0
    for row in plan:
        for kind in (".md", ".json"):
            source = at / row["moved"].split("bookmarks/")[1].replace(".md", kind)
            if source.exists() and moved < done_before:
                target = backup / source.relative_to(at)
                target.parent.mkdir(parents=True, exist_ok=True)
                source.rename(target)
                moved += 1
    # the next run, whatever it is called, finishes the one before and finds nothing more
    assert moves.resolve_duplicates(spark, str(at), "later").moved == 0
    assert files(tmp_path) == EXPECTED and report(spark, str(backup / "dedupe_report")) == LINES
    assert moves.resume(spark, str(at)) == []


def test_a_run_without_a_plan_has_moved_nothing(spark, tmp_path, monkeypatch):
    at = vault(tmp_path)
    before = files(tmp_path)
    with monkeypatch.context() as m:
        m.setattr(moves, "write_json", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            moves.resolve_duplicates(spark, str(at), "r")
    assert files(tmp_path) == before and moves.resume(spark, str(at)) == []
    assert moves.resolve_duplicates(spark, str(at), "r").moved == 3 and files(tmp_path) == EXPECTED


def test_large_groups_have_several_lines(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(moves, "LINE", 2)
    at = tmp_path / "notes"
    (at / "x").mkdir(parents=True)
    for k in range(12):
        (at / "x" / f"{k:02d}.md").write_text("---\nurl: https://e.org/a\n---\n" + "t" * k)
    done = moves.resolve_duplicates(spark, str(at), "r")
    lines = report(spark, done.report)
    assert done.moved == 11 and len(lines) > 1 and sorted(m for _, kept, found in lines for m in found) == [f"{k:02d}.md" for k in range(11)] and {k for _, k, _ in lines} == {"11.md"}
