"""Resolving duplicates in a folder of notes: a run that moves files can be taken up where it stopped.

All moves are written down before the first file moves: ``backup``/_journal/moves, then plan.json, which makes the plan count.
Moving is idempotent, so a run that dies in between is done again from its plan, not from the folder, which has changed:
same folder, same report. done.json ends it.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

from pyarrow import fs
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..operators.dedupe import dedupe_report, dedupe_summary
from ..operators.skew import attach
from ..sources.files import as_uri, children, exists, read_bytes, replace, resolve, write_json
from ..sources.notes import notes_with_sidecars, read_notes, read_sidecars
from ..tables import materialize

#: Notes that one line of the report names, about; a larger group has several lines.
LINE = 1000
REPORT, JOURNAL = "dedupe_report", "_journal"


@dataclass
class Resolved:
    scanned: int
    duplicate_groups: int
    moved: int
    backup: str | None = None

    @property
    def report(self) -> str | None:
        return self.backup and f"{self.backup}/{REPORT}"


def backup_root(folder: str) -> str:
    """Beside the folder; beside the vault for a vault's own bookmarks."""
    parent, _, name = folder.rstrip("/").rpartition("/")
    if name == "bookmarks" and parent.rpartition("/")[2] == "vault":
        parent = parent.rpartition("/")[0]
    return f"{parent}/dedupe_backup"


def write_plan(report: DataFrame, folder: str, backup: str, summary: dict) -> None:
    root = quote(resolve(as_uri(folder))[1].rstrip("/"))
    below = F.expr("substring(moved, instr(moved, root) + length(root))")  # from the slash after the folder on
    report = report.withColumn("root", F.lit(root)).withColumn("below", below)
    to = F.concat(F.lit(as_uri(backup).rstrip("/")), "below")
    report.withColumn("to", to).drop("root", "below").write.mode("overwrite").parquet(f"{backup}/{JOURNAL}/moves")
    store, at = resolve(as_uri(backup))
    write_json(store, f"{at}/{JOURNAL}/plan.json", summary)


def move(rows: Iterator[Row]) -> None:
    """Notes with their sidecars; what was moved before stays where it is."""
    for row in rows:
        for name, target in ((row["moved"], row["to"]), (row["moved"].removesuffix(".md") + ".json", row["to"].removesuffix(".md") + ".json")):
            store, path = resolve(as_uri(name))
            to = resolve(as_uri(target))[1]
            if exists(store, path):
                store.create_dir(to.rpartition("/")[0], recursive=True)
                replace(store, path, to)


def grouped(moves: DataFrame) -> DataFrame:
    """(url, kept, kept_score, moved): a line for each address; large groups have several."""
    sizes = moves.groupBy("norm_url").agg(F.count("*").alias("rows_of_key"), F.count("*").alias("notes"))
    lines = attach(moves, "norm_url", materialize(sizes, "report-sizes")).withColumn("line", F.pmod(F.xxhash64("moved"), F.ceil(F.col("notes") / LINE)))
    one = F.struct(F.col("moved").alias("from"), "to", F.col("moved_score").alias("score"))
    found = lines.groupBy("norm_url", "line", "kept", "kept_score").agg(F.array_sort(F.collect_list(one)).alias("moved"))
    return found.orderBy("norm_url", "line").select(F.col("norm_url").alias("url"), "kept", "kept_score", "moved")


def replay(spark: SparkSession, backup: str) -> Resolved:
    """Do what a plan says, as far as it has not been done."""
    store, at = resolve(as_uri(backup))
    plan = json.loads(read_bytes(store, f"{at}/{JOURNAL}/plan.json"))
    moves = spark.read.parquet(f"{backup}/{JOURNAL}/moves")
    moves.select("moved", "to").foreachPartition(move)
    grouped(moves).write.mode("overwrite").json(f"{backup}/{REPORT}")
    write_json(store, f"{at}/{JOURNAL}/done.json", plan)
    return Resolved(plan["scanned"], plan["duplicate_groups"], plan["moved"], backup)


def resume(spark: SparkSession, folder: str, root: str | None = None) -> list[Resolved]:
    """Take the runs that stopped between their plan and their end to it; those without a plan have moved nothing."""
    top = (root or backup_root(folder)).rstrip("/")
    store, at = resolve(as_uri(top))
    runs = [f.base_name for f in children(store, at) if f.type == fs.FileType.Directory]
    return [replay(spark, f"{top}/{r}") for r in runs if exists(store, f"{at}/{r}/{JOURNAL}/plan.json") and not exists(store, f"{at}/{r}/{JOURNAL}/done.json")]


def resolve_duplicates(spark: SparkSession, folder: str, run: str, root: str | None = None) -> Resolved:
    """Of notes under one address the richest stays; the others and their sidecars move to a folder named ``run``.

    Runs that stopped are taken to their end first. Without duplicates nothing is written."""
    resume(spark, folder, root)
    store, at = resolve(as_uri(folder))
    if not exists(store, at):
        return Resolved(0, 0, 0)
    notes = materialize(notes_with_sidecars(read_notes(spark, folder), read_sidecars(spark, folder)).drop("text"), "scored-notes")
    summary = dedupe_summary(notes).first().asDict()
    if not summary["moved"]:
        return Resolved(**summary)
    backup = f"{(root or backup_root(folder)).rstrip('/')}/{run}"
    write_plan(dedupe_report(notes), folder, backup, summary | {"notes_dir": folder, "backup_dir": backup})
    return replay(spark, backup)
