"""Enrichment by a pluggable function, and the split of rows that failed."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.enrichment import parse_answer, prompt, takeaway_of, three_bullets, word_count

#: (name, function from prompt to answer); a function may raise, and a blank answer counts as a failure.
Endpoint = tuple[str, Callable[[str], str]]


@dataclass
class Schedule:
    """How rows are asked: so many of a task's at a time, so often, with waits between tries, and how long for each row."""

    at_a_time: int = 3
    tries: int = 3
    #: Seconds before the second try; each further wait is twice as long. There is none after an endpoint's last try.
    wait: float = 1.0
    #: Seconds from a row's first try on after which it is not tried again.
    deadline: float | None = None
    clock: Callable[[], float] = time.monotonic
    sleep: Callable[[float], None] = time.sleep

    def ask(self, text: str, endpoints: list[Endpoint]) -> tuple[str | None, str | None, str | None]:
        """(answer, endpoint, None), or (None, None, error): endpoints in order, the first answer that is not blank, stripped."""
        error, began = "no endpoint", self.clock()
        for name, call in endpoints:
            for attempt in range(self.tries):
                if self.deadline is not None and self.clock() - began >= self.deadline:
                    return None, None, f"No answer within {self.deadline:g} s. Last error: {error}"
                try:
                    if answer := (call(text) or "").strip():
                        return answer, name, None
                    error = "empty answer"
                except Exception as exc:  # whatever an endpoint raises belongs to its row
                    error = str(exc)
                    if attempt + 1 < self.tries and self.wait:
                        self.sleep(self.within(began, self.wait * 2**attempt))
        return None, None, f"All models exhausted. Last error: {error}"

    def within(self, began: float, wait: float) -> float:
        return wait if self.deadline is None else max(0.0, min(wait, began + self.deadline - self.clock()))


def ask(df: DataFrame, prompt_col: str, endpoints: list[Endpoint], schedule: Schedule | None = None) -> DataFrame:
    """All columns with ``answer``, ``model_used`` and ``error``.

    A task asks for a few of its rows at a time and gives them back in their order; rows without a prompt are not asked. A row that no endpoint answers gets the
    last error, so one bad row does not fail its task. Waits are a row's own: others go on meanwhile."""
    names = ["answer", "model_used", "error"]
    schema = T.StructType([*df.schema.fields, *(T.StructField(n, T.StringType()) for n in names)])
    at, how = df.columns.index(prompt_col), schedule or Schedule()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with ThreadPoolExecutor(how.at_a_time) as pool:
            for batch in batches:  # a few rows at a time: an answer takes longer than a row
                for i in range(0, batch.num_rows, 100):
                    part = batch.slice(i, 100)
                    found = list(pool.map(lambda t: (None,) * 3 if t is None else how.ask(t, endpoints), part.column(at).to_pylist()))
                    yield pa.RecordBatch.from_arrays([*part.columns, *(pa.array([f[k] for f in found], pa.string()) for k in range(3))], names=[*part.schema.names, *names])

    return df.mapInArrow(run, schema)


def enrichment_of(answer: Column, source: Column, title: Column, model: Column) -> Column:
    parsed = parse_answer(answer)
    built = F.struct(
        three_bullets(parsed["summary_bullets"], source, title).alias("summary_bullets"),
        takeaway_of(parsed["takeaway"], answer).alias("takeaway"),
        parsed["tags"].alias("tags"),
        model.alias("model_used"),
        word_count(answer).cast("int").alias("tokens"),
    )
    return F.when(answer.isNotNull(), built)


def enrich(rows: DataFrame, endpoints: list[Endpoint], schedule: Schedule | None = None) -> DataFrame:
    """rows(bookmark, content) -> (bookmark, content, enrichment, error, stage); a failed row stays, without enrichment.

    A row that has a ``page_error`` already is not asked for: that is its error, and its stage is 'processing', else 'llm'.
    Each row is asked for by itself, also where addresses repeat or are null. The result is lazy: whoever computes it
    several times asks as often, so write it once (``plans.ingest.process`` does)."""
    b, c = F.col("bookmark"), F.col("content")
    rows = rows if "page_error" in rows.columns else rows.withColumn("page_error", F.lit(None).cast("string"))
    text = prompt(b["source"], b["title"], b["url"], b["post_text"], c["full_text"], c["extraction_method"], b["external_urls"])
    answers = ask(rows.withColumn("prompt", F.when(F.col("page_error").isNull(), F.coalesce(text, F.lit("")))), "prompt", endpoints, schedule)
    error = F.coalesce("page_error", "error")
    stage = F.when(F.col("page_error").isNotNull(), "processing").when(F.col("error").isNotNull(), "llm")
    return answers.select("bookmark", "content", enrichment_of(F.col("answer"), b["source"], b["title"], F.col("model_used")).alias("enrichment"), error.alias("error"), stage.alias("stage"))


def split_failed(rows: DataFrame, error: str = "error") -> tuple[DataFrame, DataFrame]:
    """(rows without an error, rows with one)."""
    return rows.where(F.col(error).isNull()), rows.where(F.col(error).isNotNull())


def dead_letters(rows: DataFrame, now: Column) -> DataFrame:
    """Failed rows of ``enrich`` in the schema of dead letters."""
    return rows.where("error IS NOT NULL").select("bookmark", "error", "stage", now.alias("timestamp"))


def counts() -> list[Column]:
    """processed, enriched, dead_letter of rows of ``enrich``."""
    return [F.count(F.lit(1)).alias("processed"), F.count_if(F.col("enrichment").isNotNull()).alias("enriched"), F.count_if(F.col("error").isNotNull()).alias("dead_letter")]


def result_counts(rows: DataFrame) -> DataFrame:
    """One row of ``counts``."""
    return rows.agg(*counts())


def classify_status(status: Column, timed_out: Column, redirects: Column | None = None, most_redirects: int = 20) -> Column:
    """'ok', 'retry' (server errors and timeouts) or 'give up' (all else, and more redirects than ``most_redirects``)."""
    loops = F.lit(False) if redirects is None else F.coalesce(redirects > most_redirects, F.lit(False))
    return F.when(loops, "give up").when(timed_out | (status >= 500), "retry").when(status.between(200, 299), "ok").otherwise("give up")
