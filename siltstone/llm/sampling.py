"""Bounded, deterministic training samples of labelled rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: So many pairs of label and group go to all tasks by broadcast; a larger table of quotas is joined as Spark sees fit.
FEW_KINDS = 100_000


def labelled_sample(texts: DataFrame, labels: DataFrame, per_label: int, seed: int = 7, by_group: bool = False, most_rows: int = 40_000) -> tuple[list[tuple[str, object, object]], dict[object, int]]:
    """(text, label, group) of up to ``per_label`` rows for each label, and how many rows have each label of the sample.

    ``texts(id, text)``, ``labels(id, label, group)``. Counts cover all labels; how many rows of a label and group are
    wanted is a table that Spark makes and joins, so there may be any number of either. Where there are so many labels
    that the sample would have more than about ``most_rows`` rows, each label has a smaller share. The choice depends on id
    and seed alone, and of several texts or labels of one id the smallest counts, so it is the same however rows are dealt
    out. Ids are chosen from the narrow table first; the texts of the chosen few are then fetched by a broadcast join. Rows
    without an id, label or text don't count. With ``by_group`` each group of a label gets its share of ``per_label``, and
    half of an even share at least, which makes half as many rows more at most; a share under one row is a chance."""
    labels = labels.where(F.col("label").isNotNull() & F.col("id").isNotNull())
    kinds = labels.groupBy("label", "group").agg(F.count("*").alias("n"))
    totals = kinds.groupBy("label").agg(F.sum("n").alias("total"), F.count("*").alias("groups"))
    found = totals.agg(F.count("*").alias("labels"), F.sum("groups").alias("kinds")).first()
    if not found["labels"]:
        return [], {}
    per = min(float(per_label), most_rows / found["labels"])
    share = F.greatest(per * F.col("n") / F.col("total"), per / (2 * F.col("groups"))) if by_group else F.lit(per)
    quotas = kinds.join(totals, "label").select("label", "group", "total", share.alias("quota"), (1.2 * share / F.col("n" if by_group else "total")).alias("share"))
    quotas = quotas.select(F.col("label").alias("of_label"), F.col("group").alias("of_group"), "total", "quota", "share")
    quotas = F.broadcast(quotas) if found["kinds"] <= FEW_KINDS else quotas
    unit = F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit(seed)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    wanted = labels.join(quotas, (F.col("label") == F.col("of_label")) & F.col("group").eqNullSafe(F.col("of_group")))
    near = wanted.withColumn("unit", unit).where(F.col("unit") < F.col("share")).select("id", "label", "group", "unit", "quota", "total").collect()
    taken: dict[object, int] = {}
    chosen = {}
    for r in sorted(near, key=lambda r: (r["unit"], str(r["id"]), str(r["label"]), str(r["group"]))):
        counter = (r["label"], r["group"]) if by_group else r["label"]
        if taken.get(counter, 0) < r["quota"] and r["id"] not in chosen:
            taken[counter] = taken.get(counter, 0) + 1
            chosen[r["id"]] = (r["unit"], r["label"], r["group"])
    few = texts.sparkSession.createDataFrame([(i,) for i in chosen], texts.select("id").schema)
    got = texts.where(F.col("text").isNotNull()).join(F.broadcast(few), "id").groupBy("id").agg(F.min("text").alias("text")).collect()
    rows = sorted(((*chosen[r["id"]], r["text"]) for r in got), key=lambda x: (x[0], x[3]))
    return [(text, label, group) for _, label, group, text in rows], {r["label"]: r["total"] for r in near}
