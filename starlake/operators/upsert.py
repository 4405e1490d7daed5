"""DS16, PR17: keyed upserts with versions.

A submission names the revision of its cell that it starts from. Of the valid submissions for a key the last one by revision,
time and id wins; the same submission sent twice is one; one that starts from an older revision than the stored one is stale
and refused. The winner is a maximum, so a key with a third of all submissions is reduced before it is shuffled.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STATES = ("accepted", "superseded", "duplicate", "stale", "invalid")


def upsert(stored: DataFrame, submitted: DataFrame, keys: Sequence[str], values: Sequence[str], valid: Column) -> tuple[DataFrame, DataFrame]:
    """(new state, outcome of each submission).

    ``stored`` has ``keys``, ``values``, ``revision`` (long, 1 or more), ``submission_id`` and ``submitted_at``; ``submitted`` has the same,
    where ``revision`` is the stored revision that the planner saw (0: none). The new state has a row per key. The outcomes are
    ``(submission_id, keys, outcome)``, one for each row of ``submitted``; rows with a null key or id are invalid.
    """
    has_keys = F.lit(True)
    for c in (*keys, "submission_id"):
        has_keys = has_keys & F.col(c).isNotNull()
    current = stored.select(*keys, F.col("revision").alias("_now"), F.col("submission_id").alias("_now_id"))
    marked = submitted.withColumn("_ok", F.coalesce(valid & has_keys, F.lit(False))).join(current, list(keys), "left")
    own = F.when(~F.col("_ok"), "invalid").when(F.col("submission_id") == F.col("_now_id"), "duplicate").when(F.coalesce("revision", F.lit(0)) < F.coalesce("_now", F.lit(0)), "stale")
    order = F.struct(F.coalesce("revision", F.lit(0)).alias("revision"), "submitted_at", "submission_id", *values)
    fresh = marked.withColumn("_own", own)
    won = fresh.where("_own is null").groupBy(*keys).agg(F.max(order).alias("_won"), F.max("_now").alias("_now"))
    new = won.select(*keys, *[F.col(f"_won.{v}").alias(v) for v in values], (F.coalesce("_now", F.lit(0)) + 1).cast("long").alias("revision"),
                     F.col("_won.submission_id").alias("submission_id"), F.col("_won.submitted_at").alias("submitted_at"))
    columns = [*keys, *values, "revision", "submission_id", "submitted_at"]
    state = stored.select(*columns).join(new.select(*keys), list(keys), "left_anti").select(*columns).unionByName(new)
    # equal rows of one submission: the first counts, the others are duplicates
    ids = fresh.groupBy("submission_id", *keys, "_own").agg(F.count(F.lit(1)).alias("_n"))
    winners = won.select(*keys, F.col("_won.submission_id").alias("_id"))
    named = ids.join(winners, list(keys), "left")
    first = F.coalesce("_own", F.when(F.col("submission_id") == F.col("_id"), F.lit("accepted")).otherwise(F.lit("superseded")))
    again = F.when(F.col("_own").isNull(), F.lit("duplicate")).otherwise(F.col("_own"))
    each = named.select("submission_id", *keys, F.explode(F.transform(F.sequence(F.lit(1), F.col("_n")), lambda i: F.when(i == 1, first).otherwise(again))).alias("outcome"))
    return state, each
