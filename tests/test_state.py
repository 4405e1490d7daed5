"""Upserts by key against a plain loop, and sketched quantiles against exact ones."""
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from starlake.operators.quantiles import exact_quantile, quantile, rank_error, rank_range, sketches
from starlake.operators.upsert import upsert
from starlake.session import written

SCHEMA = "cell int, planner string, qty int, revision long, submission_id string, submitted_at int"


def slow(state, batch):
    """({key: (qty, revision, id, at)}, Counter of (id, outcome))."""
    out, fresh = Counter(), {}
    for cell, planner, qty, seen, i, at in batch:
        key, now = (cell, planner), state.get((cell, planner))
        if cell is None or planner is None or i is None or qty is None or qty < 0:
            out[i, "invalid"] += 1
        elif now and now[2] == i:
            out[i, "duplicate"] += 1
        elif now and (seen or 0) < now[1]:
            out[i, "stale"] += 1
        else:
            fresh.setdefault(key, Counter())[(seen or 0, at, i, qty)] += 1
    new = dict(state)
    for key, sent in fresh.items():
        won = max(sent)
        new[key] = (won[3], (state[key][1] if key in state else 0) + 1, won[2], won[1])
        for s, n in sent.items():
            out[s[2], "accepted" if s == won else "superseded"] += 1
            out[s[2], "duplicate"] += n - 1
    return new, +out


def test_upserts_equal_a_loop(spark):
    rnd = random.Random(4)
    state, stored = {}, spark.createDataFrame([], SCHEMA)
    for turn in range(3):
        batch = [(rnd.choice([1, 2, 3, 3, 3, None]), rnd.choice(["a", "b", None, "c", "d"]), rnd.choice([5, 9, -1, None, 7]), rnd.choice([0, turn, turn, None]), f"s{turn}-{k}", rnd.randint(0, 9))
                 for k in range(80)]
        batch += batch[:30]
        batch += [(c, p, q, r, i, at) for (c, p), (q, r, i, at) in state.items()][:4]  # an accepted one is sent again
        new, outcomes = upsert(stored, spark.createDataFrame(batch, SCHEMA), ["cell", "planner"], ["qty"], F.col("qty") >= 0)
        state, want = slow(state, batch)
        stored = written(new)
        assert {(r.cell, r.planner): (r.qty, r.revision, r.submission_id, r.submitted_at) for r in stored.collect()} == state
        assert Counter((r.submission_id, r.outcome) for r in outcomes.collect()) == want and sum(want.values()) == len(batch)


def test_nothing_submitted_changes_nothing(spark):
    stored = spark.createDataFrame([(1, "a", 5, 1, "x", 0)], SCHEMA)
    new, outcomes = upsert(stored, stored.limit(0), ["cell", "planner"], ["qty"], F.lit(True))
    assert [tuple(r) for r in new.collect()] == [(1, "a", 5, 1, "x", 0)] and outcomes.count() == 0


@pytest.mark.parametrize("dims", [["g"], ["g", "h"]])
def test_merged_sketches_stay_within_their_bound(spark, dims):
    rows = spark.range(30000).select((F.col("id") % 3).alias("g"), (F.col("id") % 20).alias("h"), (F.col("id") * F.col("id") % 7919).alias("v"))
    found = quantile(written(sketches(rows, ["g", "h"], "v", 200)), dims, 0.5, "estimate")
    for r in rank_range(rows, dims, "v", found, "estimate").collect():
        assert r.below <= 0.5 + 3 * rank_error(200) and r.upto >= 0.5 - 3 * rank_error(200)
        assert r.n == (10000 if dims == ["g"] else 500)


def test_exact_quantiles_and_nulls(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("a", 9), ("b", 4), ("b", None), ("c", None)], "g string, v int")
    assert sorted((r.g, r.m) for r in exact_quantile(rows, ["g"], "v", F.lit(0.5), "m").collect()) == [("a", 2), ("b", 4)]
    assert sorted((r.g, r.n, r.m) for r in quantile(sketches(rows, ["g"], "v"), ["g"], 0.5, "m").collect()) == [("a", 3, 2.0), ("b", 1, 4.0)]
