"""Stored aggregates: every measure from states alone, and a refresh that computes changed days only."""
import pytest
from pyspark.sql import functions as F

from starlake.operators.measures import set_sizes, set_words
from starlake.operators.semantic import compile_query, lookup
from starlake.plans.aggregates import refresh, states
from starlake.plans.views import METRIC_VIEWS, MV_SALES
from starlake.plans.warehouse import Frames
from starlake.session import written
from starlake.sources.versions import Store


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def alike(a, b):
    a, b = rows(a), rows(b)
    assert len(a) == len(b)
    for x, y in zip(a, b):
        assert x == y or all(u == v or u == pytest.approx(v, rel=1e-12) for u, v in zip(x, y))


def test_all_measures_are_stored():
    assert sum(len(v.measures) for v in METRIC_VIEWS) == 37
    assert all(v.materialized[0].measures == tuple(m.name for m in v.measures) for v in METRIC_VIEWS)


@pytest.mark.parametrize("view", METRIC_VIEWS, ids=lambda v: v.name)
def test_states_answer_every_measure_at_any_grain(spark, built, tmp_path, view):
    mv, store, measures = view.materialized[0], Store(spark, str(tmp_path)), [m.name for m in view.measures]
    done = refresh(store, view, mv, built.frames, written)
    assert done.version == 1 and len(done.days) > 1
    mats = {mv.name: states(store, view, mv)}
    others = [d for d in mv.dimensions if d != "date"]
    grains = [[], ["fiscal_quarter", others[0]], list(mv.dimensions)] + [[x for d in others for x in view.determines.get(d, ())]]
    for dims in grains:
        routed = compile_query(view, built.frames, dims, measures, materialized=mats)
        plan = routed._jdf.queryExecution().executedPlan().toString()
        assert view.source not in plan and "sales_enriched" not in plan, dims
        alike(routed, compile_query(view, built.frames, dims, measures))
    some = {"where": "fiscal_period = 3 and region <> 'ASIA'"}
    alike(compile_query(view, built.frames, [others[-1]], measures, materialized=mats, **some), compile_query(view, built.frames, [others[-1]], measures, **some))
    none = {"where": "fiscal_year = 1"}
    alike(compile_query(view, built.frames, [], measures, materialized=mats, **none), compile_query(view, built.frames, [], measures, **none))


@pytest.mark.parametrize("view", METRIC_VIEWS, ids=lambda v: v.name)
def test_declared_dependencies_hold(built, view):
    for dim, names in view.determines.items():
        known = lookup(view, built.frames, dim, names)
        assert known.count() == known.select(dim).distinct().count()


def test_two_changed_days_are_computed_and_no_others(spark, built, tmp_path):
    mv, store, sales = MV_SALES.materialized[0], Store(spark, str(tmp_path)), built.sales_metrics
    days = [r.date_sk for r in sales.select("date_sk").distinct().orderBy("date_sk").collect()]
    some = [days[3], days[-2]]
    first = refresh(store, MV_SALES, mv, Frames(built, {"fact_sales_line": sales}), written)
    assert len(first.days) == len(days)
    assert refresh(store, MV_SALES, mv, Frames(built, {"fact_sales_line": sales.repartition(7)}), written) == type(first)(1, ())
    added = sales.where(F.col("date_sk").isin(some)).withColumn("transaction_id", F.col("transaction_id") + 10**9)
    later = Frames(built, {"fact_sales_line": sales.unionByName(added)})
    second = refresh(store, MV_SALES, mv, later, written)
    assert second.days == tuple(str(d) for d in some) and second.version == 2
    new = store.head().tables
    for name in ("cells", "distinct_transaction_id"):
        old = store.version(1).tables[name]
        assert [f.folder for f in new[name].files][:-1] == [f.folder for f in old.files]  # no file was rewritten
        assert new[name].files[-1].kept == second.days
    whole = Store(spark, str(tmp_path / "whole"))
    refresh(whole, MV_SALES, mv, later, written)
    measures = [m.name for m in MV_SALES.measures]
    for dims in ([], ["date", "region"], ["fiscal_year", "division"]):
        a, b, direct = (compile_query(MV_SALES, later, dims, measures, materialized=m) for m in (
            {mv.name: states(store, MV_SALES, mv)}, {mv.name: states(whole, MV_SALES, mv)}, None))
        alike(a, b)
        alike(a, direct)
    gone = Frames(built, {"fact_sales_line": sales.where(F.col("date_sk") != days[0])})
    third = refresh(store, MV_SALES, mv, gone, written)
    assert third.days == tuple(sorted(str(d) for d in (days[0], *some)))
    alike(compile_query(MV_SALES, gone, ["date"], measures, materialized={mv.name: states(store, MV_SALES, mv)}), compile_query(MV_SALES, gone, ["date"], measures))
    moved = Frames(built, {"fact_sales_line": sales, "dim_store": built.dim_store.withColumn("region_name", F.lit("ASIA"))})
    assert len(refresh(store, MV_SALES, mv, moved, written).days) == len(days)  # a changed dimension makes every day due


def test_sets_of_any_numbers(spark):
    numbers = [0, 1, 63, 64, -1, -64, -65, 2**62, -(2**63), 2**63 - 1]
    members = [(g, n) for g, size in (("a", 10), ("b", 4), ("c", 0)) for n in numbers[:size]] + [("c", None), ("a", 0), (None, 5)]
    words = set_words(spark.createDataFrame(members, "g string, m long"), ["g"], "m")
    assert rows(set_sizes(words, ["g"], "n")) == sorted([("a", 10), ("b", 4), (None, 1)], key=str)
    assert rows(set_sizes(words, [], "n")) == [(11,)]
    assert words.where("g = 'a'").count() == len({n >> 6 for n in numbers})


def test_dense_numbers_need_few_words(spark, built, tmp_path):
    mv, store = MV_SALES.materialized[0], Store(spark, str(tmp_path))
    refresh(store, MV_SALES, mv, built.frames, written)
    numbers = store.read("numbers_distinct_transaction_id")
    n = numbers.count()
    assert rows(numbers.select("number")) == sorted([(i,) for i in range(n)], key=str)
    per_day = store.read("distinct_transaction_id").select("_per", "word").distinct().count()
    days = store.read("cells").select("_per").distinct().count()
    assert per_day <= days + n // 64 + 1  # a day's numbers follow each other
