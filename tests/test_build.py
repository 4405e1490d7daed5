"""The build: it goes on after a stop, and computes what changed only."""
import os
import shutil
import time

import pytest

from starlake.plans.build import _shared, run_build
from starlake.plans.settings import REGISTERED
from starlake.plans.warehouse import Warehouse
from starlake.sources import specs
from starlake.sources.versions import Store, Version

SF = "/root/testdata/sf0.001"
SOME = ("dim_product", "dim_store", "dim_employee", "fact_sales_line", "fact_inventory_movement")


class Stop(Exception):
    pass


def stop_at(name):
    def after(done):
        if done == name:
            raise Stop
    return after


def digests(report):
    return {b.name: (b.rows, b.digest) for b in report}


@pytest.fixture(scope="module")
def whole(spark, tmp_path_factory):
    return run_build(spark, SF, str(tmp_path_factory.mktemp("build") / "whole"), REGISTERED, SOME)


@pytest.mark.parametrize("at", ["dim_store", "sales_enriched"])
def test_a_stopped_build_goes_on(spark, whole, tmp_path, at):
    path = str(tmp_path / "b")
    with pytest.raises(Stop):
        run_build(spark, SF, path, REGISTERED, SOME, after=stop_at(at))
    there = {name: t.files for name, t in Store(spark, path).head().tables.items()}
    wh, report = run_build(spark, SF, path, REGISTERED, SOME)
    assert {b.name for b in report if b.reused} == set(there)
    assert all(Store(spark, path).head().tables[name].files == files for name, files in there.items())  # none was written again
    assert digests(report) == digests(whole[1])
    assert sorted(wh.fact_inventory_movement.collect()) == sorted(whole[0].fact_inventory_movement.collect())


def test_a_finished_build_does_nothing(spark, tmp_path):
    path = str(tmp_path / "b")
    run_build(spark, SF, path, REGISTERED, ("dim_product", "fact_sales_line"))
    versions = Store(spark, path).versions()
    _, report = run_build(spark, SF, path, REGISTERED, ("dim_product", "fact_sales_line"))
    assert all(b.reused for b in report) and Store(spark, path).versions() == versions
    _, report = run_build(spark, SF, path, REGISTERED, ("dim_product", "fact_sales_line"), revision="other code")
    assert not any(b.reused for b in report)


def test_changed_input_makes_its_dependants_due(spark, tmp_path):
    source, path = str(tmp_path / "in"), str(tmp_path / "b")
    os.mkdir(source)
    for name in os.listdir(SF):
        shutil.copyfile(f"{SF}/{name}", f"{source}/{name}")
    run_build(spark, source, path, REGISTERED, SOME)
    later = time.time() + 10
    os.utime(f"{source}/supplier.parquet", (later, later))  # rewritten with equal rows
    _, report = run_build(spark, source, path, REGISTERED, SOME)
    assert [b.name for b in report if not b.reused] == ["dim_store"]  # it came out as it was, so employees stay
    part = spark.read.parquet(f"{SF}/part.parquet")
    shutil.move(f"{source}/part.parquet", f"{source}/old.parquet")
    part.withColumn("p_retailprice", part.p_retailprice + 1).coalesce(1).write.parquet(f"{source}/part.parquet")
    _, report = run_build(spark, source, path, REGISTERED, SOME)
    assert {b.name for b in report if not b.reused} == {"dim_product", "sales_enriched", "fact_sales_line", "fact_inventory_movement"}


def test_a_build_deals_the_rows_of_one_file_to_tasks(spark, tmp_path, monkeypatch):
    from starlake.plans import build
    monkeypatch.setattr(build, "DEALT_ROWS", 50)
    parts = spark.range(300).selectExpr("nullif(id % 290, 7) AS p_partkey", "'x y' AS p_name", "'Brand#11' AS p_brand", "'PROMO' AS p_type",
                                        "CAST(1 AS BIGINT) AS p_size", "CAST(9.5 AS DOUBLE) AS p_retailprice")
    parts.coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    plain, recording = (kind(spark, str(tmp_path), REGISTERED).dim_product for kind in (build.Warehouse, build.Recording))
    assert plain.rdd.getNumPartitions() == 1
    assert recording.rdd.getNumPartitions() == 6
    key = lambda r: str(tuple(r))
    assert sorted(recording.collect(), key=key) == sorted(plain.collect(), key=key)


def test_sales_lines_are_stored_once(spark, whole):
    """The staged lines and the fact are columns of the same files; other tables have their own."""
    store = Store(spark, os.path.dirname(os.path.dirname(os.path.dirname(whole[0].fact_sales_line.inputFiles()[0].removeprefix("file://")))))
    head = store.head()
    assert head.tables["fact_sales_line"].files == head.tables["sales_enriched"].files != head.tables["fact_inventory_movement"].files
    spec = specs.FACT_SALES_LINE
    fact = store.read("fact_sales_line", head)
    assert fact.columns == spec.names and [f.metadata.get("comment") for f in fact.schema.fields] == [c.comment for c in spec.columns]
    own = Warehouse(spark, SF, REGISTERED).fact_sales_line
    assert fact.dtypes == own.dtypes and fact.count() and not fact.exceptAll(own).count() and not own.exceptAll(fact).count()


def test_a_selection_shares_files_only_as_it_is(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    staged = store.table(spark.createDataFrame([(1, 2, "x")], "a long, b int, c string"))
    df = store.read("t", Version(0, {"t": staged}))
    shared = _shared(df.select("c", "a"), staged)
    assert store.read("t", Version(0, {"t": shared})).collect() == [("x", 1)]
    assert _shared(df.withColumn("b", df.b.cast("long")), staged) is None and _shared(df.withColumn("d", df.a), staged) is None
