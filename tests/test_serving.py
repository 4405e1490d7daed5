"""Filled texts that pay once; snapshots for point reads."""
import pytest
from pyspark.sql import functions as F

from starlake.sources import prompts as P
from starlake.sources import serving, specs

TEXTS = {"body": "prompt", "title": "title_prompt"}


def counted(folder):
    """A model that leaves a line for every prompt it gets."""
    import uuid
    from pathlib import Path

    def fn(prompts):
        (Path(folder) / uuid.uuid4().hex).write_text("".join(f"{p}\n" for p in prompts))
        return [p[::-1] for p in prompts]
    return fn, lambda: sorted(x for f in Path(folder).iterdir() for x in f.read_text().splitlines())


@pytest.fixture
def staged(spark):
    rows = [(k, None if k == 3 else f"say {k % 4}", "say 1" if k % 2 else None) for k in range(12)]
    return spark.createDataFrame(rows, "id long, prompt string, title_prompt string")


def test_each_prompt_is_sent_once(spark, staged, tmp_path):
    calls = tmp_path / "calls"
    calls.mkdir()
    fn, said = counted(str(calls))
    store = str(tmp_path / "store")
    got = {r.id: r for r in P.fill_stored(staged, TEXTS, fn, store, model="m", wave=2, batch=1).collect()}
    assert said() == ["say 0", "say 1", "say 2", "say 3"]
    assert all(r.body == (r.prompt and r.prompt[::-1]) and r.title == (r.title_prompt and "1 yas") for r in got.values()) and len(got) == 12
    more = staged.union(spark.createDataFrame([(50, "say new", None)], staged.schema))
    assert P.ask(staged, ["prompt"], fn, store, model="m") == 0
    assert P.ask(more, ["prompt"], fn, store, model="m") == 1 and said()[-1] == "say new"
    assert P.ask(staged, ["prompt"], fn, store, model="m2") == 4  # another model, other answers
    assert P.ask(staged.limit(0), ["prompt"], fn, store, model="m") == 0


def test_a_stop_keeps_committed_waves(staged, tmp_path):
    store = str(tmp_path / "store")

    def fails(prompts):
        if "say 2" in prompts:
            raise RuntimeError("down")
        return list(prompts)
    with pytest.raises(Exception, match="down"):
        P.ask(staged, ["prompt"], fails, store, model="m", wave=1, batch=1)
    left = 4 - P.answers(staged.sparkSession, store).count()
    assert 1 <= left <= 4 and P.ask(staged, ["prompt"], lambda x: x, store, model="m") == left
    with pytest.raises(Exception, match="0 answers for"):
        P.ask(staged, ["prompt"], lambda x: [], store, model="other")


def test_check_and_comments_of_filled_table(spark, wh, tmp_path):
    texts = {"review_text": "prompt", "review_title": "title_prompt"}
    staged = wh.product_review_staging
    good = staged.withColumns({"review_text": F.upper("prompt"), "review_title": F.upper("title_prompt")})
    bad = lambda df: {r.rule for r in P.text_violations(staged, df, ["review_id"], texts).where("bad > 0").collect()}
    assert bad(good) == set()
    assert bad(good.withColumn("review_text", F.lit(" "))) == {"review_text_not_blank"}
    assert bad(good.withColumn("review_title", F.lit(None).cast("string"))) == {"review_title_iff_prompt"}
    assert bad(good.withColumn("review_title", F.col("title_prompt"))) == {"review_title_not_prompt"}
    assert "rows_match" in bad(good.limit(1))
    name = P.write_texts(spark, staged, specs.PRODUCT_REVIEW_STAGING, "product_review", texts, lambda x: [p.upper() for p in x], str(tmp_path / "s"),
                         model="m", prefix="filled_", path=str(tmp_path / "t"))
    comments = {r.col_name: r.comment for r in spark.sql(f"DESCRIBE TABLE {name}").collect()}
    assert comments["review_text"] == "Text for: Body prompt" and "prompt" not in comments
    with pytest.raises(ValueError, match="not_prompt"):
        P.write_texts(spark, staged, specs.PRODUCT_REVIEW_STAGING, "product_review", texts, lambda x: x, str(tmp_path / "s2"), model="m", prefix="filled2_")


def test_point_reads_open_few_files(spark, tmp_path):
    path = str(tmp_path / "serve")
    df = spark.range(20000).select(F.when(F.col("id") > 10, F.col("id") % 500).alias("p"), (F.col("id") % 7).alias("s"), "id")
    assert serving.current(spark, path) is None
    assert serving.publish(df, path, ["p", "s"], files=16) == 1 and serving.overlaps(spark, path) == 0
    for values in ([37], [37, 3], [None], [499]):
        want = df.where(F.col("p").eqNullSafe(values[0])) if len(values) == 1 else df.where("p = 37 and s = 3")
        got = serving.point_read(spark, path, ["p", "s"], values)
        assert sorted(r.id for r in got.collect()) == sorted(r.id for r in want.collect()) and 1 <= len(got.inputFiles()) <= 2
    assert serving.point_read(spark, path, ["p", "s"], [9999]).collect() == []
    assert serving.publish(df.limit(0), path, ["p", "s"]) == 2  # the new snapshot, the old one still there
    assert serving.point_read(spark, path, ["p", "s"], [37]).collect() == []
    assert serving.point_read(spark, path, ["p", "s"], [37], number=1).count() == 40


def test_an_unfinished_snapshot_is_not_seen(spark, tmp_path):
    path = str(tmp_path / "serve")
    serving.publish(spark.range(100).withColumnRenamed("id", "k"), path, ["k"])
    (tmp_path / "serve" / "published" / "number=2" / "_temporary").mkdir(parents=True)
    assert serving.current(spark, path) == 1 and serving.point_read(spark, path, ["k"], [5]).count() == 1
