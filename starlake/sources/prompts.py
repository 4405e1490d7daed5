"""FC15, SNK7, CHK18: text fill that pays once, through a content-addressed store of answers.

A prompt is known by the SHA-256 of the model's name and its text. Of a table's prompts only the different ones that the
store lacks are sent; answers are appended and joined back to all rows. A run sends its prompts in waves, each committed
by the write that appends it: what a stop or a lost executor costs is the open wave, or the task, and never an answer
that was stored. Another model, or another version of its name, has answers of its own.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.schema import C, TableSpec, validate_schema
from ..session import written

ANSWERS = "prompt_id binary, prompt string, answer string"
SMALL = 200_000  # answers, of a paragraph each, that a broadcast may hold
Model = Callable[[list[str]], list[str]]


def prompt_id(prompt: Column, model: str) -> Column:
    """Null for a null prompt; lengths keep name and text apart."""
    return F.unhex(F.sha2(F.concat(F.lit(f"{len(model)}:{model}"), prompt).cast("binary"), 256))


def answers(spark: SparkSession, store: str) -> DataFrame:
    """One answer a prompt: where two runs sent the same prompt at a time, the first in order counts for both."""
    return spark.read.schema(ANSWERS).parquet(store).groupBy("prompt_id").agg(F.min("answer").alias("answer"))


def ask(df: DataFrame, prompts: list[str], fn: Model, store: str, *, model: str, wave: int = 100_000, batch: int = 64, tasks: int = 64) -> int:
    """Send the different non-null prompts of the columns ``prompts`` that ``store`` lacks; returns how many were sent.

    ``wave`` prompts, about, are sent before their answers are committed, in calls of up to ``batch``.
    """
    spark = df.sparkSession
    spark.createDataFrame([], ANSWERS).write.mode("append").parquet(store)  # a new store starts empty
    said = reduce(DataFrame.unionAll, [df.select(F.col(p).alias("prompt")) for p in prompts]).where("prompt is not null")
    known = spark.read.schema(ANSWERS).parquet(store).select("prompt_id")
    todo = written(said.distinct().withColumn("prompt_id", prompt_id(F.col("prompt"), model)).join(known, "prompt_id", "left_anti"))
    n = todo.count()
    waves = -(-n // wave)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            for at in range(0, len(part), batch):
                some = part.iloc[at:at + batch]
                got = fn(some["prompt"].tolist())
                if len(got) != len(some):
                    raise ValueError(f"{len(got)} answers for {len(some)} prompts")
                yield some.assign(answer=got)[["prompt_id", "prompt", "answer"]]

    for k in range(waves):
        open_ = todo.where(F.pmod(F.xxhash64("prompt_id"), F.lit(waves)) == k)
        open_.repartition(max(1, min(tasks, -(-n // waves // batch))), "prompt_id").mapInPandas(run, ANSWERS).write.mode("append").parquet(store)
    return n


def fill_stored(df: DataFrame, texts: Mapping[str, str], fn: Model, store: str, *, model: str, wave: int = 100_000, batch: int = 64) -> DataFrame:
    """``df`` with a column ``out`` for every ``out: prompt`` of ``texts``: the stored answer, null for a null prompt."""
    ask(df, list(dict.fromkeys(texts.values())), fn, store, model=model, wave=wave, batch=batch)
    found = answers(df.sparkSession, store)
    few = found.count() <= SMALL
    for out, prompt in texts.items():
        mine = found.select(F.col("prompt_id").alias("_prompt_id"), F.col("answer").alias(out))
        df = df.withColumn("_prompt_id", prompt_id(F.col(prompt), model)).join(F.broadcast(mine) if few else mine, "_prompt_id", "left").drop("_prompt_id")
    return df


def filled_spec(spec: TableSpec, name: str, texts: Mapping[str, str]) -> TableSpec:
    """The spec of a staging table once filled: each prompt column gives way to its text, with a comment."""
    outs = {prompt: out for out, prompt in texts.items()}
    columns = tuple(C(outs[c.name], "string", f"Text for: {c.comment}", nullable=c.nullable) if c.name in outs else c for c in spec.columns)
    return TableSpec(spec.schema, name, spec.grain, columns, spec.primary_key)


def text_violations(staged: DataFrame, filled: DataFrame, key: list[str], texts: Mapping[str, str], longest: int = 2_000) -> DataFrame:
    """CHK18: ``(rule, bad)`` over a filled table: a text for every prompt and none without, no blank or overlong text, none
    that repeats its prompt, and every staged row there once."""
    both = staged.select(*key, *texts.values(), F.lit(1).alias("_staged")).join(filled.select(*key, *texts, F.lit(1).alias("_filled")), key, "full")
    bad = {"rows_match": F.col("_staged").isNull() | F.col("_filled").isNull()}
    for out, prompt in texts.items():
        t, p = F.col(out), F.col(prompt)
        bad |= {f"{out}_iff_prompt": t.isNull() != p.isNull(), f"{out}_not_blank": F.trim(t) == "",
                f"{out}_not_overlong": F.length(t) > longest, f"{out}_not_prompt": t == p}
    one = both.agg(*[F.coalesce(F.sum(F.when(x, 1)), F.lit(0)).cast("long").alias(r) for r, x in bad.items()])
    return one.select(F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.col(r).alias("bad")) for r in bad])).alias("x")).select("x.*")


def write_texts(spark: SparkSession, staged: DataFrame, spec: TableSpec, name: str, texts: Mapping[str, str], fn: Model, store: str, *, model: str,
                prefix: str = "", path: str | None = None) -> str:
    """SNK7: the filled table, checked before it is written, with comments on table and columns."""
    from .sinks import write_table
    target = filled_spec(spec, name, texts)
    full = written(fill_stored(staged, texts, fn, store, model=model))
    broken = {r.rule: r.bad for r in text_violations(staged, full, list(spec.primary_key), texts).where("bad > 0").collect()}  # a row a rule
    if broken:
        raise ValueError(f"{name}: {broken}")
    validate_schema(target.project(full), target)
    return write_table(spark, full, target, prefix=prefix, path=path)
