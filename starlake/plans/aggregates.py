"""SEM4: stored aggregates and their refresh.

``refresh`` brings the stored aggregate of a metric view up to date. A manifest in the store's commit has, for every value of
the aggregate's source column ``per`` (a day), the number of source rows and a digest of them, and a digest of each joined
dimension. Only days whose rows changed are aggregated again; they go to new files, the commit swaps them in, and all other
days stay in the files they are in. A changed dimension makes every day due. What fails on the way leaves the last version.

The members of a distinct count are numbered densely in the order of the day they first appear on, so a day's set is a few
words of bits. Numbers are never given again: members that come later get the next ones, and sets of other days stay valid.
"""
from __future__ import annotations

import json
import re
from collections.abc import Mapping
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.fingerprints import wide_sum
from ..operators.measures import Part, set_words
from ..operators.ranking import positions
from ..operators.semantic import MaterializedView, MetricView, States, additive, members, parts_of, referenced_aliases
from ..sources.versions import Files, Store, Table, Version, swapped


@dataclass(frozen=True)
class Refresh:
    """What a refresh did: the version it made (or found up to date), and the days it computed."""

    version: int
    days: tuple[str, ...]


def _numbers(part: Part) -> str:
    return f"numbers_{part.name}"


def _used(view: MetricView, mv: MaterializedView) -> dict[str, list[str]]:
    """Alias (the source's or a join's) -> columns that the aggregate reads."""
    exprs = [view.dim(d).expr for d in mv.dimensions] + [p.expr for p in parts_of(view, mv.measures)]
    joins = [j for j in view.joins if any(j.name in referenced_aliases(e) for e in exprs)]
    out = {"source": {mv.per, *[j.fk for j in joins]}, **{j.name: {j.pk} for j in joins}}
    for e in exprs:
        for alias in referenced_aliases(e):
            out[alias] |= set(_columns(e, alias))
    return {alias: sorted(c) for alias, c in out.items()}


def _columns(expr: str, alias: str) -> list[str]:
    return re.findall(rf"\b{alias}\.(\w+)", expr)


def digest(columns: list[str]) -> Column:
    """An order-free digest of a group's rows: two sums of 64-bit row hashes."""
    return F.concat_ws(":", *[wide_sum(F.xxhash64(F.lit(seed), *[F.col(c) for c in columns])).cast("string") for seed in (1, 2)])


def _manifest(view: MetricView, mv: MaterializedView, frames: Mapping[str, DataFrame]) -> tuple[dict[str, str], dict[str, str]]:
    """({day: rows and digest}, {dimension: digest}): a row per day and per dimension comes to the driver."""
    used = _used(view, mv)
    day = F.coalesce(F.col(mv.per).cast("string"), F.lit(""))
    rows = frames[view.source].groupBy(day.alias("day")).agg(F.concat_ws("/", F.count(F.lit(1)).cast("string"), digest(used["source"])).alias("state")).collect()
    dims = {j.name: frames[j.table].agg(F.concat_ws("/", F.count(F.lit(1)).cast("string"), digest(used[j.name]))).first()[0] for j in view.joins if j.name in used}
    return {r["day"]: r["state"] for r in rows}, dims


def _numbered(store: Store, part: Part, found: DataFrame, base: Version | None, write) -> tuple[DataFrame, Table]:
    """(numbers of all members: member, number; their table with those of ``found`` that are new)."""
    first = found.groupBy("member").agg(F.min("_per").alias("first"))
    before = base.tables.get(_numbers(part)) if base else None
    start = 0
    if before:
        known = store.read(_numbers(part), base)
        first = first.join(known.select("member"), "member", "left_anti")
        start = (known.agg(F.max("number")).first()[0] if before.files else None)
        start = 0 if start is None else start + 1
    new = positions(first, ["first", "member"], write, "number").select("member", (F.col("number") + F.lit(start)).alias("number"))
    table = store.table(new, before)
    table = replace(table, files=(*(before.files if before else ()), *table.files))
    return store.read(_numbers(part), Version(0, {_numbers(part): table})), table


def refresh(store: Store, view: MetricView, mv: MaterializedView, frames: Mapping[str, DataFrame], write) -> Refresh:
    """Make the stored aggregate equal to one computed anew from ``frames``; ``write`` writes a frame and reads it back."""
    base = store.head()
    days, dims = _manifest(view, mv, frames)
    notes = base.tables["cells"].notes if base else {}
    old = json.loads(notes["days"]) if base else {}
    whole = not base or json.loads(notes["dims"]) != dims
    due = sorted(d for d in {*days, *old} if whole or days.get(d) != old.get(d))
    if base and not due:
        return Refresh(base.number, ())
    per = F.coalesce(F.col(mv.per).cast("string"), F.lit(""))
    source = frames[view.source] if whole else frames[view.source].where(_in_days(frames[view.source], mv.per, due))
    own = {**{name: frames[name] for name in {j.table for j in view.joins}}, view.source: source}
    parts = parts_of(view, mv.measures)

    def by_day(df: DataFrame) -> DataFrame:
        return df.withColumn("_per", F.coalesce(F.col("_per").cast("string"), F.lit("")))

    def stored(name: str, df: DataFrame) -> Table:
        before = base.tables.get(name) if base else None
        new = store.table(df.repartitionByRange("_per").sortWithinPartitions("_per"), before, key="_per")
        if before and not whole:
            return swapped(before, new, sorted(old), due)
        return replace(new, files=tuple(Files(f.folder) for f in new.files))

    tables = {"cells": stored("cells", by_day(additive(view, own, mv.dimensions, [p for p in parts if p.kind != "distinct"] or [Part("count", "1")], mv.per)))}
    for part in (p for p in parts if p.kind == "distinct"):
        found = write(by_day(members(view, own, mv.dimensions, part, mv.per)))
        numbers, tables[_numbers(part)] = _numbered(store, part, found, base, write)
        tables[part.name] = stored(part.name, set_words(found.join(numbers, "member"), ["_per", *mv.dimensions], "number"))
    tables["cells"] = replace(tables["cells"], notes={"days": json.dumps(days, sort_keys=True), "dims": json.dumps(dims, sort_keys=True)})
    return Refresh(store.commit(base, tables).number, tuple(due))


def _in_days(df: DataFrame, per: str, due: list[str]) -> Column:
    """The rows of the days ``due``, as a filter on the column itself, which the scan can use."""
    kind = df.schema[per].dataType
    some = F.col(per).isin([F.lit(d).cast(kind) for d in due if d])
    return (some | F.col(per).isNull()) if "" in due else some


def states(store: Store, view: MetricView, mv: MaterializedView, version: Version | None = None) -> States:
    """The stored aggregate as of a version (the last one, if none is given), for ``compile_query``."""
    version = version or store.head()
    sets = {p.name: store.read(p.name, version).drop("_per") for p in parts_of(view, mv.measures) if p.kind == "distinct"}
    return States(store.read("cells", version).drop("_per"), sets)
