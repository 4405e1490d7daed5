"""Semantic layer: metric views compiled to DataFrame plans (SEM1-SEM10).

A ``MetricView`` declares one source fact, many-to-one star joins, named
dimension expressions and named measure expressions (SQL expression strings
over the aliases ``source`` and each join name). ``compile_query`` turns
"these dimensions, these measures, this filter" into one grouped DataFrame:

* only the joins referenced by the chosen dimensions, measures and filter are
  added (join pruning; legal because every join is declared at-most-one-match,
  which the checks module proves with a uniqueness check on the dim key);
* the filter is applied on dimension names before aggregation, so Catalyst
  pushes it below the joins and, for source columns, into the parquet scan;
* when a materialized aggregate covers the request, the query is answered from
  its stored states alone: each measure is a formula over parts that merge
  (``measures.py``), so ratios, means and distinct counts roll up, too, and a
  dimension that a stored one determines (the fiscal year of a day) is looked up.

No DDL and no text parser: expressions are handed to Catalyst via ``F.expr``.
"""
from __future__ import annotations

import re
from dataclasses import dataclass, field
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .measures import Measure, Part, measured_by, set_sizes, set_words

# Dimensions with a row per day, or literal rows: broadcast, so a fact is not shuffled to meet them.
BOUNDED = ("dim_date", "dim_channel", "dim_gl_account", "dim_department")

_QUALIFIED = re.compile(r"\b([A-Za-z_][A-Za-z0-9_]*)\.([A-Za-z_][A-Za-z0-9_]*)\b")


@dataclass(frozen=True)
class MetricField:
    """SEM1: a named dimension or measure expression with its metadata. A measure that is to be stored has its parts."""
    name: str
    expr: str
    comment: str = ""
    display_name: str | None = None
    synonyms: tuple[str, ...] = ()
    format: str | None = None
    measure: Measure | None = None

    @property
    def states(self) -> Measure | None:
        """The measure's parts; a plain sum or count needs no declaration."""
        return self.measure or measured_by(self.expr)


@dataclass(frozen=True)
class MetricJoin:
    """SEM1/SEM3: star join ``source.<fk> = <name>.<pk>``, many-to-one."""
    name: str
    table: str
    fk: str
    pk: str
    at_most_one_match: bool = True


@dataclass(frozen=True)
class MaterializedView:
    """SEM4: a stored aggregate of the view at a reduced grain. ``per`` is the source column whose values are its
    partitions: one of them is computed anew as a whole when its source rows change."""
    name: str
    dimensions: tuple[str, ...]
    measures: tuple[str, ...]
    per: str | None = None


@dataclass(frozen=True)
class States:
    """SEM4: what a stored aggregate holds: a row of additive parts per cell, and for each distinct count its sets."""
    cells: DataFrame
    sets: Mapping[str, DataFrame] = field(default_factory=dict)


@dataclass(frozen=True)
class MetricView:
    name: str
    source: str
    comment: str
    dimensions: tuple[MetricField, ...]
    measures: tuple[MetricField, ...]
    joins: tuple[MetricJoin, ...] = ()
    materialized: tuple[MaterializedView, ...] = field(default_factory=tuple)
    #: Dimension -> dimensions of the same joined table that it determines.
    determines: Mapping[str, tuple[str, ...]] = field(default_factory=dict)

    def dim(self, name: str) -> MetricField:
        for d in self.dimensions:
            if d.name == name:
                return d
        raise KeyError(f"{self.name}: unknown dimension {name!r}")

    def measure(self, name: str) -> MetricField:
        for m in self.measures:
            if m.name == name:
                return m
        raise KeyError(f"{self.name}: unknown measure {name!r}")

    def join(self, name: str) -> MetricJoin:
        for j in self.joins:
            if j.name == name:
                return j
        raise KeyError(f"{self.name}: unknown join {name!r}")


def referenced_aliases(expr: str) -> set[str]:
    return {m.group(1) for m in _QUALIFIED.finditer(expr)}


def _filter_dims(view: MetricView, where: str | None) -> list[str]:
    if not where:
        return []
    names = {d.name for d in view.dimensions}
    tokens = set(re.findall(r"\b[A-Za-z_][A-Za-z0-9_]*\b", re.sub(r"'[^']*'", "", where)))
    return sorted(tokens & names)


def joined_frame(view: MetricView, frames: Mapping[str, DataFrame], aliases: set[str]) -> DataFrame:
    """Source fact plus only the referenced star joins (left joins: nothing is dropped)."""
    df = frames[view.source].alias("source")
    for j in view.joins:
        if j.name not in aliases:
            continue
        dim = F.broadcast(frames[j.table]) if j.table in BOUNDED else frames[j.table]
        dim = dim.alias(j.name)
        df = df.join(dim, F.col(f"source.{j.fk}") == F.col(f"{j.name}.{j.pk}"), "left")
    return df


def compile_query(
    view: MetricView,
    frames: Mapping[str, DataFrame],
    dimensions: Sequence[str],
    measures: Sequence[str],
    where: str | None = None,
    where_col: Column | None = None,
    materialized: Mapping[str, States] | None = None,
    where_dims: Sequence[str] = (),
) -> DataFrame:
    """SEM2: ``SELECT dims, MEASURE(m)... FROM view WHERE ... GROUP BY ALL`` as a DataFrame.

    ``where`` is a SQL predicate over dimension names; ``where_col`` a Column over the dimensions that
    ``where_dims`` names (e.g. with a scalar subquery). Either may be combined.
    """
    dims = list(dimensions)
    meas = [view.measure(m) for m in measures]
    fdims = _filter_dims(view, where)
    fdims = sorted({*fdims, *where_dims})
    if materialized:
        routed = route(view, frames, materialized, dims, [m.name for m in meas], fdims, where, where_col)
        if routed is not None:
            return routed
    df = dimensioned(view, frames, list(dict.fromkeys(dims + fdims)), [m.expr for m in meas])
    if where:
        df = df.filter(F.expr(where))
    if where_col is not None:
        df = df.filter(where_col)
    aggs = [F.expr(m.expr).alias(m.name) for m in meas]
    return df.groupBy(*dims).agg(*aggs) if dims else df.agg(*aggs)


def dimensioned(view: MetricView, frames: Mapping[str, DataFrame], dims: Sequence[str], exprs: Sequence[str]) -> DataFrame:
    """The source with the joins that ``dims`` and ``exprs`` need: a struct per side and a column per dimension.

    As each side is a struct, a dimension may have the name of a column of the fact or of a joined table.
    """
    aliases: set[str] = set()
    for e in [*[view.dim(d).expr for d in dims], *exprs]:
        aliases |= referenced_aliases(e)
    df = joined_frame(view, frames, aliases)
    sides = [F.struct(F.col(f"{a}.*")).alias(a) for a in ["source", *[j.name for j in view.joins if j.name in aliases]]]
    return df.select(*sides, *[F.expr(view.dim(d).expr).alias(d) for d in dims])


def parts_of(view: MetricView, measures: Sequence[str]) -> list[Part]:
    """The different parts of the measures, in order."""
    out: dict[Part, None] = {}
    for name in measures:
        states = view.measure(name).states
        if states is None:
            raise ValueError(f"{view.name}.{name} has no mergeable parts: {view.measure(name).expr}")
        out.update(dict.fromkeys(states.parts))
    return list(out)


def members(view: MetricView, frames: Mapping[str, DataFrame], dims: Sequence[str], part: Part, per: str | None = None) -> DataFrame:
    """``(per, dims, member)``: the different members of each group's set."""
    own = [F.expr(f"source.{per}").alias("_per")] if per else []
    df = dimensioned(view, frames, dims, [part.expr]).select(*own, *dims, F.expr(part.expr).alias("member"))
    return df.where("member is not null").distinct()


def additive(view: MetricView, frames: Mapping[str, DataFrame], dims: Sequence[str], parts: Sequence[Part], per: str | None = None) -> DataFrame:
    """``(per, dims, part, ...)``: the additive states of each group."""
    own = [F.expr(f"source.{per}").alias("_per")] if per else []
    df = dimensioned(view, frames, dims, [p.expr for p in parts])
    return df.groupBy(*own, *dims).agg(*[F.expr(p.sql).alias(p.name) for p in parts])


def materialize(view: MetricView, frames: Mapping[str, DataFrame], mv: MaterializedView) -> States:
    """SEM4: the states of a materialized view, as lazy frames; sets are over the members' own numbers."""
    parts = parts_of(view, mv.measures)
    sets = {p.name: set_words(members(view, frames, mv.dimensions, p).withColumn("member", F.col("member").cast("long")), mv.dimensions, "member")
            for p in parts if p.kind == "distinct"}
    return States(additive(view, frames, mv.dimensions, [p for p in parts if p.kind != "distinct"] or [Part("count", "1")]), sets)


def lookup(view: MetricView, frames: Mapping[str, DataFrame], dim: str, names: Sequence[str]) -> DataFrame:
    """``(dim, names)``: for each value of a dimension the values that it determines, from their table alone."""
    alias = referenced_aliases(view.dim(dim).expr).pop()
    table = frames[view.join(alias).table].alias(alias)
    found = table.select(*[F.expr(view.dim(d).expr).alias(d) for d in (dim, *names)]).distinct()
    return F.broadcast(found) if view.join(alias).table in BOUNDED else found


def _covered(view: MetricView, mv: MaterializedView, dims: Sequence[str]) -> dict[str, list[str]] | None:
    """Stored dimension -> those of ``dims`` that have to be looked up from it; None if one is out of reach."""
    found: dict[str, list[str]] = {}
    for d in dims:
        if d in mv.dimensions:
            continue
        by = next((s for s in mv.dimensions if d in view.determines.get(s, ())), None)
        if by is None:
            return None
        found.setdefault(by, []).append(d)
    return found


def route(
    view: MetricView,
    frames: Mapping[str, DataFrame],
    materialized: Mapping[str, States],
    dims: Sequence[str],
    measures: Sequence[str],
    filter_dims: Sequence[str],
    where: str | None,
    where_col: Column | None,
) -> DataFrame | None:
    """SEM4 router: answer from stored states when they provably give the same result.

    Covered when every requested and filtered dimension is stored or determined by a stored one and every measure is
    stored. Its parts are merged: sums and counts add up, sets are united and counted.
    """
    need = list(dict.fromkeys([*dims, *filter_dims]))
    for mv in view.materialized:
        if mv.name not in materialized or not set(measures) <= set(mv.measures):
            continue
        found = _covered(view, mv, need)
        if found is None or any(view.measure(m).states is None for m in measures):
            continue
        states, parts = materialized[mv.name], parts_of(view, measures)

        def at_dims(df: DataFrame) -> DataFrame:
            for stored, names in found.items():
                known = lookup(view, frames, stored, names).withColumnRenamed(stored, "_known")
                df = df.join(known, F.col(stored).eqNullSafe(F.col("_known")), "left").drop("_known")
            if where:
                df = df.filter(F.expr(where))
            return df.filter(where_col) if where_col is not None else df

        sums = [p for p in parts if p.kind != "distinct"]
        answers = []
        if sums:
            aggs = [p.merged(p.name).alias(p.name) for p in sums]
            cells = at_dims(states.cells)
            answers.append(cells.groupBy(*dims).agg(*aggs) if dims else cells.agg(*aggs))
        answers += [set_sizes(at_dims(states.sets[p.name]), dims, p.name) for p in parts if p.kind == "distinct"]
        if not sums and dims:  # groups without members have no words
            answers.append(at_dims(states.cells).select(*dims).distinct())
        if len(answers) > 1:
            every = answers[0]
            for other in answers[1:]:
                every = every.unionByName(other, allowMissingColumns=True)
            aggs = [(F.max(p.name) if p.kind != "distinct" else F.coalesce(F.max(p.name), F.lit(0))).alias(p.name) for p in parts]
            answers = [every.groupBy(*dims).agg(*aggs) if dims else every.agg(*aggs)]
        return answers[0].select(*dims, *[view.measure(m).states.of({p: p.name for p in parts}).alias(m) for m in measures])
    return None


def lint(view: MetricView, frames: Mapping[str, DataFrame]) -> list[str]:
    """SEM10: every expression resolves against the star; materialized names exist."""
    errors: list[str] = []
    aliases = {j.name for j in view.joins} | {"source"}
    full = joined_frame(view, frames, aliases)
    for f in (*view.dimensions, *view.measures):
        unknown = referenced_aliases(f.expr) - aliases
        if unknown:
            errors.append(f"{view.name}.{f.name}: unknown alias {sorted(unknown)}")
            continue
        try:
            full.select(F.expr(f.expr)).schema  # analysis only, no job
        except Exception as exc:  # noqa: BLE001 - report every failure
            errors.append(f"{view.name}.{f.name}: {type(exc).__name__}")
    dnames = {d.name for d in view.dimensions}
    mnames = {m.name for m in view.measures}
    for mv in view.materialized:
        for d in mv.dimensions:
            if d not in dnames:
                errors.append(f"{view.name}/{mv.name}: unknown dimension {d}")
        for m in mv.measures:
            if m not in mnames:
                errors.append(f"{view.name}/{mv.name}: unknown measure {m}")
            elif view.measure(m).states is None:
                errors.append(f"{view.name}/{mv.name}: {m} has no parts that merge")
    for d, others in view.determines.items():
        sides = [referenced_aliases(view.dim(x).expr) for x in (d, *others) if x in dnames]
        if len(sides) <= len(others) or any(x != sides[0] for x in sides):
            errors.append(f"{view.name}: {d} can't be looked up with {others}")
    return errors
