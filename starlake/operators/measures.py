"""Measures as formulas over parts that merge (AG12-AG14, SEM4).

A part is an aggregate with a stored state that can be merged: sums and counts add up, a distinct count is a set. A measure is
a formula over one or more parts: a ratio keeps numerator and denominator, a mean its sum and count, so every measure can be
answered from stored states at any coarser grain.

Sets are bitmaps in words of 64 bits, one row (group, word, bits) for each word that has a member: union is a bitwise or,
size a count of bits. Members are 64-bit integers; the denser the numbers in a group, the fewer words (see ``stored.py``).
"""
from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = 64


@dataclass(frozen=True)
class Part:
    """``kind`` (sum, count, min, max or distinct) of a SQL expression over the source's alias."""

    kind: str
    expr: str

    @property
    def sql(self) -> str:
        return f"COUNT(DISTINCT {self.expr})" if self.kind == "distinct" else f"{self.kind.upper()}({self.expr})"

    @property
    def name(self) -> str:
        """The state's column."""
        return f"{self.kind}_{re.sub(r'[^a-z0-9]+', '_', self.expr.lower().replace('source.', '')).strip('_')}"

    def merged(self, column: str) -> Column:
        """The state of a union of groups from their states; no groups count 0."""
        if self.kind == "count":
            return F.coalesce(F.sum(column), F.lit(0))
        return {"sum": F.sum, "min": F.min, "max": F.max}[self.kind](column)


@dataclass(frozen=True)
class Measure:
    parts: tuple[Part, ...]
    formula: str = "{0}"

    @property
    def sql(self) -> str:
        """The measure as one SQL aggregate over the source."""
        return self.formula.format(*[p.sql for p in self.parts])

    def of(self, columns: Mapping[Part, str]) -> Column:
        """The measure from merged states."""
        return F.expr(self.formula.format(*[columns[p] for p in self.parts]))


def _source(column: str) -> str:
    return column if "." in column else f"source.{column}"


def total(column: str) -> Measure:
    return Measure((Part("sum", _source(column)),))


def difference(a: str, b: str) -> Measure:
    return Measure((Part("sum", f"{_source(a)} - {_source(b)}"),))


def rows() -> Measure:
    return Measure((Part("count", "1"),))


def distinct(column: str) -> Measure:
    return Measure((Part("distinct", _source(column)),))


def ratio(num: Measure, den: Measure) -> Measure:
    """num / den in double, null where den is 0."""
    shifted = re.sub(r"\{(\d+)\}", lambda m: f"{{{int(m[1]) + len(num.parts)}}}", den.formula)
    return Measure(num.parts + den.parts, f"CAST({num.formula} AS DOUBLE) / NULLIF(CAST({shifted} AS DOUBLE), 0)")


def mean(column: str) -> Measure:
    """Mean of the values that are not null."""
    c = _source(column)
    return Measure((Part("sum", c), Part("count", c)), "CAST({0} AS DOUBLE) / NULLIF({1}, 0)")


def share(predicate: str) -> Measure:
    """Share of the rows for which ``predicate`` holds; null without rows."""
    return Measure((Part("sum", f"CASE WHEN {predicate} THEN 1 ELSE 0 END"), Part("count", "1")), "CAST({0} AS DOUBLE) / NULLIF({1}, 0)")


def measured_by(expr: str) -> Measure | None:
    """The measure of a plain ``SUM(column)`` or ``COUNT(1)`` given as text; None for any other text."""
    found = re.fullmatch(r"\s*(sum|count)\s*\(\s*(1|source\.\w+)\s*\)\s*", expr, re.IGNORECASE)
    return Measure((Part(found[1].lower(), found[2]),)) if found else None


# ------------------------------------------------------------------ sets
def set_words(members: DataFrame, dims: Sequence[str], member: str) -> DataFrame:
    """``(dims, word, bits)`` of rows (dims, member): a row for each 64 numbers of which a group holds any. Null is no member."""
    word = F.shiftright(F.col(member), 6)  # rounds down for negative numbers, too
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col(member).bitwiseAND(F.lit(WORD - 1)).cast("int"))
    return members.where(F.col(member).isNotNull()).groupBy(*dims, word.alias("word")).agg(F.bit_or(bit).alias("bits"))


def set_sizes(words: DataFrame, dims: Sequence[str], name: str) -> DataFrame:
    """``(dims, name)``: the sizes of the unions of the sets of each group."""
    union = words.groupBy(*dims, "word").agg(F.bit_or("bits").alias("bits"))
    size = F.coalesce(F.sum(F.bit_count("bits")), F.lit(0)).cast("long").alias(name)
    return union.groupBy(*dims).agg(size) if dims else union.agg(size)
