"""Declared table specs, ordered projection, validation, SCD2 columns (PR1-PR4).

Schemas are declared, never inferred. A builder ends with
``spec.project(df)``, which selects and orders the declared columns, casts
them to the declared types and attaches each column comment as field metadata
(so ``DESCRIBE`` and the catalog show it after a write).
"""
from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Framework dtype names -> Spark SQL type strings. Money is exact decimal.
DTYPES = {
    "long": "bigint",
    "int": "int",
    "double": "double",
    "string": "string",
    "boolean": "boolean",
    "timestamp": "timestamp",
    "timestamp_ntz": "timestamp_ntz",
    "date": "date",
    "money": "decimal(18,2)",
    "qty2": "decimal(18,2)",
    "dec1": "decimal(18,1)",
    "dec4": "decimal(18,4)",
}


class SchemaMismatchError(ValueError):
    """A frame does not match its declared spec."""


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    dtype: str
    comment: str = ""
    is_key: bool = False
    nullable: bool = True

    @property
    def sql_type(self) -> str:
        return DTYPES.get(self.dtype, self.dtype)


@dataclass(frozen=True)
class TableSpec:
    schema: str
    name: str
    grain: str
    columns: tuple[ColumnSpec, ...]
    primary_key: tuple[str, ...] = field(default_factory=tuple)

    @property
    def qualified(self) -> str:
        return f"{self.schema}.{self.name}"

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    def struct_type(self) -> T.StructType:
        """PR1: spec -> StructType with comment metadata."""
        return T.StructType([
            T.StructField(c.name, T._parse_datatype_string(c.sql_type), c.nullable, {"comment": c.comment})
            for c in self.columns
        ])

    def ddl(self) -> str:
        return ", ".join(f"{c.name} {c.sql_type}" for c in self.columns)

    def project(self, df: DataFrame, beside: Sequence[str] = ()) -> DataFrame:
        """PR2: select in declared order, cast to declared types, attach comments; then the columns ``beside``, as they are."""
        missing = [c.name for c in self.columns if c.name not in df.columns]
        if missing:
            raise SchemaMismatchError(f"{self.qualified}: missing columns {missing}")
        return df.select(*[
            F.col(c.name).cast(c.sql_type).alias(c.name, metadata={"comment": c.comment})
            for c in self.columns
        ], *beside)

    def validate(self, df: DataFrame) -> DataFrame:
        """PR3: names and types must match (order and nullability are not checked)."""
        validate_schema(df, self)
        return df


def validate_schema(df: DataFrame, spec: TableSpec) -> None:
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    expected = {c.name: T._parse_datatype_string(c.sql_type).simpleString() for c in spec.columns}
    missing = sorted(set(expected) - set(actual))
    extra = sorted(set(actual) - set(expected))
    wrong = sorted(k for k in set(expected) & set(actual) if expected[k] != actual[k])
    if missing or extra or wrong:
        detail = [f"missing={missing}"] if missing else []
        detail += [f"extra={extra}"] if extra else []
        detail += [f"{k}: {actual[k]} != {expected[k]}" for k in wrong]
        raise SchemaMismatchError(f"{spec.qualified}: " + "; ".join(detail))


def C(name: str, dtype: str, comment: str = "", key: bool = False, nullable: bool = True) -> ColumnSpec:
    return ColumnSpec(name, dtype, comment, key, nullable)


SCD2_COLUMNS = (
    C("effective_start_ts", "timestamp_ntz", "Row valid from", nullable=False),
    C("effective_end_ts", "timestamp_ntz", "Row valid to (null = open)"),
    C("is_current", "boolean", "Current version flag", nullable=False),
    C("version", "long", "SCD2 version number", nullable=False),
)


def with_scd2(df: DataFrame, start: Column | None = None) -> DataFrame:
    """PR4: add SCD2 control columns; every row is the current version 1."""
    start = start if start is not None else F.lit("1900-01-01 00:00:00").cast("timestamp_ntz")
    return df.withColumns({
        "effective_start_ts": start,
        "effective_end_ts": F.lit(None).cast("timestamp_ntz"),
        "is_current": F.lit(True),
        "version": F.lit(1).cast("long"),
    })
