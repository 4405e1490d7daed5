"""The build job (FC18-FC20): every table written once, in order, from the tables written before it, able to go on.

The build is a ``Store``. Each table is committed by itself, with a record of what it was made from (``input``: the
digests of its inputs, the settings, the bounds of the calendar), its rows and a digest of them. A build that starts on a
folder of an earlier one walks the tables in order and skips each whose record still holds: after a stop nothing that was
committed is written again, and after a change of the data only what depends on it. As inputs count by what they hold, a table
that comes out as it was leaves its dependants valid.
"""
from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from dataclasses import asdict, dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.schema import validate_schema
from ..operators.semantic import MetricView, States
from ..session import written
from ..sources import specs
from ..sources.versions import Store, Table, Version
from .aggregates import digest, refresh, states
from .settings import Settings
from .warehouse import DIMENSIONS, FACTS, Warehouse

#: Not tables of their own: sales lines with natural keys and ship dates, which the facts start from.
STAGED = ("sales_calendar", "sales_enriched")
DEALT_ROWS = 50_000  # rows per task of a driver table that a dimension is made of


def dealt(df: DataFrame) -> DataFrame:
    """``df`` dealt to as many tasks as its rows need: a file of few bytes is read by one task, however many columns a row then gets."""
    tasks = -(-df.count() // DEALT_ROWS)
    return df.repartition(tasks) if tasks > 1 else df


class Recording(Warehouse):
    """A warehouse that notes which driver tables, stored tables and bounds a plan was made from."""

    def __init__(self, *args, **kwargs):
        self.seen: set[str] = set()
        super().__init__(*args, **kwargs)

    def __getattribute__(self, name: str):
        own = object.__getattribute__(self, "__dict__")
        if name == "bounds" or name in own.get("stored", ()):
            own["seen"].add(name)
        return super().__getattribute__(name)

    def t(self, name: str) -> DataFrame:
        self.seen.add(f"driver.{name}")
        return super().t(name)

    def whole_rows(self, name: str) -> DataFrame:
        return dealt(super().whole_rows(name))


def files_digest(spark: SparkSession, path: str) -> str:
    """Names, sizes and times of a table's files: what the file system lists, nothing is read."""
    files = spark.read.format("binaryFile").load(path).select(F.element_at(F.split("path", "/"), -1).alias("file"), "length", F.unix_micros("modificationTime").alias("time"))
    return hashlib.sha256(json.dumps(sorted(tuple(r) for r in files.collect())).encode()).hexdigest()


@dataclass(frozen=True)
class Built:
    """A table of a build: its rows, and whether this run found it valid."""

    name: str
    rows: int
    digest: str
    reused: bool


def _input(name: str, seen: set[str], found: dict[str, str], bounds: dict, settings: Settings, family: str, revision: str) -> str:
    own = {k: found[k] for k in seen if k != "bounds"}
    days = {k: str(v) for k, v in bounds.items()} if "bounds" in seen else {}
    return hashlib.sha256(json.dumps([name, own, days, asdict(settings), family, revision], sort_keys=True).encode()).hexdigest()


def _recorded(store: Store, table: Table, made_from: str) -> Table:
    """``table`` with its record: rows and digest come from what was written."""
    df = store.read("new", Version(0, {"new": table}))
    row = df.agg(F.count(F.lit(1)).alias("n"), digest(df.columns).alias("d")).first()
    return replace(table, notes={"input": made_from, "rows": str(row["n"]), "digest": row["d"] or ""})


def _shared(df: DataFrame, staged: Table) -> Table | None:
    """The table of ``df``, a selection of the columns of a staged table as they are, over the files of that one; None if it has others."""
    own = {c.name: c for c in staged.columns}
    if any(f.name not in own or own[f.name].type != f.dataType.simpleString() for f in df.schema.fields):
        return None
    return replace(staged, columns=tuple(replace(own[f.name], comment=(f.metadata or {}).get("comment", "")) for f in df.schema.fields), notes={})


def run_build(spark: SparkSession, sf_dir: str, path: str, settings: Settings, tables: tuple[str, ...] = DIMENSIONS + FACTS, family: str = "md5",
              revision: str = "", after: Callable[[str], None] | None = None) -> tuple[Warehouse, list[Built]]:
    """Make the build at ``path`` hold the calendar, the dimensions, the sales lines and then ``tables``, each of them
    validated against its declared spec; the warehouse over it, and what happened to each table.

    ``revision`` names the code: another one makes every table due. ``after`` is called with each committed table's name.
    """
    store, stored, found, report = Store(spark, path), {}, {}, []
    bounds = Warehouse(spark, sf_dir, settings, family=family).bounds  # read once for the whole build
    head = store.head()
    for name in [t for t in DIMENSIONS if t in tables] + list(STAGED) + [t for t in FACTS if t in tables]:
        wh = Recording(spark, sf_dir, settings, family=family, stored=stored)
        wh.__dict__["bounds"] = bounds
        wh.seen.clear()
        df = getattr(wh, name)
        if name not in STAGED:
            df = specs.BY_NAME[name].project(df)
            validate_schema(df, specs.BY_NAME[name])
        for x in wh.seen - found.keys() - {"bounds"}:
            found[x] = files_digest(spark, f"{sf_dir.rstrip('/')}/{x.removeprefix('driver.')}.parquet")
        made_from = _input(name, wh.seen, found, bounds, settings, family, revision)
        old = head.tables.get(name) if head else None
        reused = old is not None and old.notes.get("input") == made_from
        if not reused:
            shared = _shared(df, head.tables["sales_enriched"]) if name == "fact_sales_line" else None  # the lines without their natural keys
            head = store.commit(head, {name: _recorded(store, shared or store.table(df, old), made_from)})
            if after:
                after(name)
        notes = head.tables[name].notes
        stored[name], found[name] = store.read(name, head), f"{notes['rows']}/{notes['digest']}"
        report.append(Built(name, int(notes["rows"]), notes["digest"], reused))
    done = Warehouse(spark, sf_dir, settings, family=family, stored=stored)
    done.__dict__["bounds"] = bounds
    return done, report


def build(spark: SparkSession, sf_dir: str, path: str, settings: Settings, tables: tuple[str, ...] = DIMENSIONS + FACTS,
          family: str = "md5") -> Warehouse:
    """The warehouse over a build at ``path``, a folder in shared storage; what is there and valid is kept."""
    return run_build(spark, sf_dir, path, settings, tables, family)[0]


def open_build(spark: SparkSession, sf_dir: str, path: str, settings: Settings, tables: tuple[str, ...] = DIMENSIONS + FACTS,
               family: str = "md5") -> Warehouse:
    """The warehouse over a finished build, in a later job."""
    store = Store(spark, path)
    head = store.head()
    return Warehouse(spark, sf_dir, settings, family=family, stored={t: store.read(t, head) for t in (*STAGED, *tables)})


def stored_aggregate(wh: Warehouse, view: MetricView, name: str, path: str) -> States:
    """SEM4: bring the materialized aggregate ``name`` of ``view`` in the store at ``path`` up to date and open it."""
    mv = next(m for m in view.materialized if m.name == name)
    store = Store(wh.spark, path)
    refresh(store, view, mv, wh.frames, written)
    return states(store, view, mv)
