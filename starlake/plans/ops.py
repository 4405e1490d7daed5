"""Operational tables and the override flow (FC16, FC17, PR17, DS16)."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions.keyed import dec, id128, round2, weighted_pick
from ..sources import specs
from .facts import Draws

# Fixed values that must equal the reference's for right results.
PLANNERS = ("planner_amir", "planner_bianca", "planner_chen", "planner_dana")
OVERRIDE_REASONS = ("Local promotion", "Competitor closeout", "Weather event", "Known stockout recovery")
REPLEN_STATUSES = (("Suggested", 60), ("Approved", 20), ("Ordered", 10), ("Rejected", 10))


def build_replenishment_order(latest: DataFrame, dim_date: DataFrame, *, family: str = "md5") -> DataFrame:
    """FC16 (PR10, PR11, SC11): an order for every cell of the latest snapshot at or below its reorder point.

    ``latest`` is the snapshot's latest period-end. An order fills up to the reorder point plus the safety
    stock. All but a keyed 60 % have been decided by a planner, two days later and up to two units off.
    """
    draw = Draws(["product_sk", "store_sk"], family)
    stages, weights = zip(*REPLEN_STATUSES)
    low = (latest.where("available_qty <= reorder_point").join(cal.days(dim_date, "date"), "date_sk")
           .withColumns({"status": weighted_pick(draw.share("order_stage"), stages, weights), "created_at": F.col("date").cast("timestamp_ntz"),
                         "suggested_qty": F.expr("greatest(reorder_point + safety_stock_qty - available_qty, 0)").cast("int")}))

    def decided(value: Column) -> Column:
        return F.when(F.col("status") != stages[0], value)

    return specs.REPLENISHMENT_ORDER.project(low.withColumns({
        "replen_id": id128("product_sk", "store_sk", "date_sk", tag="replen"), "created_by": F.lit("system"),
        "approved_qty": decided(F.greatest(F.col("suggested_qty") + draw.number("order_change", -2, 2), F.lit(0))),
        "approved_by": decided(draw.one_of("order_planner", PLANNERS)),
        "updated_at": F.coalesce(decided(F.expr("created_at + INTERVAL 2 DAYS")), F.col("created_at"))}))


def build_forecast_override(forecast: DataFrame, dim_date: DataFrame, *, rate: str, family: str = "md5") -> DataFrame:
    """FC17 (SC11): a keyed share of the improved forecasts is changed by a planner, by 30 % at most and not below 0."""
    cell = ["product_sk", "store_sk", "date_sk"]
    draw = Draws(cell, family)
    changed = forecast.where((F.col("forecast_version") == "improved") & draw.chance("override", rate)).join(cal.days(dim_date, "date"), "date_sk")
    factor = dec("0.7", 2, 1) + draw.share("override_by") * dec("0.6", 2, 1)
    return specs.FORECAST_OVERRIDE.project(changed.withColumns({
        "override_id": id128(*cell, tag="override"), "ai_forecast_qty": F.col("forecast_qty"),
        "override_qty": round2(F.greatest(F.col("forecast_qty") * factor, F.lit(0))),
        "override_reason": draw.one_of("override_why", OVERRIDE_REASONS), "planner_id": draw.one_of("override_planner", PLANNERS),
        "created_at": F.col("date").cast("timestamp_ntz"), "updated_at": F.expr("CAST(date AS TIMESTAMP_NTZ) + INTERVAL 1 DAY")}))


# ---- submitted overrides -----------------------------------------------------------------------------

_WHOLE = ("product_sk", "store_sk", "fiscal_year", "fiscal_week")
_AMOUNT = ("ai_forecast_qty", "override_qty")
_CHOICE = {"override_reason": OVERRIDE_REASONS, "planner_id": PLANNERS}
SUBMITTED = (*_WHOLE, *_AMOUNT, *_CHOICE)


def _as_number(name: str) -> Column:
    """The field as a number of its kind, null where it isn't one ("10.5" is no week)."""
    text = F.trim(F.col(name).cast("string"))
    if name in _WHOLE:
        return F.when(text.rlike(r"^[+-]?\d+$"), text.try_cast("long"))
    return text.try_cast("decimal(18,2)")


def _rules() -> list[tuple[str, Column]]:
    """(what is wrong, where it is): the first that holds is a record's error."""
    rules = [(f"{f} is missing", F.col(f).isNull()) for f in SUBMITTED]
    rules += [(f"{f} is no number", _as_number(f).isNull()) for f in (*_WHOLE, *_AMOUNT)]
    rules += [(f"{f} is unknown", ~F.col(f).isin(*values)) for f, values in _CHOICE.items()]
    return [*rules, ("override_qty is negative", _as_number("override_qty") < 0), ("fiscal_week is not in 1-53", ~_as_number("fiscal_week").between(1, 53))]


def validate_overrides(submitted: DataFrame) -> DataFrame:
    """PR17: ``submitted`` plus ``error``: null, or what is wrong with the record. Fields may be text."""
    return submitted.withColumn("error", F.coalesce(*[F.when(bad, F.lit(said)) for said, bad in _rules()]))


def accept_overrides(submitted: DataFrame, stored: DataFrame, submitted_at: Column) -> DataFrame:
    """DS16 (RS3): stored overrides and the valid submitted ones, newest first.

    A valid record gets its typed fields, an id from its cell, planner and time, and both timestamps.
    """
    typed = {f: _as_number(f) for f in (*_WHOLE, *_AMOUNT)}
    valid = validate_overrides(submitted).where("error is null").withColumns({**typed, "created_at": submitted_at, "updated_at": submitted_at})
    new = specs.FORECAST_OVERRIDE.project(valid.withColumn(
        "override_id", id128(*_WHOLE, "planner_id", "created_at", tag="submitted")))
    return stored.unionByName(new).orderBy(F.desc("created_at"), "override_id")


def submitted_from(spark: SparkSession, records: list[dict]) -> DataFrame:
    """RS3: records of a form or an API call as a frame of text fields; absent fields are null."""
    rows = [tuple(None if r.get(f) is None else str(r[f]) for f in SUBMITTED) for r in records]
    return spark.createDataFrame(rows, ", ".join(f"{f} string" for f in SUBMITTED))
