"""CHK11: are drawn attributes independent of each other?

The rows of a pair of attributes are counted by value; what follows works on this table, which has a row for each pair of
values, not on the data. G = 2 * sum n_ij * ln(n * n_ij / (n_i * n_j)), twice the rows times the mutual information in nats, is
about chi-squared with (r - 1)(c - 1) degrees of freedom if the attributes are independent; draws that share a salt or a key
make it grow with the rows. The bound is what chance stays below: the mean, five standard deviations, and ten for short tails.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Pair:
    """Two attributes of a table, drawn for each of its rows."""

    table: str
    a: str
    b: str


#: Every two attributes that are drawn per row from keys and salts of their own.
DRAWN = (
    Pair("dim_product", "private_label_flag", "is_marketplace"), Pair("dim_product", "uom", "lifecycle_status"),
    Pair("dim_product", "private_label_flag", "lifecycle_status"), Pair("dim_product", "uom", "is_marketplace"),
    Pair("dim_store", "is_ship_from_store", "is_bopis_enabled"),
    Pair("dim_customer", "acquisition_channel", "email_opt_in"), Pair("dim_customer", "loyalty_member_flag", "email_opt_in"),
    Pair("dim_customer", "loyalty_member_flag", "acquisition_channel"),
    Pair("fact_returns", "return_reason", "disposition"), Pair("fact_returns", "return_reason", "is_fraud_suspected"),
    Pair("fact_inventory_movement", "movement_type", "reason_code"),
)


def independence(df: DataFrame, pair: Pair) -> DataFrame:
    """One row: ``table_name, attribute_a, attribute_b, row_count, freedom, g, bound, dependent``; g and bound to 3 decimals. A null is
    a value like any other."""
    text = [F.coalesce(F.col(c).cast("string"), F.lit("\0")).alias(x) for c, x in ((pair.a, "a"), (pair.b, "b"))]
    cells = df.select(*text).groupBy("a", "b").agg(F.count(F.lit(1)).cast("double").alias("n"))
    sums = cells.select("a", "b", "n", F.sum("n").over(Window.partitionBy("a")).alias("n_a"), F.sum("n").over(Window.partitionBy("b")).alias("n_b"),
                        F.sum("n").over(Window.partitionBy()).alias("all"))  # a row per pair of values
    one = sums.agg(F.coalesce(F.sum("n"), F.lit(0.0)).cast("long").alias("row_count"),
                   ((F.countDistinct("a") - 1) * (F.countDistinct("b") - 1)).cast("long").alias("freedom"),
                   F.round(2 * F.coalesce(F.sum(F.col("n") * F.log(F.col("all") * F.col("n") / (F.col("n_a") * F.col("n_b")))), F.lit(0.0)), 3).alias("g"))
    bound = F.round(F.col("freedom") + 5 * F.sqrt(2.0 * F.greatest(F.col("freedom"), F.lit(0))) + 10, 3)
    return one.select(F.lit(pair.table).alias("table_name"), F.lit(pair.a).alias("attribute_a"), F.lit(pair.b).alias("attribute_b"), "row_count", "freedom", "g",
                      bound.alias("bound"), (F.col("g") > bound).alias("dependent"))
