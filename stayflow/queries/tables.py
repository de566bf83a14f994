"""Movement histories and other inputs that Spark derives from the driver's tables.

``events`` is read as a movement log: a user is an encounter, the event type is the place, and a
movement lasts until the user's next event.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stayflow.operators.intervals import ADMIT, collapse_runs, mark_edges
from stayflow.operators.ordered import Ordered, arrange
from stayflow.operators.sequences import seq
from stayflow.sources.scratch import keep
from stayflow.sources.tables import load

UNITS = ["view", "click", "purchase"]
ICU = "purchase"
ACCOUNTS = 50


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return load(spark, folder, [name])[name]


def moves(spark: SparkSession, folder: str) -> Ordered:
    """csn, har, event_id, dept, in_dttm, out_dttm (NULL for the last), value."""
    log = table(spark, folder, "events").select(
        F.col("user_id").alias("csn"),
        F.pmod("user_id", F.lit(ACCOUNTS)).alias("har"),
        "event_id",
        F.col("event_type").alias("dept"),
        F.col("ts").alias("in_dttm"),
        "value",
    )
    return arrange(log, ["csn"], ["in_dttm", "event_id"]).shift(out_dttm=("in_dttm", 1))


def is_unit() -> Column:
    return F.col("dept").isin(UNITS)


def unit_stays(spark: SparkSession, folder: str) -> tuple[DataFrame, Ordered]:
    """Stays on units, numbered per encounter, and the movements they come from."""
    log = moves(spark, folder)
    marked = mark_edges(log.filter(is_unit()), ["dept"], end="out_dttm")
    runs = collapse_runs(
        marked,
        starts=F.col("admit_status") == ADMIT,
        closes=F.col("discharge_status").isNotNull(),
        first={"har": "har", "dept": "dept", "unit_in_dttm": "in_dttm"},
        last={"unit_out_dttm": "out_dttm", "unit_status": "discharge_status"},
    ).drop("_line")
    stays = seq(arrange(runs, ["csn"], ["unit_in_dttm"], known=log), "line").df
    return stays, log


def kept_stays(spark: SparkSession, folder: str) -> tuple[Ordered, Ordered]:
    """The stays written once, arranged per encounter, and the movements."""
    stays, log = unit_stays(spark, folder)
    return arrange(keep(stays), ["csn"], ["unit_in_dttm"], known=log), log


def stay_encounters(log: Ordered) -> DataFrame:
    """csn and disch_dttm: the start of the encounter's last movement."""
    return log.df.groupBy("csn").agg(F.max("in_dttm").alias("disch_dttm"))


# -- encounters and accounts: an order is an encounter, a customer an account -----------------


def order_encounters(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order, with the class of its account."""
    orders = table(spark, folder, "orders")
    return orders.select(
        F.col("o_orderkey").alias("csn"),
        F.col("o_custkey").alias("har"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("dept_id"),
        F.when(F.col("o_orderpriority") == "1-URGENT", 103).otherwise(101).alias("pat_class"),
        F.col("o_orderdate").alias("admit_dttm"),
        F.date_add("o_orderdate", 30).cast("timestamp_ntz").alias("disch_dttm"),
        F.when(F.col("o_orderstatus") == "P", 2).otherwise(1).alias("base_class"),
    )


def order_movements(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order line: a movement from the ship date for two days."""
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("csn"),
        F.col("l_linenumber").cast("bigint").alias("dept_id"),
        F.col("l_shipdate").alias("in_dttm"),
        F.date_add("l_shipdate", 2).cast("timestamp_ntz").alias("out_dttm"),
    )


def stored_orders(spark: SparkSession, folder: str) -> DataFrame:
    """What an earlier run is taken to have stored: one row per line of a returned item."""
    lines = table(spark, folder, "lineitem").filter(F.col("l_returnflag") == "R")
    return lines.select(
        F.col("l_orderkey").alias("csn"),
        F.col("l_suppkey").alias("har"),
        F.when(F.col("l_linestatus") == "F", "DISCHARGED").otherwise("OPEN").alias("unit_status"),
        F.col("l_shipdate").alias("unit_out_dttm"),
        F.when(F.col("l_linestatus") == "F", 1).otherwise(0).alias("billed_as_op"),
    )


def customer_accounts(spark: SparkSession, folder: str) -> DataFrame:
    """One account per customer with orders.

    Customers of the furniture segment count as merged into the account with their nation's number
    at the time of their last order.
    """
    per_customer = (
        table(spark, folder, "orders")
        .groupBy("o_custkey")
        .agg(
            F.max("o_orderkey").alias("prim_csn"),
            F.min("o_orderdate").alias("adm_dttm"),
            F.max("o_orderdate").alias("last_dttm"),
            F.round(F.sum("o_totalprice"), 2).alias("tot_chgs"),
        )
    )
    joined = per_customer.join(
        table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    merged = F.col("c_mktsegment") == "FURNITURE"
    return joined.select(
        F.col("c_custkey").alias("har"),
        "prim_csn",
        F.when(merged, F.col("c_nationkey").cast("bigint")).alias("combine_har"),
        F.when(merged, F.col("last_dttm")).alias("combine_dttm"),
        "adm_dttm",
        F.when(F.col("c_mktsegment") == "BUILDING", 2).otherwise(1).alias("base_class"),
        "tot_chgs",
    )
