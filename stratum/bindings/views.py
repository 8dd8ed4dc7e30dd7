"""The test tables in banking roles, once for Spark and once as SQL text.

orders = accounts and loans, lineitem = transactions, customer = customers, events = logs and responses.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import RunContext
from ..functions import bands
from ..operators.dedup import latest_by
from .registry import table

AS_OF = "2001-12-31"
CTX = RunContext(as_of=dt.date.fromisoformat(AS_OF), salt="pepper", batch_id="20011231T000000Z", commit_sha="c0ffee")
STATUS = {"F": "active", "O": "restricted", "P": "suspended"}
CHANNELS = {"A": "atm", "N": "online_banking", "R": "branch"}

LINE_ORDER = (
    "l_shipdate l_partkey l_suppkey l_extendedprice l_quantity l_discount l_tax l_returnflag l_linestatus".split()
)
LINES_SQL = f"""(SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
ORDER BY {', '.join(c + ' DESC' for c in LINE_ORDER)}) AS rn FROM lineitem) WHERE rn = 1)"""

ACCOUNTS_SQL = """(SELECT o_orderkey AS account_id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS opening_date,
CASE o_orderstatus WHEN 'F' THEN 'active' WHEN 'O' THEN 'restricted' WHEN 'P' THEN 'suspended' END AS account_status,
o_orderpriority AS account_tier, o_totalprice AS credit_limit FROM orders)"""

TX_SQL = f"""(SELECT l_orderkey AS account_id, l_linenumber AS transaction_id, CAST(l_shipdate AS DATE) AS transaction_date,
l_extendedprice AS amount, l_linestatus = 'F' AS is_completed, l_returnflag <> 'R' AS is_debit,
CASE l_returnflag WHEN 'A' THEN 'atm' WHEN 'N' THEN 'online_banking' WHEN 'R' THEN 'branch' END AS channel,
l_discount + 0.0 AS transaction_cost FROM {LINES_SQL})"""


def lines(spark: SparkSession, sf: str) -> DataFrame:
    """Line items, the newest per order and line."""
    return latest_by(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], LINE_ORDER, tie=())


def accounts(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("account_id"), F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("opening_date"),
        bands.map_lookup("o_orderstatus", STATUS).alias("account_status"),
        F.col("o_orderpriority").alias("account_tier"), F.col("o_totalprice").alias("credit_limit"),
    )


def transactions(spark: SparkSession, sf: str) -> DataFrame:
    return lines(spark, sf).select(
        F.col("l_orderkey").alias("account_id"), F.col("l_linenumber").alias("transaction_id"),
        F.col("l_shipdate").cast("date").alias("transaction_date"), F.col("l_extendedprice").alias("amount"),
        (F.col("l_linestatus") == "F").alias("is_completed"), (F.col("l_returnflag") != "R").alias("is_debit"),
        bands.map_lookup("l_returnflag", CHANNELS).alias("channel"),
        (F.col("l_discount") + 0.0).alias("transaction_cost"),
    )


def responses(spark: SparkSession, sf: str) -> DataFrame:
    """Events as campaign responses."""
    kinds = {"click": "clicked", "purchase": "converted", "view": "opened", "error": "complained", "signup": "ignored"}
    return table(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("response_id"), F.col("user_id").cast("string").alias("customer_id"),
        F.col("ts").cast("date").alias("response_date"), bands.map_lookup("event_type", kinds).alias("response_type"),
        F.col("value").alias("conversion_value_zar"),
    )
