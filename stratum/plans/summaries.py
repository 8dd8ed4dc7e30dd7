"""Periodic and topical summaries of transactions, products, loans and channels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import steady_avg, steady_sum
from ..operators.groups import with_group


def period_summary(df: DataFrame, date: str, amount: str, unit: str, keys: Sequence[str] = ()) -> DataFrame:
    """Count, sum, mean and extremes per ``day``, ``month`` or ``year`` (and further keys)."""
    period = F.date_trunc(unit, F.col(date)).cast("date")
    return df.groupBy(period.alias("period"), *keys).agg(
        F.count(F.lit(1)).alias("transactions"), steady_sum(amount).alias("total_amount"),
        steady_avg(amount).alias("avg_amount"), F.min(amount).alias("min_amount"), F.max(amount).alias("max_amount"),
    )


def performance(df: DataFrame, keys: Sequence[str], amount: str, actor: str) -> DataFrame:
    """Volume, value and distinct actors per product, channel, card or branch."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("transactions"), steady_sum(amount).alias("total_amount"),
        steady_avg(amount).alias("avg_amount"), F.count_distinct(actor).alias("actors"),
    )


def loan_portfolio(loans: DataFrame, keys: Sequence[str]) -> DataFrame:
    granted = F.col("amount_granted")
    return loans.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("applications"), F.count_if("is_booked").alias("booked"),
        F.count_if("is_rejected").alias("rejected"), steady_sum("requested_amount").alias("requested"),
        steady_sum(granted).alias("granted"), steady_avg("ifrs9_ecl_12m", 6).alias("avg_expected_loss"),
    )


def anomalies(df: DataFrame, keys: Sequence[str], amount: str, z: float = 3.0) -> DataFrame:
    """Rows further than ``z`` standard deviations from the mean of their group.

    Mean and deviation come from a combining aggregate joined back, not from a window over the group.
    """
    stats = {"group_mean": F.avg(amount), "group_std": F.stddev_samp(amount), "group_rows": F.count(F.lit(1))}
    scored = with_group(df, keys, stats).withColumn(
        "z_score", F.try_divide(F.col(amount) - F.col("group_mean"), F.nullif(F.col("group_std"), F.lit(0.0)))
    )
    return scored.withColumn("is_anomaly", F.coalesce(F.abs("z_score") > z, F.lit(False)))


def customer_value(df: DataFrame, customer: str, date: str, amount: str, as_of: Column) -> DataFrame:
    """Value to date per customer: total, orders, tenure and value per year of tenure."""
    out = df.groupBy(customer).agg(
        F.count(F.lit(1)).alias("orders"), steady_sum(amount).alias("total_value"),
        F.min(F.col(date).cast("date")).alias("first_day"), F.max(F.col(date).cast("date")).alias("last_day"),
    )
    days = F.greatest(F.datediff(as_of, "first_day"), F.lit(1))
    return out.withColumns({
        "tenure_days": days, "value_per_year": F.col("total_value") * 365.0 / days,
        "recency_days": F.datediff(as_of, "last_day"),
    })


def exposure(df: DataFrame, customer: str, amount: str) -> DataFrame:
    """Open items and amount per customer."""
    return df.groupBy(customer).agg(F.count(F.lit(1)).alias("items"), steady_sum(amount).alias("exposure"))


def collector_load(cases: DataFrame, collector: str, days: str, written_off: Column) -> DataFrame:
    return cases.groupBy(collector).agg(
        F.count(F.lit(1)).alias("cases"), F.avg(days).alias("avg_days"), F.count_if(written_off).alias("write_offs")
    )


def card_usage(df: DataFrame, card: str, amount: str, actor: str, failed: Column) -> DataFrame:
    """Transactions per kind of card: number, failures and their share, value, distinct users."""
    rows = F.count(F.lit(1))
    return df.groupBy(card).agg(
        rows.alias("transactions"), F.count_if(failed).alias("failed"), (F.count_if(failed) / rows).alias("failed_share"),
        steady_sum(F.when(~failed, F.col(amount))).alias("settled_amount"), F.count_distinct(actor).alias("users"),
    )


def compliance(df: DataFrame, keys: Sequence[str], checks: Mapping[str, Column]) -> DataFrame:
    """Share of rows that pass each check (an unknown outcome does not pass), and rows that fail any."""
    passed = {n: F.coalesce(c, F.lit(False)) for n, c in checks.items()}
    shares = [(F.count_if(c) / F.count(F.lit(1))).alias(f"{n}_share") for n, c in passed.items()]
    everything = reduce(lambda a, b: a & b, passed.values())
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("checked"), *shares, F.count_if(~everything).alias("non_compliant"))
