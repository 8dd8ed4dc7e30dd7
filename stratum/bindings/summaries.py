"""Summary products."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans import summaries
from . import views
from .registry import query, table


def _period_sql(unit: str, keys: str = "") -> str:
    more = f", {keys}" if keys else ""
    return f"""SELECT CAST(date_trunc('{unit}', transaction_date) AS DATE) AS period{more}, count(*) AS transactions, round(sum(amount), 2) AS total_amount,
round(sum(amount), 2) / count(amount) AS avg_amount, min(amount) AS min_amount, max(amount) AS max_amount FROM {views.TX_SQL} WHERE is_completed GROUP BY ALL"""


def _completed(spark, sf):
    return views.transactions(spark, sf).filter("is_completed")


@query("daily_summary", _period_sql("day", "channel"))
def _(spark, sf):
    return summaries.period_summary(_completed(spark, sf), "transaction_date", "amount", "day", ["channel"])


@query("monthly_activity", _period_sql("month", "account_id"))
def _(spark, sf):
    return summaries.period_summary(_completed(spark, sf), "transaction_date", "amount", "month", ["account_id"])


@query("yearly_metrics", _period_sql("year"))
def _(spark, sf):
    return summaries.period_summary(_completed(spark, sf), "transaction_date", "amount", "year")


@query("channel_performance", f"""SELECT channel, count(*) AS transactions, round(sum(amount), 2) AS total_amount, round(sum(amount), 2) / count(amount) AS avg_amount,
count(DISTINCT account_id) AS actors FROM {views.TX_SQL} GROUP BY 1""")
def _(spark, sf):
    return summaries.performance(views.transactions(spark, sf), ["channel"], "amount", "account_id")


@query("product_performance", """SELECT p_type, p_brand, count(*) AS transactions, round(sum(l_extendedprice), 2) AS total_amount, round(sum(l_extendedprice), 2) / count(l_extendedprice) AS avg_amount,
count(DISTINCT l_orderkey) AS actors FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL""")
def _(spark, sf):
    sold = table(spark, sf, "lineitem").join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return summaries.performance(sold, ["p_type", "p_brand"], "l_extendedprice", "l_orderkey")


@query("loan_portfolio", """SELECT o_orderpriority, count(*) AS applications, count(*) FILTER (WHERE o_orderstatus = 'F') AS booked, count(*) FILTER (WHERE o_orderstatus = 'P') AS rejected,
round(sum(o_totalprice), 2) AS requested, round(sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END), 2) AS granted, round(sum(o_totalprice), 6) / count(o_totalprice) AS avg_expected_loss FROM orders GROUP BY 1""")
def _(spark, sf):
    loans = table(spark, sf, "orders").withColumns({
        "is_booked": F.col("o_orderstatus") == "F", "is_rejected": F.col("o_orderstatus") == "P",
        "requested_amount": F.col("o_totalprice"), "amount_granted": F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")),
        "ifrs9_ecl_12m": F.round("o_totalprice", 2),
    })
    return summaries.loan_portfolio(loans, ["o_orderpriority"])


@query("anomaly_flags", """SELECT event_id, event_type, coalesce(abs((value - m) / nullif(s, 0)) > 3, FALSE) AS is_anomaly FROM (
SELECT *, avg(value) OVER (PARTITION BY event_type) AS m, stddev_samp(value) OVER (PARTITION BY event_type) AS s FROM events)""")
def _(spark, sf):
    return summaries.anomalies(table(spark, sf, "events"), ["event_type"], "value").select("event_id", "event_type", "is_anomaly")


@query("customer_value", """SELECT o_custkey, count(*) AS orders, round(sum(o_totalprice), 2) AS total_value, CAST(min(o_orderdate) AS DATE) AS first_day, CAST(max(o_orderdate) AS DATE) AS last_day,
greatest(date_diff('day', CAST(min(o_orderdate) AS DATE), DATE '2001-12-31'), 1)::INTEGER AS tenure_days, round(sum(o_totalprice), 2) * 365.0 / greatest(date_diff('day', CAST(min(o_orderdate) AS DATE), DATE '2001-12-31'), 1) AS value_per_year,
date_diff('day', CAST(max(o_orderdate) AS DATE), DATE '2001-12-31')::INTEGER AS recency_days FROM orders GROUP BY 1""")
def _(spark, sf):
    return summaries.customer_value(table(spark, sf, "orders"), "o_custkey", "o_orderdate", "o_totalprice", F.lit(views.AS_OF).cast("date"))


@query("segment_distribution", """SELECT c_mktsegment, n_name, count(*) AS row_count FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL""")
def _(spark, sf):
    from ..operators.profiling import frequency

    placed = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return frequency(placed, ["c_mktsegment", "n_name"])


@query("card_usage", """SELECT o_orderpriority, count(*) AS transactions, count(*) FILTER (WHERE l_quantity >= 45) AS failed, count(*) FILTER (WHERE l_quantity >= 45) / count(*) AS failed_share,
CAST(sum(CASE WHEN l_quantity < 45 THEN CAST(l_extendedprice AS DECIMAL(18, 2)) END) AS DOUBLE) AS settled_amount, count(DISTINCT o_custkey) AS users FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""")
def _(spark, sf):
    """The order priority plays the kind of card."""
    rows = table(spark, sf, "lineitem").join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return summaries.card_usage(rows, "o_orderpriority", "l_extendedprice", "o_custkey", F.col("l_quantity") >= 45)


@query("compliance", """SELECT c_mktsegment, count(*) AS checked, count(*) FILTER (WHERE c_acctbal > 0) / count(*) AS kyc_share, count(*) FILTER (WHERE c_nationkey < 20) / count(*) AS fica_share,
count(*) FILTER (WHERE NOT (c_acctbal > 0 AND c_nationkey < 20)) AS non_compliant FROM customer GROUP BY 1""")
def _(spark, sf):
    checks = {"kyc": F.col("c_acctbal") > 0, "fica": F.col("c_nationkey") < 20}
    return summaries.compliance(table(spark, sf, "customer"), ["c_mktsegment"], checks)
