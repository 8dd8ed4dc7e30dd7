"""Profiling and data-quality queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.keys import steady_avg, steady_sum
from ..operators import profiling, quality, sketches
from ..operators.quality import Rule
from ..plans import entities, summaries
from ..plans.dims import date_dim_for
from ..plans.entities import engagement
from ..session import fresh_path
from ..sources import tables
from . import views
from .registry import documents, query, table


@query("freq_table", """SELECT o_orderpriority, o_orderstatus, count(*) AS row_count FROM orders GROUP BY ALL""")
def _(spark, sf):
    return profiling.frequency(table(spark, sf, "orders"), ["o_orderpriority", "o_orderstatus"])


@query("top_groups", """SELECT l_partkey, count(*) AS row_count FROM lineitem GROUP BY 1 ORDER BY row_count DESC, l_partkey LIMIT 10""")
def _(spark, sf):
    return profiling.frequency(table(spark, sf, "lineitem"), ["l_partkey"], top_n=10)


@query("profile_categorical", """SELECT 'c_mktsegment' AS column_name, c_mktsegment AS value, count(*) AS row_count FROM customer GROUP BY c_mktsegment
UNION ALL SELECT 'c_nationkey', CAST(c_nationkey AS VARCHAR), count(*) FROM customer GROUP BY c_nationkey""")
def _(spark, sf):
    return profiling.profile_categorical(table(spark, sf, "customer"), ["c_mktsegment", "c_nationkey"])


@query("count_histogram", """SELECT group_size, count(*) AS key_count FROM (SELECT o_custkey, count(*) AS group_size FROM orders GROUP BY 1) GROUP BY 1""")
def _(spark, sf):
    return profiling.count_histogram(table(spark, sf, "orders"), ["o_custkey"])


@query("cross_tab", """SELECT o_orderpriority, count(*) FILTER (WHERE o_orderstatus = 'F') AS F, count(*) FILTER (WHERE o_orderstatus = 'O') AS O,
count(*) FILTER (WHERE o_orderstatus = 'P') AS P FROM orders GROUP BY 1""")
def _(spark, sf):
    return profiling.cross_tab(table(spark, sf, "orders"), "o_orderpriority", "o_orderstatus", ["F", "O", "P"])


@query("conditional_counts", """SELECT l_returnflag, count(*) AS row_count, count(*) FILTER (WHERE l_quantity > 25) AS large, count(*) FILTER (WHERE l_discount = 0) AS undiscounted
FROM lineitem GROUP BY 1""")
def _(spark, sf):
    return profiling.conditional_counts(table(spark, sf, "lineitem"), ["l_returnflag"], {
        "large": F.col("l_quantity") > 25, "undiscounted": F.col("l_discount") == 0,
    })


@query("numeric_summary", """SELECT l_linestatus, count(*) AS row_count, min(l_extendedprice) AS lo, max(l_extendedprice) AS hi, round(sum(l_extendedprice), 2) AS total,
round(sum(l_extendedprice), 2) / count(l_extendedprice) AS mean, count(DISTINCT l_partkey) AS parts FROM lineitem GROUP BY 1""")
def _(spark, sf):
    price = "l_extendedprice"
    return table(spark, sf, "lineitem").groupBy("l_linestatus").agg(
        F.count(F.lit(1)).alias("row_count"), F.min(price).alias("lo"), F.max(price).alias("hi"), steady_sum(price).alias("total"),
        steady_avg(price).alias("mean"), F.count_distinct("l_partkey").alias("parts"),
    )


@query("describe_stats", """SELECT 'count' AS summary, count(l_quantity)::DOUBLE AS l_quantity FROM lineitem UNION ALL SELECT 'mean', round(avg(l_quantity), 6) FROM lineitem
UNION ALL SELECT 'stddev', round(stddev_samp(l_quantity), 6) FROM lineitem UNION ALL SELECT 'min', min(l_quantity) FROM lineitem UNION ALL SELECT 'max', max(l_quantity) FROM lineitem""")
def _(spark, sf):
    stats = profiling.describe(table(spark, sf, "lineitem"), ["l_quantity"])
    return stats.select("summary", F.round(F.col("l_quantity").cast("double"), 6).alias("l_quantity"))


@query("null_profile", """SELECT 'o_orderkey' AS column_name, CAST(0 AS BIGINT) AS nulls, 0.0::DOUBLE AS null_pct UNION ALL SELECT 'p', count(*) FILTER (WHERE o_orderstatus <> 'P'),
count(*) FILTER (WHERE o_orderstatus <> 'P') * 100.0::DOUBLE / count(*) FROM orders""")
def _(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") == "P", F.col("o_totalprice")).alias("p"))
    return profiling.null_profile(rows)


@query("column_profile", """SELECT 'o_custkey' AS column_name, count(DISTINCT o_custkey) AS distinct_values, CAST(0 AS BIGINT) AS nulls, count(*) AS row_count FROM orders
UNION ALL SELECT 'o_orderstatus', count(DISTINCT o_orderstatus), 0, count(*) FROM orders UNION ALL SELECT 'o_totalprice', count(DISTINCT o_totalprice), 0, count(*) FROM orders
UNION ALL SELECT 'p', count(DISTINCT o_orderpriority) FILTER (WHERE o_orderstatus = 'P'), count(*) FILTER (WHERE o_orderstatus <> 'P'), count(*) FROM orders""")
def _(spark, sf):
    rows = table(spark, sf, "orders").withColumn("p", F.when(F.col("o_orderstatus") == "P", F.col("o_orderpriority")))
    return profiling.column_profile(rows, ["o_custkey", "o_orderstatus", "o_totalprice", "p"])


@query("candidate_keys", """SELECT k AS key_columns, d AS distinct_keys, n AS row_count, d = n AS is_key FROM (
SELECT 'l_orderkey' AS k, count(DISTINCT l_orderkey) AS d, count(*) AS n FROM lineitem
UNION ALL SELECT 'l_orderkey,l_linenumber', count(DISTINCT (l_orderkey, l_linenumber)), count(*) FROM lineitem
UNION ALL SELECT 'l_orderkey,l_linenumber,l_partkey,l_suppkey,l_shipdate', count(DISTINCT (l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate)), count(*) FROM lineitem)""")
def _(spark, sf):
    return profiling.candidate_keys(table(spark, sf, "lineitem"), [
        ["l_orderkey"], ["l_orderkey", "l_linenumber"], ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"],
    ])


@query("coverage_matrix", """SELECT table_name, year, CAST(sum(n) AS BIGINT) AS row_count, count(*) AS months, count(*) >= 12 AS is_complete FROM (
SELECT 'orders' AS table_name, CAST(year(o_orderdate) AS INTEGER) AS year, month(o_orderdate) AS m, count(*) AS n FROM orders GROUP BY ALL
UNION ALL SELECT 'lineitem', CAST(year(l_shipdate) AS INTEGER), month(l_shipdate), count(*) FROM lineitem GROUP BY ALL
UNION ALL SELECT 'events', CAST(year(ts) AS INTEGER), month(ts), count(*) FROM events GROUP BY ALL) GROUP BY table_name, year""")
def _(spark, sf):
    return profiling.coverage({
        "orders": (table(spark, sf, "orders"), "o_orderdate"), "lineitem": (table(spark, sf, "lineitem"), "l_shipdate"),
        "events": (table(spark, sf, "events"), "ts"),
    })


@query("coverage_grid", "SELECT 'orders' AS table_name, CAST(year(o_orderdate) AS INTEGER) AS year, " + ", ".join(
    f"CASE WHEN count(*) FILTER (WHERE month(o_orderdate) = {m}) > 0 THEN 'x' ELSE '.' END AS m{m:02d}" for m in range(1, 13)
) + " FROM orders GROUP BY 2")
def _(spark, sf):
    return profiling.coverage_grid(table(spark, sf, "orders"), "o_orderdate", "orders")


@query("data_quality_flag", """SELECT o_orderkey, CASE WHEN count(DISTINCT month(o_orderdate)) OVER (PARTITION BY year(o_orderdate)) >= 12 THEN 'complete' ELSE 'incomplete_year' END AS data_quality_flag
FROM orders""")
def _(spark, sf):
    return profiling.flag_incomplete_years(table(spark, sf, "orders"), "o_orderdate").select("o_orderkey", "data_quality_flag")


@query("exposure_by_customer", """SELECT o_custkey, count(*) AS items, round(sum(o_totalprice), 2) AS exposure FROM orders WHERE o_orderstatus = 'O' GROUP BY 1""")
def _(spark, sf):
    return summaries.exposure(table(spark, sf, "orders").filter("o_orderstatus = 'O'"), "o_custkey", "o_totalprice")


@query("collector_load", """SELECT l_suppkey, count(*) AS cases, avg(l_quantity) AS avg_days, count(*) FILTER (WHERE l_returnflag = 'R') AS write_offs FROM lineitem GROUP BY 1""")
def _(spark, sf):
    return summaries.collector_load(table(spark, sf, "lineitem"), "l_suppkey", "l_quantity", F.col("l_returnflag") == "R")


OPTED_SQL = """(SELECT CAST(user_id AS VARCHAR) AS customer_id, max(CAST(event_type IN ('view', 'click', 'purchase') AS INTEGER)) AS has_engaged,
max(CAST(event_type = 'error' AND value > 150 AS INTEGER)) AS has_opted_out FROM events GROUP BY 1)"""


def opted(spark, sf):
    """Only costly errors count as complaints here, so that both answers occur."""
    rows = views.responses(spark, sf).withColumn(
        "response_type", F.when((F.col("response_type") == "complained") & (F.col("conversion_value_zar") <= 150), "ignored")
        .otherwise(F.col("response_type")),
    )
    return engagement.opted_in(rows.withColumns(engagement.response_flags("response_type")))


@query("opt_in_flags", f"SELECT *, has_engaged = 1 AND has_opted_out = 0 AS is_opted_in_marketing FROM {OPTED_SQL}")
def _(spark, sf):
    return opted(spark, sf)


@query("ratios", """SELECT count(*) FILTER (WHERE event_type = 'error') / count(*) AS complaint_rate, count(*) FILTER (WHERE value > 50) / count(*) AS large_share FROM events""")
def _(spark, sf):
    return quality.ratios(table(spark, sf, "events"), {
        "complaint_rate": F.col("event_type") == "error", "large_share": F.col("value") > 50,
    })


# ---- data quality

@query("dq_null_rules", """SELECT 'o_orderkey_null' AS rule, 'fail' AS severity, count(*) AS checked, CAST(0 AS BIGINT) AS failed, 0.0::DOUBLE AS pct FROM orders
UNION ALL SELECT 'p_null', 'warn', count(*) FILTER (WHERE o_orderpriority = '1-URGENT'), count(*) FILTER (WHERE o_orderpriority = '1-URGENT' AND o_orderstatus <> 'P'),
count(*) FILTER (WHERE o_orderpriority = '1-URGENT' AND o_orderstatus <> 'P') * 100.0::DOUBLE / count(*) FILTER (WHERE o_orderpriority = '1-URGENT') FROM orders""")
def _(spark, sf):
    rows = table(spark, sf, "orders").withColumn("p", F.when(F.col("o_orderstatus") == "P", F.col("o_totalprice")))
    return quality.run_rules(rows, [
        *quality.required(["o_orderkey"]), *quality.required(["p"], "warn", F.col("o_orderpriority") == "1-URGENT"),
    ])


@query("dq_duplicate_keys", """SELECT count(*) AS repeated_keys, CAST(sum(n) AS BIGINT) AS row_count FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)""")
def _(spark, sf):
    return quality.duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("dq_domain", """SELECT event_type, count(*) AS row_count FROM events WHERE event_type NOT IN ('view', 'click', 'purchase') GROUP BY 1""")
def _(spark, sf):
    return quality.outside_domain(table(spark, sf, "events"), "event_type", ["view", "click", "purchase"])


@query("dq_logic", """SELECT 'granted_above_requested' AS check_name, count(*) FILTER (WHERE l_extendedprice > l_quantity * 1000 * 1.1) AS failed FROM lineitem
UNION ALL SELECT 'returned_still_open', count(*) FILTER (WHERE l_returnflag = 'R' AND l_linestatus = 'O') FROM lineitem""")
def _(spark, sf):
    return quality.failed_counts(table(spark, sf, "lineitem"), {
        "granted_above_requested": F.col("l_extendedprice") > F.col("l_quantity") * 1000 * 1.1,
        "returned_still_open": (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O"),
    })


@query("dq_dates", """SELECT 'o_orderdate' AS column_name, CAST(min(o_orderdate) AS DATE) AS earliest, CAST(max(o_orderdate) AS DATE) AS latest,
count(*) FILTER (WHERE o_orderdate > DATE '2001-01-01') AS future_dated FROM orders""")
def _(spark, sf):
    return quality.date_sanity(table(spark, sf, "orders"), ["o_orderdate"], F.lit("2001-01-01").cast("date"))


@query("dq_stage_ranges", """SELECT l_returnflag, min(l_quantity) AS min_dpd, max(l_quantity) AS max_dpd, avg(l_quantity) AS avg_dpd FROM lineitem GROUP BY 1""")
def _(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_returnflag").agg(
        F.min("l_quantity").alias("min_dpd"), F.max("l_quantity").alias("max_dpd"), F.avg("l_quantity").alias("avg_dpd")
    )


@query("date_profile", """SELECT column_name, CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month, count(*) AS row_count, 'lineitem' AS table_name FROM (
SELECT 'l_shipdate' AS column_name, l_shipdate AS d FROM lineitem UNION ALL SELECT 'l_returned', CASE WHEN l_returnflag = 'R' THEN l_shipdate END FROM lineitem) GROUP BY ALL""")
def _(spark, sf):
    rows = table(spark, sf, "lineitem").withColumn("l_returned", F.when(F.col("l_returnflag") == "R", F.col("l_shipdate")))
    return quality.date_profile(rows, ["l_shipdate", "l_returned"], "lineitem")


@query("dq_text_len", """SELECT 'text' AS column_name, CAST(0 AS BIGINT) AS nulls, min(length(text))::INTEGER AS min_length, max(length(text))::INTEGER AS max_length, round(avg(length(text)), 6) AS avg_length FROM documents""")
def _(spark, sf):
    out = quality.text_lengths(table(spark, sf, "documents"), ["text"])
    return out.withColumn("avg_length", F.round("avg_length", 6))


PII_SQL = r"""SELECT doc_id, regexp_matches(text, '[0-9]{13}') AS has_national_id, regexp_matches(text, '[0-9]{3}[\s-]?[0-9]{3}[\s-]?[0-9]{4}') AS has_phone,
regexp_matches(text, '[\w.-]+@[\w.-]+') AS has_email FROM documents"""


@query("dq_pii_scan", f"SELECT * FROM ({PII_SQL}) WHERE has_national_id OR has_phone OR has_email")
def _(spark, sf):
    return quality.pii_rows(documents(spark, sf), "text", ["doc_id"])


@query("dq_lineage", """SELECT count(DISTINCT CAST(ts AS DATE)) AS batches, count(DISTINCT event_type) AS commits, min(ts) AS first_ingest, max(ts) AS last_ingest FROM events""")
def _(spark, sf):
    rows = table(spark, sf, "events").select(
        F.col("ts").cast("date").cast("string").alias("_batch_id"), F.col("event_type").alias("_commit_sha"), F.col("ts").alias("_ingest_timestamp")
    )
    return quality.lineage(rows)


@query("dq_calendar", """WITH d AS (SELECT unnest(generate_series(CAST(min(o_orderdate) AS DATE) - INTERVAL 1 YEAR, CAST(max(o_orderdate) AS DATE) + INTERVAL 1 YEAR, INTERVAL 1 DAY)) AS d FROM orders)
SELECT count(*) AS days, count(*) FILTER (WHERE isodow(d) >= 6) AS weekend_days, count(*) FILTER (WHERE isodow(d) >= 6) * 100.0::DOUBLE / count(*) AS weekend_pct,
count(*) FILTER (WHERE d = last_day(d)) AS month_ends, count(*) FILTER (WHERE d = last_day(d) AND month(d) IN (3, 6, 9, 12)) AS quarter_ends FROM d""")
def _(spark, sf):
    return quality.calendar_checks(date_dim_for(table(spark, sf, "orders"), "o_orderdate"))


@query("dq_row_flags", """SELECT event_id, event_type = 'error' AND value <= 20 AS dq_missing_failure_reason, value > 100 AS dq_non_zar_currency FROM events""")
def _(spark, sf):
    rows = table(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("atm_log_id"), F.lit("cash_withdrawal").alias("event_type"),
        F.when(F.col("event_type") == "error", "failed").otherwise("ok").alias("attempt_result"),
        F.when(F.col("value") > 20, "reason").alias("failure_reason"),
        F.when(F.col("value") > 100, "usd").otherwise("zar").alias("currency"), F.lit(None).cast("string").alias("customer_id"),
        F.col("ts").cast("timestamp").alias("_ingest_timestamp"),
    )
    logs = entities.atm_logs(rows, [table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("customer_id"))], views.CTX)
    return logs.select(F.col("atm_log_id").cast("bigint").alias("event_id"), "dq_missing_failure_reason", "dq_non_zar_currency")


@query("dq_rules_by_type", """SELECT 'large' AS rule, 'warn' AS severity, count(*) AS checked, count(*) FILTER (WHERE value > 300) AS failed,
count(*) FILTER (WHERE value > 300) * 100.0::DOUBLE / count(*) AS pct FROM events WHERE event_type = 'purchase'""")
def _(spark, sf):
    return quality.run_rules(table(spark, sf, "events"), [Rule("large", F.col("value") > 300, "warn", F.col("event_type") == "purchase")])


@query("sketch_ranges", """SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS row_count, TRUE AS distinct_close, TRUE AS quantiles_close FROM orders GROUP BY 1""")
def _(spark, sf):
    """Sketches per month of two batches, stored, then merged per year; beside them the exact numbers, which tell whether the
    distinct customers and three quantiles lie within the stated errors."""
    orders, path = table(spark, sf, "orders"), fresh_path(spark, "sketches")
    for n in (0, 1):
        batch = orders.filter(F.pmod("o_custkey", F.lit(2)) == n)
        tables.append(sketches.sketch_batch(batch, f"b{n}", "o_orderdate", [], ["o_custkey"], ["o_totalprice"]), path)
    year, wanted = F.year("month").alias("year"), [0.1, 0.5, 0.9]
    merged = sketches.estimates(sketches.merge_sketches(tables.read_table(spark, path), {"year": year}), wanted)
    exact = orders.groupBy(F.year("o_orderdate").alias("y")).agg(F.count_distinct("o_custkey").alias("customers"))
    near = F.abs(F.col("distinct_o_custkey") - F.col("customers")) <= F.col("customers") * sketches.distinct_error() + 1
    # rank of each estimate: share of rows below and up to it
    placed = orders.join(merged.select(F.col("year").alias("y2"), "quantiles_o_totalprice"), F.year("o_orderdate") == F.col("y2"))
    q = [F.get("quantiles_o_totalprice", F.lit(i)) for i in range(len(wanted))]
    ranks = placed.groupBy("y2").agg(*[
        x for i, p in enumerate(wanted) for x in (F.avg((F.col("o_totalprice") < q[i]).cast("int")).alias(f"lo{i}"), F.avg((F.col("o_totalprice") <= q[i]).cast("int")).alias(f"hi{i}"))
    ])
    inside = [(F.col(f"lo{i}") - sketches.rank_error() <= p) & (F.col(f"hi{i}") + sketches.rank_error() >= p) for i, p in enumerate(wanted)]
    out = merged.join(exact, F.col("year") == F.col("y")).join(ranks, F.col("year") == F.col("y2"))
    return out.select("year", F.col("rows").alias("row_count"), near.alias("distinct_close"), (inside[0] & inside[1] & inside[2]).alias("quantiles_close"))
