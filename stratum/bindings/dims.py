"""Dimension queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions.keys import surrogate
from ..operators.scd2 import pit_join
from ..plans import dims
from . import views
from .registry import query, table

HOLIDAYS_SQL = "(" + ", ".join(f"DATE '{d}'" for d in dims.PUBLIC_HOLIDAYS) + ")"
DATE_COLUMNS = f"""CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS DATE) AS full_date, CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
CAST(day(d) AS INTEGER) AS day, CAST(quarter(d) AS INTEGER) AS quarter, CAST(strftime(d, '%W') AS INTEGER) AS week_of_year, CAST(isodow(d) AS INTEGER) AS day_of_week,
strftime(d, '%A') AS day_name, strftime(d, '%B') AS month_name, isodow(d) >= 6 AS is_weekend, d = last_day(d) AS is_month_end,
d = last_day(d) AND month(d) IN (3, 6, 9, 12) AS is_quarter_end, CAST(d AS DATE) IN {HOLIDAYS_SQL} AS is_public_holiday_za"""


@query("dim_date", f"""SELECT {DATE_COLUMNS} FROM (SELECT unnest(generate_series(CAST(min(o_orderdate) AS DATE) - INTERVAL 1 YEAR,
CAST(max(o_orderdate) AS DATE) + INTERVAL 1 YEAR, INTERVAL 1 DAY)) AS d FROM orders)""")
def _(spark, sf):
    return dims.date_dim_for(table(spark, sf, "orders"), "o_orderdate")


@query("dim_date_events", f"""SELECT {DATE_COLUMNS} FROM (SELECT unnest(generate_series(CAST(min(ts) AS DATE) - INTERVAL 1 YEAR,
CAST(max(ts) AS DATE) + INTERVAL 1 YEAR, INTERVAL 1 DAY)) AS d FROM events)""")
def _(spark, sf):
    """The years the holiday list covers."""
    return dims.date_dim_for(table(spark, sf, "events"), "ts")


@query("calendar_table", """SELECT CAST(d AS DATE) AS date, CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month_no, strftime(d, '%B') AS month,
CAST(quarter(d) AS INTEGER) AS quarter_no, concat('Qtr ', quarter(d)) AS quarter, CAST(day(d) AS INTEGER) AS day FROM (
SELECT unnest(generate_series(date_trunc('year', min(l_shipdate)), make_date(year(max(l_shipdate)), 12, 31)::TIMESTAMP, INTERVAL 1 DAY)) AS d FROM lineitem)""")
def _(spark, sf):
    return dims.calendar_table(table(spark, sf, "lineitem"), "l_shipdate")


@query("join_calendar", f"""SELECT event_id, CAST(ts AS DATE) IN {HOLIDAYS_SQL} AS is_public_holiday_za, strftime(ts, '%A') AS day_name FROM events""")
def _(spark, sf):
    dates = dims.date_dim_for(table(spark, sf, "events"), "ts")
    return dims.join_calendar(table(spark, sf, "events"), dates, "ts", ["is_public_holiday_za", "day_name"]).select(
        "event_id", "is_public_holiday_za", "day_name"
    )


@query("dim_product", """SELECT code AS product_code, CASE code WHEN 'credit_card' THEN 'Credit Card' WHEN 'home_loan' THEN 'Home Loan' ELSE code END AS product_name,
CASE code WHEN 'credit_card' THEN 'Credit' WHEN 'home_loan' THEN 'Lending' ELSE 'Unknown' END AS product_category, code IN ('credit_card', 'home_loan') AS is_credit_product,
sum(act) > 0 AS is_active, count(*) AS total_enrollments, CAST(sum(act) AS BIGINT) AS active_enrollments FROM (
SELECT CASE p_type WHEN 'ECONOMY' THEN 'credit_card' WHEN 'PROMO' THEN 'home_loan' ELSE lower(p_type) END AS code, CAST(l_linestatus = 'O' AND p_type <> 'LARGE' AS INTEGER) AS act
FROM lineitem JOIN part ON l_partkey = p_partkey) GROUP BY code""")
def _(spark, sf):
    sold = table(spark, sf, "lineitem").join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    code = F.when(F.col("p_type") == "ECONOMY", "credit_card").when(F.col("p_type") == "PROMO", "home_loan").otherwise(F.lower("p_type"))
    enrolled = sold.select(
        code.alias("product_code"), ((F.col("l_linestatus") == "O") & (F.col("p_type") != "LARGE")).alias("is_active_enrollment")
    )
    return dims.product_dim(enrolled, dims.product_lookup(spark))


@query("lookup_join", """SELECT c_custkey, coalesce(n_name, concat('nation ', c_nationkey)) AS nation, coalesce(r_name, 'OTHER') AS region FROM customer
LEFT JOIN (SELECT * FROM nation WHERE n_regionkey < 3) ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""")
def _(spark, sf):
    places = table(spark, sf, "nation").filter("n_regionkey < 3").join(
        table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    ).select("n_nationkey", F.col("n_name").alias("nation"), F.col("r_name").alias("region"))
    rows = dims.lookup_join(
        table(spark, sf, "customer").withColumnRenamed("c_nationkey", "n_nationkey"), places, "n_nationkey",
        {"nation": F.concat(F.lit("nation "), F.col("n_nationkey")), "region": "OTHER"},
    )
    return rows.select("c_custkey", "nation", "region")


@query("dim_customer_union", """SELECT 'c' || c_custkey AS customer_id, c_name AS full_name, c_acctbal AS annual_income, NULL::DOUBLE AS annual_turnover, c_mktsegment AS occupation, NULL::VARCHAR AS company_size FROM customer
UNION ALL SELECT 's' || s_suppkey, s_name, NULL, s_acctbal, NULL, 'n' || s_nationkey FROM supplier""")
def _(spark, sf):
    people = table(spark, sf, "customer").select(
        F.concat(F.lit("c"), F.col("c_custkey")).alias("customer_id"), F.col("c_name").alias("full_name"),
        F.col("c_acctbal").alias("annual_income"), F.col("c_mktsegment").alias("occupation"), F.col("c_name").alias("email"),
    )
    firms = table(spark, sf, "supplier").select(
        F.concat(F.lit("s"), F.col("s_suppkey")).alias("customer_id"), F.col("s_name").alias("full_name"),
        F.col("s_acctbal").alias("annual_turnover"), F.concat(F.lit("n"), F.col("s_nationkey")).alias("company_size"),
    )
    columns = ["customer_id", "full_name", "annual_income", "annual_turnover", "occupation", "company_size"]
    return dims.unified([people, firms], columns)


@query("dim_channel", f"""SELECT channel, CASE channel WHEN 'atm' THEN 'machine' WHEN 'online_banking' THEN 'digital' ELSE 'other' END AS channel_group, count(*) AS transactions FROM {views.TX_SQL} GROUP BY 1""")
def _(spark, sf):
    return dims.channel_dim(views.transactions(spark, sf), groups={"atm": "machine", "online_banking": "digital"})


@query("surrogate_keys", """SELECT count(*) AS row_count, count(*) AS distinct_keys FROM (SELECT DISTINCT o_orderkey FROM orders UNION ALL SELECT DISTINCT c_custkey FROM customer)""")
def _(spark, sf):
    """Keys of two record types never meet, although both count from zero."""
    keys = table(spark, sf, "orders").select(surrogate("o_orderkey", record_type="order").alias("sk")).unionByName(
        table(spark, sf, "customer").select(surrogate("c_custkey", record_type="customer").alias("sk"))
    )
    return keys.agg(F.count(F.lit(1)).alias("row_count"), F.count_distinct("sk").alias("distinct_keys"))


# ---- publication in two batches

GOLD_CUT = "1998-01-01"
GOLD_AUDIT_SQL = f"""WITH a AS (SELECT account_id, opening_date < DATE '{GOLD_CUT}' AS early, account_status FROM {views.ACCOUNTS_SQL}),
t AS (SELECT account_id, transaction_id, transaction_date < DATE '{GOLD_CUT}' AS early FROM {views.TX_SQL} WHERE is_completed)
SELECT 'b1' AS batch_id, 'dim_account' AS target_table, count(*) AS rows_read, count(*) AS rows_inserted, CAST(0 AS BIGINT) AS rows_expired FROM a WHERE early
UNION ALL SELECT 'b2', 'dim_account', count(*), count(*) FILTER (WHERE NOT early OR account_status <> 'active'), count(*) FILTER (WHERE early AND account_status <> 'active') FROM a
UNION ALL SELECT 'b1', 'fact_transaction', count(*), count(*), 0 FROM t WHERE early
UNION ALL SELECT 'b2', 'fact_transaction', count(*), count(*) FILTER (WHERE NOT early), 0 FROM t
UNION ALL SELECT b, 'dim_channel', count(DISTINCT channel), count(DISTINCT channel), 0 FROM (SELECT channel FROM {views.TX_SQL}), (VALUES ('b1'), ('b2')) v(b) GROUP BY b"""


@query("gold_run", GOLD_AUDIT_SQL)
def _(spark, sf):
    """Channels, account history and fact in two batches. In the first every known account is active; the second brings
    all accounts with their real status, and all transactions."""
    from dataclasses import replace

    from ..plans.gold import GoldTable, run_gold
    from ..session import durable, fresh_path
    from ..sources.tables import read_table

    # four tables are built from the transactions: their newest rows are found once
    accounts, moves = views.accounts(spark, sf), durable(views.transactions(spark, sf), "gold-transactions")
    early = accounts.filter(F.col("opening_date") < GOLD_CUT).withColumn("account_status", F.lit("active"))
    root, log = fresh_path(spark, "gold"), fresh_path(spark, "gold-control")

    def fact(rows):
        def build(ready):
            done = rows.filter("is_completed").withColumn("transaction_sk", surrogate("account_id", "transaction_id"))
            return pit_join(done, ready["dim_account"], "account_id", "transaction_date", ["dim_account_key"])

        return build

    batches = {"b1": (early, moves.filter(F.col("transaction_date") < GOLD_CUT), "1998-01-01"), "b2": (accounts, moves, "1999-01-01")}
    for batch, (known, rows, day) in batches.items():
        plan = [
            (GoldTable("dim_channel", "transactions", "replace", ("channel",)), lambda ready: dims.channel_dim(moves)),
            (GoldTable("dim_account", "accounts", "history", ("account_id",), ("account_status",), "opening_date", "dim_account_key"), lambda ready, known=known: known),
            (GoldTable("fact_transaction", "transactions", "upsert", ("transaction_sk",)), fact(rows)),
        ]
        ctx = replace(views.CTX, batch_id=batch, as_of=dt.date.fromisoformat(day))
        run_gold(spark, plan, root, log, ctx)
        run_gold(spark, plan, root, log, ctx)  # a repeated batch changes nothing
    return read_table(spark, f"{log}/gold_audit_log").select("batch_id", "target_table", "rows_read", "rows_inserted", "rows_expired")
