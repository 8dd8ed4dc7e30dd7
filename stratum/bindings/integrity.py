"""Deduplication, upsert, history and integrity queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.keys import date_key
from ..operators import dedup, groups, integrity, profiling, quality, ranking, scd2, upsert
from ..plans import fact as fact_plan
from ..sources import tables as sinks
from ..session import fresh_path
from . import views
from .registry import query, table

LINE_COLUMNS = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_returnflag, l_linestatus"


@query("latest_by_key", f"SELECT {LINE_COLUMNS}, CAST(l_shipdate AS DATE) AS ship_date FROM {views.LINES_SQL}")
def _(spark, sf):
    return views.lines(spark, sf).selectExpr(*LINE_COLUMNS.split(", "), "CAST(l_shipdate AS DATE) AS ship_date")


@query("exact_dedup", """SELECT doc_id, lang, source, n_chars FROM (SELECT *, row_number() OVER (PARTITION BY text
ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1""")
def _(spark, sf):
    docs = table(spark, sf, "documents")
    return dedup.drop_copies(docs, ["text"], [F.col("doc_id").asc()], digest=True).select("doc_id", "lang", "source", "n_chars")


@query("dup_groups", """SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem
GROUP BY ALL HAVING count(*) > 1""")
def _(spark, sf):
    return profiling.duplicate_groups(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("dup_rows_back", """SELECT doc_id, source, copies FROM (SELECT doc_id, source, count(*) OVER (PARTITION BY text)
AS copies FROM documents) WHERE copies > 1""")
def _(spark, sf):
    docs = table(spark, sf, "documents").withColumn("h", F.sha2("text", 256))
    return profiling.duplicate_rows(docs.drop("text"), ["h"]).select("doc_id", "source", "copies")


@query("dup_flag", """SELECT conv_id, turn, role, count(*) OVER (PARTITION BY text) > 1 AS is_duplicate
FROM conversations""")
def _(spark, sf):
    talk = table(spark, sf, "conversations").withColumn("h", F.sha2("text", 256)).drop("text")
    talk = groups.with_group_count(talk, ["h"], "n")
    return talk.select("conv_id", "turn", "role", (F.col("n") > 1).alias("is_duplicate"))


@query("primary_violation", f"""WITH a AS {views.ACCOUNTS_SQL}
SELECT account_id, customer_id, coalesce(p > 1, NULL) AS primary_account_violation, n > 1 AS multi_account_flag FROM (
SELECT *, count(*) OVER (PARTITION BY customer_id) AS n,
nullif(count(*) FILTER (WHERE account_tier = '1-URGENT') OVER (PARTITION BY customer_id), 0) AS p FROM a)""")
def _(spark, sf):
    rows = views.accounts(spark, sf)
    urgent = F.count_if(F.col("account_tier") == "1-URGENT")
    rows = groups.with_group(rows, ["customer_id"], {"p": F.nullif(urgent, F.lit(0)), "n": F.count(F.lit(1))})
    return rows.select(
        "account_id", "customer_id", (F.col("p") > 1).alias("primary_account_violation"),
        (F.col("n") > 1).alias("multi_account_flag"),
    )


@query("distinct_union", """SELECT DISTINCT id FROM (SELECT o_custkey AS id FROM orders UNION ALL
SELECT user_id AS id FROM events UNION ALL SELECT c_custkey AS id FROM customer)""")
def _(spark, sf):
    return integrity.key_union([
        table(spark, sf, "orders").select(F.col("o_custkey").alias("id")),
        table(spark, sf, "events").select(F.col("user_id").alias("id")),
        table(spark, sf, "customer").select(F.col("c_custkey").alias("id")),
    ], "id")


KNOWN_SQL = "(SELECT c_custkey, c_mktsegment FROM customer WHERE c_acctbal > 0)"


def known(spark, sf):
    """Customers in credit play the customer dimension, so that orders of the others are orphans."""
    return table(spark, sf, "customer").filter("c_acctbal > 0")


@query("orphan_flags", f"""SELECT o_orderkey, k.c_custkey IS NULL AS is_orphan_customer, e.user_id IS NULL AS is_silent
FROM orders LEFT JOIN {KNOWN_SQL} k ON o_custkey = c_custkey
LEFT JOIN (SELECT DISTINCT user_id FROM events) e ON o_custkey = user_id""")
def _(spark, sf):
    rows = integrity.existence_flag(table(spark, sf, "orders"), known(spark, sf), {"o_custkey": "c_custkey"}, "is_orphan_customer")
    rows = integrity.existence_flag(rows, table(spark, sf, "events"), {"o_custkey": "user_id"}, "is_silent")
    return rows.select("o_orderkey", "is_orphan_customer", "is_silent")


@query("orphan_anti", f"""SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM {KNOWN_SQL})""")
def _(spark, sf):
    rows = integrity.orphans(table(spark, sf, "orders"), known(spark, sf), {"o_custkey": "c_custkey"})
    return rows.select("o_orderkey", "o_custkey", "o_totalprice")


@query("orphan_trimmed_key", """SELECT c_custkey, c_mktsegment FROM customer WHERE upper(trim(c_mktsegment)) NOT IN
(SELECT 'AUTOMOBILE' UNION SELECT 'MACHINERY')""")
def _(spark, sf):
    segments = table(spark, sf, "customer").filter(F.col("c_mktsegment").isin("AUTOMOBILE", "MACHINERY"))
    padded = segments.select(F.concat(F.lit("  "), F.lower("c_mktsegment"), F.lit(" ")).alias("seg")).distinct()
    rows = integrity.orphans(table(spark, sf, "customer"), padded, {"c_mktsegment": F.upper(F.trim("seg"))})
    return rows.select("c_custkey", "c_mktsegment")


@query("orphan_chained", f"""SELECT o_orderkey, o_custkey FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM {KNOWN_SQL}) AND o_custkey NOT IN (SELECT user_id FROM events)""")
def _(spark, sf):
    rows = integrity.orphans_everywhere(table(spark, sf, "orders"), [
        (known(spark, sf), {"o_custkey": "c_custkey"}), (table(spark, sf, "events"), {"o_custkey": "user_id"}),
    ])
    return rows.select("o_orderkey", "o_custkey")


@query("orphan_found_elsewhere", f"""SELECT o_orderkey, o_custkey FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM {KNOWN_SQL}) AND o_custkey IN (SELECT user_id FROM events)""")
def _(spark, sf):
    rows = integrity.found_elsewhere(
        table(spark, sf, "orders"), (known(spark, sf), {"o_custkey": "c_custkey"}),
        (table(spark, sf, "events"), {"o_custkey": "user_id"}),
    )
    return rows.select("o_orderkey", "o_custkey")


@query("rows_of_sample", """SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN
(SELECT o_custkey FROM orders GROUP BY 1 ORDER BY count(*) DESC, o_custkey LIMIT 5)""")
def _(spark, sf):
    orders = table(spark, sf, "orders")
    busiest = profiling.frequency(orders, ["o_custkey"], top_n=5)
    return integrity.rows_of_sample(orders, "o_custkey", busiest).select("o_orderkey", "o_custkey")


@query("split_by_type", """SELECT part, count(*) AS row_count, round(sum(c_acctbal), 2) AS balance FROM (
SELECT c_acctbal, CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'individual'
WHEN c_mktsegment IN ('MACHINERY', 'AUTOMOBILE') THEN 'non_individual' END AS part FROM customer)
WHERE part IS NOT NULL GROUP BY part""")
def _(spark, sf):
    parts = integrity.split_by(table(spark, sf, "customer"), "c_mktsegment", {
        "individual": ["HOUSEHOLD"], "non_individual": ["MACHINERY", "AUTOMOBILE"],
    })
    both = parts["individual"].withColumn("part", F.lit("individual")).unionByName(
        parts["non_individual"].withColumn("part", F.lit("non_individual"))
    )
    return both.groupBy("part").agg(F.count(F.lit(1)).alias("row_count"), F.round(F.sum("c_acctbal"), 2).alias("balance"))


# ---- upsert

TARGET_SQL = "(SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01')"
SOURCE_SQL = """(SELECT o_orderkey, o_custkey, 'X' AS o_orderstatus, o_totalprice * 2 AS o_totalprice, 'NEW' AS o_orderpriority
FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01')"""


def order_batches(spark, sf):
    orders = table(spark, sf, "orders")
    columns = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
    target = orders.filter("o_orderdate < timestamp_ntz'1999-01-01 00:00:00'").select(*columns)
    source = orders.filter("o_orderdate >= timestamp_ntz'1998-01-01 00:00:00'").select(
        "o_orderkey", "o_custkey", F.lit("X").alias("o_orderstatus"), (F.col("o_totalprice") * 2).alias("o_totalprice"),
        F.lit("NEW").alias("o_orderpriority"),
    )
    return target, source


UPSERT_SQL = f"""SELECT coalesce(s.o_orderkey, t.o_orderkey) AS o_orderkey, coalesce(s.o_custkey, t.o_custkey) AS o_custkey,
coalesce(s.o_orderstatus, t.o_orderstatus) AS o_orderstatus, coalesce(s.o_totalprice, t.o_totalprice) AS o_totalprice,
coalesce(t.o_orderpriority, s.o_orderpriority) AS o_orderpriority
FROM {TARGET_SQL} t FULL JOIN {SOURCE_SQL} s ON t.o_orderkey = s.o_orderkey"""


@query("upsert_single", UPSERT_SQL)
def _(spark, sf):
    target, source = order_batches(spark, sf)
    return upsert.upsert(target, source, ["o_orderkey"], preserve=["o_orderpriority"])


@query("upsert_counts", f"""SELECT CAST(sum(CAST(t.o_orderkey IS NULL AS INT)) AS BIGINT) AS inserted,
CAST(sum(CAST(t.o_orderkey IS NOT NULL AND s.o_orderkey IS NOT NULL AS INT)) AS BIGINT) AS updated,
CAST(sum(CAST(s.o_orderkey IS NULL AS INT)) AS BIGINT) AS untouched
FROM {TARGET_SQL} t FULL JOIN {SOURCE_SQL} s ON t.o_orderkey = s.o_orderkey""")
def _(spark, sf):
    return upsert.upsert_counts(*order_batches(spark, sf), ["o_orderkey"])


@query("upsert_composite", f"""WITH d AS {views.LINES_SQL}, t AS (SELECT * FROM d WHERE l_returnflag <> 'R'),
s AS (SELECT * FROM d WHERE l_linestatus = 'O')
SELECT coalesce(s.l_orderkey, t.l_orderkey) AS l_orderkey, coalesce(s.l_linenumber, t.l_linenumber) AS l_linenumber,
CASE WHEN s.l_orderkey IS NULL THEN t.l_quantity WHEN t.l_orderkey IS NULL THEN s.l_quantity + 100 ELSE -1.0 END AS l_quantity,
coalesce(s.l_linestatus, t.l_linestatus) AS l_linestatus
FROM t FULL JOIN s ON t.l_orderkey = s.l_orderkey AND t.l_linenumber = s.l_linenumber""")
def _(spark, sf):
    columns = ["l_orderkey", "l_linenumber", "l_quantity", "l_linestatus"]
    rows = views.lines(spark, sf)
    target = rows.filter("l_returnflag <> 'R'").select(*columns)
    source = rows.filter("l_linestatus = 'O'").select(*columns).withColumn("l_quantity", F.col("l_quantity") + 100)
    return upsert.upsert(target, source, ["l_orderkey", "l_linenumber"], touch={"l_quantity": F.lit(-1.0)})


@query("merge_table", UPSERT_SQL)
def _(spark, sf):
    """Two published snapshots; the log names the second."""
    target, source = order_batches(spark, sf)
    root = fresh_path(spark, "merge")
    sinks.merge_table(target, root, ["o_orderkey"], "b1")
    sinks.merge_table(source, root, ["o_orderkey"], "b2", preserve=["o_orderpriority"])
    return sinks.current_snapshot(spark, root)


SMALL_SQL = """(SELECT o_orderkey, o_custkey, 'S' AS o_orderstatus, 0.0 AS o_totalprice, 'NEW' AS o_orderpriority FROM orders
WHERE o_custkey IN (SELECT min(o_custkey) FROM orders))"""


@query("merge_increment", f"""SELECT t.o_orderkey, t.o_custkey, coalesce(s.o_orderstatus, t.o_orderstatus) AS o_orderstatus,
coalesce(s.o_totalprice, t.o_totalprice) AS o_totalprice, coalesce(s.o_orderpriority, t.o_orderpriority) AS o_orderpriority
FROM orders t LEFT JOIN {SMALL_SQL} s ON t.o_orderkey = s.o_orderkey""")
def _(spark, sf):
    """All orders, then one customer's orders again: a bucketed table whose second batch rewrites a few buckets."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    first = orders.agg(F.min("o_custkey")).first()[0]
    again = orders.filter(F.col("o_custkey") == first).withColumns({
        "o_orderstatus": F.lit("S"), "o_totalprice": F.lit(0.0), "o_orderpriority": F.lit("NEW"),
    })
    root = fresh_path(spark, "merge")
    sinks.merge_table(orders, root, ["o_orderkey"], "b1")
    sinks.merge_table(again, root, ["o_orderkey"], "b2")
    return sinks.current_snapshot(spark, root)


@query("backfill_column", """SELECT c_custkey, c_acctbal > 0 AND c_mktsegment = 'HOUSEHOLD' AS is_flagged, FALSE AS is_initial_deposit
FROM customer""")
def _(spark, sf):
    rows = table(spark, sf, "customer").select(
        "c_custkey", F.when((F.col("c_mktsegment") == "HOUSEHOLD") & (F.col("c_acctbal") > 0), True).alias("is_flagged")
    )
    return upsert.backfill(upsert.backfill(rows, "is_flagged", False), "is_initial_deposit", False)


# ---- history

CHANGE_DAY = "1998-06-30"
FIRST_SQL = f"(SELECT * FROM {views.ACCOUNTS_SQL} WHERE opening_date < DATE '1998-06-30')"
NEXT_SQL = f"""(SELECT account_id, customer_id, opening_date,
CASE WHEN account_tier = '1-URGENT' THEN 'frozen' ELSE account_status END AS account_status, account_tier,
CASE WHEN account_tier = '5-LOW' THEN NULL ELSE credit_limit END AS credit_limit FROM {views.ACCOUNTS_SQL})"""
HISTORY_SQL = f"""(
SELECT f.account_id, f.opening_date AS effective_from, CASE WHEN changed THEN DATE '1998-06-29' ELSE DATE '9999-12-31' END AS effective_to,
NOT changed AS is_current, f.account_status, f.credit_limit FROM (SELECT f.*, (f.account_status IS DISTINCT FROM n.account_status
OR f.credit_limit IS DISTINCT FROM n.credit_limit) AS changed FROM {FIRST_SQL} f JOIN {NEXT_SQL} n USING (account_id)) f
UNION ALL
SELECT n.account_id, DATE '1998-06-30', DATE '9999-12-31', TRUE, n.account_status, n.credit_limit
FROM {NEXT_SQL} n LEFT JOIN {FIRST_SQL} f USING (account_id) WHERE f.account_id IS NULL
OR f.account_status IS DISTINCT FROM n.account_status OR f.credit_limit IS DISTINCT FROM n.credit_limit)"""
KEYED_SQL = f"(SELECT sha256(concat(account_id, '|', effective_from)) AS dim_account_key, * FROM {HISTORY_SQL})"


def account_snapshots(spark, sf):
    """Accounts opened before the change day, and a later snapshot of all accounts."""
    rows = views.accounts(spark, sf)
    later = rows.withColumns({
        "account_status": F.when(F.col("account_tier") == "1-URGENT", "frozen").otherwise(F.col("account_status")),
        "credit_limit": F.when(F.col("account_tier") != "5-LOW", F.col("credit_limit")),
    })
    return rows.filter(F.col("opening_date") < CHANGE_DAY), later


def account_history(spark, sf):
    """Accounts opened before the change day, then one later snapshot of all accounts."""
    early, later = account_snapshots(spark, sf)
    first = scd2.scd2_init(early, "account_id", "opening_date", "dim_account_key")
    return scd2.scd2_apply(first, later, "account_id", ["account_status", "credit_limit"], CHANGE_DAY, "dim_account_key")


@query("history_table", f"""SELECT dim_account_key, account_id, effective_from, effective_to, is_current, account_status, credit_limit
FROM {KEYED_SQL}""")
def _(spark, sf):
    """The same history through a bucketed table, two batches and one that brings nothing new."""
    first, later = account_snapshots(spark, sf)
    root = fresh_path(spark, "history")
    for batch, rows in (("b1", first), ("b2", later), ("b3", later)):
        sinks.merge_history(rows, root, "account_id", ["account_status", "credit_limit"], "opening_date", CHANGE_DAY, batch, "dim_account_key")
    return sinks.current_snapshot(spark, root).drop("customer_id", "opening_date", "account_tier")


@query("scd2_init", f"""SELECT sha256(concat(account_id, '|', opening_date)) AS dim_key, account_id, opening_date AS effective_from,
DATE '9999-12-31' AS effective_to, TRUE AS is_current, account_status FROM {views.ACCOUNTS_SQL}""")
def _(spark, sf):
    rows = views.accounts(spark, sf).select("account_id", "opening_date", "account_status")
    return scd2.scd2_init(rows, "account_id", "opening_date").drop("opening_date")


@query("scd2_apply", f"""SELECT dim_account_key, account_id, effective_from, effective_to, is_current, account_status, credit_limit
FROM {KEYED_SQL}""")
def _(spark, sf):
    return account_history(spark, sf).drop("customer_id", "opening_date", "account_tier")


@query("scd2_from_events", """SELECT user_id, d AS effective_from, coalesce(lead(d) OVER w - 1, DATE '9999-12-31') AS effective_to,
lead(d) OVER w IS NULL AS is_current, event_type FROM (SELECT *, CAST(ts AS DATE) AS d, row_number() OVER
(PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1
WINDOW w AS (PARTITION BY user_id ORDER BY d)""")
def _(spark, sf):
    rows = scd2.scd2_from_events(
        table(spark, sf, "events"), "user_id", "ts", F.trunc("effective_from", "week"), tiebreak=["event_id"]
    )
    return rows.select("user_id", "effective_from", "effective_to", "is_current", "event_type")


@query("version_history", """SELECT l_orderkey, l_linenumber, count(*) AS versions, CAST(min(l_shipdate) AS DATE) AS first_seen,
CAST(max(l_shipdate) AS DATE) AS last_seen FROM lineitem GROUP BY ALL""")
def _(spark, sf):
    rows = table(spark, sf, "lineitem").withColumn("day", F.col("l_shipdate").cast("date"))
    return scd2.version_history(rows, ["l_orderkey", "l_linenumber"], "day")


@query("version_histogram", f"""SELECT versions, count(*) AS key_count FROM (SELECT account_id, count(*) AS versions
FROM {HISTORY_SQL} GROUP BY 1) GROUP BY 1""")
def _(spark, sf):
    return profiling.count_histogram(account_history(spark, sf), ["account_id"], "versions")


PATCHED_SQL = f"""(SELECT *, CASE WHEN effective_from = min(effective_from) OVER (PARTITION BY account_id)
THEN DATE '0001-01-01' ELSE effective_from END AS patched_from FROM {KEYED_SQL})"""


@query("pit_join", f"""SELECT t.account_id, t.transaction_id, t.transaction_date, h.dim_account_key, h.account_status
FROM {views.TX_SQL} t LEFT JOIN {PATCHED_SQL} h ON t.account_id = h.account_id
AND t.transaction_date BETWEEN h.patched_from AND h.effective_to""")
def _(spark, sf):
    tx = views.transactions(spark, sf).select("account_id", "transaction_id", "transaction_date")
    return scd2.pit_join(tx, account_history(spark, sf), "account_id", "transaction_date", ["dim_account_key", "account_status"])


FACT_SQL = f"""SELECT t.account_id, t.transaction_id, t.transaction_date,
CAST(strftime(t.transaction_date, '%Y%m%d') AS INTEGER) AS date_key, h.dim_account_key,
sha256(CAST(c.c_custkey AS VARCHAR)) AS primary_customer_sk,
CASE WHEN t.is_debit THEN -t.amount ELSE t.amount END AS transaction_amount, abs(t.amount) AS transaction_amount_abs,
t.transaction_cost AS fee_amount, t.channel, t.is_debit
FROM {views.TX_SQL} t LEFT JOIN {PATCHED_SQL} h ON t.account_id = h.account_id
AND t.transaction_date BETWEEN h.patched_from AND h.effective_to
LEFT JOIN orders o ON t.account_id = o.o_orderkey AND o.o_orderpriority <> '5-LOW'
LEFT JOIN customer c ON o.o_custkey = c.c_custkey WHERE t.is_completed"""


FACT_COLUMNS = (
    "account_id transaction_id transaction_date date_key dim_account_key primary_customer_sk transaction_amount "
    "transaction_amount_abs fee_amount channel is_debit"
).split()


def transaction_fact(spark, sf, columns=tuple(FACT_COLUMNS), history_columns=()):
    rows = views.accounts(spark, sf)
    holders = rows.filter("account_tier <> '5-LOW'").select("account_id", "customer_id", F.lit("primary_holder").alias("signatory_role"))
    customers = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("customer_id"), F.sha2(F.col("c_custkey").cast("string"), 256).alias("customer_sk")
    )
    owners = fact_plan.account_owner(holders, rows, customers)
    return fact_plan.transaction_fact(
        views.transactions(spark, sf), account_history(spark, sf), owners, columns, history_columns
    )


@query("fact_transactions", FACT_SQL)
def _(spark, sf):
    return transaction_fact(spark, sf)


@query("fact_fk_coverage", f"""WITH f AS ({FACT_SQL}), n AS (SELECT 'date_key' AS foreign_key, count(*) AS checked,
count(*) - count(date_key) AS nulls FROM f UNION ALL SELECT 'dim_account_key', count(*), count(*) - count(dim_account_key) FROM f
UNION ALL SELECT 'primary_customer_sk', count(*), count(*) - count(primary_customer_sk) FROM f)
SELECT foreign_key, checked, nulls, nulls * 100.0::DOUBLE / checked AS pct, CASE WHEN nulls * 100.0::DOUBLE / checked < 1 THEN 'ok'
WHEN nulls * 100.0::DOUBLE / checked < 5 THEN 'warn' ELSE 'fail' END AS verdict FROM n""")
def _(spark, sf):
    return quality.fk_coverage(transaction_fact(spark, sf), ["date_key", "dim_account_key", "primary_customer_sk"])


@query("fact_monthly_by_segment", f"""WITH f AS ({FACT_SQL})
SELECT date_trunc('month', f.transaction_date)::DATE AS month, c.c_mktsegment AS segment, count(*) AS transactions,
round(sum(f.transaction_amount), 2) AS net_amount, round(sum(f.transaction_amount_abs), 2) AS gross_amount
FROM f JOIN orders o ON f.account_id = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY ALL""")
def flagship(spark, sf):
    """Newest transactions, valid account version, signed amounts, monthly sums by customer segment."""
    fact = transaction_fact(
        spark, sf, ["transaction_date", "customer_id", "transaction_amount", "transaction_amount_abs"], ["customer_id"]
    )
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("customer_id"), F.col("c_mktsegment").alias("segment"))
    # one row per customer and month meets the customers; a busy customer is small by then
    cells = fact.groupBy("customer_id", F.trunc("transaction_date", "month").alias("month")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("transaction_amount").alias("net"), F.sum("transaction_amount_abs").alias("gross")
    )
    return (
        cells.join(customers, "customer_id").groupBy("month", "segment")
        .agg(F.sum("n").alias("transactions"), F.round(F.sum("net"), 2).alias("net_amount"),
             F.round(F.sum("gross"), 2).alias("gross_amount"))
    )


@query("fact_products", f"""WITH t AS (SELECT account_id, transaction_id, transaction_date FROM {views.TX_SQL} WHERE is_completed),
e AS (SELECT DISTINCT l_orderkey AS account_id, CAST(l_shipdate AS DATE) AS d, p_type FROM lineitem JOIN part ON l_partkey = p_partkey),
m AS (SELECT account_id, d, min(p_type) AS p_type FROM e GROUP BY ALL)
SELECT t.account_id, t.transaction_id, arg_max(m.p_type, m.d) AS product_code FROM t LEFT JOIN m
ON t.account_id = m.account_id AND m.d <= t.transaction_date GROUP BY ALL""")
def _(spark, sf):
    tx = views.transactions(spark, sf).filter("is_completed").select("account_id", "transaction_id", "transaction_date")
    bought = table(spark, sf, "lineitem").join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_orderkey").alias("account_id"), F.col("l_shipdate").cast("date").alias("enrollment_date"),
        F.col("p_type").alias("product_code"),
    )
    return fact_plan.fact_products(tx, bought).select("account_id", "transaction_id", "product_code")


@query("asof_join", """SELECT o_orderkey, t.event_type FROM orders LEFT JOIN (SELECT user_id, CAST(ts AS DATE) - 8500 AS d, arg_max(event_type, (ts, event_id)) AS event_type FROM events GROUP BY ALL) t
ON o_custkey = t.user_id AND t.d = (SELECT max(CAST(ts AS DATE) - 8500) FROM events e WHERE e.user_id = o_custkey AND CAST(ts AS DATE) - 8500 <= CAST(o_orderdate AS DATE))""")
def _(spark, sf):
    """The last event of the customer before the order (events moved back to the time of the orders)."""
    daily = dedup.latest_by(
        table(spark, sf, "events").withColumn("day", F.date_sub(F.col("ts").cast("date"), 8500)), ["user_id", "day"], ["ts", "event_id"]
    )
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("user_id"), "o_orderdate")
    return ranking.asof_join(orders, daily, "user_id", "o_orderdate", "day", ["event_type"]).select("o_orderkey", "event_type")


@query("date_keys", """SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key FROM orders""")
def _(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", date_key("o_orderdate").alias("date_key"))
