"""High-water marks, increments, late rows and reconciliation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import control, quality
from . import views
from .registry import query, table

# every day of events is one batch; a day with more errors than purchases is a failed run
RUNS_SQL = """(SELECT 'events' AS pipeline_name, CAST(ts AS DATE)::VARCHAR AS batch_id, max(ts) AS watermark_value, min(ts) AS processed_timestamp,
CASE WHEN count(*) FILTER (WHERE event_type = 'error') > count(*) FILTER (WHERE event_type = 'purchase') THEN 'FAILED' ELSE 'SUCCESS' END AS status
FROM events WHERE ts < TIMESTAMP '2024-01-16' GROUP BY CAST(ts AS DATE))"""
ALL_RUNS_SQL = RUNS_SQL.replace("WHERE ts < TIMESTAMP '2024-01-16' ", "")


def stored(spark, sf):
    """What earlier runs have read; the rest of the table is what comes next."""
    return table(spark, sf, "events").filter("ts < timestamp_ntz'2024-01-16 00:00:00'")


def runs(events):
    errors, purchases = (F.count_if(F.col("event_type") == k) for k in ("error", "purchase"))
    return events.groupBy(F.col("ts").cast("date").cast("string").alias("batch_id")).agg(
        F.lit("events").alias("pipeline_name"), F.max("ts").alias("watermark_value"),
        F.min("ts").alias("processed_timestamp"), F.when(errors > purchases, "FAILED").otherwise("SUCCESS").alias("status"),
    )


@query("watermark_value", f"""SELECT 'success' AS rule, max(watermark_value) FILTER (WHERE status = 'SUCCESS') AS watermark_value FROM {ALL_RUNS_SQL}
UNION ALL SELECT 'any', max(watermark_value) FROM {ALL_RUNS_SQL} UNION ALL SELECT 'latest', arg_max(watermark_value, processed_timestamp) FROM {ALL_RUNS_SQL}
UNION ALL SELECT 'never_run', NULL""")
def _(spark, sf):
    log = runs(table(spark, sf, "events"))
    rows = [control.last_watermark(log, "events", how).select(F.lit(how).alias("rule"), "watermark_value")
            for how in ("success", "any", "latest")]
    rows.append(control.last_watermark(log, "other").select(F.lit("never_run").alias("rule"), "watermark_value"))
    return rows[0].unionByName(rows[1]).unionByName(rows[2]).unionByName(rows[3])


INCREMENT_SQL = f"(SELECT * FROM events WHERE ts > (SELECT max(watermark_value) FILTER (WHERE status = 'SUCCESS') FROM {RUNS_SQL}))"


def increment(spark, sf):
    last = control.watermark_of(runs(stored(spark, sf)), "events")
    return control.incremental(table(spark, sf, "events"), "ts", last)


@query("incremental_filter", f"SELECT event_id, ts, user_id, event_type, value FROM {INCREMENT_SQL}")
def _(spark, sf):
    return increment(spark, sf).drop("props")


@query("next_watermark", f"SELECT max(ts) AS watermark_value FROM {INCREMENT_SQL}")
def _(spark, sf):
    return control.next_watermark(increment(spark, sf), "ts")


@query("control_reset", f"SELECT batch_id, watermark_value, status FROM {ALL_RUNS_SQL} WHERE batch_id <> '2024-01-03'")
def _(spark, sf):
    kept = control.reset_pipeline(runs(table(spark, sf, "events")), "events", "2024-01-03")
    return kept.select("batch_id", "watermark_value", "status")


@query("touched_history", f"""SELECT event_id, user_id FROM {INCREMENT_SQL} UNION ALL SELECT event_id, user_id FROM events
WHERE ts < TIMESTAMP '2024-01-16' AND user_id IN (SELECT user_id FROM {INCREMENT_SQL})""")
def _(spark, sf):
    return control.touched_history(stored(spark, sf), increment(spark, sf), ["user_id"]).select("event_id", "user_id")


@query("late_rows", """SELECT event_id, value, props, FALSE AS is_late FROM events WHERE event_type <> 'purchase'
UNION ALL SELECT event_id, value, NULL, TRUE FROM events WHERE event_type = 'purchase'""")
def _(spark, sf):
    events = table(spark, sf, "events").select("event_id", "event_type", "value", "props")
    late = events.filter("event_type = 'purchase'").drop("props")
    return control.add_late_rows(events.filter("event_type <> 'purchase'"), late, "is_late").drop("event_type")


@query("reconcile_layers", f"""SELECT b.row_count AS before_row_count, b.amount AS before_amount, a.row_count AS after_row_count,
a.amount AS after_amount, a.row_count - b.row_count AS row_gap, abs(a.row_count - b.row_count) * 100 > b.row_count * 5 AS row_alert,
a.amount <> b.amount AS amount_alert FROM (SELECT count(*) AS row_count, round(sum(l_extendedprice), 2) AS amount FROM lineitem) b,
(SELECT count(*) AS row_count, round(sum(l_extendedprice), 2) AS amount FROM {views.LINES_SQL}) a""")
def _(spark, sf):
    return control.reconcile(table(spark, sf, "lineitem"), views.lines(spark, sf), "l_extendedprice", 5.0)


@query("run_summary", f"""SELECT rows_in, rows_out, rows_in - rows_out AS rows_removed FROM
(SELECT count(*) AS rows_in FROM lineitem), (SELECT count(*) AS rows_out FROM {views.LINES_SQL})""")
def _(spark, sf):
    return quality.run_summary(table(spark, sf, "lineitem"), views.lines(spark, sf))
