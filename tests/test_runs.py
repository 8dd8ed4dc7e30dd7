"""Incremental runs: two batches equal one full load, repeats change nothing, dead runs can be repeated."""

import datetime as dt
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from stratum.operators.dedup import latest_by
from stratum.operators.groups import with_group_count
from stratum.plans import entities
from stratum.plans.gold import GoldTable, run_gold
from stratum.plans.runs import run_silver
from stratum.sources import tables

META = "_source_file string, _ingest_timestamp timestamp, _batch_id string, _commit_sha string, year string, month string"
VOLATILE = ("created_timestamp", "updated_timestamp", "silver_load_timestamp", "silver_batch_id")


def loans(spark, data):
    rows = [(i, state, str(amount), "f", dt.datetime(2024, 1, day), "b", "c", "2024", "01") for i, state, amount, day in data]
    return spark.createDataFrame(rows, f"loan_id string, workflow_state string, requested_amount string, {META}")


DATA = [("a", "Booked", 1, 1), ("b", "Open", 2, 1), ("a", "Declined", 3, 2), ("c", "Booked", 4, 3), ("c", "Withdrawn", 5, 3)]


def test_incremental_equals_full(spark, tmp_path, ctx, rows):
    full, inc, log = (str(tmp_path / n) for n in ("full", "inc", "log"))
    bronze = loans(spark, DATA)
    run_silver("full", bronze, entities.loans, full, ["loan_id"], log, ctx)
    first = run_silver("inc", bronze.filter("day(_ingest_timestamp) = 1"), entities.loans, inc, ["loan_id"], log, replace(ctx, batch_id="b1"))
    second = run_silver("inc", bronze, entities.loans, inc, ["loan_id"], log, replace(ctx, batch_id="b2"))
    assert first == {"processed": 2, "inserted": 2, "updated": 0} and second == {"processed": 3, "inserted": 1, "updated": 1}
    clean = lambda path: rows(tables.current_snapshot(spark, path).drop(*VOLATILE))
    assert clean(full) == clean(inc)
    before = clean(inc)
    assert run_silver("inc", bronze, entities.loans, inc, ["loan_id"], log, replace(ctx, batch_id="b3"))["processed"] == 0
    assert clean(inc) == before
    audit = tables.read_table(spark, f"{log}/silver_audit_log")
    assert audit.filter("pipeline_name = 'inc'").count() == 2 and audit.filter("end_timestamp < start_timestamp").count() == 0


def test_created_time_survives_updates(spark, tmp_path, ctx):
    root, log = str(tmp_path / "t"), str(tmp_path / "log")
    bronze = loans(spark, DATA)
    run_silver("p", bronze.filter("day(_ingest_timestamp) = 1"), entities.loans, root, ["loan_id"], log, replace(ctx, batch_id="b1"))
    old = {r["loan_id"]: r["created_timestamp"] for r in tables.current_snapshot(spark, root).collect()}
    run_silver("p", bronze, entities.loans, root, ["loan_id"], log, replace(ctx, batch_id="b2"))
    new = {r["loan_id"]: (r["created_timestamp"], r["updated_timestamp"]) for r in tables.current_snapshot(spark, root).collect()}
    assert new["a"][0] == old["a"] and new["a"][1] > old["a"] and new["b"][0] == old["b"]


def test_run_after_a_dead_one(spark, tmp_path, ctx):
    """The table was published but the mark was not written: the same rows come again and change no key."""
    root, log = str(tmp_path / "t"), str(tmp_path / "log")
    bronze = loans(spark, DATA)
    tables.merge_table(entities.loans(bronze, ctx), root, ["loan_id"], "dead", preserve=("created_timestamp",))
    out = run_silver("p", bronze, entities.loans, root, ["loan_id"], log, replace(ctx, batch_id="again"))
    assert out == {"processed": 5, "inserted": 0, "updated": 3}
    assert tables.current_snapshot(spark, root).agg(F.count_distinct("loan_id"), F.count("*")).first() == (3, 3)


def test_same_batch_after_a_dead_run(spark, tmp_path, ctx):
    """Published, then stopped: the same batch id completes mark and audit and leaves the table alone."""
    root, log = str(tmp_path / "t"), str(tmp_path / "log")
    bronze = loans(spark, DATA)
    tables.merge_table(entities.loans(bronze, ctx), root, ["loan_id"], ctx.batch_id, preserve=("created_timestamp",))
    path = tables.current_path(spark, root)
    run_silver("p", bronze, entities.loans, root, ["loan_id"], log, ctx)
    assert tables.current_path(spark, root) == path
    assert tables.read_table(spark, f"{log}/batch_watermark").count() == tables.read_table(spark, f"{log}/silver_audit_log").count() == 1
    assert run_silver("p", bronze, entities.loans, root, ["loan_id"], log, replace(ctx, batch_id="next"))["processed"] == 0


def test_gold_history_and_hard_uniqueness(spark, tmp_path, ctx):
    table = GoldTable("dim", "src", "history", ("k",), ("v",), "since", "dim_key")
    frame = lambda data: spark.createDataFrame(data, "k string, v int, since date")
    root, log = str(tmp_path / "g"), str(tmp_path / "c")
    day = dt.date(2024, 1, 1)
    first = run_gold(spark, [(table, lambda _: frame([("a", 1, day), ("b", 1, day)]))], root, log, replace(ctx, batch_id="b1"))
    second = run_gold(spark, [(table, lambda _: frame([("a", 2, day), ("c", 1, day)]))], root, log, replace(ctx, batch_id="b2"))
    assert first["dim"] == {"rows_read": 2, "rows_inserted": 2, "rows_expired": 0}
    assert second["dim"] == {"rows_read": 2, "rows_inserted": 2, "rows_expired": 1}
    assert run_gold(spark, [(table, lambda _: frame([]))], root, log, replace(ctx, batch_id="b2")) == {}
    with pytest.raises(ValueError):
        run_gold(spark, [(table, lambda _: frame([("a", 3, day), ("a", 4, day)]))], root, log, replace(ctx, batch_id="b3"))
    assert tables.current_path(spark, f"{root}/dim").endswith("b2"), "nothing was published"
    assert tables.read_table(spark, f"{log}/gold_audit_log").count() == 2


def test_group_facts_follow_moves_between_groups(spark, tmp_path, ctx, rows):
    """An account that changes its customer corrects the stored rows of both customers."""
    schema = f"account_id string, customer_id string, {META}"
    row = lambda a, c, day: (a, c, "f", dt.datetime(2024, 1, day), "b", "c", "2024", "01")
    data = [row("a", "x", 1), row("b", "x", 1), row("c", "y", 1), row("d", None, 1), row("b", "y", 2), row("e", "x", 3), row("f", None, 3)]

    def build(bronze, ctx):
        newest = latest_by(bronze, ["account_id"], ["_ingest_timestamp"]).select("account_id", "customer_id")
        return with_group_count(newest, ["customer_id"], "owned")

    bronze = spark.createDataFrame(data, schema)
    root, log = str(tmp_path / "t"), str(tmp_path / "log")
    for day in (1, 2, 3):
        part = bronze.filter(F.dayofmonth("_ingest_timestamp") <= day)
        run_silver("p", part, build, root, ["account_id"], log, replace(ctx, batch_id=f"b{day}"), group=["customer_id"])
        assert rows(tables.current_snapshot(spark, root)) == rows(build(part, ctx))
