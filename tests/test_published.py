"""Bucketed tables: results, counts, and files that stay."""

import datetime as dt
import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from stratum.operators.scd2 import scd2_apply, scd2_init
from stratum.operators.upsert import upsert, upsert_placed
from stratum.sources import published, tables

KINDS = "k long, v string, created int"


def files_of(state):
    return {b: {f: os.path.getmtime(os.path.join(p, f)) for f in os.listdir(p)} for b, p in state.folders.items()}


@pytest.fixture()
def table(spark, tmp_path):
    root = str(tmp_path / "t")
    df = spark.range(4000).select(F.col("id").alias("k"), F.lit("old").alias("v"), F.lit(1).alias("created"))
    assert tables.merge_table(df, root, ["k"], "b1", buckets=32) == {"inserted": 4000, "updated": 0, "untouched": 0}
    return root, df


def test_small_merge_leaves_other_buckets(spark, table, rows):
    root, df = table
    before = published.current_state(spark, root)
    small = spark.createDataFrame([(7, "new", 2), (5000, "new", 2)], KINDS)
    assert tables.merge_table(small, root, ["k"], "b2", preserve=["created"]) == {"inserted": 1, "updated": 1, "untouched": 3999}
    after = published.current_state(spark, root)
    moved = {b for b, p in after.folders.items() if before.folders.get(b) != p}
    assert 1 <= len(moved) <= 2 and len(after.folders) == 32 and after.rows == 4001
    old, new = files_of(before), files_of(after)
    assert all(old[b] == new[b] for b in after.folders if b not in moved)
    assert rows(tables.current_snapshot(spark, root)) == rows(upsert(df, small, ["k"], ["created"]))
    # only the touched buckets are scanned
    scanned = published.read_state(spark, after, sorted(moved)).inputFiles()
    assert {f.split(published.BUCKET + "=")[1].split("/")[0] for f in scanned} == {str(b) for b in moved}


def test_many_batches_equal_one_upsert_after_the_other(spark, table, rows):
    root, want = table
    for n in range(1, 5):
        batch = spark.range(n * 900, n * 900 + 500, n).select(F.col("id").alias("k"), F.lit(f"b{n}").alias("v"), F.lit(n).alias("created"))
        counts = tables.merge_table(batch, root, ["k"], f"n{n}", preserve=["created"], touch={"v": F.lit("touched")})
        size = want.count()
        want = spark.createDataFrame(upsert(want, batch, ["k"], ["created"], {"v": F.lit("touched")}).collect(), KINDS)
        assert counts["inserted"] == want.count() - size and counts["inserted"] + counts["updated"] == batch.count()
        assert counts["updated"] + counts["untouched"] == size
    assert rows(tables.current_snapshot(spark, root)) == rows(want)


def test_null_keys_match_nothing_and_none_is_lost(spark, tmp_path, rows):
    root = str(tmp_path / "n")
    first = spark.createDataFrame([(None, "a"), (1, "b"), (None, "c")], "k long, v string")
    second = spark.createDataFrame([("z", None), ("y", 1), ("a", None)], "v string, k long").withColumn("extra", F.lit(1))
    tables.merge_table(first, root, ["k"], "b1")
    assert tables.merge_table(second, root, ["k"], "b2") == {"inserted": 2, "updated": 1, "untouched": 2}
    third = spark.createDataFrame([(None, "q"), (2, "w")], "k long, v string")
    assert tables.merge_table(third, root, ["k"], "b3") == {"inserted": 2, "updated": 0, "untouched": 5}
    got = tables.current_snapshot(spark, root)
    assert got.columns == ["k", "v", "extra"]
    assert rows(got) == sorted(
        [(None, "a", None), (None, "c", None), (1, "y", 1), (None, "z", 1), (None, "a", 1), (None, "q", None), (2, "w", None)], key=repr,
    )


def test_new_column_and_changed_type(spark, table):
    root, _ = table
    tables.merge_table(spark.createDataFrame([(1, "x", 3, 2.5)], KINDS + ", score double"), root, ["k"], "b2")
    got = tables.current_snapshot(spark, root)
    assert got.schema["score"].dataType.simpleString() == "double" and got.filter("score is not null").count() == 1 and got.count() == 4000
    with pytest.raises(ValueError, match="column v is string"):
        tables.merge_table(spark.createDataFrame([(1, 5)], "k long, v int"), root, ["k"], "b3")
    assert tables.current_snapshot(spark, root).count() == 4000


def test_dead_run_and_repeated_batch(spark, table, rows):
    root, df = table
    batch = spark.createDataFrame([(3, "new", 9)], KINDS)
    # a run that died after writing and before its log rows: nobody reads it, the repeated one overwrites it
    batch.withColumn(published.BUCKET, F.lit(0)).write.partitionBy(published.BUCKET).parquet(f"{root}/batch=b2")
    assert rows(tables.current_snapshot(spark, root)) == rows(df)
    assert tables.merge_table(batch, root, ["k"], "b2")["updated"] == 1
    with pytest.raises(ValueError, match="already published"):
        tables.merge_table(batch, root, ["k"], "b2")
    assert tables.current_snapshot(spark, root).filter("v = 'new'").count() == 1


def test_whole_snapshot_becomes_bucketed(spark, tmp_path, rows):
    root = str(tmp_path / "w")
    df = spark.range(50).select(F.col("id").alias("k"), F.lit("a").alias("v"))
    tables.publish(df, root, "b1")
    assert tables.merge_table(spark.createDataFrame([(3, "b"), (99, "b")], "k long, v string"), root, ["k"], "b2") == {
        "inserted": 1, "updated": 1, "untouched": 49,
    }
    assert tables.current_snapshot(spark, root).count() == 51
    # and a later whole snapshot replaces the buckets
    tables.publish(df, root, "b3")
    assert rows(tables.current_snapshot(spark, root)) == rows(df)


def test_vacuum_keeps_what_is_read(spark, table, rows):
    root, _ = table
    tables.merge_table(spark.createDataFrame([(7, "new", 2)], KINDS), root, ["k"], "b2")
    want = rows(tables.current_snapshot(spark, root))
    gone = tables.vacuum(spark, root)
    assert len(gone) == 1 and "batch=b1" in gone[0] and not os.path.exists(gone[0])
    assert rows(tables.current_snapshot(spark, root)) == want and tables.vacuum(spark, root) == []


def test_history_rewrites_changed_buckets_only(spark, tmp_path, rows):
    root = str(tmp_path / "h")
    first = spark.range(600).select(F.col("id").alias("k"), F.lit("a").alias("s"), F.lit(dt.date(2020, 1, 1)).alias("since"))
    assert tables.merge_history(first, root, "k", ["s"], "since", "2020-01-01", "b1", buckets=16) == {"inserted": 600, "expired": 0}
    second = first.withColumn("s", F.when(F.col("k") == 5, "b").otherwise(F.col("s"))).unionByName(
        spark.createDataFrame([(1000, "n", dt.date(2021, 1, 1))], first.schema)
    )
    before = published.current_state(spark, root)
    assert tables.merge_history(second, root, "k", ["s"], "since", "2021-02-01", "b2") == {"inserted": 2, "expired": 1}
    after = published.current_state(spark, root)
    assert 1 <= sum(before.folders[b] != after.folders[b] for b in before.folders) <= 2
    want = scd2_apply(scd2_init(first, "k", "since"), second, "k", ["s"], "2021-02-01")
    assert rows(tables.current_snapshot(spark, root)) == rows(want)
    # the same snapshot once more changes nothing, and the batch is on record
    assert tables.merge_history(second, root, "k", ["s"], "since", "2021-03-01", "b3") == {"inserted": 0, "expired": 0}
    assert published.current_state(spark, root).folders == after.folders and tables.is_published(spark, root, "b3")
    assert rows(tables.current_snapshot(spark, root)) == rows(want)


def test_counts_survive_a_failing_task(spark, tmp_path):
    """Rows are counted in the tasks that write them; a first attempt that dies leaves no count."""
    seen = str(tmp_path / "seen")
    os.makedirs(seen)

    def flaky(batches):
        from pyspark import TaskContext

        context = TaskContext.get()
        for batch in batches:
            yield batch
        mark = f"{seen}/{context.partitionId()}"
        if context.partitionId() == 1 and not os.path.exists(mark):
            open(mark, "w").close()
            raise RuntimeError("lost")

    df = spark.range(0, 1000, 1, 4).mapInArrow(flaky, "id long")
    if spark.sparkContext.master.startswith("local[") and "," not in spark.sparkContext.master:
        with pytest.raises(Exception):  # a local master does not repeat tasks: the write fails and is run again
            published.write_counted(df, str(tmp_path / "out"), {})
    assert published.write_counted(df, str(tmp_path / "out"), {"even": F.count_if(F.col("id") % 2 == 0)}) == {"rows": 1000, "even": 500}


def test_first_load_writes_its_rows_once(spark, tmp_path, monkeypatch):
    def no_step(df, name="cut"):
        raise AssertionError("written beside the table")

    monkeypatch.setattr(published, "durable", no_step)
    root = str(tmp_path / "once")
    rows = spark.createDataFrame([(1, "a"), (None, "b"), (None, "b"), (3, "c")], "k long, v string")
    assert tables.merge_table(rows, root, ["k"], "b1") == {"inserted": 4, "updated": 0, "untouched": 0}
    # a source read from files is not written again either; nulls in the key match nothing
    new = spark.createDataFrame([(1, "x"), (None, "b"), (9, "n")], "k long, v string")
    assert tables.merge_table(new, root, ["k"], "b2", written=True) == {"inserted": 2, "updated": 1, "untouched": 3}
    got = sorted(map(tuple, tables.current_snapshot(spark, root).collect()), key=repr)
    assert got == sorted([(1, "x"), (None, "b"), (None, "b"), (None, "b"), (3, "c"), (9, "n")], key=repr)


def test_repeated_keys_of_a_first_load_publish_nothing(spark, tmp_path):
    root = str(tmp_path / "twice")
    with pytest.raises(ValueError, match="not unique"):
        tables.merge_table(spark.createDataFrame([(1, "a"), (1, "b")], "k long, v string"), root, ["k"], "b1")
    assert tables.current_snapshot(spark, root) is None and not (tmp_path / "twice" / "batch=b1").exists()


def test_merge_deals_rows_once(spark):
    rows = spark.range(100).selectExpr("id AS k", "id * 2 AS v", "CAST(id % 4 AS int) AS b")
    merged = upsert_placed(rows, rows.limit(10), ["k"], "b", state="state")
    plan = merged.groupBy("b", "state").count()._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("RepartitionByExpression") == 1
    assert merged.filter("state = 'updated'").count() == 10 and merged.count() == 100


def test_gold_writes_built_rows_once(spark, tmp_path, monkeypatch, ctx):
    from stratum.plans.gold import GoldTable, run_gold

    def no_step(df, name="cut"):
        raise AssertionError("written twice")

    monkeypatch.setattr(published, "durable", no_step)
    root, log = str(tmp_path / "gold"), str(tmp_path / "log")
    for batch, rows in (("b1", [(1, "a")]), ("b2", [(1, "b"), (2, "c")])):
        df = spark.createDataFrame(rows, "k long, v string").withColumn("since", F.lit("2020-01-01").cast("date"))
        plan = [
            (GoldTable("fact", "s", "upsert", ("k",)), lambda ready, df=df: df),
            (GoldTable("dim", "s", "history", ("k",), ("v",), "since"), lambda ready, df=df: df),
        ]
        done = run_gold(spark, plan, root, log, replace(ctx, batch_id=batch))
    assert done["fact"] == {"rows_read": 2, "rows_inserted": 1, "rows_expired": 0}
    assert done["dim"] == {"rows_read": 2, "rows_inserted": 2, "rows_expired": 1}
