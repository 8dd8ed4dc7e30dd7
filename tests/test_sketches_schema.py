"""Mergeable sketches against exact numbers; the stream's schema log."""

import json

import pytest
from pyspark.sql import functions as F

from stratum.operators import sketches
from stratum.streaming.ingest import RESCUED
from stratum.streaming.schema_log import current_schema, evolved, ingest_evolving, read_evolved, versions


def detail(spark, n=60_000):
    i = F.col("id")
    return spark.range(n).select(
        F.date_add(F.lit("2023-01-01").cast("date"), (i % 400).cast("int")).alias("day"), (i * 7919 % 9973).alias("actor"),
        F.when(i % 11 != 0, F.pmod(F.xxhash64("id"), F.lit(100_000)) / 7).alias("amount"), (i % 3).cast("string").alias("kind"),
    )


def test_merged_sketches_stay_within_their_error(spark, tmp_path):
    rows, path = detail(spark), str(tmp_path / "sketches")
    for n in range(3):  # three batches that share months
        part = rows.filter(F.pmod(F.xxhash64("actor", "day"), F.lit(3)) == n)
        sketches.sketch_batch(part, f"b{n}", "day", ["kind"], ["actor"], ["amount"]).write.mode("append").parquet(path)
    stored = spark.read.parquet(path)
    assert stored.count() == 3 * 3 * 14
    ranges = [("2023-01-01", "2023-12-01"), ("2023-03-01", "2023-03-01"), ("2024-01-01", None)]
    for first, last in ranges:
        inside = rows.filter(F.trunc("day", "month").between(F.lit(first), F.lit(last or "2999-01-01")))
        exact = {r["kind"]: r for r in inside.groupBy("kind").agg(F.count("*").alias("n"), F.count_distinct("actor").alias("d")).collect()}
        for r in sketches.estimates(sketches.merge_sketches(stored, ["kind"], first, last), [0.1, 0.5, 0.9]).collect():
            assert r["rows"] == exact[r["kind"]]["n"]
            assert abs(r["distinct_actor"] - exact[r["kind"]]["d"]) <= sketches.distinct_error() * exact[r["kind"]]["d"] + 1
            values = inside.filter((F.col("kind") == r["kind"]) & F.col("amount").isNotNull())
            total = values.count()
            for p, q in zip([0.1, 0.5, 0.9], r["quantiles_amount"]):
                below, upto = values.filter(F.col("amount") < q).count() / total, values.filter(F.col("amount") <= q).count() / total
                assert below - sketches.rank_error() <= p <= upto + sketches.rank_error()


def test_sketches_of_nothing_and_of_nulls(spark):
    rows = detail(spark, 30).withColumn("amount", F.lit(None).cast("double"))
    one = sketches.estimates(sketches.merge_sketches(sketches.sketch_batch(rows, "b", "day", [], ["actor"], ["amount"]))).first()
    assert one["rows"] == 30 and one["distinct_actor"] == 30 and one["quantiles_amount"] is None
    empty = sketches.merge_sketches(sketches.sketch_batch(rows.limit(0), "b", "day", ["kind"], ["actor"], ["amount"]), ["kind"])
    assert sketches.estimates(empty).count() == 0


def run(spark, root, mode, log="log"):
    ingest_evolving(spark, f"{root}/src", f"{root}/dst", f"{root}/marks", f"{root}/{log}", "b1", "id bigint, v bigint", mode).awaitTermination()
    return read_evolved(spark, f"{root}/dst", f"{root}/{log}")


def test_new_column_is_added(spark, tmp_path):
    root = str(tmp_path)
    spark.sql("SELECT 1L AS id, 5L AS v").write.parquet(f"{root}/src/2023/01/a.parquet")
    assert run(spark, root, "evolve").filter("v = 5").count() == 1
    assert current_schema(spark, f"{root}/log")[0] == 1
    spark.sql("SELECT 2L AS id, 'x' AS v, 'new' AS extra, 1.5D AS Score").write.parquet(f"{root}/src/2023/02/a.parquet")
    run(spark, root, "evolve")
    spark.sql("SELECT 3L AS id, 7 AS extra, 2.5D AS score").write.parquet(f"{root}/src/2023/03/a.parquet")
    got = run(spark, root, "evolve")
    assert {(r.id, r.v, r.extra, r.Score, r[RESCUED]) for r in got.collect()} == {
        (1, 5, None, None, None), (2, None, "new", 1.5, '{"v":"x"}'), (3, None, "7", 2.5, None),
    }
    log = [(r.version, json.loads(r.added)) for r in versions(spark, f"{root}/log").orderBy("version").collect()]
    assert log == [(1, ["id", "v"]), (2, ["extra", "Score"])]
    assert run(spark, root, "evolve").count() == 3  # nothing has arrived: no row, no version


def test_new_column_is_rescued(spark, tmp_path):
    root = str(tmp_path)
    spark.sql("SELECT 1L AS id, 5L AS v, 'kept' AS extra").write.parquet(f"{root}/src/2023/01/a.parquet")
    got = run(spark, root, "rescue")
    assert [(r.id, r.v, r[RESCUED]) for r in got.collect()] == [(1, 5, '{"extra":"kept"}')]
    assert current_schema(spark, f"{root}/log")[0] == 1
    with pytest.raises(ValueError):
        run(spark, root, "neither")


def test_repeated_batch_adds_no_version(spark, tmp_path, monkeypatch):
    """The batch dies after its version was logged: run again, it finds it."""
    from stratum.streaming import schema_log

    root = str(tmp_path)
    spark.sql("SELECT 1L AS id, 'new' AS extra").write.parquet(f"{root}/src/2023/01/a.parquet")
    real = schema_log.conform
    monkeypatch.setattr(schema_log, "conform", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(Exception, match="lost"):
        run(spark, root, "evolve")
    monkeypatch.setattr(schema_log, "conform", real)
    assert run(spark, root, "evolve").filter("extra = 'new'").count() == 1
    assert versions(spark, f"{root}/log").count() == 2


def test_evolved_names(spark):
    schema = spark.range(1).selectExpr("id", "id AS B").schema
    found = spark.range(1).selectExpr("id AS b", "id AS c", "'f' AS _source_file").schema
    wider, added = evolved(schema, found)
    assert added == ["c"] and wider.names == ["id", "B", "c"] and wider["c"].nullable
