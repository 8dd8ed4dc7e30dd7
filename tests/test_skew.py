"""A key with a third of all rows: AQE must be able to split it in every large join, and results stay whole."""

import pytest
from pyspark.sql import functions as F

from stratum.operators import groups, integrity, profiling, ranking, scd2
from stratum.plans import customer360, fact, summaries
from stratum.session import durable, released

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
}


@pytest.fixture()
def tight(spark):
    old = {k: spark.conf.get(k, None) for k in SMALL}
    for k, v in SMALL.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot(spark, n=60_000):
    """Every third row belongs to account 0."""
    i = F.col("id")
    return spark.range(n, numPartitions=8).select(
        i.alias("transaction_id"), F.when(i % 3 == 0, 0).otherwise(i % 5000).cast("string").alias("account_id"),
        F.date_add(F.lit("2023-01-01").cast("date"), (i % 700).cast("int")).alias("transaction_date"),
        (i % 97).cast("double").alias("amount"), F.lit(True).alias("is_completed"), (i % 2 == 0).alias("is_debit"),
        F.lit(0.5).alias("transaction_cost"), F.sha2(i.cast("string"), 512).alias("payload"),
    )


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    qe = df._jdf.queryExecution()
    plan = qe.executedPlan()
    if "isFinalPlan=true" not in plan.toString():
        df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def history(spark):
    rows = spark.range(5000).select(
        F.col("id").cast("string").alias("account_id"), F.lit("2023-06-01").cast("date").alias("opened"), F.lit("active").alias("status"),
        (F.col("id") % 50).alias("customer_id"),
    )
    return scd2.scd2_init(rows, "account_id", "opened", "dim_account_key").drop("opened")


def test_group_facts_split(tight):
    df = groups.with_group(hot(tight), ["account_id"], {"n": F.count(F.lit(1)), "s": F.sum("amount")})
    assert "skew=true" in final_plan(df)
    assert df.count() == 60_000 and df.filter("account_id = '0'").select(F.max("n")).first()[0] == df.filter("account_id = '0'").count()


def test_orphan_flags_split(tight):
    known = tight.range(4000).select(F.col("id").cast("string").alias("account_id"))
    df = integrity.existence_flag(hot(tight), known, {"account_id": "account_id"}, "is_orphan")
    assert "skew=true" in final_plan(df) and df.count() == 60_000


def test_fact_splits_and_keeps_rows(tight):
    owners = tight.range(3000).select(F.col("id").cast("string").alias("account_id"), F.col("id").alias("primary_customer_sk"))
    columns = ["transaction_id", "account_id", "transaction_date", "dim_account_key", "primary_customer_sk", "transaction_amount", "customer_id", "payload"]
    df = fact.transaction_fact(hot(tight), history(tight), owners, columns, ["customer_id"])
    assert "skew=true" in final_plan(df)
    assert df.count() == 60_000 and df.filter("dim_account_key IS NULL").count() == 0
    monthly = df.groupBy("customer_id", F.trunc("transaction_date", "month").alias("month")).agg(F.sum("transaction_amount").alias("net"))
    assert "skew=true" in final_plan(monthly)


def test_point_in_time_join_splits(tight):
    df = scd2.pit_join(hot(tight), history(tight), "account_id", "transaction_date", ["dim_account_key"])
    assert "skew=true" in final_plan(df) and df.count() == 60_000


def test_chained_group_facts_split(tight):
    df = groups.with_group_count(groups.with_group_count(hot(tight), ["account_id"], "n"), ["account_id"], "m")
    assert final_plan(df).count("skew=true") >= 2 and df.filter("n <> m").count() == 0


def test_null_keys_split(tight):
    """A third of the rows without a key."""
    rows = hot(tight).withColumn("account_id", F.when(F.col("account_id") != "0", F.col("account_id")))
    df = groups.with_group_count(rows, ["account_id"], "n")
    assert "skew=true" in final_plan(df) and df.count() == 60_000
    both = groups.with_group_count(rows, ["account_id"], "n", null_safe=True)
    assert "skew=true" in final_plan(both) and both.filter("account_id IS NULL AND n < 20000").count() == 0


def test_anomalies_split(tight):
    df = summaries.anomalies(hot(tight), ["account_id"], "amount")
    assert "skew=true" in final_plan(df) and df.count() == 60_000


def test_positions_of_a_hot_key_spread(tight):
    """The hot key's rows are shuffled by key and chunk: no partition holds them all."""
    df = ranking.with_neighbours(
        hot(tight), ["account_id"], ["transaction_date", "transaction_id"], F.trunc("transaction_date", "month"), position="seq"
    )
    assert "hashpartitioning(account_id" not in df._jdf.queryExecution().executedPlan().toString()
    assert df.filter("account_id = '0'").agg(F.max("seq"), F.count_distinct("seq")).first()[0] == df.filter("account_id = '0'").count()


def test_missing_dates_of_a_hot_key_spread(tight, monkeypatch):
    """60,000 rows of one key without a date: the input is read once, no sort aggregate, no task with more than a tenth."""
    reads = []
    monkeypatch.setattr(ranking, "durable", lambda df, name, keep=ranking.durable: (reads.append(df), keep(df, name))[1])
    df = tight.range(60_000).select(F.lit("a").alias("k"), F.lit(None).cast("date").alias("d"), "id", F.rand(1).alias("v"))
    out = ranking.with_neighbours(df, ["k"], ["d", "id"], F.col("d"), position="n", lags={"p": "id"})
    assert len(reads) == 1 and out.filter("n = id + 1 AND coalesce(p, -1) = id - 1").count() == 60_000
    for plan in (reads[0]._jdf.queryExecution().executedPlan().toString(), final_plan(out)):
        assert "SortAggregate" not in plan and "Range (0, 60000" not in final_plan(out)
    groups_ = df.select(ranking.chunk_key(df, ["k"], ["d", "id"], F.col("d")).alias("g")).groupBy("g").count()
    assert groups_.agg(F.max("count")).first()[0] <= 10_000
    rows_, days = out.withColumn("x", F.lit(1)), df.select("k", F.col("d").alias("at")).limit(1)
    found = ranking.asof_join(rows_, days, "k", "d", "at", ["at"])
    assert found.filter("at IS NULL").count() == 60_000 and "SortAggregate" not in final_plan(found)


def test_few_groups_leave_the_detail_in_place(spark):
    """Five groups: their written aggregate is broadcast by its size, the detail is not exchanged."""
    rows = hot(spark).withColumn("branch", F.col("transaction_id") % 5)
    for df in (groups.with_group_count(rows, ["branch"], "n"), summaries.anomalies(rows, ["branch"], "amount")):
        plan = final_plan(df)
        assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan and df.count() == 60_000
    flagged = profiling.flag_incomplete_years(rows, "transaction_date")
    assert "hashpartitioning" not in final_plan(flagged) and flagged.count() == 60_000


def test_many_groups_still_split(tight):
    """A group per row beside the hot one: both sides are shuffled and the hot key is split."""
    rows = hot(tight).withColumn("account_id", F.when(F.col("transaction_id") % 3 == 0, "0").otherwise(F.col("transaction_id").cast("string")))
    df = groups.with_group_count(rows, ["account_id"], "n")
    assert "skew=true" in final_plan(df) and df.filter("n = 20000").count() == 20_000


def test_column_profile_makes_no_row_per_cell(spark, rows):
    df = spark.createDataFrame([(1, "a", 0.5, {"x": 1}), (1, None, -0.0, None), (None, "a", 0.0, {"x": 1})], "i int, s string, d double, m map<string, int>")
    profile = profiling.column_profile(df)
    assert "Generate" not in final_plan(profile)
    assert rows(profile) == [("d", 2, 0, 3), ("i", 1, 1, 3), ("m", 1, 1, 3), ("s", 1, 1, 3)]
    assert rows(profiling.column_profile(df.limit(0), ["i"])) == [("i", 0, 0, 0)]


def test_activity_aggregates_by_hash(spark):
    rows = hot(spark).select(
        F.col("account_id").alias("customer_id"), "transaction_date", (F.col("transaction_id") % 3).cast("string").alias("channel"),
        F.col("amount").alias("amount_abs"), F.col("is_debit").alias("is_salary_candidate"),
    )
    out = customer360.activity(rows, F.lit("2024-12-31").cast("date"))
    plan = final_plan(out)
    assert "ObjectHashAggregate" not in plan and "SortAggregate" not in plan and "collect_set" not in plan
    one = out.filter("customer_id = '0'").first()
    want = rows.filter("customer_id = '0'").agg(
        F.count_distinct(F.trunc("transaction_date", "month")), F.max("transaction_date"), F.round(F.avg("amount_abs"), 6), F.mode("channel", True),
    ).first()
    assert (one["number_of_active_months"], one["last_day_of_transactions"], round(one["average_transaction_volume"], 6), one["most_preferred_channel"]) == tuple(want)
    assert one["is_on_regular_salary"] == 1


def test_released_steps_are_gone(spark):
    import os

    with released(spark):
        kept = durable(spark.range(5), "step")
        folder = kept.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
        with released(spark):
            inner = durable(spark.range(3), "step")
            deeper = inner.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
        assert os.path.exists(folder) and not os.path.exists(deeper)
    assert not os.path.exists(folder)
