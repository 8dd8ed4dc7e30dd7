import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from stratum.operators import bridge, control, dedup, groups, integrity, profiling, quality, ranking, scd2, upsert
from stratum.plans import dims

D = dt.date


# ---- dedup and groups

def test_latest_by(spark, rows):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (None, 1, "c"), (None, 3, "d"), (2, None, "e"), (2, 0, "f")], "k int, t int, v string")
    assert rows(dedup.latest_by(df, ["k"], ["t"])) == sorted([(1, 2, "b"), (None, 3, "d"), (2, 0, "f")], key=repr)


def test_latest_by_does_not_depend_on_partitioning(spark, rows):
    df = spark.createDataFrame([(1, 5, str(i)) for i in range(50)], "k int, t int, v string")
    assert rows(dedup.latest_by(df.repartition(7), ["k"], ["t"])) == rows(dedup.latest_by(df.coalesce(1), ["k"], ["t"]))


def test_drop_copies_digest(spark, rows):
    df = spark.createDataFrame([("x", None, 2), ("x", None, 1), ("x", "y", 3)], "a string, b string, i int")
    plain = dedup.drop_copies(df, ["a", "b"], [F.col("i").asc()])
    assert rows(plain) == rows(dedup.drop_copies(df, ["a", "b"], [F.col("i").asc()], digest=True)) == [("x", "y", 3), ("x", None, 1)]


def test_group_count_null_key(spark, rows):
    df = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    assert rows(groups.with_group_count(df, ["k"], "n")) == [(1, 2), (1, 2), (None, None)]
    assert rows(groups.with_group_count(df, ["k"], "n", null_safe=True)) == [(1, 2), (1, 2), (None, 1)]


# ---- ranking against windows

@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows under one key, null keys, null and repeated values."""
    rnd = random.Random(7)
    data = []
    for i in range(900):
        key = 0 if i % 3 == 0 else rnd.choice([None, 1, 2, 3])
        data.append((key, D(2024, 1, 1) + dt.timedelta(days=rnd.randrange(40)), i, rnd.choice([None, 0.0, 0.0, 1.5, 2.5, 7.0])))
    return spark.createDataFrame(data, "k int, d date, i int, v double")


@pytest.mark.parametrize("chunk", ["day", "month", "all"])
def test_neighbours_equal_windows(spark, rows, skewed, chunk):
    chunk = {"day": F.col("d"), "month": F.trunc("d", "month"), "all": F.lit(1)}[chunk]
    got = ranking.with_neighbours(skewed, ["k"], ["d", "i"], chunk, "n", {"p": "v"}, {"q": "v"})
    w = Window.partitionBy("k").orderBy("d", "i")
    want = skewed.select("*", F.row_number().over(w).alias("n"), F.lag("v").over(w).alias("p"), F.lead("v").over(w).alias("q"))
    assert rows(got) == rows(want)


@pytest.mark.parametrize("order", [["d", "i"], ["d", "s", "i"], ["d", "s", "t"], ["d", "t", "i"]])
def test_neighbours_without_dates(spark, rows, skewed, order, monkeypatch):
    """Most dates of the hot key are missing: the rest of the order cuts its rows, and positions stay those of one window."""
    monkeypatch.setattr(ranking, "NULL_SPAN", 50)
    df = skewed.withColumns({
        "d": F.when((F.col("k") > 0) | (F.col("i") % 10 == 0), F.col("d")), "s": F.when(F.col("i") % 4 > 0, F.concat(F.lit("s"), F.col("i") % 5)),
        "t": F.timestamp_seconds(F.col("i") * 4000),
    })
    got = ranking.with_neighbours(df, ["k"], order, F.col("d"), "n", {"p": "v", "pi": "i"}, {"q": "v", "qi": "i"})
    w = Window.partitionBy("k").orderBy(*order)
    want = df.select(
        "*", F.row_number().over(w).alias("n"), F.lag("v").over(w).alias("p"), F.lag("i").over(w).alias("pi"),
        F.lead("v").over(w).alias("q"), F.lead("i").over(w).alias("qi"),
    )
    assert rows(got) == rows(want)
    missing = df.filter("d IS NULL AND k = 0").select(ranking.chunk_key(df, ["k"], order, F.col("d")).alias("g"))
    assert missing.groupBy("g").count().agg(F.max("count")).first()[0] <= 60


@pytest.mark.parametrize("tiles", [2, 4, 7])
def test_tiles_equal_ntile(spark, rows, skewed, tiles):
    got = ranking.with_tiles(skewed, {"a": "v", "b": "i"}, "i", tiles)
    want = skewed.select(
        "*", F.ntile(tiles).over(Window.orderBy("v", "i")).alias("a"), F.ntile(tiles).over(Window.orderBy("i")).alias("b")
    )
    assert rows(got) == rows(want)


def test_tiles_of_few_rows(spark, rows):
    df = spark.createDataFrame([(1, 5.0), (2, 4.0), (3, None)], "i int, v double")
    assert rows(ranking.with_tiles(df, {"t": "v"}, "i")) == [(1, 5.0, 3), (2, 4.0, 2), (3, None, 1)]
    assert ranking.with_tiles(df.filter("i > 9"), {"t": "v"}, "i").count() == 0


def test_exact_quantiles(spark, rows, skewed):
    got = rows(ranking.exact_quantiles(skewed, "k", "v", [0.0, 0.25, 0.5, 1.0]))
    want = skewed.groupBy("k").agg(F.percentile("v", F.array(*[F.lit(p) for p in (0.0, 0.25, 0.5, 1.0)])).alias("q"))
    want = rows(want.select("k", F.posexplode("q").alias("p", "q")).select("k", F.element_at(F.array(*[F.lit(p) for p in (0.0, 0.25, 0.5, 1.0)]), F.col("p") + 1), "q"))
    assert got == want


# ---- integrity

def test_existence_flag(spark, rows):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, v string")
    dim = spark.createDataFrame([(1,), (1,), (None,)], "id int")
    assert rows(integrity.existence_flag(df, dim, {"k": "id"}, "o")) == [(1, "a", False), (2, "b", True), (None, "c", True)]


def test_orphan_chain(spark, rows):
    df = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    a, b = spark.createDataFrame([(1,)], "x int"), spark.createDataFrame([(2,)], "y int")
    assert rows(integrity.orphans_everywhere(df, [(a, {"k": "x"}), (b, {"k": "y"})])) == [(3,)]
    assert rows(integrity.found_elsewhere(df, (a, {"k": "x"}), (b, {"k": "y"}))) == [(2,)]


# ---- upsert

def test_upsert_semantics(spark, rows):
    t = spark.createDataFrame([(1, "old", 10), (2, "old", 20), (None, "old", 30)], "k int, v string, created int")
    s = spark.createDataFrame([(2, "new", 99), (3, "new", 99), (None, "new", 99)], "k int, v string, created int")
    out = upsert.upsert(t, s, ["k"], preserve=["created"], touch={"v": F.lit("touched")})
    assert rows(out) == sorted([(1, "old", 10), (2, "touched", 20), (3, "new", 99), (None, "old", 30), (None, "new", 99)], key=repr)
    assert tuple(upsert.upsert_counts(t, s, ["k"]).first()) == (2, 1, 2)


def test_upsert_is_idempotent_and_incremental(spark, rows):
    t = spark.createDataFrame([(i, i % 3, i) for i in range(20)], "a int, b int, v int")
    s = spark.createDataFrame([(i, i % 3, -i) for i in range(10, 30)], "a int, b int, v int")
    once = upsert.upsert(t, s, ["a", "b"])
    assert rows(upsert.upsert(once, s, ["a", "b"])) == rows(once)
    halves = upsert.upsert(upsert.upsert(t, s.filter("a < 20"), ["a", "b"]), s.filter("a >= 20"), ["a", "b"])
    assert rows(halves) == rows(once)


def test_upsert_new_and_dropped_columns(spark, rows):
    t = spark.createDataFrame([(1, "x")], "k int, only_t string")
    s = spark.createDataFrame([(1, 7), (2, 8)], "k int, only_s int")
    assert rows(upsert.upsert(t, s, ["k"])) == [(1, "x", 7), (2, None, 8)]


def test_require_unique(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,)], "k int")
    with pytest.raises(ValueError):
        upsert.require_unique(df, ["k"])
    upsert.require_unique(df.filter("k is null"), ["k"])


# ---- history

BASE = [("a", "active", 1.0, D(2020, 1, 1)), ("b", None, None, D(2020, 2, 1)), ("c", "active", 3.0, D(2020, 3, 1)), ("e", "active", None, D(2020, 1, 5))]
SCHEMA = "account_id string, status string, lim double, opened date"
KEEP = ["account_id", "status", "lim", "effective_from", "effective_to", "is_current"]


def step(dim, spark, data, day):
    return scd2.scd2_apply(dim, spark.createDataFrame(data, SCHEMA), "account_id", ["status", "lim"], day)


def test_scd2_changes(spark, rows):
    dim = scd2.scd2_init(spark.createDataFrame(BASE, SCHEMA), "account_id", "opened")
    nxt = [("a", "frozen", 1.0, D(2020, 1, 1)), ("b", "active", None, D(2020, 2, 1)), ("c", "active", 3.0, D(2020, 3, 1)),
           ("d", "new", None, D(2024, 1, 1)), ("e", "active", 5.0, D(2020, 1, 5))]
    out = step(dim, spark, nxt, "2024-05-01")
    got = rows(out.select(*KEEP))
    end = D(9999, 12, 31)
    assert ("a", "active", 1.0, D(2020, 1, 1), D(2024, 4, 30), False) in got and ("a", "frozen", 1.0, D(2024, 5, 1), end, True) in got
    assert ("b", None, None, D(2020, 2, 1), D(2024, 4, 30), False) in got and ("b", "active", None, D(2024, 5, 1), end, True) in got
    assert ("c", "active", 3.0, D(2020, 3, 1), end, True) in got and ("d", "new", None, D(2024, 5, 1), end, True) in got
    assert ("e", "active", 5.0, D(2024, 5, 1), end, True) in got
    assert len(got) == 8
    assert out.select("dim_key").distinct().count() == 8
    assert rows(step(out, spark, nxt, "2024-06-01")) == rows(out)  # nothing changed: nothing happens


def test_scd2_same_day_and_invariants(spark, rows):
    dim = scd2.scd2_init(spark.createDataFrame(BASE, SCHEMA), "account_id", "opened")
    for day, status in (("2024-05-01", "s1"), ("2024-05-01", "s2"), ("2024-07-01", "s3"), ("2024-08-01", "s3")):
        dim = step(dim, spark, [(k, status, lim, o) for k, _, lim, o in BASE], day)
    a = rows(dim.filter("account_id = 'a'").select("status", "effective_from", "effective_to", "is_current"))
    assert a == sorted([("active", D(2020, 1, 1), D(2024, 4, 30), False), ("s2", D(2024, 5, 1), D(2024, 6, 30), False), ("s3", D(2024, 7, 1), D(9999, 12, 31), True)], key=repr)
    w = Window.partitionBy("account_id").orderBy("effective_from")
    gaps = dim.withColumn("nxt", F.lead("effective_from").over(w)).filter("nxt IS NOT NULL AND date_add(effective_to, 1) <> nxt")
    assert gaps.count() == 0
    assert dim.groupBy("account_id").agg(F.count_if("is_current").alias("n")).filter("n <> 1").count() == 0


def test_pit_join_keeps_rows(spark, rows):
    dim = scd2.scd2_init(spark.createDataFrame(BASE, SCHEMA), "account_id", "opened")
    dim = step(dim, spark, [("a", "frozen", 1.0, D(2020, 1, 1))], "2024-05-01")
    fact = spark.createDataFrame([("a", D(2019, 1, 1)), ("a", D(2024, 4, 30)), ("a", D(2024, 5, 1)), ("z", D(2024, 1, 1)), (None, D(2024, 1, 1))], "account_id string, day date")
    got = rows(scd2.pit_join(fact, dim, "account_id", "day", ["status"]))
    assert got == sorted([("a", D(2019, 1, 1), "active"), ("a", D(2024, 4, 30), "active"), ("a", D(2024, 5, 1), "frozen"),
                          ("z", D(2024, 1, 1), None), (None, D(2024, 1, 1), None)], key=repr)
    strict = rows(scd2.pit_join(fact, dim, "account_id", "day", ["status"], patch_first=False))
    assert ("a", D(2019, 1, 1), None) in strict and len(strict) == 5


# ---- control

def test_watermarks(spark):
    t = lambda d: dt.datetime(2024, 1, d)
    log = None
    for value, status, done in ((3, "SUCCESS", 1), (9, "FAILED", 2), (5, "SUCCESS", 3), (4, "SUCCESS", 4)):
        row = control.control_row(spark, control.WATERMARK_SCHEMA, {"pipeline_name": "p", "watermark_value": t(value), "status": status, "processed_timestamp": t(done), "batch_id": str(done)})
        log = row if log is None else log.unionByName(row)
    assert control.watermark_of(log, "p") == t(5)
    assert control.watermark_of(log, "p", "any") == t(9)
    assert control.watermark_of(log, "p", "latest") == t(4)
    assert control.watermark_of(log, "other") is None
    assert control.watermark_of(control.empty_control(spark, control.WATERMARK_SCHEMA), "p") is None
    assert control.reset_pipeline(log, "p", "2").count() == 3 and control.reset_pipeline(log, "p").count() == 0
    data = spark.createDataFrame([(t(4),), (t(5),), (t(6),)], "ts timestamp")
    assert control.incremental(data, "ts", t(5)).count() == 1 and control.incremental(data, "ts", None).count() == 3
    assert control.next_watermark(data.filter("false"), "ts", t(5)).first()[0] == t(5)


def test_touched_history(spark, rows):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(1, "c")], "k int, v string")
    assert rows(control.touched_history(old, new, ["k"])) == [(1, "a"), (1, "c")]


# ---- bridge, quality, profiles

def test_explode_json(spark, rows):
    data = [(1, '[{"c":"x","r":"p"},{"c":"y","r":null}]'), (2, "[]"), (3, "null"), (4, None), (5, "[{bad")]
    df = spark.createDataFrame(data, "a int, j string")
    schema = "array<struct<c: string, r: string>>"
    assert rows(bridge.explode_json(df, "j", schema, ["a"])) == [("x", "p", 1), ("y", None, 1)]
    assert bridge.malformed_json(df, "j", schema).first()[0] == 1


def test_rules_and_require(spark, rows):
    df = spark.createDataFrame([(1, "i", None), (None, "b", 1), (3, "i", 2)], "k int, t string, v int")
    res = quality.run_rules(df, [*quality.required(["k"]), *quality.required(["v"], "warn", F.col("t") == "i")])
    assert [(r["rule"], r["checked"], r["failed"]) for r in res.collect()] == [("k_null", 3, 1), ("v_null", 2, 1)]
    with pytest.raises(ValueError):
        quality.require(res)
    quality.require(res, "none")
    assert quality.run_rules(df.filter("false"), quality.required(["k"])).first()["pct"] == 0.0


def test_fk_verdicts(spark):
    df = spark.range(1000).select(*[F.when(F.col("id") >= n, F.col("id")).alias(f"k{n}") for n in (9, 10, 49, 50)])
    assert [r["verdict"] for r in quality.fk_coverage(df, df.columns).collect()] == ["ok", "warn", "warn", "fail"]


def test_profiles(spark, rows):
    df = spark.createDataFrame([(1, "x"), (2, "x"), (None, None)], "a int, b string")
    assert rows(profiling.null_profile(df)) == [("a", 1, 100 / 3), ("b", 1, 100 / 3)]
    assert rows(profiling.column_profile(df)) == [("a", 2, 1, 3), ("b", 1, 1, 3)]
    keys = {r["key_columns"]: (r["distinct_keys"], r["is_key"]) for r in profiling.candidate_keys(df, [["a"], ["b"], ["a", "b"]]).collect()}
    assert keys == {"a": (3, True), "b": (2, False), "a,b": (3, True)}
    assert rows(profiling.duplicate_rows(df, ["b"]).select("a", "copies")) == [(1, 2), (2, 2)]


def test_date_dim_range(spark):
    d = dims.date_dim(spark, "2023-12-30", "2024-03-01")
    assert d.count() == 63 and d.filter("is_public_holiday_za").count() == 1
    assert d.filter("is_quarter_end").count() == 1 and d.filter("is_month_end").count() == 3
    assert len(dims.PUBLIC_HOLIDAYS) == len(set(dims.PUBLIC_HOLIDAYS)) and len(d.columns) == 14


@pytest.mark.parametrize("unit", ["day", "month", "year"])
def test_asof_join_brute_force(spark, unit):
    rnd = random.Random(3)
    day = lambda: D(2024, 1, 1) + dt.timedelta(days=rnd.randrange(120))
    left = [(i, rnd.choice([0, 0, 0, 1, 2, None]), rnd.choice([day(), day(), day(), None])) for i in range(300)]
    right = {(rnd.choice([0, 0, 1, None]), day()): rnd.choice(["x", "y", None]) for _ in range(60)}
    ldf = spark.createDataFrame(left, "i int, k int, d date")
    rdf = spark.createDataFrame([(k, d, v) for (k, d), v in right.items()], "k int, at date, v string")
    got = {r["i"]: r["v"] for r in ranking.asof_join(ldf, rdf, "k", "d", "at", ["v"], unit if unit != "day" else "week").collect()}
    want = {}
    for i, k, d in left:
        hits = [(at, v) for (rk, at), v in right.items() if k is not None and d is not None and rk == k and at <= d]
        want[i] = max(hits, key=lambda h: h[0])[1] if hits else None
    assert got == want


def test_conform_to_schema(spark):
    from pyspark.sql.types import StructType

    from stratum.functions.casting import conform

    df = spark.createDataFrame([("7", "x", "gone")], "a string, b string, z string")
    out = conform(df, StructType.fromDDL("b int, a int, c double"))
    assert out.dtypes == [("b", "int"), ("a", "int"), ("c", "double")] and tuple(out.first()) == (None, 7, None)


def test_columns_that_only_break_ties_are_not_shuffled(spark):
    import re

    df = spark.createDataFrame([(1, 2, "a"), (1, 2, "b")], "k int, t int, wide string")
    plan = dedup.latest_by(df, ["k"], ["t"]).select("k", "t")._jdf.queryExecution().optimizedPlan().toString().splitlines()
    below = next(x for x in plan if "xxhash64" in x)
    assert any("Window [" in x for x in plan[:plan.index(below)]) and "wide" not in re.sub(r"xxhash64\(.*?\) AS", "", below)
