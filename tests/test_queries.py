"""Every registered query against its SQL on the smallest tables, and the shape of its plan."""

import duckdb
import pytest

import __spark_entry__ as contract
import check
from stratum.bindings.views import lines
from stratum.operators.dedup import latest_by

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    con.sql("SET TimeZone='UTC'")
    for t in check.TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", list(contract.queries()))
def test_matches_sql(spark, con, name):
    _, verdict = check.compare(spark, con, name, SF)
    assert verdict in ("ok", "rows only"), verdict


@pytest.mark.parametrize("name", [
    "fact_transactions", "orphan_flags", "upsert_single", "scd2_apply", "sequence_by_type", "quartiles", "median",
    "reconcile_layers", "gap_manifest", "centroid_score", "customer_360",
])
def test_no_cross_join(spark, name):
    plan = contract.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["month", "segment", "transactions", "net_amount", "gross_amount"]
    assert df.count() > 0


def test_dedup_reduces_before_the_shuffle(spark):
    scan = spark.read.parquet(f"{SF}/lineitem.parquet")
    plan = latest_by(scan, ["l_orderkey"], ["l_shipdate"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_lines_are_limited_before_the_shuffle_and_read_few_columns(spark):
    plan = lines(spark, SF).select("l_orderkey", "l_linenumber")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "REPARTITION_BY_NUM" not in plan and "l_shipmode" not in plan


@pytest.mark.parametrize("name", ["medoid", "cluster_summary"])
def test_typical_rows_need_no_sort_aggregate(spark, name):
    assert "SortAggregate" not in contract.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


def test_kmeans_query_searches_with_the_default_starts(spark, monkeypatch):
    seen = []

    class Stop(Exception):
        pass

    def choose_k(vectors, *args, **kw):
        seen.append((args, kw))
        raise Stop

    monkeypatch.setattr("stratum.plans.topics.choose_k", choose_k)
    with pytest.raises(Stop):
        contract.queries()["kmeans_silhouette"](spark, contract.SMOKE_DIR)
    assert seen == [((), {})]
