"""Positions, neighbours, tiles and quantiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import ranking
from .registry import query, table


@query("event_sequence", """SELECT event_id, user_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS INTEGER) AS seq FROM events""")
def _(spark, sf):
    rows = table(spark, sf, "events").drop("props")
    out = ranking.with_neighbours(rows, ["user_id"], ["ts", "event_id"], F.to_date("ts"), position="seq")
    return out.select("event_id", "user_id", "seq")


@query("lag_delta", """SELECT event_id, user_id, value - lag(value) OVER w AS value_delta, lead(event_type) OVER w AS next_type, lag(v2) OVER w AS prev_v2
FROM (SELECT *, CASE WHEN value > 50 THEN value END AS v2 FROM events) WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def _(spark, sf):
    rows = table(spark, sf, "events").withColumn("v2", F.when(F.col("value") > 50, F.col("value")))
    out = ranking.with_neighbours(
        rows, ["user_id"], ["ts", "event_id"], F.to_date("ts"), lags={"prev": "value", "prev_v2": "v2"}, leads={"next_type": "event_type"}
    )
    return out.select("event_id", "user_id", (F.col("value") - F.col("prev")).alias("value_delta"), "next_type", "prev_v2")


@query("sequence_by_type", """SELECT l_orderkey, l_linenumber, CAST(row_number() OVER (PARTITION BY l_returnflag ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS INTEGER) AS seq
FROM lineitem""")
def _(spark, sf):
    """Three keys hold the whole table: the shape of a hot account."""
    out = ranking.with_neighbours(
        table(spark, sf, "lineitem"), ["l_returnflag"],
        ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"],
        F.col("l_shipdate"), position="seq",
    )
    return out.select("l_orderkey", "l_linenumber", "seq")


@query("quartiles", """SELECT c_custkey, CAST(ntile(4) OVER (ORDER BY c_acctbal, c_custkey) AS INTEGER) AS balance_quartile,
CAST(ntile(4) OVER (ORDER BY c_nationkey, c_custkey) AS INTEGER) AS nation_quartile,
CAST(ntile(4) OVER (ORDER BY CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN c_acctbal END NULLS FIRST, c_custkey) AS INTEGER) AS sparse_quartile FROM customer""")
def _(spark, sf):
    rows = table(spark, sf, "customer").withColumn("sparse", F.when(F.col("c_mktsegment") == "HOUSEHOLD", F.col("c_acctbal")))
    out = ranking.with_tiles(
        rows, {"balance_quartile": "c_acctbal", "nation_quartile": "c_nationkey", "sparse_quartile": "sparse"}, "c_custkey"
    )
    return out.select("c_custkey", "balance_quartile", "nation_quartile", "sparse_quartile")


@query("median", """SELECT l_returnflag, 0.5::DOUBLE AS probability, quantile_cont(l_extendedprice, 0.5) AS quantile FROM lineitem GROUP BY 1
UNION ALL SELECT l_returnflag, 0.9::DOUBLE, quantile_cont(l_extendedprice, 0.9) FROM lineitem GROUP BY 1""")
def _(spark, sf):
    return ranking.exact_quantiles(table(spark, sf, "lineitem"), "l_returnflag", "l_extendedprice", [0.5, 0.9])


@query("approx_median", """SELECT o_orderpriority, quantile_disc(o_totalprice, 0.5) AS median_price FROM orders GROUP BY 1""")
def _(spark, sf):
    """The sketch is exact while a group has fewer rows than its accuracy."""
    return table(spark, sf, "orders").groupBy("o_orderpriority").agg(
        F.percentile_approx("o_totalprice", 0.5, 100_000).alias("median_price")
    )
