"""Typing, flattening, masking and band queries."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import bands, casting, masking
from ..operators import bridge, quality
from ..plans.entities import engagement, holdings, lending, people
from . import views
from .registry import query, table

RAW_SPEC = {
    "o_orderkey": "bigint", "o_totalprice": "double", "o_orderdate": "date", "o_orderpriority": "string lower trim",
    "o_orderstatus": "string trim", "o_shippriority": "int", "o_custkey": "int",
}


def raw_orders(spark, sf):
    """Orders as a landing file would bring them: all text, padded, with words where numbers should be.

    The table is one row group, so one task would read it and cast it too: the rows are dealt out first.
    """
    columns = ["o_orderkey", "o_totalprice", "o_orderdate", "o_orderpriority", "o_orderstatus", "o_custkey"]
    o = table(spark, sf, "orders").select(*columns).repartition("o_orderkey")
    return o.select(
        F.col("o_orderkey").cast("string"), F.col("o_totalprice").cast("string"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"),
        F.concat(F.lit("  "), F.col("o_orderpriority"), F.lit(" ")).alias("o_orderpriority"),
        F.concat(F.lit(" "), F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(F.col("o_orderstatus") == "P", "n/a").otherwise(F.concat(F.col("o_custkey").cast("string"), F.lit(".0"))).alias("o_custkey"),
    )


@query("typed_projection", """SELECT o_orderkey, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, lower(o_orderpriority) AS o_orderpriority,
o_orderstatus, CAST(NULL AS INTEGER) AS o_shippriority, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_custkey AS INTEGER) END AS o_custkey FROM orders""")
def _(spark, sf):
    return casting.project(raw_orders(spark, sf), RAW_SPEC)


@query("cast_failures", """SELECT 'o_custkey' AS column_name, count(*) FILTER (WHERE o_orderstatus = 'P') AS failed FROM orders
UNION ALL SELECT 'o_orderkey', 0 UNION ALL SELECT 'o_totalprice', 0 UNION ALL SELECT 'o_orderdate', 0""")
def _(spark, sf):
    return casting.cast_failures(raw_orders(spark, sf), RAW_SPEC)


@query("select_existing", """SELECT c_custkey AS custkey, c_name AS name, c_mktsegment AS mktsegment FROM customer""")
def _(spark, sf):
    shouting = table(spark, sf, "customer").toDF(" CustKey", "Name ", "NationKey", "AcctBal", "MktSegment")
    return casting.keep_existing(casting.normalise_names(shouting), ["custkey", "name", "mktsegment", "birth_date"])


@query("parse_dates", """SELECT o_orderkey, CAST(coalesce(try_strptime(s, '%Y-%m-%d'), try_strptime(s, '%d/%m/%Y'), try_strptime(s, '%m/%d/%Y')) AS DATE) AS day
FROM (SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 'O' THEN strftime(o_orderdate, '%d/%m/%Y')
ELSE strftime(o_orderdate, '%m/%d/%Y') END AS s FROM orders)""")
def _(spark, sf):
    o = table(spark, sf, "orders")
    d, s = F.col("o_orderdate"), F.col("o_orderstatus")
    text = (
        F.when(s == "F", F.date_format(d, "yyyy-MM-dd")).when(s == "O", F.date_format(d, "dd/MM/yyyy"))
        .otherwise(F.date_format(d, "MM/dd/yyyy"))
    )
    return o.select("o_orderkey", casting.parse_date(text, holdings.EVENT_DATE_FORMATS).alias("day"))


@query("parse_timestamps", """SELECT event_id, CASE WHEN event_type = 'view' THEN NULL WHEN event_type IN ('signup', 'error') THEN date_trunc('minute', ts)
ELSE date_trunc('second', ts) END AS comm_ts FROM events""")
def _(spark, sf):
    e = table(spark, sf, "events")
    formats = {"click": "yyyy-MM-dd HH:mm:ss", "purchase": "yyyy/MM/dd HH:mm:ss", "signup": "dd/MM/yyyy HH:mm", "error": "dd-MMM-yyyy HH:mm"}
    text = F.lit("not a time")
    for kind, fmt in formats.items():
        text = F.when(F.col("event_type") == kind, F.date_format("ts", fmt)).otherwise(text)
    return e.select("event_id", casting.parse_timestamp(text, engagement.COMPLAINT_FORMATS).cast("timestamp_ntz").alias("comm_ts"))


@query("struct_flatten", """SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS pr_k, NULL::VARCHAR AS pr_absent, value FROM events""")
def _(spark, sf):
    e = table(spark, sf, "events").withColumns({"props": F.from_json("props", "k int"), "k": F.lit("flat copy")})
    flat = casting.flatten(e, {"props": {"k": "pr_k", "absent": "pr_absent"}}, redundant=["k"])
    return flat.select("event_id", "pr_k", "pr_absent", "value")


# ---- masks

@query("mask_hash", """SELECT c_custkey, sha256(concat(c_name, 'pepper')) AS c_name,
CASE WHEN c_acctbal > 0 THEN sha256(concat('pepper', c_mktsegment)) END AS c_mktsegment FROM customer""")
def _(spark, sf):
    rows = table(spark, sf, "customer").withColumn("c_mktsegment", F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment")))
    return masking.mask(rows, {"c_name": "hash", "c_mktsegment": "hash_prefix"}, "pepper").select("c_custkey", "c_name", "c_mktsegment")


@query("mask_email", """SELECT c_custkey, CASE WHEN c_mktsegment <> 'MACHINERY' THEN concat(sha256(concat(lower(c_name), 'pepper')), '@', lower(c_mktsegment), '.example') END AS email
FROM customer""")
def _(spark, sf):
    at = F.when(F.col("c_mktsegment") == "MACHINERY", ".").otherwise("@")
    rows = table(spark, sf, "customer").withColumn("email", F.concat(F.lower("c_name"), at, F.lower("c_mktsegment"), F.lit(".example")))
    return masking.mask(rows, {"email": "email"}, "pepper").select("c_custkey", "email")


@query("mask_phone", """SELECT c_custkey, concat(substr(p, 1, 4), '***', right(p, 3)) AS phone, CASE WHEN starts_with(p, '+27') THEN 'ZA' ELSE 'OTHER' END AS country
FROM (SELECT c_custkey, concat('+', 20 + c_nationkey, '82', lpad(CAST(c_custkey AS VARCHAR), 7, '0')) AS p FROM customer)""")
def _(spark, sf):
    number = F.concat(F.lit("+"), F.col("c_nationkey") + 20, F.lit("82"), F.lpad(F.col("c_custkey").cast("string"), 7, "0"))
    rows = table(spark, sf, "customer").withColumn("phone", number)
    rows = rows.withColumn("country", people.phone_country("phone"))
    return masking.mask(rows, {"phone": "phone"}, "pepper").select("c_custkey", "phone", "country")


@query("mask_last4", """SELECT s_suppkey, concat('****', right(s_name, 4)) AS s_name, concat('****', CAST(s_nationkey AS VARCHAR)) AS short FROM supplier""")
def _(spark, sf):
    rows = table(spark, sf, "supplier").withColumn("short", F.col("s_nationkey").cast("string"))
    return masking.mask(rows, {"s_name": "last4", "short": "last4"}, "pepper").select("s_suppkey", "s_name", "short")


# ---- bands, flags and scores

@query("bands_income", """SELECT c_custkey, CASE WHEN i IS NULL THEN 'Unknown' WHEN i < 50000 THEN 'Low (<50k)' WHEN i < 200000 THEN 'Lower-Middle (50k-200k)'
WHEN i < 500000 THEN 'Middle (200k-500k)' WHEN i < 1000000 THEN 'Upper-Middle (500k-1M)' ELSE 'High (1M+)' END AS income_band,
CASE WHEN i >= 1000000 THEN 'Affluent' WHEN i >= 200000 THEN 'Mass Market' ELSE 'Entry Level' END AS customer_segment,
CASE WHEN i < 1000000 THEN 'Small Business' WHEN i < 10000000 THEN 'Medium Business' WHEN i IS NOT NULL THEN 'Large Enterprise' END AS business_segment
FROM (SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN c_acctbal * 150 END AS i FROM customer)""")
def _(spark, sf):
    rows = table(spark, sf, "customer").withColumn("i", F.when(F.col("c_acctbal") > 0, F.col("c_acctbal") * 150))
    return rows.select(
        "c_custkey", people.income_band("i").alias("income_band"), people.segment("i").alias("customer_segment"),
        people.business_segment("i").alias("business_segment"),
    )


@query("bands_age", """SELECT o_orderkey, age, CASE WHEN age < 25 THEN '18-24' WHEN age < 35 THEN '25-34' WHEN age < 45 THEN '35-44' WHEN age < 55 THEN '45-54'
WHEN age < 65 THEN '55-64' WHEN age >= 65 THEN '65+' ELSE 'Unknown' END AS age_band, datesub('year', b, DATE '2001-12-31')::INTEGER AS full_years
FROM (SELECT o_orderkey, b, CAST(floor(date_diff('day', b, DATE '2001-12-31') / 365.25) AS INTEGER) AS age FROM
(SELECT o_orderkey, CAST(o_orderdate AS DATE) - CAST(o_custkey AS INTEGER) * 15 AS b FROM orders))""")
def _(spark, sf):
    day = F.lit(views.AS_OF).cast("date")
    rows = table(spark, sf, "orders").withColumn("b", F.date_sub(F.col("o_orderdate").cast("date"), F.col("o_custkey").cast("int") * 15))
    age = bands.years_by_days("b", day)
    return rows.select(
        "o_orderkey", age.alias("age"), people.age_band(age).alias("age_band"), bands.full_years("b", day).alias("full_years")
    )


@query("birth_date_shift", """SELECT o_orderkey, CASE WHEN age < 0 THEN b - INTERVAL 960 MONTH WHEN age > 120 THEN b + INTERVAL 960 MONTH ELSE b END::DATE AS birth_date,
age < 0 OR age > 120 AS dq_birth_date_corrected FROM (SELECT o_orderkey, b, CASE WHEN b > DATE '2001-12-31' THEN -1 ELSE datesub('year', b, DATE '2001-12-31') END AS age FROM
(SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN CAST(o_orderdate AS DATE) + 3000 WHEN 'O' THEN CAST(o_orderdate AS DATE) - 50000 ELSE CAST(o_orderdate AS DATE) - 9000 END AS b FROM orders))""")
def _(spark, sf):
    day, s = F.col("o_orderdate").cast("date"), F.col("o_orderstatus")
    born = F.when(s == "F", F.date_add(day, 3000)).when(s == "O", F.date_sub(day, 50000)).otherwise(F.date_sub(day, 9000))
    rows = table(spark, sf, "orders").withColumns({"birth_date": born, "customer_type": F.lit("Individual")})
    fixed = people.shift_birth_dates(rows, F.lit(views.AS_OF).cast("date"))
    return fixed.select("o_orderkey", "birth_date", "dq_birth_date_corrected")


@query("birth_date_by_year", """SELECT o_orderkey, CASE WHEN year(b) > 2030 THEN b - INTERVAL 960 MONTH WHEN year(b) < 1910 THEN b + INTERVAL 960 MONTH ELSE b END::DATE AS birth_date FROM
(SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN CAST(o_orderdate AS DATE) + 14000 WHEN 'O' THEN CAST(o_orderdate AS DATE) - 33000 ELSE CAST(o_orderdate AS DATE) - 9000 END AS b FROM orders)""")
def _(spark, sf):
    day, s = F.col("o_orderdate").cast("date"), F.col("o_orderstatus")
    born = F.when(s == "F", F.date_add(day, 14000)).when(s == "O", F.date_sub(day, 33000)).otherwise(F.date_sub(day, 9000))
    return table(spark, sf, "orders").select("o_orderkey", people.birth_date_by_year(born).alias("birth_date"))


@query("conform_schema", """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_custkey AS INTEGER) END AS o_custkey, NULL::DATE AS closed FROM orders""")
def _(spark, sf):
    declared = StructType.fromDDL("o_orderkey bigint, o_custkey int, closed date")
    return casting.conform(raw_orders(spark, sf), declared)


@query("risk_tier", """SELECT l_orderkey, l_linenumber, risk, CASE WHEN risk < 0.3 THEN 'Low' WHEN risk < 0.6 THEN 'Medium' WHEN risk < 0.8 THEN 'High' WHEN risk >= 0.8 THEN 'Critical' ELSE 'Unscored' END AS tier,
risk >= 0.8 OR l_returnflag = 'R' AS is_high_risk FROM (SELECT l_orderkey, l_linenumber, l_returnflag, CASE WHEN l_linestatus = 'F' THEN l_quantity / 50 END AS risk FROM lineitem)""")
def _(spark, sf):
    rows = table(spark, sf, "lineitem").withColumn("risk", F.when(F.col("l_linestatus") == "F", F.col("l_quantity") / 50))
    tier = people.risk_tier("risk")
    return rows.select(
        "l_orderkey", "l_linenumber", "risk", tier.alias("tier"),
        bands.any_of([F.col("risk") >= 0.8, F.col("l_returnflag") == "R"]).alias("is_high_risk"),
    )


@query("completeness", """SELECT c_custkey, s AS score, CASE WHEN s <= 2 THEN 'Poor' WHEN s <= 4 THEN 'Moderate' ELSE 'Complete' END AS band FROM (
SELECT c_custkey, 2 + CAST(c_acctbal > 0 AS INT) + CAST(c_acctbal > 3000 AS INT) + CAST(c_acctbal > 6000 AS INT) + CAST(c_acctbal > 9000 AS INT) AS s FROM customer)""")
def _(spark, sf):
    rows = table(spark, sf, "customer").withColumns({
        f"v{n}": F.when(F.col("c_acctbal") > n, F.col("c_acctbal")) for n in (0, 3000, 6000, 9000)
    })
    score = bands.score(bands.present(["c_name", "c_mktsegment", "v0", "v3000", "v6000", "v9000"]))
    band = bands.band(score, people.COMPLETENESS_EDGES, people.COMPLETENESS_LABELS, closed="right")
    return rows.select("c_custkey", score.alias("score"), band.alias("band"))


@query("bucket_dpd", """SELECT l_orderkey, l_linenumber, CASE WHEN d <= 30 THEN '1-30' WHEN d <= 60 THEN '31-60' WHEN d <= 90 THEN '61-90' ELSE '90+' END AS dpd_bucket,
CASE WHEN a < 1000 THEN '<1k' WHEN a < 5000 THEN '1k-5k' WHEN a < 10000 THEN '5k-10k' ELSE '10k+' END AS arrears_bucket,
CASE WHEN p < 25 THEN 'Low' WHEN p < 50 THEN 'Medium' WHEN p < 75 THEN 'High' ELSE 'Major' END AS participation_bucket
FROM (SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag <> 'R' THEN CAST(l_quantity * 3 AS INT) END AS d, CASE WHEN l_linestatus = 'F' THEN l_extendedprice / 5 END AS a, l_quantity * 2 AS p FROM lineitem)""")
def _(spark, sf):
    rows = table(spark, sf, "lineitem")
    days = F.when(F.col("l_returnflag") != "R", (F.col("l_quantity") * 3).cast("int"))
    arrears = F.when(F.col("l_linestatus") == "F", F.col("l_extendedprice") / 5)
    return rows.select(
        "l_orderkey", "l_linenumber", lending.dpd_bucket(days).alias("dpd_bucket"),
        lending.arrears_bucket(arrears).alias("arrears_bucket"),
        lending.participation_bucket(F.col("l_quantity") * 2).alias("participation_bucket"),
    )


@query("map_lookup", """SELECT event_id, CASE event_type WHEN 'error' THEN 'failed' WHEN 'purchase' THEN 'paid' ELSE 'unknown' END AS label FROM events""")
def _(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", bands.map_lookup("event_type", {"error": "failed", "purchase": "paid"}, "unknown").alias("label")
    )


@query("fill_not_applicable", """SELECT event_id, CASE WHEN event_type IN ('view', 'click') AND value <= 20 THEN 'not_applicable' WHEN value > 20 THEN event_type END AS category FROM events""")
def _(spark, sf):
    rows = table(spark, sf, "events").withColumn("category", F.when(F.col("value") > 20, F.col("event_type")))
    return rows.select("event_id", bands.fill_when("category", F.col("event_type").isin("view", "click"), "not_applicable").alias("category"))


# ---- JSON bridges

HOLDER_SCHEMA = "array<struct<supplier: string, role: string, since: string>>"
HOLDERS_SQL = """(SELECT o_orderkey AS account_id, CAST(o_custkey AS VARCHAR) AS supplier, CASE WHEN o_totalprice > 100000 THEN 'primary_holder' ELSE 'clerk' END AS role,
CAST(o_orderdate AS DATE) AS since FROM orders WHERE o_orderstatus <> 'P' UNION ALL
SELECT o_orderkey, o_orderpriority, CASE WHEN o_orderpriority = '1-URGENT' THEN 'primary_holder' ELSE 'joint_holder' END, CAST(o_orderdate AS DATE) + 10 FROM orders WHERE o_orderstatus = 'F')"""


def holder_json(spark, sf):
    """Accounts with a JSON array of one or two holders; pending ones carry ``[]``."""
    def item(who, role, since):
        return F.struct(who.alias("supplier"), role.alias("role"), F.date_format(since, "yyyy-MM-dd").alias("since"))

    day = F.col("o_orderdate").cast("date")
    first = item(F.col("o_custkey").cast("string"), F.when(F.col("o_totalprice") > 100000, "primary_holder").otherwise("clerk"), day)
    second = item(
        F.col("o_orderpriority"), F.when(F.col("o_orderpriority") == "1-URGENT", "primary_holder").otherwise("joint_holder"), F.date_add(day, 10)
    )
    status = F.col("o_orderstatus")
    arrays = F.when(status == "F", F.to_json(F.array(first, second))).when(status == "O", F.to_json(F.array(first))).otherwise("[]")
    return table(spark, sf, "orders").select(F.col("o_orderkey").alias("account_id"), arrays.alias("holders"))


def holder_rows(spark, sf):
    rows = bridge.explode_json(holder_json(spark, sf), "holders", HOLDER_SCHEMA, ["account_id"])
    return rows.withColumn("since", F.col("since").try_cast("date"))


@query("bridge_explode", f"""SELECT account_id, supplier, role, since, CASE role WHEN 'primary_holder' THEN 'Primary Holder' WHEN 'joint_holder' THEN 'Joint Holder'
ELSE 'Other' END AS relationship_type FROM {HOLDERS_SQL}""")
def _(spark, sf):
    return holder_rows(spark, sf).withColumn("relationship_type", bands.map_lookup("role", holdings.ROLE_LABELS, "Other"))


@query("bridge_checks", f"""SELECT CAST(0 AS BIGINT) AS null_members, CAST(0 AS BIGINT) AS null_groups, count(*) FILTER (WHERE p = 0) AS no_primary,
count(*) FILTER (WHERE p > 1) AS several_primaries FROM (SELECT account_id, count(*) FILTER (WHERE role = 'primary_holder') AS p FROM {HOLDERS_SQL} GROUP BY 1)""")
def _(spark, sf):
    return quality.bridge_checks(holder_rows(spark, sf), "account_id", "supplier", F.col("role") == "primary_holder")


@query("primary_holder", f"""SELECT account_id, supplier, since FROM (SELECT *, row_number() OVER (PARTITION BY account_id ORDER BY since, supplier) AS rn
FROM {HOLDERS_SQL} WHERE role = 'primary_holder') WHERE rn = 1""")
def _(spark, sf):
    return bridge.primary_holder(holder_rows(spark, sf), "account_id", "role", "primary_holder", ["since", "supplier"]).drop("role")


@query("malformed_json", """SELECT count(*) FILTER (WHERE event_type = 'error') AS malformed FROM events""")
def _(spark, sf):
    broken = table(spark, sf, "events").withColumn(
        "j", F.when(F.col("event_type") == "error", F.concat(F.lit("["), "props")).otherwise(F.concat(F.lit("["), "props", F.lit("]")))
    )
    return bridge.malformed_json(broken, "j", "array<struct<k: int>>")
