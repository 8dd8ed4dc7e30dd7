"""The silver builders on the test tables dressed as bronze."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import bands
from ..operators.quality import run_rules
from ..plans import dims, entities
from ..plans.entities import payments
from ..plans.runs import run_silver
from ..session import fresh_path
from ..sources import tables
from . import views
from .registry import query, table

CTX = views.CTX


def bronze(df: DataFrame, day: Column, **columns: Column) -> DataFrame:
    """Source columns plus the bronze audit columns, with the period of ``day``."""
    meta = {
        "_source_file": F.lit("landing"), "_ingest_timestamp": day.cast("timestamp"), "_batch_id": F.lit("b1"),
        "_commit_sha": F.lit("c0ffee"), "year": F.date_format(day, "yyyy"), "month": F.date_format(day, "MM"),
    }
    return df.select(*[c.alias(n) for n, c in {**columns, **meta}.items()])


def text(column: str) -> Column:
    return F.col(column).cast("string")


# ---- customers

def customer_bronze(spark, sf):
    segment = F.col("c_mktsegment")
    individual = segment.isin("HOUSEHOLD", "BUILDING", "AUTOMOBILE")
    return bronze(
        table(spark, sf, "customer"), F.date_add(F.lit("1994-01-01").cast("date"), F.col("c_custkey").cast("int")),
        customer_id=text("c_custkey"),
        customer_type=F.when(individual, " Individual").when(segment == "MACHINERY", "Company ").otherwise("Organization"),
        full_name=F.col("c_name"), gender=F.lit(" f "), citizenship=F.when(F.col("c_nationkey") < 5, "za, gb").when(F.col("c_nationkey") < 15, "ZA"),
        birth_date=F.date_format(F.date_add(F.lit("1950-01-01").cast("date"), (F.col("c_acctbal") * 2).cast("int")), "yyyy-MM-dd"),
        id_type=F.when(F.col("c_nationkey") < 12, "National ID").otherwise("Passport"),
        id_number=F.concat(F.lit("500101"), F.lpad(text("c_custkey"), 7, "0")),
        annual_income=F.when(F.col("c_acctbal") > 0, (F.col("c_acctbal") * 150).cast("string")),
        annual_turnover=F.when(~individual, (F.col("c_acctbal") * 2000).cast("string")),
        risk_score=F.when(F.col("c_acctbal") > 0, F.col("c_acctbal") / 10000),
        is_pep=F.when(F.col("c_nationkey") == 3, "true").when(F.col("c_nationkey") > 4, "false"),
        sanctioned_country=F.lit("false"), email=F.concat(F.lit(" "), F.lower("c_mktsegment"), F.lit("@Mail.example")),
        phone_number=F.concat(F.lit("+2782"), F.lpad(text("c_custkey"), 7, "0")),
        residential_address=F.when(F.col("c_nationkey") < 20, text("c_nationkey")),
        capture_channel=F.when(F.col("c_nationkey") < 10, "Mobile App").otherwise("branch"),
    )


CUSTOMER_SQL = """(SELECT *, CASE WHEN inc THEN c_acctbal * 150 END AS annual_income, CASE WHEN inc THEN c_acctbal / 10000 END AS risk_score,
CASE WHEN c_nationkey < 5 THEN 'ZA, GB' WHEN c_nationkey < 15 THEN 'ZA' END AS citizenship, CASE WHEN ind AND b0 > DATE '2001-12-31' THEN CAST(b0 - INTERVAL 960 MONTH AS DATE) ELSE b0 END AS b
FROM (SELECT *, c_acctbal > 0 AS inc, c_mktsegment IN ('HOUSEHOLD', 'BUILDING', 'AUTOMOBILE') AS ind, DATE '1950-01-01' + CAST(trunc(c_acctbal * 2) AS INTEGER) AS b0 FROM customer))"""


@query("silver_customers", f"""SELECT CAST(c_custkey AS VARCHAR) AS customer_id, CASE WHEN ind THEN 'Individual' WHEN c_mktsegment = 'MACHINERY' THEN 'Company' ELSE 'Organization' END AS customer_type,
'F' AS gender, b AS birth_date, CAST(floor(date_diff('day', b, DATE '2001-12-31') / 365.25) AS INTEGER) AS age,
sha256(concat('500101', lpad(CAST(c_custkey AS VARCHAR), 7, '0'), 'pepper')) AS id_number, CASE WHEN c_nationkey < 12 THEN strftime(b, '%y%m%d') = '500101' END AS id_dob_match,
concat(sha256(concat(lower(c_mktsegment), 'pepper')), '@mail.example') AS email, 'ZA' AS phone_country_code, TRUE AS is_valid_email,
CASE WHEN citizenship IS NOT NULL THEN citizenship NOT IN ('ZA', 'South Africa') END AS is_foreign_national, c_nationkey < 5 AS is_dual_citizen, CASE WHEN c_nationkey < 15 THEN 'ZA' END AS primary_citizenship,
CASE WHEN risk_score < 0.3 THEN 'Low' WHEN risk_score < 0.6 THEN 'Medium' WHEN risk_score < 0.8 THEN 'High' WHEN risk_score >= 0.8 THEN 'Critical' ELSE 'Unscored' END AS kyc_risk_tier,
CASE WHEN (CASE WHEN c_nationkey = 3 THEN TRUE WHEN c_nationkey > 4 THEN FALSE END) OR coalesce(risk_score >= 0.8, FALSE) THEN 'High Risk' ELSE 'Standard Risk' END AS risk_segment,
(CASE WHEN c_nationkey = 3 THEN TRUE WHEN c_nationkey > 4 THEN FALSE END) OR coalesce(risk_score >= 0.8, FALSE) AS is_high_risk,
CAST(3 + CAST(c_nationkey < 20 AS INT) + 2 * CAST(inc AS INT) AS INTEGER) AS completeness_score, c_nationkey < 10 AS is_digital_customer,
CASE WHEN NOT ind THEN CASE WHEN c_acctbal * 2000 < 1000000 THEN 'Small Business' WHEN c_acctbal * 2000 < 10000000 THEN 'Medium Business' ELSE 'Large Enterprise' END END AS business_segment,
CASE WHEN ind THEN CASE WHEN annual_income >= 1000000 THEN 'Affluent' WHEN annual_income >= 200000 THEN 'Mass Market' ELSE 'Entry Level' END END AS customer_segment,
risk_score IS NOT NULL AND citizenship IS NOT NULL AS segmentation_ready, CAST(floor(date_diff('day', DATE '1994-01-01' + CAST(c_custkey AS INTEGER), DATE '2001-12-31') / 365.25) AS INTEGER) AS customer_tenure_years
FROM {CUSTOMER_SQL}""")
def _(spark, sf):
    return entities.customers(customer_bronze(spark, sf), CTX).select(
        "customer_id", "customer_type", "gender", "birth_date", "age", "id_number", "id_dob_match", "email", "phone_country_code",
        "is_valid_email", "is_foreign_national", "is_dual_citizen", "primary_citizenship", "kyc_risk_tier", "risk_segment", "is_high_risk",
        "completeness_score", "is_digital_customer", "business_segment", "customer_segment", "segmentation_ready", "customer_tenure_years",
    )


@query("silver_customers_split", f"""SELECT 'individual' AS part, count(*) AS row_count, count(*) FILTER (WHERE dup) AS duplicate_emails FROM (
SELECT count(*) OVER (PARTITION BY c_mktsegment) > 1 AS dup FROM {CUSTOMER_SQL} WHERE ind) UNION ALL SELECT 'business', count(*), 0 FROM {CUSTOMER_SQL} WHERE NOT ind""")
def _(spark, sf):
    people, firms = entities.split_customers(entities.customers(customer_bronze(spark, sf), CTX))
    a = people.agg(F.lit("individual").alias("part"), F.count(F.lit(1)).alias("row_count"), F.count_if("is_duplicate_email").alias("duplicate_emails"))
    b = firms.agg(F.lit("business").alias("part"), F.count(F.lit(1)).alias("row_count"), F.lit(0).cast("bigint").alias("duplicate_emails"))
    return a.unionByName(b)


@query("silver_dim_customer", f"""SELECT CAST(c_custkey AS VARCHAR) AS customer_id, CASE WHEN ind THEN annual_income END AS annual_income, CASE WHEN NOT ind THEN c_acctbal * 2000 END AS annual_turnover,
CASE WHEN ind THEN 'F' END AS gender FROM {CUSTOMER_SQL}""")
def _(spark, sf):
    people, firms = entities.split_customers(entities.customers(customer_bronze(spark, sf), CTX))
    return dims.customer_dim(people, firms).select("customer_id", "annual_income", "annual_turnover", "gender")


# ---- accounts

def account_bronze(spark, sf):
    price, day = F.col("o_totalprice"), F.col("o_orderdate").cast("date")
    tier = {"1-URGENT": "Premium", "2-HIGH": "standard ", "3-MEDIUM": "basic"}
    return bronze(
        table(spark, sf, "orders"), day,
        account_id=text("o_orderkey"), customer_id=text("o_custkey"), account_number=F.lpad(text("o_orderkey"), 10, "7"),
        account_type=F.when(price < 100000, "Joint").when(price > 400000, "business").otherwise("cheque"),
        account_tier=bands.map_lookup("o_orderpriority", tier, "other"),
        account_status=bands.map_lookup("o_orderstatus", {"F": " Active", "O": "frozen", "P": "restricted"}),
        opening_date=F.date_format(day, "yyyy-MM-dd"), approval_date=F.date_format(F.date_add(day, 3), "yyyy-MM-dd"),
        status_change_date=F.when(F.col("o_orderstatus") != "F", F.date_format(F.date_add(day, 30), "yyyy-MM-dd")),
        overdraft_limit=F.when(price > 300000, price.cast("string")), credit_card_limit=F.lit("0"),
        currency=F.when(price > 450000, "usd").otherwise("zar"), is_primary_account=F.when(F.col("o_orderpriority") == "1-URGENT", "true").otherwise("false"),
        card_type=F.when(F.col("o_orderstatus") == "F", "gold credit card").when(F.col("o_orderstatus") == "O", "debit"),
        card_number=text("o_orderkey"), card_expiry_date=F.date_format(F.date_add(day, 1000), "yyyy-MM-dd"),
        proof_of_income_provided=F.lit("true"), tax_certificate_provided=F.when(F.col("o_orderstatus") == "P", "yes").otherwise("nonsense"),
        record_last_updated_at=F.date_format(day, "yyyy-MM-dd HH:mm:ss"), interest_rate=F.lit("7.5"),
    )


@query("silver_accounts", """SELECT CAST(o_orderkey AS VARCHAR) AS account_id, concat('****', right(lpad(CAST(o_orderkey AS VARCHAR), 10, '7'), 4)) AS account_number, sha256(concat(o_orderkey, 'pepper')) AS card_number,
age AS account_age_days, CASE WHEN age < 90 THEN 'New (<3 months)' WHEN age < 365 THEN 'Recent (3-12 months)' WHEN age < 1095 THEN 'Established (1-3 years)' ELSE 'Mature (3+ years)' END AS account_age_band,
o_orderstatus = 'F' AS is_active, o_orderstatus <> 'F' AS is_inactive, o_orderstatus = 'O' AS is_at_risk,
CASE o_orderpriority WHEN '1-URGENT' THEN 'Premium — gold/platinum' WHEN '2-HIGH' THEN 'Standard — cheque/current/business' WHEN '3-MEDIUM' THEN 'Basic — easy/savings/joint' ELSE 'Unknown' END AS tier_label,
o_totalprice > 300000 AS has_overdraft, FALSE AS has_credit_card, o_totalprice > 450000 AS is_foreign_currency, CASE WHEN o_totalprice > 450000 THEN 'USD' ELSE 'ZAR' END AS currency,
o_totalprice < 100000 AS is_joint_account, o_totalprice > 400000 AS is_business_account, d + 1000 > DATE '2001-12-31' AS card_valid, date_diff('day', DATE '2001-12-31', d + 1000) BETWEEN 0 AND 90 AS card_expiring_soon,
CASE o_orderstatus WHEN 'F' THEN 'credit' WHEN 'O' THEN 'debit' ELSE 'none' END AS card_category, CASE WHEN o_orderstatus = 'P' THEN 2 ELSE 1 END::INTEGER AS onboarding_doc_score,
CASE WHEN o_orderstatus <> 'F' THEN age - 30 END::INTEGER AS days_since_status_change, 3::INTEGER AS approval_lag_days, coalesce(pr > 1, NULL) AS primary_account_violation, n > 1 AS multi_account_flag
FROM (SELECT *, CAST(o_orderdate AS DATE) AS d, date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-12-31')::INTEGER AS age, count(*) OVER (PARTITION BY o_custkey) AS n,
nullif(count(*) FILTER (WHERE o_orderpriority = '1-URGENT') OVER (PARTITION BY o_custkey), 0) AS pr FROM orders)""")
def _(spark, sf):
    return entities.accounts(account_bronze(spark, sf), CTX).select(
        "account_id", "account_number", "card_number", "account_age_days", "account_age_band", "is_active", "is_inactive", "is_at_risk", "tier_label",
        "has_overdraft", "has_credit_card", "is_foreign_currency", "currency", "is_joint_account", "is_business_account", "card_valid",
        "card_expiring_soon", "card_category", "onboarding_doc_score", "days_since_status_change", "approval_lag_days",
        "primary_account_violation", "multi_account_flag",
    )


@query("silver_dim_account", """SELECT CAST(o_orderkey AS VARCHAR) AS account_id, CAST(o_orderdate AS DATE) AS effective_from,
CASE WHEN o_totalprice > 300000 THEN DATE '2001-12-30' ELSE DATE '9999-12-31' END AS effective_to, o_totalprice <= 300000 AS is_current, CASE WHEN o_totalprice > 300000 THEN o_totalprice END AS overdraft_limit FROM orders
UNION ALL SELECT CAST(o_orderkey AS VARCHAR), DATE '2001-12-31', DATE '9999-12-31', TRUE, o_totalprice + 1 FROM orders WHERE o_totalprice > 300000""")
def _(spark, sf):
    """First load, then a snapshot in which every overdraft limit has grown."""
    silver = entities.accounts(account_bronze(spark, sf), CTX).withColumns({"branch_code": F.lit("b"), "opening_channel": F.lit("o")})
    first = dims.account_dim(None, silver, CTX)
    second = dims.account_dim(first, silver.withColumn("overdraft_limit", F.col("overdraft_limit") + 1), CTX)
    return second.select("account_id", "effective_from", "effective_to", "is_current", "overdraft_limit")


@query("silver_bridge", """SELECT CAST(o_custkey AS VARCHAR) AS customer_id, CAST(o_orderkey AS VARCHAR) AS account_id, CASE WHEN o_orderstatus = 'F' THEN 'Primary Holder' ELSE 'Director' END AS relationship_type,
o_orderstatus = 'F' AS is_primary_holder, CAST(o_orderdate AS DATE) AS effective_date, TRUE AS is_active FROM orders WHERE o_orderstatus <> 'P'""")
def _(spark, sf):
    item = F.struct(
        text("o_custkey").alias("customer_id"), F.when(F.col("o_orderstatus") == "F", "primary_holder").otherwise("director").alias("signatory_role"),
        F.lit("dual").alias("signing_rule"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("effective_date"), F.lit(True).alias("is_active"),
    )
    nothing = F.lit(None).cast("string")
    rows = bronze(
        table(spark, sf, "orders"), F.col("o_orderdate").cast("date"), account_id=text("o_orderkey"), record_last_updated_at=text("o_orderdate"),
        signatories_json=F.when(F.col("o_orderstatus") == "P", "null").otherwise(F.to_json(F.array(item))),
        is_primary_account=F.lit(True), account_type=nothing, account_status=nothing, currency=nothing, branch_code=nothing,
    )
    return entities.bridge_customer_account(rows, CTX).select(
        "customer_id", "account_id", "relationship_type", "is_primary_holder", "effective_date", "is_active"
    )


def people_and_accounts(spark, sf):
    people = table(spark, sf, "customer").filter("c_acctbal > 0").select(text("c_custkey").alias("customer_id"))
    accounts = table(spark, sf, "orders").filter("o_orderstatus <> 'P'").select(text("o_orderkey").alias("account_id"))
    return people, accounts


ORPHANS_SQL = "c_acctbal <= 0 AS is_orphan_customer, o_orderstatus = 'P' AS is_orphan_account"


@query("silver_signatories", f"""SELECT CAST(o_orderkey AS VARCHAR) AS account_id, CAST(o_custkey AS VARCHAR) AS customer_id, l_returnflag = 'A' AS is_primary_holder, l_returnflag <> 'N' AS requires_multiple_signatures,
CAST(l_shipdate AS DATE) AS effective_date, count(*) OVER (PARTITION BY o_orderkey) AS signatory_count_on_account, {ORPHANS_SQL} FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey""")
def _(spark, sf):
    flag = F.col("l_returnflag")
    joined = table(spark, sf, "lineitem").join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    rows = bronze(
        joined, F.col("l_shipdate").cast("date"), account_id=text("o_orderkey"), customer_id=text("o_custkey"),
        signatory_role=F.when(flag == "A", " Primary_Holder").otherwise("director"),
        signing_rule=F.when(flag == "A", "DUAL").when(flag == "R", "tiered ").otherwise("single"),
        effective_date=F.date_format("l_shipdate", "yyyy-MM-dd"), is_active=F.lit("true"),
    )
    people, accounts = people_and_accounts(spark, sf)
    return entities.signatories(rows, people, accounts).select(
        "account_id", "customer_id", "is_primary_holder", "requires_multiple_signatures", "effective_date", "signatory_count_on_account",
        "is_orphan_customer", "is_orphan_account",
    )


# ---- events on accounts

@query("silver_status_events", """SELECT account_id, event_date, event_type, new_status, new_status IN ('frozen', 'suspended') AS is_closure_event, status_reason = 'fraud_suspicion' AS is_risk_related,
CAST(row_number() OVER (PARTITION BY account_id ORDER BY event_date, event_type, new_status, status_reason) AS INTEGER) AS event_sequence_on_account, CAST(account_id AS BIGINT) >= 100 AS is_orphan_account FROM (
SELECT CAST(user_id AS VARCHAR) AS account_id, CAST(ts AS DATE) AS event_date, event_type, CASE event_type WHEN 'error' THEN 'frozen' WHEN 'view' THEN 'active' ELSE 'suspended' END AS new_status,
CASE WHEN value > 100 THEN 'fraud_suspicion' ELSE 'routine' END AS status_reason FROM events)""")
def _(spark, sf):
    kind, day = F.col("event_type"), F.col("ts").cast("date")
    rows = bronze(
        table(spark, sf, "events"), day, account_id=text("user_id"),
        event_date=F.when(F.dayofmonth(day) > 12, F.date_format(day, "MM/dd/yyyy")).otherwise(F.date_format(day, "yyyy-MM-dd")),
        event_type=F.upper(kind), new_status=F.when(kind == "error", "Frozen").when(kind == "view", "active").otherwise("SUSPENDED"),
        status_reason=F.when(F.col("value") > 100, "fraud_suspicion").otherwise("routine"),
    )
    accounts = table(spark, sf, "customer").filter("c_custkey < 100").select(text("c_custkey").alias("account_id"))
    out = entities.status_events(rows, accounts)
    return out.select(
        "account_id", "event_date", "event_type", "new_status", "is_closure_event", "is_risk_related", "event_sequence_on_account", "is_orphan_account"
    )


@query("silver_limits_history", """SELECT account_id, event_date, overdraft_limit, coalesce(overdraft_limit, 0) + coalesce(credit_card_limit, 0) AS total_limit_exposure, change_reason = 'risk_review' AS is_risk_driven_change,
CAST(row_number() OVER w AS INTEGER) AS change_sequence_on_account, overdraft_limit - lag(overdraft_limit) OVER w AS overdraft_limit_delta, credit_card_limit - lag(credit_card_limit) OVER w AS credit_card_limit_delta FROM (
SELECT CAST(user_id AS VARCHAR) AS account_id, CAST(ts AS DATE) AS event_date, event_type, CASE WHEN event_type <> 'view' THEN round(value, 0) END AS overdraft_limit, round(value / 2, 0) AS credit_card_limit,
CASE WHEN value > 100 THEN 'risk_review' ELSE 'growth' END AS change_reason FROM events) WINDOW w AS (PARTITION BY account_id ORDER BY event_date, event_type, overdraft_limit NULLS FIRST, credit_card_limit NULLS FIRST)""")
def _(spark, sf):
    rows = bronze(
        table(spark, sf, "events"), F.col("ts").cast("date"), account_id=text("user_id"), event_date=F.date_format("ts", "yyyy-MM-dd"),
        event_type=F.col("event_type"), overdraft_limit=F.when(F.col("event_type") != "view", F.round("value", 0).cast("string")),
        credit_card_limit=F.round(F.col("value") / 2, 0).cast("string"),
        change_reason=F.when(F.col("value") > 100, " Risk_Review").otherwise("growth"),
    )
    accounts = table(spark, sf, "customer").select(text("c_custkey").alias("account_id"))
    return entities.limits_history(rows, accounts).select(
        "account_id", "event_date", "overdraft_limit", "total_limit_exposure", "is_risk_driven_change", "change_sequence_on_account",
        "overdraft_limit_delta", "credit_card_limit_delta",
    )


@query("silver_enrollments", """SELECT account_id, enrollment_date, product_code, enrollment_status = 'active' AS is_active_enrollment, product_code = 'credit_card' AS is_credit_product, count(*) OVER (PARTITION BY account_id) AS product_count_on_account,
CAST(row_number() OVER (PARTITION BY account_id ORDER BY enrollment_date, product_code, enrollment_status) AS INTEGER) AS enrollment_sequence_on_account, CASE product_code WHEN 'credit_card' THEN 'credit_products' ELSE 'other' END AS product_category,
CAST(enrollment_status <> 'active' AS INTEGER) AS is_closed FROM (SELECT CAST(l_orderkey AS VARCHAR) AS account_id, CAST(l_shipdate AS DATE) AS enrollment_date,
CASE WHEN p_type = 'PROMO' THEN 'credit_card' ELSE lower(p_type) END AS product_code, CASE WHEN l_linestatus = 'O' THEN 'active' ELSE 'cancelled' END AS enrollment_status FROM lineitem JOIN part ON l_partkey = p_partkey)""")
def _(spark, sf):
    sold = table(spark, sf, "lineitem").join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    rows = bronze(
        sold, F.col("l_shipdate").cast("date"), account_id=text("l_orderkey"), enrollment_date=F.date_format("l_shipdate", "yyyy-MM-dd"),
        product_code=F.when(F.col("p_type") == "PROMO", "Credit_Card ").otherwise(F.col("p_type")),
        enrollment_status=F.when(F.col("l_linestatus") == "O", "ACTIVE").otherwise("cancelled"),
    )
    _, accounts = people_and_accounts(spark, sf)
    return entities.enrollments(rows, accounts, family_flags=True).select(
        "account_id", "enrollment_date", "product_code", "is_active_enrollment", "is_credit_product", "product_count_on_account",
        "enrollment_sequence_on_account", "product_category", "is_closed",
    )


# ---- payments

TIES = ["l_extendedprice", "l_quantity", "l_suppkey", "l_partkey", "l_returnflag", "l_linestatus"]
NEWEST_LINES_SQL = f"""(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber, CAST(l_shipdate AS DATE)
ORDER BY {', '.join(c + ' DESC' for c in TIES)}) AS rn FROM lineitem) WHERE rn = 1)"""


def transaction_bronze(spark, sf):
    part = F.struct(
        F.concat(F.lit("d"), F.col("l_partkey")).alias("debit_order_id"), F.when(F.col("l_quantity") > 40, "Salary").otherwise("Insurance").alias("debit_order_type"),
        F.lit("Monthly").alias("frequency"), F.lit("payee").alias("beneficiary_name"), F.lit("true").alias("is_immediate_payment"),
    )
    day = F.col("l_shipdate").cast("date")
    return bronze(
        table(spark, sf, "lineitem"), day, transaction_id=F.concat_ws("-", text("l_orderkey"), text("l_linenumber")), account_id=text("l_orderkey"),
        transaction_timestamp=F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("T10:20:30")), transaction_date=F.date_format(day, "yyyy-MM-dd"),
        transaction_time=F.lit("bad"), amount=text("l_extendedprice"), transaction_cost=text("l_quantity"),
        category=F.when(F.col("l_returnflag") == "R", "Debit_Order").when(F.col("l_returnflag") == "A", "loan_payment").otherwise("scheduled_payment"),
        debit_credit=F.when(F.col("l_linestatus") == "F", "credit").otherwise(" Debit"), status=F.when(F.col("l_quantity") < 45, "Completed").otherwise("failed"),
        channel=F.when(F.col("l_linenumber") == 1, "Online").when(F.col("l_linenumber") == 2, " Mobile ").otherwise("ATM"),
        currency=F.when(F.col("l_linestatus") == "F", "usd"), debit_order_id=F.lit("flat copy"), receiving_account=F.lpad(text("l_suppkey"), 8, "0"),
        debit_order_metadata=F.when(F.col("l_returnflag") == "R", part), tie=F.struct(*TIES),
    )


@query("silver_transactions", """SELECT concat_ws('-', l_orderkey, l_linenumber) AS transaction_id, CAST(l_shipdate AS DATE) AS transaction_date, CAST(l_shipdate AS DATE) + TIME '10:20:30' AS transaction_timestamp,
count(*) AS n, count(*) FILTER (WHERE l_quantity < 45) > 0 AS any_completed FROM lineitem GROUP BY ALL""")
def _(spark, sf):
    """Row identity of the builder: one row per id and date, with the number of source rows beside it."""
    rows = transaction_bronze(spark, sf)
    silver = entities.transactions(rows, CTX).select("transaction_id", "transaction_date", F.col("transaction_timestamp").cast("timestamp_ntz").alias("transaction_timestamp"))
    source = rows.groupBy(F.col("transaction_id").alias("i"), F.col("transaction_date").cast("date").alias("d")).agg(
        F.count(F.lit(1)).alias("n"), (F.count_if(F.col("status") == "Completed") > 0).alias("any_completed")
    )
    return silver.join(source, (F.col("transaction_id") == F.col("i")) & (F.col("transaction_date") == F.col("d"))).drop("i", "d")


@query("silver_transaction_flags", f"""SELECT concat_ws('-', l_orderkey, l_linenumber) AS transaction_id, CAST(l_shipdate AS DATE) AS transaction_date, l_extendedprice AS amount, l_quantity AS transaction_cost,
l_linestatus = 'F' AS is_credit, l_quantity < 45 AS is_completed, l_returnflag = 'R' AS is_debit_order, l_returnflag <> 'A' AS is_recurring, CASE WHEN l_returnflag = 'R' THEN concat('d', l_partkey) END AS do_debit_order_id,
coalesce(l_linestatus = 'F' AND l_returnflag = 'R' AND l_quantity > 40, FALSE) AS is_salary_candidate, CASE WHEN l_linestatus = 'F' THEN 'USD' ELSE 'ZAR' END AS currency,
CASE l_linenumber WHEN 1 THEN 'online_banking' WHEN 2 THEN 'mobile_banking_app' ELSE 'atm' END AS channel, CASE WHEN l_returnflag = 'R' THEN sha256('payeepepper') END AS do_beneficiary_name,
concat('****', right(lpad(CAST(l_suppkey AS VARCHAR), 8, '0'), 4)) AS receiving_account, CAST(year(l_shipdate) AS INTEGER) AS transaction_year, CAST(dayofweek(l_shipdate) + 1 AS INTEGER) AS transaction_day_of_week
FROM {NEWEST_LINES_SQL}""")
def _(spark, sf):
    return entities.transactions(transaction_bronze(spark, sf), CTX, ties=["tie"]).select(
        "transaction_id", "transaction_date", "amount", "transaction_cost", "is_credit", "is_completed", "is_debit_order", "is_recurring",
        "do_debit_order_id", F.coalesce("is_salary_candidate", F.lit(False)).alias("is_salary_candidate"), "currency", "channel",
        "do_beneficiary_name", "receiving_account", "transaction_year", "transaction_day_of_week",
    )


@query("silver_transaction_rules", """SELECT rule, 'fail' AS severity, count(*) AS checked, CAST(0 AS BIGINT) AS failed, 0.0::DOUBLE AS pct FROM (SELECT DISTINCT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS d FROM lineitem),
(VALUES ('transaction_id_null'), ('account_id_null'), ('transaction_timestamp_null'), ('transaction_date_null'), ('amount_null'), ('debit_credit_null'), ('status_null'), ('channel_null')) v(rule) GROUP BY rule""")
def _(spark, sf):
    return run_rules(entities.transactions(transaction_bronze(spark, sf), CTX), payments.transaction_rules())


@query("silver_deposits", f"""SELECT is_initial_deposit, debit_credit, count(*) AS row_count, CAST(sum(CAST(amount AS DECIMAL(18, 2))) AS DOUBLE) AS amount FROM (
SELECT FALSE AS is_initial_deposit, CASE WHEN l_linestatus = 'F' THEN 'credit' ELSE 'debit' END AS debit_credit, l_extendedprice AS amount FROM {NEWEST_LINES_SQL}
UNION ALL SELECT TRUE, 'credit', o_totalprice FROM orders) GROUP BY ALL""")
def _(spark, sf):
    """Late deposits join the transactions exactly once."""
    deposits = bronze(
        table(spark, sf, "orders"), F.col("o_orderdate").cast("date"), account_id=text("o_orderkey"), amount=F.col("o_totalprice"),
        channel=F.lit("Branch"), transaction_date=F.col("o_orderdate").cast("date"), ch_branch_code=F.lit("b1"),
    )
    both = entities.transactions(transaction_bronze(spark, sf), CTX, deposits, ties=["tie"])
    total = F.sum(F.col("amount").cast("decimal(18, 2)")).cast("double")
    return both.groupBy("is_initial_deposit", "debit_credit").agg(F.count(F.lit(1)).alias("row_count"), total.alias("amount"))


@query("silver_debit_orders", """SELECT CAST(o_orderkey AS VARCHAR) AS debit_order_id, o_orderstatus = 'F' AS is_active, o_orderstatus = 'P' AS is_cancelled, o_orderpriority <> '5-LOW' AS is_recurring, o_totalprice > 250000 AS is_linked_to_loan,
sha256(concat('payee ', o_custkey, 'pepper')) AS beneficiary_name, o_orderstatus = 'O' AS notification_required, CAST(year(o_orderdate) AS INTEGER) AS effective_year, CAST(month(o_orderdate) AS INTEGER) AS effective_month, 12::INTEGER AS collection_day FROM orders""")
def _(spark, sf):
    rows = bronze(
        table(spark, sf, "orders"), F.col("o_orderdate").cast("date"), debit_order_id=text("o_orderkey"), amount=text("o_totalprice"),
        status=bands.map_lookup("o_orderstatus", {"F": "active", "O": "suspended", "P": "cancelled"}),
        frequency=F.when(F.col("o_orderpriority") == "5-LOW", "Once").otherwise(" Monthly"), linked_loan_id=F.when(F.col("o_totalprice") > 250000, text("o_orderkey")),
        beneficiary_name=F.concat(F.lit("payee "), F.col("o_custkey")), notification_required=F.when(F.col("o_orderstatus") == "O", "true"),
        record_last_updated_at=F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"), collection_day=F.lit("12.0"),
    )
    return entities.debit_orders(rows, CTX).select(
        "debit_order_id", "is_active", "is_cancelled", "is_recurring", "is_linked_to_loan", "beneficiary_name", "notification_required",
        "effective_year", "effective_month", "collection_day",
    )


@query("silver_atm_logs", """SELECT CAST(event_id AS VARCHAR) AS atm_log_id, event_type = 'purchase' AS is_financial_transaction, CASE WHEN event_type = 'purchase' THEN 'financial_transaction' ELSE 'atm_service_event' END AS atm_event_group,
CASE WHEN event_type = 'purchase' THEN 'approved' WHEN event_type = 'error' THEN 'insufficient_funds' ELSE 'unknown' END AS host_response_code_label, event_type = 'error' AS is_failed_attempt, value > 50 AS is_generic_location,
CASE WHEN value > 100 THEN 'cash' WHEN event_type <> 'purchase' THEN 'not_applicable' END AS transaction_category, sha256(concat(user_id, 'pepper')) AS ewallet_recipient_msisdn_masked, user_id >= 100 AS dq_orphan_customer,
event_type = 'view' AS dq_missing_balance FROM events""")
def _(spark, sf):
    kind = F.col("event_type")
    rows = bronze(
        table(spark, sf, "events"), F.col("ts").cast("date"), atm_log_id=text("event_id"), customer_id=text("user_id"),
        event_type=F.when(kind == "purchase", "Cash_Withdrawal").when(kind == "view", "balance_enquiry ").otherwise("pin_change"),
        host_response_code=F.when(kind == "purchase", "00").when(kind == "error", "51").otherwise("99"), attempt_result=F.when(kind == "error", "FAILED").otherwise("ok"),
        atm_location=F.when(F.col("value") > 50, "ATM network terminal").otherwise("Main road"), currency=F.lit("zar"),
        transaction_category=F.when(F.col("value") > 100, "Cash"), ewallet_recipient_msisdn_entered=text("user_id"),
    )
    people = table(spark, sf, "customer").select(text("c_custkey").alias("customer_id"))
    tables = [people.filter(F.col("customer_id").cast("int") < 50), people.filter(F.col("customer_id").cast("int").between(40, 99))]
    return entities.atm_logs(rows, tables, CTX).select(
        "atm_log_id", "is_financial_transaction", "atm_event_group", "host_response_code_label", "is_failed_attempt", "is_generic_location",
        "transaction_category", "ewallet_recipient_msisdn_masked", "dq_orphan_customer", "dq_missing_balance",
    )


# ---- lending

@query("silver_loans", """SELECT CAST(o_orderkey AS VARCHAR) AS loan_id, CASE o_orderstatus WHEN 'F' THEN 'Disbursed' WHEN 'O' THEN 'Rejected' ELSE 'Unknown' END AS loan_status, o_orderstatus = 'F' AS is_booked, o_orderstatus = 'O' AS is_rejected,
greatest(200000 - o_totalprice, 0) AS discretionary_income, o_orderpriority = '1-URGENT' AS is_fully_granted, o_totalprice > 250000 AS is_disbursed, CASE WHEN o_orderpriority <> '5-LOW' THEN 0.8::DOUBLE END AS loan_to_value_ratio,
CASE WHEN o_orderstatus <> 'P' THEN 5 END::INTEGER AS days_to_decision, CAST(year(o_orderdate) AS INTEGER) AS application_year FROM orders""")
def _(spark, sf):
    day, price = F.col("o_orderdate").cast("date"), F.col("o_totalprice")
    stamp = lambda d: F.date_format(d, "yyyy-MM-dd HH:mm:ss")
    rows = bronze(
        table(spark, sf, "orders"), day, loan_id=text("o_orderkey"), customer_id=text("o_custkey"),
        workflow_state=bands.map_lookup("o_orderstatus", {"F": "Booked", "O": "Declined"}, "Open"), application_date=stamp(day),
        decision_at=F.when(F.col("o_orderstatus") != "P", stamp(F.date_add(day, 5))), disbursed_at=F.when(price > 250000, stamp(day)),
        requested_amount=price.cast("string"), amount_granted=F.when(F.col("o_orderpriority") == "1-URGENT", price).otherwise(price / 2),
        discretionary_income=200000 - price, collateral_type=F.when(F.col("o_orderpriority") == "5-LOW", "none").otherwise("house"), loan_to_value_ratio=F.lit("0.8"),
    )
    return entities.loans(rows, CTX).select(
        "loan_id", "loan_status", "is_booked", "is_rejected", "discretionary_income", "is_fully_granted", "is_disbursed", "loan_to_value_ratio",
        "days_to_decision", "application_year",
    )


@query("silver_participations", """SELECT CAST(o_orderkey AS VARCHAR) AS participation_id, CASE WHEN p < 25 THEN 'Low' WHEN p < 50 THEN 'Medium' WHEN p < 75 THEN 'High' ELSE 'Major' END AS participation_bucket, o_orderstatus = 'F' AS is_incoming_participation,
CASE WHEN o_orderstatus = 'F' THEN 'External' ELSE 'Internal' END AS participation_source, o_orderstatus <> 'F' AS has_internal_loan, date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-12-31')::INTEGER AS participation_age_days,
o_totalprice * 25 / 100.0::DOUBLE AS retained_amount FROM (SELECT *, o_totalprice / 5000 AS p FROM orders)""")
def _(spark, sf):
    incoming = F.col("o_orderstatus") == "F"
    rows = bronze(
        table(spark, sf, "orders"), F.col("o_orderdate").cast("date"), participation_id=text("o_orderkey"), loan_id=F.when(~incoming, text("o_orderkey")),
        participation_direction=F.when(incoming, "incoming_participation").otherwise("outgoing_participation"), participation_pct=F.col("o_totalprice") / 5000,
        participation_amount=F.col("o_totalprice"), retained_pct=F.lit("25"), effective_date=F.date_format("o_orderdate", "yyyy-MM-dd"), status=F.lit("active"),
    )
    return entities.loan_participations(rows, CTX).select(
        "participation_id", "participation_bucket", "is_incoming_participation", "participation_source", "has_internal_loan", "participation_age_days", "retained_amount"
    )


@query("silver_collections", f"""SELECT CAST(o_orderkey AS VARCHAR) AS case_id, CASE WHEN a < 1000 THEN '<1k' WHEN a < 5000 THEN '1k-5k' WHEN a < 10000 THEN '5k-10k' ELSE '10k+' END AS arrears_bucket,
CASE WHEN dpd <= 30 THEN '1-30' WHEN dpd <= 60 THEN '31-60' WHEN dpd <= 90 THEN '61-90' ELSE '90+' END AS dpd_bucket, CASE o_orderstatus WHEN 'F' THEN 'low' WHEN 'O' THEN 'loss' END AS stage_risk, o_orderstatus = 'F' AS is_ptp_case, {ORPHANS_SQL}
FROM (SELECT *, o_totalprice / 40 AS a, CAST(o_totalprice / 4000 AS INTEGER) AS dpd0, CAST(floor(o_totalprice / 4000) AS INTEGER) AS dpd FROM orders) JOIN customer ON o_custkey = c_custkey""")
def _(spark, sf):
    rows = bronze(
        table(spark, sf, "orders"), F.col("o_orderdate").cast("date"), case_id=text("o_orderkey"), customer_id=text("o_custkey"), account_id=text("o_orderkey"),
        arrears_amount=(F.col("o_totalprice") / 40).cast("string"), days_past_due=F.floor(F.col("o_totalprice") / 4000).cast("string"),
        collection_stage=bands.map_lookup("o_orderstatus", {"F": "Pre_Delinquent", "O": "write_off"}, "other"),
        promise_to_pay_amount=F.when(F.col("o_orderstatus") == "F", "100"),
    )
    people, accounts = people_and_accounts(spark, sf)
    return entities.collections_cases(rows, people, accounts).select(
        "case_id", "arrears_bucket", "dpd_bucket", "stage_risk", "is_ptp_case", "is_orphan_customer", "is_orphan_account"
    )


@query("silver_incremental_run", """SELECT 'table' AS part, count(*) AS row_count, CAST(0 AS BIGINT) AS inserted, CAST(0 AS BIGINT) AS updated FROM orders
UNION ALL SELECT 'b1', count(*), count(*), 0 FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'
UNION ALL SELECT 'b2', count(*), count(*), 0 FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01'""")
def _(spark, sf):
    """Loans in two batches through marks, merge and audit; a third run finds nothing."""
    day = F.col("o_orderdate").cast("date")
    rows = bronze(table(spark, sf, "orders"), day, loan_id=text("o_orderkey"), workflow_state=F.lit("Booked"), requested_amount=text("o_totalprice"))
    root, control_root = fresh_path(spark, "loans"), fresh_path(spark, "control")
    first = rows.filter("_ingest_timestamp < timestamp'1999-01-01 00:00:00'")
    for part, batch in ((first, "b1"), (rows, "b2"), (rows, "b3")):
        run_silver("loans", part, entities.loans, root, ["loan_id"], control_root, replace(CTX, batch_id=batch))
    audit = tables.read_table(spark, f"{control_root}/silver_audit_log").select(
        F.col("batch_id").alias("part"), F.col("rows_processed").alias("row_count"), F.col("rows_inserted").alias("inserted"), F.col("rows_updated").alias("updated")
    )
    total = tables.current_snapshot(spark, root).agg(
        F.lit("table").alias("part"), F.count(F.lit(1)).alias("row_count"), F.lit(0).cast("bigint").alias("inserted"), F.lit(0).cast("bigint").alias("updated")
    )
    return total.unionByName(audit)


def in_two_runs(spark, rows, build, keys, group, cut):
    """The table after two incremental runs, split by arrival."""
    root, control_root = fresh_path(spark, "runs"), fresh_path(spark, "control")
    for part, batch in ((rows.filter(F.col("_ingest_timestamp") < F.lit(cut).cast("timestamp")), "b1"), (rows, "b2")):
        run_silver("p", part, build, root, keys, control_root, replace(CTX, batch_id=batch), group=group)
    return tables.current_snapshot(spark, root)


@query("incremental_accounts", """SELECT CAST(o_orderkey AS VARCHAR) AS account_id, o_orderstatus = 'F' AS is_active, coalesce(pr > 1, NULL) AS primary_account_violation, n > 1 AS multi_account_flag
FROM (SELECT *, count(*) OVER (PARTITION BY o_custkey) AS n, nullif(count(*) FILTER (WHERE o_orderpriority = '1-URGENT') OVER (PARTITION BY o_custkey), 0) AS pr FROM orders)""")
def _(spark, sf):
    """Counts per customer are right after the second run, also on rows of the first."""
    got = in_two_runs(spark, account_bronze(spark, sf), entities.accounts, ["account_id"], ["customer_id"], "1998-06-01")
    return got.select("account_id", "is_active", "primary_account_violation", "multi_account_flag")


@query("incremental_complaints", """SELECT CAST(event_id AS VARCHAR) AS comm_id, CASE WHEN n >= 8 THEN 'HIGH' WHEN n >= 5 THEN 'MEDIUM' ELSE 'LOW' END AS customer_risk_band
FROM (SELECT *, count(*) OVER (PARTITION BY user_id) AS n FROM events)""")
def _(spark, sf):
    rows, known = complaint_bronze(spark, sf)
    got = in_two_runs(spark, rows, lambda new, ctx: entities.complaints(new, *known), ["comm_id"], ["customer_id"], "2024-01-16")
    return got.select("comm_id", "customer_risk_band")


# ---- engagement

@query("silver_complaints", """SELECT CAST(event_id AS VARCHAR) AS comm_id, CASE WHEN event_type = 'error' THEN 'escalated' ELSE 'open' END AS resolution_status, CAST(ts AS DATE) AS comm_date, CAST(quarter(ts) AS INTEGER) AS comm_quarter, strftime(ts, '%A') AS day_of_week,
CASE WHEN n >= 8 THEN 'HIGH' WHEN n >= 5 THEN 'MEDIUM' ELSE 'LOW' END AS customer_risk_band, user_id >= 100 AS is_orphan_customer FROM (SELECT *, count(*) OVER (PARTITION BY user_id) AS n FROM events)""")
def _(spark, sf):
    rows, known = complaint_bronze(spark, sf)
    return entities.complaints(rows, *known).select(
        "comm_id", "resolution_status", "comm_date", "comm_quarter", "day_of_week", "customer_risk_band", "is_orphan_customer"
    )


def complaint_bronze(spark, sf):
    """Complaints, and the known customers and accounts."""
    rows = bronze(
        table(spark, sf, "events"), F.col("ts").cast("date"), comm_id=text("event_id"), customer_id=text("user_id"), account_id=text("user_id"),
        timestamp=F.date_format("ts", "dd/MM/yyyy HH:mm"), resolution_status=F.when(F.col("event_type") == "error", " Escalted").otherwise("Open"),
        subject=F.lit(" s "), body=F.col("props"),
    )
    people = table(spark, sf, "customer").filter("c_custkey < 100")
    return rows, (people.select(text("c_custkey").alias("customer_id")), people.select(text("c_custkey").alias("account_id")))


@query("silver_campaigns", """SELECT DISTINCT CAST(l_suppkey AS VARCHAR) AS campaign_id, CASE WHEN l_returnflag = 'A' THEN 'sms,email' ELSE 'sms' END AS channel, CASE WHEN l_linestatus = 'F' THEN 'Gauteng' ELSE 'Limpopo' END AS region,
CASE WHEN l_returnflag = 'A' THEN 2 ELSE 1 END::INTEGER AS channel_count, 365::INTEGER AS duration_days, TRUE AS is_active FROM lineitem""")
def _(spark, sf):
    rows = bronze(
        table(spark, sf, "lineitem"), F.col("l_shipdate").cast("date"), campaign_id=text("l_suppkey"), campaign_name=F.lit("n"), campaign_type=F.lit("T"),
        target_segment=F.lit("All"), product_focus=F.lit("P"), offer_summary=F.lit("o"), status=F.lit("Live"), success_metric=F.lit("m"),
        budget_zar=F.lit("10"), target_customers_count=F.lit("5"), channel=F.when(F.col("l_returnflag") == "A", "SMS,email").otherwise("sms"),
        region=F.when(F.col("l_linestatus") == "F", "Pretoria").otherwise("Limpopo"), start_date=F.lit("2001-07-01"), end_date=F.lit("2002-07-01"),
    )
    return entities.campaigns(rows, CTX).select("campaign_id", "channel", "region", "channel_count", "duration_days", "is_active")


@query("silver_responses", """SELECT CAST(event_id AS VARCHAR) AS response_id, event_type IN ('view', 'click', 'purchase') AS is_positive_response, event_type = 'error' AS is_negative_response, event_type = 'purchase' AS is_converted,
FALSE AS is_opted_out, CAST(year(ts) AS VARCHAR) AS response_year, CAST(month(ts) AS VARCHAR) AS response_month FROM events""")
def _(spark, sf):
    r = views.responses(spark, sf)
    rows = bronze(r, F.col("response_date"), **{c: F.col(c) for c in r.columns})
    return entities.campaign_responses(rows, CTX).select(
        "response_id", "is_positive_response", "is_negative_response", "is_converted", "is_opted_out", "response_year", "response_month"
    )
