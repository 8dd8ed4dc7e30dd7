"""Edge rows of the silver entities and a small end-to-end run."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stratum.operators import quality
from stratum.plans import customer360, dims, entities, fact, topics
from stratum.plans.entities import holdings, payments, people

T = dt.datetime
META = "_source_file string, _ingest_timestamp timestamp, _batch_id string, _commit_sha string, year string, month string"


def bronze(spark, schema, data, times=None):
    out = []
    for i, row in enumerate(data):
        at = times[i] if times else T(2024, 1, 1)
        out.append((*row, "f", at, "b", "c", f"{at:%Y}", f"{at:%m}"))
    return spark.createDataFrame(out, f"{schema}, {META}")


@pytest.fixture()
def people_rows(spark):
    schema = "customer_id string, customer_type string, birth_date string, id_type string, id_number string, email string, phone_number string, annual_income string, risk_score string, citizenship string, is_pep string, sanctioned_country string, annual_turnover string"
    data = [
        ("1", " Individual ", "1990-05-01", "National ID", "9005015009087", " A@B.co", "+27821234567", "50000", "0.8", "za, gb", None, "false", None),
        ("1", "Individual", "1990-05-01", "National ID", "9005015009087", "a@b.co", "+27821234567", "200000", "0.1", "ZA", "false", "false", None),
        ("2", "Individual", "2060-01-01", "Passport", None, "nope", None, "abc", None, None, None, None, None),
        ("3", "Individual", "1880-01-01", "National ID", "111", "a@b.co", "123", None, "0.3", "KE", "true", None, None),
        ("4", "Company", "not a date", None, None, None, None, None, "0.6", None, None, None, "10000000"),
        (None, "Organization", None, None, None, None, None, None, None, None, None, None, None),
    ]
    times = [T(2024, 1, 1), T(2024, 2, 1)] + [T(2024, 1, 1)] * 4
    return bronze(spark, schema, data, times)


def test_customers(spark, ctx, people_rows):
    got = {r["customer_id"]: r for r in entities.customers(people_rows, ctx).collect()}
    assert len(got) == 5
    one, two, three, four = got["1"], got["2"], got["3"], got["4"]
    assert one["annual_income"] == 200000 and one["customer_segment"] == "Mass Market" and one["kyc_risk_tier"] == "Low"
    assert one["id_dob_match"] is True and len(one["id_number"]) == 64 and one["is_high_risk"] is False
    assert one["email"].endswith("@b.co") and one["is_valid_email"] is True and one["phone_country_code"] == "ZA"
    assert str(two["birth_date"]) == "1980-01-01" and two["dq_birth_date_corrected"] and two["email"] is None
    assert two["is_high_risk"] is None and two["risk_segment"] == "Standard Risk" and two["income_band"] == "Unknown"
    assert str(three["birth_date"]) == "1960-01-01" and three["id_dob_match"] is False and three["is_foreign_national"] is True
    assert three["is_high_risk"] is True and three["kyc_risk_tier"] == "Medium"
    assert four["birth_date"] is None and four["business_segment"] == "Large Enterprise" and four["customer_segment"] is None
    assert not four["dq_birth_date_suspect"]


def test_customer_split(spark, ctx, people_rows):
    person, firm = entities.split_customers(entities.customers(people_rows, ctx))
    flags = {r["customer_id"]: r["is_duplicate_email"] for r in person.collect()}
    assert flags == {"1": True, "2": None, "3": True}
    assert firm.count() == 2 and "birth_date" not in firm.columns and "annual_turnover" not in person.columns
    dim = dims.customer_dim(person, firm)
    assert dim.columns == dims.CUSTOMER_COLUMNS and dim.count() == 5
    res = {r["rule"]: r["failed"] for r in quality.run_rules(people_rows.withColumns({c: F.lit(None) for c in (
        "full_name branch_id gender marital_status nationality education_level ethnicity location_exposure financial_goal "
        "company_size directors_count shareholders_count vat_registered").split()}), people.null_rules()).collect()}
    assert res["customer_id_null"] == 1 and res["id_number_null"] == 1


def test_accounts_cdc_order(spark, ctx):
    schema = "account_id string, customer_id string, account_number string, account_status string, account_tier string, overdraft_limit string, currency string, record_last_updated_at string, is_primary_account string, opening_date string, card_expiry_date string"
    data = [
        ("a", "1", "12", "Active ", "premium", "0", None, None, "true", "2024-06-30", "2024-09-28"),
        ("a", "1", "123456", "FROZEN", "gold", "10", "usd", "2024-01-01 00:00:00", "true", "2024-04-01", "2024-09-29"),
        ("b", "1", None, "suspended", None, "x", "eur ", "2024-01-01 00:00:00", "true", "bad", None),
    ]
    got = {r["account_id"]: r for r in entities.accounts(bronze(spark, schema, data), ctx).collect()}
    a, b = got["a"], got["b"]
    assert a["account_status"] == "frozen" and a["account_number"] == "****3456" and a["is_at_risk"] and a["tier_label"] == "Unknown"
    assert a["account_age_band"] == "Recent (3-12 months)" and a["currency"] == "USD" and not a["card_expiring_soon"]
    assert b["overdraft_limit"] is None and b["has_overdraft"] is False and b["account_age_band"] == "Unknown" and b["currency"] == "EUR"
    assert a["primary_account_violation"] is True and a["multi_account_flag"] is True
    assert {r.name for r in holdings.null_rules()} >= {"account_id_null", "iban_null"}


def test_signatories_dates_and_orphans(spark):
    df = bronze(spark, "account_id string, customer_id string, signatory_role string, signing_rule string, effective_date string, is_active string",
                [("a", "1", " PRIMARY_HOLDER", "Dual", "31/12/2023", "true"), ("a", None, "director", None, "12/31/2023", None), ("z", "1", "x", "single", "?", "no")])
    out = entities.signatories(df, spark.createDataFrame([("1",)], "customer_id string"), spark.createDataFrame([("a",), ("a",)], "account_id string"))
    got = sorted(((r["account_id"], r["customer_id"] or "", str(r["effective_date"]), r["signatory_count_on_account"], r["is_orphan_customer"], r["is_orphan_account"]) for r in out.collect()))
    assert got == [("a", "", "2023-12-31", 2, True, False), ("a", "1", "2023-12-31", 2, False, False), ("z", "1", "None", 1, False, True)]


def test_limits_lag_over_history(spark):
    df = bronze(spark, "account_id string, event_date string, event_type string, overdraft_limit string, credit_card_limit string, change_reason string",
                [("a", "2024-01-01", "set", "100", None, "x"), ("a", "2024-02-01", "raise", "150", "5", "risk_review"), ("a", "2024-03-01", "drop", None, "7", "x"), ("b", None, "set", "1", "1", None)])
    out = entities.limits_history(df, spark.createDataFrame([("a",)], "account_id string"))
    got = [tuple(r) for r in out.filter("account_id = 'a'").orderBy("event_date").select("change_sequence_on_account", "overdraft_limit_delta", "credit_card_limit_delta", "total_limit_exposure").collect()]
    assert got == [(1, None, None, 100.0), (2, 50.0, None, 155.0), (3, None, 2.0, 7.0)]


def test_transactions_and_deposits(spark, ctx):
    schema = ("transaction_id string, account_id string, transaction_date string, transaction_timestamp string, amount string, channel string, currency string, "
              "debit_credit string, status string, category string, debit_order_id string, debit_order_metadata struct<debit_order_id: string, debit_order_type: string>")
    data = [
        ("t1", "a", "2024-01-01", "2024-01-01T08:00:00", "10.5", "Online", None, "credit", "completed", "debit_order", "flat", ("d1", "Salary")),
        ("t1", "a", "2024-01-02", "bad", "x", " Mobile", "usd", "debit", "failed", "loan_payment", "flat", None),
        ("t1", "a", "2024-01-01", "2024-01-01T08:00:00", "10.5", "Online", None, "credit", "completed", "debit_order", "flat", ("d1", "Salary")),
    ]
    deposits = bronze(spark, payments.DEPOSIT_SCHEMA, [("a", 99.0, "Branch", dt.date(2023, 12, 31), ("br", None, None))]).withColumn("ch_branch_code", F.col("channel_metadata.branch_code")).drop("channel_metadata")
    out = entities.transactions(bronze(spark, schema, data), ctx, deposits)
    got = {(r["transaction_id"], str(r["transaction_date"])): r for r in out.collect()}
    assert len(got) == 3 and out.count() == 3
    a, b, dep = got["t1", "2024-01-01"], got["t1", "2024-01-02"], got[None, "2023-12-31"]
    assert a["do_debit_order_id"] == "d1" and a["is_salary_candidate"] and a["channel"] == "online_banking" and a["currency"] == "ZAR"
    assert b["amount"] is None and b["transaction_timestamp"] is None and b["channel"] == "mobile_banking_app" and b["currency"] == "USD"
    assert dep["is_initial_deposit"] and dep["transaction_year"] == 2023 and dep["year"] == "2023" and dep["is_credit"]
    assert len({r["transaction_sk"] for r in got.values()}) == 3


def test_fact_end_to_end(spark, ctx, rows):
    silver = spark.createDataFrame([("a", "1", "active", 1.0, dt.date(2024, 1, 10)), ("b", "2", "active", None, dt.date(2024, 1, 1))],
                                   "account_id string, customer_id string, account_status string, overdraft_limit double, opening_date date")
    full = silver.withColumns({c: F.lit(None).cast("string") for c in dims.ACCOUNT_COLUMNS if c not in silver.columns})
    first = dims.account_dim(None, full, ctx)
    second = dims.account_dim(first, full.withColumn("account_status", F.when(F.col("account_id") == "a", "frozen").otherwise("active")), ctx)
    assert second.count() == 3
    tx = spark.createDataFrame(
        [("a", dt.date(2024, 1, 1), 5.0, True, True), ("a", dt.date(2024, 6, 30), 5.0, False, True), ("b", dt.date(2024, 2, 1), 7.0, True, False), ("x", dt.date(2024, 2, 1), 7.0, None, True)],
        "account_id string, transaction_date date, amount double, is_debit boolean, is_completed boolean").withColumn("transaction_cost", F.lit(0.1))
    bridge = spark.createDataFrame([("a", "1", "primary_holder"), ("a", "9", "primary_holder"), ("b", "2", "director")], "account_id string, customer_id string, signatory_role string")
    customers = spark.createDataFrame([("1", 11), ("2", 22)], "customer_id string, customer_sk int")
    owners = fact.account_owner(bridge, silver, customers)
    assert rows(owners) == [("a", 11)]
    out = fact.transaction_fact(tx, second, owners, ["account_id", "date_key", "transaction_amount", "transaction_amount_abs", "primary_customer_sk", "account_status"], ["account_status"])
    assert rows(out) == [("a", 20240101, -5.0, 5.0, 11, "active"), ("a", 20240630, 5.0, 5.0, 11, "frozen"), ("x", 20240201, 7.0, 7.0, None, None)]


def test_salary_rules(spark):
    def tx(months):
        return spark.createDataFrame([("c", dt.date(y, m, 25), "eft", 100.0, True) for y, m in months],
                                     "customer_id string, transaction_date date, channel string, amount_abs double, is_salary_candidate boolean")

    day = F.lit("2024-06-30").cast("date")
    flags = lambda months: tuple(customer360.activity(tx(months), day).select("is_on_regular_salary", "has_salary_stopped").first())
    assert flags([(2023, 12), (2024, 1)]) == (0, 0)
    assert flags([(2023, 11), (2023, 12), (2024, 1)]) == (1, 1)
    assert flags([(2024, 2), (2024, 3), (2024, 4)]) == (1, 0)
    assert flags([(2024, 1), (2024, 3), (2024, 5)]) == (0, 0)


def test_topics_pipeline(spark):
    data = [(str(i), f"Re: Card {i} blocked" if i % 2 else "Loan question", f"My card number {i} is blocked please help me now" if i % 2 else "How do I apply for a loan with you today", [1.0, 0.05 * (i % 3)] if i % 2 else [0.05 * (i % 3), 1.0]) for i in range(12)]
    df = topics.drop_noise(topics.prepare(spark.createDataFrame(data, "message_id string, subject string, body string, v array<double>")))
    df = topics.with_frequency(df, "subject_norm", "subject_count", "subject_is_common")
    df = topics.with_frequency(df, "body_norm", "body_template_count", "body_is_common")
    scored = topics.score_centroids(df, "v", [(0, [1.0, 0.0]), (1, [0.0, 1.0])])
    summary = topics.topic_summary(scored, "subject", "body", "message_id", common="subject_is_common")
    got = {r["topic"]: r for r in summary.collect()}
    assert got[0]["email_count"] == 6 and got[1]["topic_label"] == "Loan question" and got[1]["dominant_subject_share"] == 1.0
    assert got[0]["top_subjects"].count(" | ") == 2 and got[0]["common_subject_emails"] == 6
    assert got[1]["example_message"] == "How do I apply for a loan with you today"
    table = topics.assignments(scored, summary)
    assert table.columns == topics.ASSIGNMENT_COLUMNS and table.count() == 12 and table.filter("needs_review").count() == 0


def test_score_reviews_unsure_rows(spark):
    df = spark.createDataFrame([(1, [1.0, 1.0]), (2, [-1.0, 0.0]), (3, [2.0, 0.0])], "i int, v array<double>")
    out = {r["i"]: r["needs_review"] for r in topics.score_centroids(df, "v", [(0, [1.0, 0.0]), (1, [0.0, 1.0])]).collect()}
    assert out == {1: True, 2: True, 3: False}
    alone = {r["i"]: r["needs_review"] for r in topics.score_centroids(df, "v", [(0, [1.0, 0.0]), (1, [0.0, 1.0])], margin_min=None).collect()}
    assert alone == {1: False, 2: True, 3: False}


def test_campaign_key_spans_channels(spark, ctx):
    schema = "campaign_id string, campaign_name string, channel string, region string, start_date string, end_date string"
    data = [("c", "n", "SMS, email", "Durban", "2024-06-01", "2024-07-01"), ("c", "n", "SMS, email", "Durban", "2024-06-01", "2024-07-01"), ("c", "n", "sms", "Cape", "2024-06-01", "2024-06-02")]
    out = entities.campaigns(bronze(spark, schema, data), ctx)
    assert sorted((r["region"], r["channel_count"], r["duration_days"], r["is_active"]) for r in out.collect()) == [("Cape", 1, 1, False), ("KwaZulu-Natal", 2, 30, True)]
    assert out.select("campaign_sk").distinct().count() == 2
