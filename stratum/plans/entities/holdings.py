"""Accounts and what hangs on them: holders, status events, limits, enrolments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ...config import RunContext
from ...functions import bands, masking
from ...functions.casting import parse_date, project
from ...functions.keys import surrogate
from ...operators.bridge import explode_json
from ...operators.dedup import latest_by
from ...operators.groups import with_group, with_group_count
from ...operators.integrity import existence_flag
from ...operators.quality import Rule, required
from ...operators.ranking import with_neighbours
from .common import BRONZE_META, EVENT_DATE_FORMATS, kinds, silver_meta, today

DOCUMENTS = (
    "proof_of_income_provided proof_of_address_provided bank_statements_provided employer_letter_provided "
    "business_registration_provided tax_certificate_provided minimum_deposit_met"
)
SPEC = kinds(
    plain="account_id customer_id",
    text="account_number bank_product_name status_reason branch_code card_number opening_channel statement_frequency "
    "swift_code iban linked_joint_accounts bundled_products beneficiaries cdc_op_hint",
    lower="account_type account_tier account_status card_type",
    upper="currency",
    date="opening_date approval_date status_change_date closure_date card_issue_date card_expiry_date "
    "online_banking_activation_date",
    double="expected_amount interest_rate monthly_charges transactions_rate negative_balance_rate overdraft_limit "
    "credit_card_limit",
    boolean=f"is_primary_account kyc_verified fica_verified online_banking_enabled cross_border_enabled {DOCUMENTS}",
    timestamp="record_last_updated_at",
)
MASKS = {"account_number": "last4", "card_number": "hash", "iban": "hash"}

# fixed values: bands, labels and role names
ACCOUNT_AGE_EDGES = (90, 365, 1095)
ACCOUNT_AGE_LABELS = ("New (<3 months)", "Recent (3-12 months)", "Established (1-3 years)", "Mature (3+ years)")
TIER_LABELS = {
    "basic": "Basic — easy/savings/joint",
    "standard": "Standard — cheque/current/business",
    "premium": "Premium — gold/platinum",
}
INACTIVE = ("frozen", "suspended", "restricted")
AT_RISK = ("suspended", "frozen")
FOREIGN_CURRENCIES, HOME_CURRENCY = ("USD", "EUR"), "ZAR"
EXPIRY_WINDOW_DAYS = 90
ROLE_LABELS = {
    "primary_holder": "Primary Holder",
    "joint_holder": "Joint Holder",
    "authorized_signatory": "Authorized Signatory",
    "finance_manager": "Finance Manager",
    "director": "Director",
}
SIGNATORY_SCHEMA = (
    "array<struct<customer_id: string, signatory_role: string, signing_rule: string, effective_date: string, "
    "is_active: boolean>>"
)
JOINT_SIGNING = ("both_to_sign", "dual", "tiered")
RISK_REASONS = ("high_risk_suspicion", "fraud_suspicion", "risk_monitoring", "moderate_risk")
CLOSURE_STATUSES = ("frozen", "suspended")
CREDIT_PRODUCTS = ("credit_card", "overdraft_facility", "business_credit_line")
PRODUCT_FAMILIES = {
    "online_banking": "core_banking", "debit_card": "core_banking",
    "credit_card": "credit_products", "overdraft_facility": "credit_products",
    "investment_account": "investment", "wealth_management": "investment",
}


def null_rules() -> list[Rule]:
    return [
        *required("account_id account_number customer_id account_type account_tier account_status opening_date currency".split()),
        *required(
            "status_change_date status_reason swift_code iban linked_joint_accounts overdraft_limit "
            "credit_card_limit online_banking_activation_date".split(), "expected",
        ),
    ]


def account_age_band(days: Column | str) -> Column:
    return bands.band(days, ACCOUNT_AGE_EDGES, ACCOUNT_AGE_LABELS, null_label="Unknown")


def accounts(bronze: DataFrame, ctx: RunContext) -> DataFrame:
    day = today(ctx)
    newest = latest_by(bronze, ["account_id"], ["record_last_updated_at", "_ingest_timestamp"])
    masked = masking.mask(project(newest, SPEC, keep=BRONZE_META), MASKS, ctx.salt)
    age = F.datediff(day, "opening_date")
    foreign = F.col("currency").isin(*FOREIGN_CURRENCIES)
    card = F.col("card_type")
    enriched = masked.withColumns({
        "account_age_days": age,
        "account_age_band": account_age_band(age),
        "is_active": F.col("account_status") == "active",
        "is_inactive": F.col("account_status").isin(*INACTIVE),
        "is_at_risk": F.col("account_status").isin(*AT_RISK),
        "tier_label": bands.map_lookup("account_tier", TIER_LABELS, "Unknown"),
        "has_overdraft": F.coalesce(F.col("overdraft_limit") > 0, F.lit(False)),
        "has_credit_card": F.coalesce(F.col("credit_card_limit") > 0, F.lit(False)),
        "is_foreign_currency": foreign,
        "currency": F.when(foreign, F.col("currency")).otherwise(HOME_CURRENCY),
        "is_joint_account": F.col("account_type") == "joint",
        "is_business_account": F.col("account_type") == "business",
        "card_valid": F.col("card_expiry_date") > day,
        "card_category": F.when(card.contains("credit"), "credit").when(card.contains("debit"), "debit").otherwise("none"),
        "card_expiring_soon": F.coalesce(
            F.datediff("card_expiry_date", day).between(0, EXPIRY_WINDOW_DAYS), F.lit(False)
        ),
        "onboarding_doc_score": bands.score([F.col(c) for c in DOCUMENTS.split()]),
        "days_since_status_change": F.datediff(day, "status_change_date"),
        "approval_lag_days": F.datediff("approval_date", "opening_date"),
        "account_sk": surrogate("account_id"),
    })
    # both counts in one aggregate: a customer without a primary account stays unknown, not False
    counted = with_group(enriched, ["customer_id"], {
        "__primary": F.nullif(F.count_if("is_primary_account"), F.lit(0)), "__owned": F.count(F.lit(1)),
    })
    flagged = counted.withColumns({
        "primary_account_violation": F.col("__primary") > 1, "multi_account_flag": F.col("__owned") > 1,
    }).drop("__primary", "__owned")
    return silver_meta(flagged, "bronze_accounts", ctx)


def bridge_customer_account(bronze: DataFrame, ctx: RunContext) -> DataFrame:
    """One row per account and holder, from the JSON array on the account."""
    newest = latest_by(bronze, ["account_id"], ["record_last_updated_at", "_ingest_timestamp"])
    keep = [
        "account_id", "is_primary_account", "account_type", "account_status", "currency", "branch_code",
        "_source_file", "_ingest_timestamp", "_batch_id", "_commit_sha",
    ]
    rows = explode_json(newest, "signatories_json", SIGNATORY_SCHEMA, keep)
    return rows.withColumns({
        "effective_date": F.col("effective_date").try_cast("date"),
        "is_primary_holder": F.col("signatory_role") == "primary_holder",
        "relationship_type": bands.map_lookup("signatory_role", ROLE_LABELS, "Other"),
        "silver_batch_id": F.lit(ctx.batch_id), "silver_load_timestamp": F.current_timestamp(),
    })


def signatories(bronze: DataFrame, customers: DataFrame, accounts: DataFrame) -> DataFrame:
    spec = kinds(plain="account_id customer_id effective_date", lower="signatory_role signing_rule", boolean="is_active")
    rows = project(bronze, spec, keep=BRONZE_META).withColumns({
        "effective_date": parse_date("effective_date", EVENT_DATE_FORMATS),
        "is_primary_holder": F.col("signatory_role") == "primary_holder",
        "requires_multiple_signatures": F.col("signing_rule").isin(*JOINT_SIGNING),
    })
    rows = with_group_count(rows, ["account_id"], "signatory_count_on_account")
    rows = existence_flag(rows, customers, {"customer_id": "customer_id"}, "is_orphan_customer")
    return existence_flag(rows, accounts, {"account_id": "account_id"}, "is_orphan_account")


def status_events(history: DataFrame, accounts: DataFrame) -> DataFrame:
    """``history`` is the increment plus stored events of its accounts (``control.touched_history``)."""
    spec = kinds(plain="account_id event_date", lower="event_type new_status status_reason")
    rows = project(history, spec, keep=BRONZE_META).withColumns({
        "event_date": parse_date("event_date", EVENT_DATE_FORMATS),
        "is_risk_related": F.col("status_reason").isin(*RISK_REASONS),
        "is_closure_event": F.col("new_status").isin(*CLOSURE_STATUSES),
    })
    rows = with_neighbours(
        rows, ["account_id"], ["event_date", "event_type", "new_status", "status_reason"], F.col("event_date"),
        position="event_sequence_on_account",
    )
    return existence_flag(rows, accounts, {"account_id": "account_id"}, "is_orphan_account")


def limits_history(history: DataFrame, accounts: DataFrame) -> DataFrame:
    spec = kinds(
        plain="account_id event_date", lower="event_type change_reason", double="overdraft_limit credit_card_limit"
    )
    rows = project(history, spec, keep=BRONZE_META).withColumns({
        "event_date": parse_date("event_date", EVENT_DATE_FORMATS),
        "is_risk_driven_change": F.col("change_reason") == "risk_review",
        "total_limit_exposure": F.coalesce("overdraft_limit", F.lit(0.0)) + F.coalesce("credit_card_limit", F.lit(0.0)),
    })
    rows = with_neighbours(
        rows, ["account_id"], ["event_date", "event_type", "overdraft_limit", "credit_card_limit", "change_reason"],
        F.col("event_date"), position="change_sequence_on_account",
        lags={"__overdraft": "overdraft_limit", "__credit": "credit_card_limit"},
    )
    rows = rows.withColumns({
        "overdraft_limit_delta": F.col("overdraft_limit") - F.col("__overdraft"),
        "credit_card_limit_delta": F.col("credit_card_limit") - F.col("__credit"),
    }).drop("__overdraft", "__credit")
    return existence_flag(rows, accounts, {"account_id": "account_id"}, "is_orphan_account")


def enrollments(history: DataFrame, accounts: DataFrame, family_flags: bool = False) -> DataFrame:
    """Product enrolments; ``family_flags`` adds the columns of the older layout."""
    spec = kinds(plain="account_id enrollment_date", lower="product_code enrollment_status")
    rows = project(history, spec, keep=BRONZE_META).withColumns({
        "enrollment_date": parse_date("enrollment_date", EVENT_DATE_FORMATS),
        "is_active_enrollment": F.col("enrollment_status") == "active",
        "is_credit_product": F.col("product_code").isin(*CREDIT_PRODUCTS),
    })
    rows = with_group_count(rows, ["account_id"], "product_count_on_account")
    rows = with_neighbours(
        rows, ["account_id"], ["enrollment_date", "product_code", "enrollment_status"], F.col("enrollment_date"),
        position="enrollment_sequence_on_account",
    )
    if family_flags:
        status = F.col("enrollment_status")
        rows = rows.na.drop(subset=["account_id", "product_code"]).withColumns({
            "is_active": F.coalesce((status == "active").cast("int"), F.lit(0)),
            "is_closed": F.coalesce(status.isin("cancelled", "suspended").cast("int"), F.lit(0)),
            "is_suspended": F.coalesce((status == "suspended").cast("int"), F.lit(0)),
            "product_category": bands.map_lookup("product_code", PRODUCT_FAMILIES, "other"),
        })
    return existence_flag(rows, accounts, {"account_id": "account_id"}, "is_orphan_account")
