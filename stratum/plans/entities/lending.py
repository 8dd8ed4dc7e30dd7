"""Loans, participations and collections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ...config import RunContext
from ...functions import bands
from ...functions.casting import project
from ...operators.dedup import latest_by
from ...operators.integrity import existence_flag
from .common import BRONZE_META, kinds, silver_meta

LOAN_SPEC = kinds(
    plain="loan_id customer_id account_id",
    text="loan_type application_status workflow_state rate_type collateral_type pricing_basis",
    timestamp="application_date decision_at booked_at disbursed_at",
    double="requested_amount amount_granted monthly_installment nominal_rate apr ifrs9_pd_12m ifrs9_lgd ifrs9_ecl_12m "
    "discretionary_income loan_to_value_ratio",
    boolean="affordability_pass",
)
PARTICIPATION_SPEC = kinds(
    plain="participation_id loan_id external_loan_reference customer_id account_id",
    text="participation_direction originating_bank servicing_bank participant_bank participant_role loan_type "
    "risk_share_type status notes",
    date="effective_date",
    double="participation_pct participation_amount retained_pct servicing_fee_bps",
)
CASE_SPEC = kinds(
    plain="case_id customer_id account_id",
    text="assigned_collector arrangement_plan last_contact_channel notes",
    lower="collection_stage status",
    double="arrears_amount promise_to_pay_amount",
    int="days_past_due",
    date="promise_to_pay_date last_contact_date",
)

# fixed values: status names, buckets and stage risks
LOAN_STATUSES = {"Booked": "Disbursed", "Declined": "Rejected", "Withdrawn": "Withdrawn"}
BOOKED, UNSECURED, INCOMING = "Booked", "none", "incoming_participation"
LOAN_REFERENCES = {"has_internal_loan": "loan_id", "is_external_loan": "external_loan_reference"}
FULLY_GRANTED_SHARE = 0.99
SHARE_EDGES, SHARE_LABELS = (25, 50, 75), ("Low", "Medium", "High", "Major")
ARREARS_EDGES, ARREARS_LABELS = (1_000, 5_000, 10_000), ("<1k", "1k-5k", "5k-10k", "10k+")
DPD_EDGES, DPD_LABELS = (30, 60, 90), ("1-30", "31-60", "61-90", "90+")
STAGE_RISKS = {
    "pre_delinquent": "low", "early_collections": "medium", "late_collections": "high", "legal": "critical",
    "write_off": "loss",
}


def arrears_bucket(amount: Column | str) -> Column:
    return bands.band(amount, ARREARS_EDGES, ARREARS_LABELS, null_label=ARREARS_LABELS[-1])


def dpd_bucket(days: Column | str) -> Column:
    return bands.band(days, DPD_EDGES, DPD_LABELS, closed="right", null_label=DPD_LABELS[-1])


def participation_bucket(pct: Column | str) -> Column:
    return bands.band(pct, SHARE_EDGES, SHARE_LABELS, null_label=SHARE_LABELS[-1])


def at_least_zero(amount: str) -> Column:
    """Never negative; an unknown amount counts as none."""
    return F.greatest(F.col(amount), F.lit(0.0))


def calendar_parts(day: str, prefix: str) -> dict[str, Column]:
    return {f"{prefix}_{part.__name__}": part(day) for part in (F.year, F.month)}


def loan_progress() -> dict[str, Column]:
    """How far an application has come: its status by name, and flags for its milestones."""
    state, asked = F.col("workflow_state"), F.col("requested_amount")
    status = bands.map_lookup(state, LOAN_STATUSES, "Unknown")
    return {
        "loan_status": status,
        "is_booked": state == BOOKED,
        "is_rejected": status == LOAN_STATUSES["Declined"],
        "is_disbursed": F.col("disbursed_at").isNotNull(),
        "is_fully_granted": F.col("amount_granted") >= asked * FULLY_GRANTED_SHARE,
        "days_to_decision": F.datediff("decision_at", "application_date"),
    }


def loan_risk() -> dict[str, Column]:
    """Income and collateral as the risk models take them: a ratio only means something with collateral."""
    return {
        "discretionary_income": at_least_zero("discretionary_income"),
        "loan_to_value_ratio": F.when(F.col("collateral_type") != UNSECURED, F.col("loan_to_value_ratio")),
    }


def loans(bronze: DataFrame, ctx: RunContext) -> DataFrame:
    rows = project(latest_by(bronze, ["loan_id"], ["_ingest_timestamp"]), LOAN_SPEC, keep=BRONZE_META)
    derived = {**loan_progress(), **loan_risk(), **calendar_parts("application_date", "application")}
    return silver_meta(rows.withColumns(derived), "bronze_loans", ctx)


def participation_side() -> dict[str, Column]:
    """Which bank the loan comes from, as the direction tells and as the references to it show."""
    incoming = F.col("participation_direction") == INCOMING
    return {
        "is_incoming_participation": incoming,
        "participation_source": F.when(incoming, "External").otherwise("Internal"),
        **{flag: F.col(reference).isNotNull() for flag, reference in LOAN_REFERENCES.items()},
    }


def participation_share(today: Column) -> dict[str, Column]:
    """Size, kept part and age of the share."""
    return {
        "participation_bucket": participation_bucket("participation_pct"),
        "retained_amount": F.col("participation_amount") * F.col("retained_pct") / 100.0,
        "participation_age_days": F.datediff(today, "effective_date"),
        "is_active": F.col("status") == "active",
    }


def loan_participations(bronze: DataFrame, ctx: RunContext) -> DataFrame:
    rows = project(latest_by(bronze, ["participation_id"], ["_ingest_timestamp"]), PARTICIPATION_SPEC, keep=BRONZE_META)
    rows = rows.withColumns({**participation_side(), **participation_share(F.lit(ctx.as_of))})
    return silver_meta(rows, "bronze_loan_participations", ctx)


def collections_cases(bronze: DataFrame, customers: DataFrame, accounts: DataFrame) -> DataFrame:
    rows = project(bronze, CASE_SPEC, keep=BRONZE_META).withColumns({
        "is_ptp_case": F.col("promise_to_pay_amount").isNotNull(),
        "is_arrangement_case": F.col("arrangement_plan").isNotNull(),
        "arrears_bucket": arrears_bucket("arrears_amount"),
        "dpd_bucket": dpd_bucket("days_past_due"),
        "stage_risk": bands.map_lookup("collection_stage", STAGE_RISKS),
    })
    rows = existence_flag(rows, customers, {"customer_id": "customer_id"}, "is_orphan_customer")
    return existence_flag(rows, accounts, {"account_id": "account_id"}, "is_orphan_account")
