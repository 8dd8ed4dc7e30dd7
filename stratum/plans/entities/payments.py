"""Transactions, late deposits, debit orders and ATM logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ...config import RunContext
from ...functions import bands, masking
from ...functions.casting import flatten, project
from ...functions.keys import surrogate
from ...operators.control import add_late_rows
from ...operators.dedup import latest_by, row_tiebreak
from ...operators.integrity import existence_flag, key_union
from ...operators.quality import Rule, required
from .common import BRONZE_META, kinds, silver_meta

# fixed values: nested metadata to flat columns, and the flat copies the source also carries
TRANSACTION_PARTS = {
    "debit_order_metadata": {
        "debit_order_id": "do_debit_order_id", "debit_order_type": "do_debit_order_type", "frequency": "do_frequency",
        "beneficiary_name": "do_beneficiary_name", "is_immediate_payment": "do_is_immediate_payment",
    },
    "loan_payment_metadata": {
        "loan_id": "loan_id", "loan_type": "loan_type", "payment_type": "loan_payment_type",
        "installment_number": "loan_installment_number", "is_recovery_attempt": "loan_is_recovery_attempt",
        "immediate_payment": "loan_is_immediate_payment",
    },
    "channel_metadata": {
        "payment_network": "ch_payment_network", "atm_id": "ch_atm_id", "branch_code": "ch_branch_code",
        "network_type": "ch_network_type",
    },
    "error_metadata": {},
}
REDUNDANT_COLUMNS = (
    "debit_order_id", "debit_order_type", "frequency", "is_immediate_payment", "immediate_payment", "loan_id",
    "loan_type", "payment_type", "installment_number", "is_recovery_attempt",
)
DROPPED_COLUMNS = ("transaction_time", "ewallet_number")
TRANSACTION_SPEC = kinds(
    plain="transaction_id account_id",
    text="channel description do_debit_order_id do_debit_order_type do_frequency do_beneficiary_name loan_id loan_type "
    "loan_payment_type ch_payment_network ch_atm_id ch_branch_code ch_network_type beneficiary_name merchant_name "
    "receiving_account failure_reason error_types data_error_types third_party_timeout rrn stan source_system",
    lower="category debit_credit status",
    upper="currency",
    timestamp="transaction_timestamp record_last_updated_at",
    date="transaction_date",
    double="amount transaction_cost",
    long="authorization_time_ms",
    int="loan_installment_number",
    boolean="do_is_immediate_payment loan_is_recovery_attempt loan_is_immediate_payment has_error has_data_error",
)
CHANNEL_NAMES = {"Online": "online_banking", "Mobile": "mobile_banking_app"}
SALARY_TYPES = ("Salary", "Payroll", "Income", "Wage")
HOME_CURRENCY = "ZAR"

DEPOSIT_SCHEMA = (
    "account_id string, amount double, channel string, transaction_date date, "
    "channel_metadata struct<branch_code: string, terminal_id: string, atm_id: string>"
)
DEPOSIT_COLUMNS = {
    "account_id": "account_id", "amount": "amount", "channel": "channel", "transaction_date": "transaction_date",
    "ch_branch_code": "channel_metadata.branch_code", "ch_terminal_id": "channel_metadata.terminal_id",
    "ch_atm_id": "channel_metadata.atm_id",
}
DEPOSIT_TYPE = "INITIAL_DEPOSIT"

RECURRING_FREQUENCIES = ("Monthly", "Weekly", "Quarterly")
DEBIT_ORDER_SPEC = kinds(
    plain="debit_order_id account_id customer_id creditor_id",
    text="debit_order_type frequency status suspension_reason suspension_initiated_by cancellation_reason "
    "notification_method beneficiary_name beneficiary_account_number beneficiary_branch_code beneficiary_bank_name "
    "beneficiary_account_type description linked_loan_id linked_policy_number linked_subscription_id",
    timestamp="start_date end_date cancellation_date suspension_date record_last_updated_at",
    double="amount",
    int="collection_day notification_days_before",
    boolean="is_fixed_amount can_be_reactivated notification_required",
)

RESPONSE_LABELS = {
    "00": "approved", "05": "do_not_honour", "51": "insufficient_funds", "55": "incorrect_pin",
    "57": "transaction_not_permitted", "61": "exceeds_withdrawal_limit", "68": "response_received_too_late",
    "91": "issuer_unavailable",
}
SERVICE_EVENTS = (
    "balance_enquiry", "card_retained", "card_status_check", "cardless_withdrawal", "ewallet_cashout",
    "ewallet_send_voucher", "mini_statement", "pin_change",
)
GENERIC_LOCATION = "ATM network terminal"
NOT_APPLICABLE = "not_applicable"
ATM_SPEC = kinds(
    plain="atm_log_id event_time customer_id account_id account_number masked_card_number card_number_hash "
    "card_expiry_date pin_attempt_number host_response_code linked_transaction_id ewallet_reference "
    "ewallet_recipient_msisdn_entered",
    text="atm_id terminal_id atm_location atm_province",
    lower="account_status card_type event_type attempt_result failure_reason cash_bin_status transaction_category "
    "transaction_status source_system ewallet_error_type",
    upper="currency",
    timestamp="event_timestamp",
    date="event_date",
    double="atm_latitude atm_longitude amount available_balance_returned network_latency_ms",
    boolean="card_block_status balance_enquiry_requested receipt_printed",
)


def transaction_rules() -> list[Rule]:
    return required(
        "transaction_id account_id transaction_timestamp transaction_date amount debit_credit status channel".split()
    )


def channel_name(column: Column | str) -> Column:
    c = F.trim(F.col(column) if isinstance(column, str) else column)
    return bands.map_lookup(c, CHANNEL_NAMES, F.lower(c))


def transactions(bronze: DataFrame, ctx: RunContext, deposits: DataFrame | None = None, ties: Sequence[str] = ()) -> DataFrame:
    """Transactions keyed by id and date, with late deposits unioned once and marked.

    Of rows with one file period and ingest time the largest by ``ties`` stays (by a hash of the row without them).
    """
    # rows are flat and typed before the newest is chosen, by the values as they came: narrow rows are shuffled and sorted
    came = {"__day": F.col("transaction_date"), **{f"__by{i}": F.col(c) for i, c in enumerate(ties)}, "__row": row_tiebreak(bronze)}
    flat = flatten(bronze.withColumns(came), TRANSACTION_PARTS, REDUNDANT_COLUMNS).drop(*DROPPED_COLUMNS)
    slim = project(flat, TRANSACTION_SPEC, keep=(*BRONZE_META, *came), missing="skip")
    order = ["year", "month", "_ingest_timestamp", *list(came)[1:-1], F.col("__row")]
    newest = latest_by(slim, ["transaction_id", "__day"], order, tie=())
    clean = project(newest, TRANSACTION_SPEC, keep=BRONZE_META)
    masked = masking.mask(
        clean, {"beneficiary_name": "hash", "do_beneficiary_name": "hash", "receiving_account": "last4"}, ctx.salt
    )
    when, category = F.col("transaction_timestamp"), F.col("category")
    flags = {
        **{f"is_{s}": F.col("status") == s for s in ("completed", "failed", "reversed")},
        **{f"is_{s}": F.col("debit_credit") == s for s in ("debit", "credit")},
        "is_debit_order": category == "debit_order",
        "is_loan_payment": category == "loan_payment",
        "is_scheduled": category == "scheduled_payment",
        "is_recurring": category.isin("debit_order", "scheduled_payment"),
        "is_salary_candidate": (F.col("debit_credit") == "credit") & (category == "debit_order")
        & F.col("do_debit_order_type").isin(*SALARY_TYPES),
    }
    enriched = masked.withColumns({
        "transaction_sk": surrogate("transaction_id", "transaction_date"),
        "channel": channel_name("channel"),
        "currency": F.coalesce("currency", F.lit(HOME_CURRENCY)),
        "transaction_year": F.year(when), "transaction_month": F.month(when),
        "transaction_day_of_week": F.dayofweek(when),
        **flags,
    })
    silver = silver_meta(enriched, "bronze_transactions", ctx)
    if deposits is None:
        return silver.withColumn("is_initial_deposit", F.lit(False))
    return add_late_rows(silver, initial_deposits(deposits, ctx), "is_initial_deposit")


def initial_deposits(bronze: DataFrame, ctx: RunContext) -> DataFrame:
    """Opening deposits in the shape of transactions; the period comes from the date, not the file name."""
    day = F.col("transaction_date").cast("date")
    rows = bronze.withColumns({
        "transaction_date": day,
        "transaction_sk": surrogate("account_id", day, record_type=DEPOSIT_TYPE),
        "transaction_timestamp": day.cast("timestamp"),
        "amount": F.col("amount").try_cast("double"),
        "channel": channel_name("channel"),
        "currency": F.lit(HOME_CURRENCY), "debit_credit": F.lit("credit"), "status": F.lit("completed"),
        "category": F.lit("initial_deposit"),
        "transaction_year": F.year(day), "transaction_month": F.month(day),
        "transaction_day_of_week": F.dayofweek(day),
        **{f"is_{n}": F.lit(n in ("completed", "credit")) for n in (
            "completed", "failed", "reversed", "debit", "credit", "debit_order", "loan_payment", "scheduled",
            "recurring", "salary_candidate",
        )},
        "year": F.date_format(day, "yyyy"), "month": F.date_format(day, "MM"),
    })
    return silver_meta(rows, "initial_deposits", ctx).drop("ch_terminal_id", "transaction_type")


def debit_orders(bronze: DataFrame, ctx: RunContext) -> DataFrame:
    newest = latest_by(bronze, ["debit_order_id"], ["year", "month", "_ingest_timestamp"])
    masked = masking.mask(project(newest, DEBIT_ORDER_SPEC, keep=BRONZE_META), {"beneficiary_name": "hash"}, ctx.salt)
    updated = F.col("record_last_updated_at")
    enriched = masked.withColumns({
        "debit_order_sk": surrogate("debit_order_id"),
        **{f"is_{s}": F.col("status") == s for s in ("active", "suspended", "cancelled")},
        "is_recurring": F.col("frequency").isin(*RECURRING_FREQUENCIES),
        "is_linked_to_loan": F.col("linked_loan_id").isNotNull(),
        "is_fixed": F.col("is_fixed_amount"),
        "notification_required": F.coalesce("notification_required", F.lit(False)),
        "effective_year": F.year(updated), "effective_month": F.month(updated),
    })
    return silver_meta(enriched, "bronze_debit_orders", ctx)


def atm_logs(bronze: DataFrame, customer_tables: Sequence[DataFrame], ctx: RunContext) -> DataFrame:
    newest = latest_by(bronze, ["atm_log_id"], ["_ingest_timestamp"])
    clean = project(newest, ATM_SPEC, keep=BRONZE_META)
    entered = "ewallet_recipient_msisdn_entered"
    service = F.col("event_type").isin(*SERVICE_EVENTS)
    failed = F.col("attempt_result") == "failed"
    rows = clean.withColumns({
        "ewallet_recipient_msisdn_masked": masking.hashed(entered, ctx.salt),
        "host_response_code_label": bands.map_lookup("host_response_code", RESPONSE_LABELS, "unknown"),
        **{c: bands.fill_when(c, service, NOT_APPLICABLE)
           for c in ("transaction_category", "linked_transaction_id", "transaction_status")},
        "is_financial_transaction": ~service,
        "atm_event_group": F.when(~service, "financial_transaction").otherwise("atm_service_event"),
        "is_failed_attempt": failed,
        "is_generic_location": F.col("atm_location") == GENERIC_LOCATION,
        "dq_non_zar_currency": F.col("currency") != HOME_CURRENCY,
        "dq_missing_failure_reason": failed & F.col("failure_reason").isNull(),
        "dq_missing_balance": (F.col("event_type") == "balance_enquiry") & F.col("available_balance_returned").isNull(),
    }).drop(entered)
    known = key_union(customer_tables, "customer_id")
    return silver_meta(existence_flag(rows, known, {"customer_id": "customer_id"}, "dq_orphan_customer"), "bronze_atm_logs", ctx)
