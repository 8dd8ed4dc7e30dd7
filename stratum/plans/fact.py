"""Transaction fact."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import OPEN_END
from ..functions.keys import date_key
from ..operators.bridge import primary_holder
from ..operators.dedup import latest_by
from ..operators.ranking import asof_join
from ..operators.scd2 import FROM, TO, open_first, pit_join

FACT_COLUMNS = (
    "transaction_sk date_key dim_account_key primary_customer_sk transaction_id account_id transaction_date "
    "transaction_timestamp transaction_amount transaction_amount_abs fee_amount authorization_time_ms channel category "
    "debit_credit currency description merchant_name loan_id do_debit_order_id rrn stan is_debit is_credit "
    "is_debit_order is_loan_payment is_scheduled is_recurring is_salary_candidate is_initial_deposit has_error"
).split()


def signed(amount: str, is_debit: Column) -> Column:
    """Debits negative, everything else (also unknown) as it is."""
    return F.when(is_debit, -F.col(amount)).otherwise(F.col(amount))


def account_owner(
    bridge: DataFrame, accounts: DataFrame, customers: DataFrame, order: Sequence[str] = ("customer_id",)
) -> DataFrame:
    """(account_id, primary_customer_sk): one row per account with a primary holder.

    The holder decides that the account has a primary customer; the key comes from the account's own customer.
    """
    holders = primary_holder(bridge, "account_id", "signatory_role", "primary_holder", order).select("account_id")
    owners = accounts.select("account_id", F.col("customer_id").alias("__owner"))
    keys = customers.select(F.col("customer_id").alias("__cust"), F.col("customer_sk").alias("primary_customer_sk"))
    return (
        holders.join(owners, "account_id", "left")
        .join(keys, F.col("__owner") == F.col("__cust"), "left")
        .select("account_id", "primary_customer_sk")
    )


def account_side(history: DataFrame, owners: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Account versions with the account's primary customer; an account without versions keeps its owner."""
    versions = open_first(history.select("account_id", FROM, TO, *columns), "account_id")
    sides = versions.join(owners.withColumnRenamed("account_id", "__acc"), F.col("account_id") == F.col("__acc"), "full_outer")
    return sides.withColumns({
        "account_id": F.coalesce("account_id", "__acc"),
        FROM: F.coalesce(FROM, F.lit("0001-01-01").cast("date")), TO: F.coalesce(TO, F.lit(OPEN_END).cast("date")),
    }).drop("__acc")


def transaction_fact(
    transactions: DataFrame,
    account_history: DataFrame,
    owners: DataFrame,
    columns: Sequence[str] = FACT_COLUMNS,
    history_columns: Sequence[str] = (),
) -> DataFrame:
    """Completed transactions with date key, the account version of their day, the primary customer and
    signed and absolute amounts. One output row per completed transaction.

    Owner and version meet on the account side first, so the large side is shuffled once and joined once.
    """
    done = transactions.filter("is_completed").withColumn("date_key", date_key("transaction_date"))
    wanted = ["dim_account_key", *history_columns]
    side = account_side(account_history, owners, wanted)
    placed = pit_join(done, side, "account_id", "transaction_date", [*wanted, "primary_customer_sk"], patch_first=False)
    return placed.withColumns({
        "transaction_amount": signed("amount", F.col("is_debit")), "transaction_amount_abs": F.abs("amount"),
        "fee_amount": F.col("transaction_cost"),
    }).select(*columns)


def fact_products(fact: DataFrame, enrollments: DataFrame) -> DataFrame:
    """Optional product key: the latest enrolment of the account up to the transaction date."""
    latest = latest_by(enrollments, ["account_id", "enrollment_date"], [F.col("product_code").asc()])
    return asof_join(fact, latest, "account_id", "transaction_date", "enrollment_date", ["product_code"])
