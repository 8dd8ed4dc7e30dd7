"""Customer 360: one wide row per individual."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import bands, calendar
from ..operators.ranking import with_tiles
from ..session import durable

# fixed values: months that make a salary regular, months without one that make it stopped
REGULAR_MONTHS, STOPPED_MONTHS = 3, 2
# fixed values: the published columns in order, with their types
COLUMNS = {
    "customer_id": "string", "birth_date": "date", "city": "string", "province": "string", "nationality": "string",
    "citizenship": "string", "primary_citizenship": "string", "is_dual_citizen": "boolean", "risk_score": "double",
    "preferred_contact_method": "string", "is_pep": "boolean", "expected_income": "double",
    "is_opted_in_marketing": "boolean", "number_of_accounts": "bigint", "first_account_opening_date": "date",
    "age_at_opening": "bigint", "has_overdraft": "bigint", "has_credit_card": "bigint",
    "number_of_active_months": "bigint", "transactions_frequency": "decimal(24,12)", "last_day_of_transactions": "date",
    "average_days_between_transactions": "bigint", "average_transaction_volume": "double", "has_had_a_loan": "bigint",
    "number_of_loans": "bigint", "most_preferred_channel": "string", "is_on_regular_salary": "bigint",
    "has_salary_stopped": "bigint", "transactions_frequency_quartile": "bigint", "active_months_quartile": "bigint",
    "avg_days_between_transactions_quartile": "bigint", "avg_transaction_volume_quartile": "bigint",
    "silver_batch_id": "string",
}
QUARTILES = {
    "transactions_frequency_quartile": "transactions_frequency",
    "active_months_quartile": "number_of_active_months",
    "avg_days_between_transactions_quartile": "average_days_between_transactions",
    "avg_transaction_volume_quartile": "average_transaction_volume",
}


def account_facts(accounts: DataFrame, customer: str = "customer_id") -> DataFrame:
    return accounts.groupBy(customer).agg(
        F.count(F.lit(1)).cast("int").alias("number_of_accounts"),
        F.min("opening_date").alias("first_account_opening_date"),
        F.max(F.col("has_overdraft").cast("int")).alias("has_overdraft"),
        F.max(F.col("has_credit_card").cast("int")).alias("has_credit_card"),
    )


def activity(transactions: DataFrame, as_of: Column, customer: str = "customer_id") -> DataFrame:
    """Activity and salary facts of completed transactions.

    Columns read: customer, transaction_date, channel, amount_abs, is_salary_candidate. The rows are read once, into cells
    of (customer, month, channel) with a bitmap of days; everything else is hash aggregates of cells with buffers of fixed
    size: days by bits, months by cells, three consecutive paid months by votes for their first one, and the preferred
    channel by the maximum of count and rank in one number. A salary is regular with three consecutive months and has
    stopped when it was regular and the last two months before ``as_of`` have none.
    """
    day = F.col("transaction_date")
    cells = durable(transactions.groupBy(customer, calendar.month_index(day).alias("month"), "channel").agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount_abs").alias("volume"), F.min(day).alias("first_day"), F.max(day).alias("last_day"),
        F.bit_or(F.call_function("shiftleft", F.lit(1), F.dayofmonth(day) - 1)).alias("day_bits"),
        F.max(F.col("is_salary_candidate").cast("int")).alias("paid"),
    ), "cells")
    months = cells.groupBy(customer, "month").agg(
        F.sum("n").alias("n"), F.sum("volume").alias("volume"), F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day"),
        F.bit_or("day_bits").alias("day_bits"), F.max("paid").alias("paid"),
    ).select(
        customer, "n", "volume", "first_day", "last_day", F.bit_count("day_bits").alias("days"),
        F.when(F.col("month").isNotNull(), 1).alias("months"), F.when(F.col("paid") == 1, F.col("month")).alias("paid_month"),
    )
    # a paid month votes for itself and the months before it; a month with all votes begins a regular salary
    starts = F.array(*[F.col("month") - k for k in range(REGULAR_MONTHS)])
    paid = cells.filter("paid = 1 AND month IS NOT NULL").select(customer, "month").distinct()
    votes = paid.select(customer, F.explode(starts).alias("start")).groupBy(customer, "start").count()
    steady = votes.filter(F.col("count") == REGULAR_MONTHS).select(customer, F.lit(1).alias("regular"))
    # channels by falling name: a higher rank is an earlier name, so that the larger number wins a tie
    names = [r[0] for r in cells.select("channel").distinct().orderBy(F.desc("channel")).collect() if r[0] is not None]  # a handful
    rank = F.array_position(F.array(*[F.lit(n) for n in names]), F.col("channel")) - 1 if names else F.lit(0).cast("long")
    used = cells.filter("channel IS NOT NULL").groupBy(customer, rank.alias("rank")).agg(F.sum("n").alias("uses"))
    used = used.select(customer, (F.col("uses") * len(names) + F.col("rank")).alias("best"))

    parts = months.unionByName(steady, allowMissingColumns=True).unionByName(used, allowMissingColumns=True)
    facts = parts.groupBy(customer).agg(
        F.sum("n").alias("transactions"), F.round(F.sum("volume"), 2).alias("volume"), F.min("first_day").alias("first_day"),
        F.max("last_day").alias("last_day_of_transactions"), F.sum("days").alias("days"),
        F.coalesce(F.sum("months"), F.lit(0)).cast("int").alias("number_of_active_months"), F.max("paid_month").alias("last_paid"),
        F.coalesce(F.max("regular"), F.lit(0)).alias("is_on_regular_salary"), F.max("best").alias("best"),
    )
    span = F.datediff("last_day_of_transactions", "first_day")
    silent = F.col("last_paid") < calendar.month_index(as_of) - STOPPED_MONTHS
    place = (F.col("best") % max(len(names), 1) + 1).cast("int")
    channel = F.element_at(F.array(*[F.lit(n) for n in names]), place) if names else F.lit(None).cast("string")
    return facts.select(
        customer, "number_of_active_months",
        (F.col("transactions") / F.nullif("number_of_active_months", F.lit(0))).alias("transactions_frequency"),
        "last_day_of_transactions",
        F.when(F.col("days") > 1, F.floor(span / (F.col("days") - 1))).cast("int").alias("average_days_between_transactions"),
        (F.col("volume") / F.col("transactions")).alias("average_transaction_volume"),
        channel.alias("most_preferred_channel"), "is_on_regular_salary",
        ((F.col("is_on_regular_salary") == 1) & F.coalesce(silent, F.lit(False))).cast("int").alias("has_salary_stopped"),
    )


def loan_facts(loans: DataFrame, customer: str = "customer_id") -> DataFrame:
    return loans.groupBy(customer).agg(F.count(F.lit(1)).cast("int").alias("number_of_loans"))


def customer_360(
    individuals: DataFrame,
    accounts: DataFrame,
    transactions: DataFrame,
    loans: DataFrame,
    opted: DataFrame,
    as_of: dt.date | str,
    batch_id: str | None = None,
) -> DataFrame:
    """``transactions``: completed rows with customer_id, transaction_date, channel, amount_abs, is_salary_candidate.

    Every input is reduced to one row per customer before the joins, which all use the customer key. The result has the
    33 published columns in order and type; what ``individuals`` does not bring is null.
    """
    day = F.lit(str(as_of)).cast("date")
    wide = (
        individuals
        .join(opted.select("customer_id", "is_opted_in_marketing"), "customer_id", "left")
        .join(account_facts(accounts), "customer_id", "left")
        .join(activity(transactions, day), "customer_id", "left")
        .join(loan_facts(loans), "customer_id", "left")
    )
    zero = ("number_of_accounts", "has_overdraft", "has_credit_card", "number_of_active_months", "number_of_loans",
            "is_on_regular_salary", "has_salary_stopped")
    filled = wide.withColumns({
        **{c: F.coalesce(F.col(c), F.lit(0)) for c in zero},
        "is_opted_in_marketing": F.coalesce("is_opted_in_marketing", F.lit(False)),
        "has_had_a_loan": (F.coalesce("number_of_loans", F.lit(0)) > 0).cast("int"),
        "age_at_opening": bands.full_years("birth_date", F.col("first_account_opening_date")),
        "silver_batch_id": F.lit(batch_id).cast("string"),
    })
    # the tiles read the rows twice (ranks, then tags): write the joined rows once instead of joining twice
    absent = {c: F.lit(None).cast(t) for c, t in COLUMNS.items() if c not in filled.columns and c not in QUARTILES}
    known = filled.withColumns(absent).select(*[c for c in COLUMNS if c not in QUARTILES])
    tiled = with_tiles(durable(known, "customer360"), QUARTILES, "customer_id")
    return tiled.select(*[F.col(c).cast(t).alias(c) for c, t in COLUMNS.items()])


