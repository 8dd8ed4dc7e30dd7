"""Customer 360."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans import customer360
from . import views
from .profiles import OPTED_SQL, opted
from .registry import query, table

SALARY_LIMIT = 60000
BASE_SQL = f"""
t AS (SELECT a.customer_id, t.transaction_date AS d, t.channel, abs(t.amount) AS amt, NOT t.is_debit AND t.amount < {SALARY_LIMIT} AS sal
  FROM {views.TX_SQL} t JOIN {views.ACCOUNTS_SQL} a USING (account_id) WHERE t.is_completed),
act AS (SELECT customer_id, count(DISTINCT date_trunc('month', d)) AS months, count(*) AS n, max(d) AS last_d, min(d) AS first_d,
  count(DISTINCT d) AS days, round(sum(amt), 2) AS vol FROM t GROUP BY 1),
ch AS (SELECT customer_id, channel FROM (SELECT customer_id, channel, row_number() OVER (PARTITION BY customer_id ORDER BY count(*) DESC, channel) AS rn
  FROM t GROUP BY customer_id, channel) WHERE rn = 1),
sm AS (SELECT DISTINCT customer_id, year(d) * 12 + month(d) AS m FROM t WHERE sal),
runs AS (SELECT customer_id, m - rk AS run, count(*) AS len, max(m) AS last_m FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY m) AS rk FROM sm) GROUP BY ALL),
salary AS (SELECT customer_id, CAST(max(len) >= 3 AS INTEGER) AS regular, CAST(max(len) >= 3 AND max(last_m) < 2001 * 12 + 12 - 2 AS INTEGER) AS stopped FROM runs GROUP BY 1),
acc AS (SELECT customer_id, CAST(count(*) AS INTEGER) AS n_acc, min(opening_date) AS first_open, max(CAST(account_tier = '1-URGENT' AS INTEGER)) AS od,
  max(CAST(credit_limit > 400000 AS INTEGER)) AS cc FROM {views.ACCOUNTS_SQL} GROUP BY 1),
loan AS (SELECT customer_id, CAST(count(*) AS INTEGER) AS n_loan FROM {views.ACCOUNTS_SQL} WHERE account_status = 'suspended' GROUP BY 1),
wide AS (SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_custkey, make_date(1920 + CAST(c_custkey AS INTEGER) % 60, 6, 15) AS birth_date, concat('city ', c_nationkey) AS city, c_mktsegment AS province,
  concat('n', c_nationkey) AS nationality, concat('n', c_nationkey) AS citizenship, concat('n', c_nationkey % 5) AS primary_citizenship, c_nationkey % 2 = 0 AS is_dual_citizen, CAST(c_nationkey AS DOUBLE) AS risk_score,
  'email' AS preferred_contact_method, c_acctbal < 0 AS is_pep, c_acctbal * 2.0 AS expected_income, coalesce(o.has_engaged = 1 AND o.has_opted_out = 0, FALSE) AS is_opted_in_marketing, CAST(coalesce(n_acc, 0) AS BIGINT) AS number_of_accounts, first_open AS first_account_opening_date,
  CASE WHEN first_open IS NOT NULL THEN datesub('year', make_date(1920 + CAST(c_custkey AS INTEGER) % 60, 6, 15), first_open) END::BIGINT AS age_at_opening,
  CAST(coalesce(od, 0) AS BIGINT) AS has_overdraft, CAST(coalesce(cc, 0) AS BIGINT) AS has_credit_card, CAST(coalesce(months, 0) AS BIGINT) AS number_of_active_months,
  n / months AS transactions_frequency, last_d AS last_day_of_transactions,
  CASE WHEN days > 1 THEN CAST(floor(date_diff('day', first_d, last_d) / (days - 1)) AS BIGINT) END AS average_days_between_transactions,
  vol / n AS average_transaction_volume, ch.channel AS most_preferred_channel, CAST(coalesce(n_loan, 0) AS BIGINT) AS number_of_loans, CAST(coalesce(n_loan, 0) > 0 AS BIGINT) AS has_had_a_loan,
  CAST(coalesce(regular, 0) AS BIGINT) AS is_on_regular_salary, CAST(coalesce(stopped, 0) AS BIGINT) AS has_salary_stopped
  FROM customer LEFT JOIN {OPTED_SQL} o ON o.customer_id = CAST(c_custkey AS VARCHAR) LEFT JOIN acc ON acc.customer_id = c_custkey LEFT JOIN act ON act.customer_id = c_custkey
  LEFT JOIN ch ON ch.customer_id = c_custkey LEFT JOIN loan ON loan.customer_id = c_custkey LEFT JOIN salary ON salary.customer_id = c_custkey)
"""


def inputs(spark, sf):
    key = F.col("customer_id").cast("string")
    accounts = views.accounts(spark, sf).withColumns({
        "has_overdraft": F.col("account_tier") == "1-URGENT", "has_credit_card": F.col("credit_limit") > 400000,
    })
    owners = accounts.select("account_id", "customer_id")
    tx = views.transactions(spark, sf).filter("is_completed").join(owners, "account_id").select(
        key.alias("customer_id"), "transaction_date", "channel", F.abs("amount").alias("amount_abs"),
        (~F.col("is_debit") & (F.col("amount") < SALARY_LIMIT)).alias("is_salary_candidate"),
    )
    people = table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("customer_id"), "c_custkey", F.col("c_mktsegment").alias("province"),
        F.concat(F.lit("city "), F.col("c_nationkey")).alias("city"), F.concat(F.lit("n"), F.col("c_nationkey")).alias("nationality"),
        F.concat(F.lit("n"), F.col("c_nationkey")).alias("citizenship"), F.concat(F.lit("n"), F.col("c_nationkey") % 5).alias("primary_citizenship"),
        (F.col("c_nationkey") % 2 == 0).alias("is_dual_citizen"), F.col("c_nationkey").cast("double").alias("risk_score"),
        F.lit("email").alias("preferred_contact_method"), (F.col("c_acctbal") < 0).alias("is_pep"), (F.col("c_acctbal") * 2.0).alias("expected_income"),
        F.make_date(F.lit(1920) + F.col("c_custkey").cast("int") % 60, F.lit(6), F.lit(15)).alias("birth_date"),
    )
    accounts = accounts.withColumn("customer_id", key)
    return people, accounts, tx, accounts.filter("account_status = 'suspended'"), opted(spark, sf)


@query("customer_360", f"""WITH {BASE_SQL} SELECT * EXCLUDE (c_custkey) REPLACE (CAST(CAST(transactions_frequency AS DECIMAL(24, 12)) AS DOUBLE) AS transactions_frequency), CAST(ntile(4) OVER (ORDER BY transactions_frequency NULLS FIRST, customer_id) AS BIGINT) AS transactions_frequency_quartile,
CAST(ntile(4) OVER (ORDER BY number_of_active_months NULLS FIRST, customer_id) AS BIGINT) AS active_months_quartile,
CAST(ntile(4) OVER (ORDER BY average_days_between_transactions NULLS FIRST, customer_id) AS BIGINT) AS avg_days_between_transactions_quartile,
CAST(ntile(4) OVER (ORDER BY average_transaction_volume NULLS FIRST, customer_id) AS BIGINT) AS avg_transaction_volume_quartile FROM wide""")
def _(spark, sf):
    wide = customer360.customer_360(*inputs(spark, sf), as_of=views.AS_OF).drop("silver_batch_id")
    return wide.withColumn("transactions_frequency", F.col("transactions_frequency").cast("double"))
