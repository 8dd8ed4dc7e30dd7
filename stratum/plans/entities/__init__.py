"""Silver entities: bronze rows -> cleaned, masked and enriched rows.

Every builder takes the bronze increment (already filtered by its high-water mark) and a ``RunContext``.
Order inside a builder: newest row per key, typing, checks that need raw values, masking, derivation.
"""

from .holdings import accounts, bridge_customer_account, enrollments, limits_history, signatories, status_events
from .people import customers, split_customers
from .engagement import campaign_responses, campaigns, complaints
from .lending import collections_cases, loan_participations, loans
from .payments import atm_logs, debit_orders, initial_deposits, transactions

__all__ = [
    "accounts", "atm_logs", "bridge_customer_account", "campaign_responses", "campaigns", "collections_cases",
    "complaints", "customers", "debit_orders", "enrollments", "initial_deposits", "limits_history",
    "loan_participations", "loans", "signatories", "split_customers", "status_events", "transactions",
]
