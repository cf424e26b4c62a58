"""Fixed values of the source system that rules test for. Rules and their SQL checks share them."""

from __future__ import annotations

# Fixed values, in the order of the source.
REFUNDABLE = ("Refunded", "Cancelled", "Failed")
RATEABLE = ("Delivered", "Out For Delivery", "Refunded")
CANCELLED = ("Cancelled", "Rejected")
UNCOLLECTED = ("Failed", "Pending")
WALLETS = ("Paypal", "Apple Pay", "Google Pay", "Gift Card")
NOT_COMPLETED = ("Failed", "Returned")
IN_PROGRESS = ("In Transit", "Partial")
SEVERE_WEATHER = ("Stormy", "Snowy")
HIGH_WEATHER = ("Rainy", "Windy")
OPEN_INVOICE = ("Pending", "Partial")
UNPAID_INVOICE = ("Pending", "Partial", "Overdue")
SETTLED = ("Paid", "Paid - Date Unknown", "Waived", "Disputed")
COLLECTED = ("Paid", "Paid - Date Unknown")
WORKING = ("Available", "On Delivery", "On Break")
PAST_MIDNIGHT = ("00:00", "01:00")


def sql_list(values: tuple[str, ...]) -> str:
    """The values as a SQL list."""
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"
