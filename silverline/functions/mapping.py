"""Category maps: raw spelling to canonical value."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from silverline.functions.text import UNKNOWN, match_key

# Raw spellings (lower case) and their canonical categories.
DISCOUNT_TYPE = {
    "fixed": "fixed",
    "dollar": "fixed",
    "$": "fixed",
    "percentage": "percentage",
    "percent": "percentage",
    "%": "percentage",
    "bogo": "bogo",
    "buy_one_get_one": "bogo",
    "free_shipping": "free_shipping",
}

# Fixed values.
INVENTORY_STATUS = {
    "in_stock": "in_stock",
    "in stock": "in_stock",
    "instock": "in_stock",
    "low_stock": "low_stock",
    "low stock": "low_stock",
    "out_of_stock": "out_of_stock",
    "out of stock": "out_of_stock",
    "discontinued": "discontinued",
    "pending": "pending",
}

# Fixed values.
PAYMENT_METHOD = {
    "credit_card": "credit_card",
    "credit card": "credit_card",
    "credit": "credit_card",
    "debit_card": "debit_card",
    "debit card": "debit_card",
    "debit": "debit_card",
    "paypal": "paypal",
    "cash": "cash",
    "bank_transfer": "bank_transfer",
    "transfer": "bank_transfer",
    "crypto": "crypto",
    "bitcoin": "crypto",
}

# Fixed values.
PAYMENT_STATUS = {
    "completed": "completed",
    "success": "completed",
    "paid": "completed",
    "pending": "pending",
    "failed": "failed",
    "declined": "failed",
    "cancelled": "cancelled",
    "canceled": "cancelled",
    "refunded": "refunded",
}

# Fixed values.
SHIPPING_CARRIER = {
    "fedex": "FedEx",
    "ups": "UPS",
    "dhl": "DHL",
    "usps": "USPS",
    "amazon logistics": "Amazon Logistics",
    "amazon": "Amazon Logistics",
    "local courier": "Local Courier",
}

# Fixed values.
SHIPPING_STATUS = {
    "pending": "pending",
    "in_transit": "in_transit",
    "in transit": "in_transit",
    "delivered": "delivered",
    "delayed": "delayed",
    "lost": "lost",
    "cancelled": "cancelled",
    "canceled": "cancelled",
}


def _literal(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def map_values(col: Column, mapping: Mapping[str, str], default: str = UNKNOWN) -> Column:
    """Canonical category of a value; ``default`` for unknown, blank and NULL.

    A literal map keeps the generated code small however many spellings there are.
    """
    if not mapping:
        return F.lit(default)
    entries = ", ".join(_literal(part) for pair in mapping.items() for part in pair)
    return F.coalesce(F.element_at(F.expr(f"map({entries})"), match_key(col)), F.lit(default))
