import pytest
from pyspark.sql import functions as F

from silverline.functions import mapping

CASES = {
    "DISCOUNT_TYPE": {
        "fixed": ["fixed", "FIXED", "dollar", " $ "],
        "percentage": ["percentage", "PERCENT", "%"],
        "bogo": ["bogo", "buy_one_get_one"],
        "free_shipping": ["free_shipping"],
        "UNKNOWN": ["invalid_type", "", None],
    },
    "INVENTORY_STATUS": {
        "in_stock": ["in_stock", "in stock", "InStock"],
        "low_stock": ["LOW_STOCK", "low stock"],
        "out_of_stock": ["out_of_stock", "out of stock"],
        "discontinued": ["discontinued"],
        "pending": ["pending"],
        "UNKNOWN": ["N/A", " ", None],
    },
    "PAYMENT_METHOD": {
        "credit_card": ["credit_card", "credit card", "Credit"],
        "debit_card": ["debit_card", "debit card", "debit"],
        "paypal": [" PayPal "],
        "cash": ["cash"],
        "bank_transfer": ["bank_transfer", "transfer"],
        "crypto": ["crypto", "Bitcoin"],
        "UNKNOWN": ["cheque", None],
    },
    "PAYMENT_STATUS": {
        "completed": ["completed", "success", "PAID"],
        "pending": ["pending"],
        "failed": ["failed", "declined"],
        "cancelled": ["cancelled", "canceled"],
        "refunded": ["refunded"],
        "UNKNOWN": ["", None],
    },
    "SHIPPING_CARRIER": {
        "FedEx": ["fedex", "FEDEX "],
        "UPS": ["ups"],
        "DHL": ["dhl"],
        "USPS": ["usps"],
        "Amazon Logistics": ["amazon logistics", "Amazon"],
        "Local Courier": ["local courier"],
        "UNKNOWN": ["pigeon", None],
    },
    "SHIPPING_STATUS": {
        "pending": ["pending"],
        "in_transit": ["in_transit", "In Transit"],
        "delivered": ["delivered"],
        "delayed": ["delayed"],
        "lost": ["lost"],
        "cancelled": ["cancelled", "canceled"],
        "UNKNOWN": ["?", None],
    },
}


@pytest.mark.parametrize("name", CASES)
def test_map(evaluate, name):
    values = [raw for raws in CASES[name].values() for raw in raws]
    expected = [to for to, raws in CASES[name].items() for _ in raws]
    assert evaluate(values, lambda c: mapping.map_values(c, getattr(mapping, name))) == expected


def test_quotes_and_default(evaluate):
    odd = {"it's": "a'b", "back\\slash": "c"}
    assert evaluate(["It's", "back\\slash", "x"], lambda c: mapping.map_values(c, odd, "none")) == ["a'b", "c", "none"]


def test_empty_map():
    assert mapping.map_values(F.lit("x"), {}) is not None
