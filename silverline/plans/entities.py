"""The nine shop entities: raw columns, cleaning rules, types and constraints."""

from __future__ import annotations

from silverline.functions import mapping
from silverline.operators.integrity import Rule
from silverline.plans.spec import (
    CodeRule,
    DateRule,
    EmailRule,
    EntitySpec,
    MapRule,
    PhoneRule,
    ReferenceRule,
    TextRule,
    raw_schema,
)

# Column names, kept characters, sentinels and types of the nine tables. Keys are 64 bits wide.

DATE = DateRule()
CODE = CodeRule()
PERSON = TextRule(keep_chars="'-", case_mode="person")
ID_PRESENT = Rule("id_present", "id", "not_null")

CUSTOMERS = EntitySpec(
    name="customers",
    schema=raw_schema(
        "name", "email", "phone", "city", "country", "created_at", "updated_at", "registration_date"
    ),
    rules={
        "name": PERSON,
        "city": TextRule(keep_chars="'-."),
        "email": EmailRule(),
        "phone": PhoneRule(),
        "country": ReferenceRule("country"),
        "created_at": DATE,
        "updated_at": DATE,
        "registration_date": DATE,
    },
    types={"id": "long"},
    constraints=(ID_PRESENT,),
)

COUPONS = EntitySpec(
    name="coupons",
    schema=raw_schema(
        "code",
        "discount_type",
        "discount_value",
        "min_order",
        "max_uses",
        "used_count",
        "expires_at",
        "is_active",
        "created_at",
        "updated_at",
    ),
    rules={
        "code": CODE,
        "discount_type": MapRule(mapping.DISCOUNT_TYPE),
        "expires_at": DATE,
        "created_at": DATE,
        "updated_at": DATE,
    },
    types={
        "id": "long",
        "discount_value": "double",
        "min_order": "double",
        "max_uses": "int",
        "used_count": "int",
        "is_active": "bool",
    },
    constraints=(ID_PRESENT,),
)

CATEGORIES = EntitySpec(
    name="categories",
    schema=raw_schema("name", "parent_id", "description", "is_active", "created_at", "updated_at"),
    rules={
        "name": TextRule(keep_chars="'-&", keep_digits=True),
        "description": TextRule(
            keep_chars="'-.,&/()", replacement="No description", case_mode="none", keep_digits=True
        ),
        "created_at": DATE,
        "updated_at": DATE,
    },
    types={"id": "long", "parent_id": "long", "is_active": "bool"},
    constraints=(ID_PRESENT,),
)

INVENTORY = EntitySpec(
    name="inventory",
    schema=raw_schema(
        "product_id",
        "warehouse",
        "quantity",
        "reorder_point",
        "last_restock",
        "status",
        "created_at",
        "updated_at",
    ),
    rules={
        "warehouse": TextRule(keep_chars="-", keep_digits=True),
        "status": MapRule(mapping.INVENTORY_STATUS),
        "last_restock": DATE,
        "created_at": DATE,
        "updated_at": DATE,
    },
    types={"id": "long", "product_id": "long", "quantity": "int", "reorder_point": "int"},
    constraints=(ID_PRESENT, Rule("quantity_not_negative", "quantity", "min", (0,))),
)

PAYMENTS = EntitySpec(
    name="payments",
    schema=raw_schema(
        "order_id", "amount", "method", "status", "transaction_id", "paid_at", "created_at", "updated_at"
    ),
    rules={
        "method": MapRule(mapping.PAYMENT_METHOD),
        "status": MapRule(mapping.PAYMENT_STATUS),
        "transaction_id": CODE,
        "paid_at": DATE,
        "created_at": DATE,
        "updated_at": DATE,
    },
    types={"id": "long", "order_id": "long", "amount": "double"},
    constraints=(ID_PRESENT, Rule("amount_two_decimals", "amount", "decimals", (2,), "round")),
)

PRODUCTS = EntitySpec(
    name="products",
    schema=raw_schema(
        "name", "category", "price", "stock", "brand", "description", "created_at", "updated_at"
    ),
    rules={
        "name": TextRule(keep_chars="'-&/().", keep_digits=True),
        "category": TextRule(keep_chars="'-&", keep_digits=True),
        "brand": TextRule(keep_chars="'-.", keep_digits=True),
        "description": TextRule(
            keep_chars="'-.,&/()",
            replacement="No description",
            case_mode="none",
            keep_digits=True,
            strip_html=True,
        ),
        "created_at": DATE,
        "updated_at": DATE,
    },
    types={"id": "long", "price": "double", "stock": "int"},
    null_tokens={"stock": ("unlimited",)},
    constraints=(ID_PRESENT, Rule("price_not_negative", "price", "min", (0,))),
)

REVIEWS = EntitySpec(
    name="reviews",
    schema=raw_schema(
        "product_id",
        "customer_id",
        "rating",
        "title",
        "comment",
        "verified_purchase",
        "created_at",
        "updated_at",
    ),
    rules={
        "title": TextRule(keep_chars="'-.,!?()", replacement="No title", keep_digits=True),
        "comment": TextRule(
            keep_chars="'-.,!?()", replacement="No comment", case_mode="none", keep_digits=True
        ),
        "created_at": DATE,
        "updated_at": DATE,
    },
    types={
        "id": "long",
        "product_id": "long",
        "customer_id": "long",
        "rating": "int",
        "verified_purchase": "bool",
    },
    constraints=(ID_PRESENT, Rule("rating_1_to_5", "rating", "between", (1, 5))),
)

SHIPPING = EntitySpec(
    name="shipping",
    schema=raw_schema(
        "order_id",
        "carrier",
        "tracking_number",
        "status",
        "estimated_delivery",
        "actual_delivery",
        "cost",
        "created_at",
        "updated_at",
    ),
    rules={
        "carrier": MapRule(mapping.SHIPPING_CARRIER),
        "status": MapRule(mapping.SHIPPING_STATUS),
        "tracking_number": CODE,
        "estimated_delivery": DATE,
        "actual_delivery": DATE,
        "created_at": DATE,
        "updated_at": DATE,
    },
    types={"id": "long", "order_id": "long", "cost": "double"},
    constraints=(ID_PRESENT, Rule("cost_not_negative", "cost", "min", (0,))),
)

SUPPLIERS = EntitySpec(
    name="suppliers",
    schema=raw_schema(
        "name", "contact_name", "email", "phone", "country", "rating", "is_active", "created_at", "updated_at"
    ),
    rules={
        "name": TextRule(keep_chars="'-.&", keep_digits=True),
        "contact_name": PERSON,
        "email": EmailRule(),
        "phone": PhoneRule(),
        "country": ReferenceRule("country"),
        "created_at": DATE,
        "updated_at": DATE,
    },
    types={"id": "long", "rating": "double", "is_active": "bool"},
    constraints=(ID_PRESENT, Rule("rating_not_negative", "rating", "min", (0,), "nullify")),
)

# Registration order is the order of a full run.
ENTITY_SPECS = {
    spec.name: spec
    for spec in (
        CUSTOMERS,
        COUPONS,
        CATEGORIES,
        INVENTORY,
        PAYMENTS,
        PRODUCTS,
        REVIEWS,
        SHIPPING,
        SUPPLIERS,
    )
}
