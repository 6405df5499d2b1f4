"""The two example schemas that the queries validate against, and their rules."""

from __future__ import annotations

from assayer.operators.schema import Field, SchemaDefinition

EMAIL = r"^[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\.[a-zA-Z0-9-.]+$"
PHONE = r"^\+?[0-9]{10,15}$"
CUSTOMER_ID = r"^CUST-[0-9]{6}$"
POSTAL_CODE = r"^[0-9]{5}(-[0-9]{4})?$"
TRANSACTION_ID = r"^TXN-[0-9]{8}$"
PRODUCT_ID = r"^PRD-[0-9]{6}$"
PAYMENT_METHOD = r"^(CREDIT|DEBIT|CASH|CHECK|TRANSFER)$"
PAYMENT_METHODS = ["CREDIT", "DEBIT", "CASH", "CHECK", "TRANSFER"]

CUSTOMER_V1 = SchemaDefinition(
    name="customer_data",
    version=1,
    fields=(
        Field("customer_id", "string", nullable=False),
        Field("name", "string", nullable=False),
        Field("email", "string", nullable=False),
        Field("phone", "string"),
        Field("address", "string"),
        Field("created_at", "timestamp", nullable=False),
    ),
    patterns={"email": EMAIL, "phone": PHONE, "customer_id": CUSTOMER_ID},
)

CUSTOMER_V2 = SchemaDefinition(
    name="customer_data",
    version=2,
    fields=(
        Field("customer_id", "string", nullable=False),
        Field("first_name", "string", nullable=False),
        Field("last_name", "string", nullable=False),
        Field("email", "string", nullable=False),
        Field("phone", "string"),
        Field("address", "string"),
        Field("city", "string"),
        Field("state", "string"),
        Field("country", "string", default="USA"),
        Field("postal_code", "string"),
        Field("created_at", "timestamp", nullable=False),
        Field("updated_at", "timestamp"),
        Field("customer_type", "string", default="regular"),
    ),
    patterns={"email": EMAIL, "phone": PHONE, "customer_id": CUSTOMER_ID, "postal_code": POSTAL_CODE},
)

SALES_V1 = SchemaDefinition(
    name="sales_transactions",
    version=1,
    fields=(
        Field("transaction_id", "string", nullable=False),
        Field("customer_id", "string", nullable=False),
        Field("product_id", "string", nullable=False),
        Field("quantity", "integer", nullable=False),
        Field("unit_price", "decimal(10,2)", nullable=False),
        Field("total_price", "decimal(10,2)", nullable=False),
        Field("transaction_date", "timestamp", nullable=False),
        Field("payment_method", "string"),
    ),
    patterns={
        "transaction_id": TRANSACTION_ID,
        "customer_id": CUSTOMER_ID,
        "product_id": PRODUCT_ID,
        "payment_method": PAYMENT_METHOD,
    },
    ranges={
        "quantity": {"min": 1, "max": 10000},
        "unit_price": {"min": 0.01, "max": 100000},
        "total_price": {"min": 0.01, "max": 1000000},
    },
)
