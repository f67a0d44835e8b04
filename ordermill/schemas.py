"""Column contracts of the raw and processed tables, as ``{column: Spark type}``."""

from __future__ import annotations

RAW = {
    "customers": {
        "customer_id": "string",
        "name": "string",
        "email": "string",
        "country": "string",
        "signup_date": "date",
        "run_date": "string",
    },
    "products": {
        "product_id": "string",
        "category": "string",
        "name": "string",
        "cost": "double",
        "price": "double",
        "run_date": "string",
    },
    "orders": {
        "order_id": "string",
        "order_date": "date",
        "customer_id": "string",
        "product_id": "string",
        "quantity": "bigint",
        "price": "double",
        "country": "string",
        "run_date": "string",
    },
    "payments": {
        "payment_id": "string",
        "order_id": "string",
        "payment_method": "string",
        "payment_date": "date",
        "amount": "double",
        "run_date": "string",
    },
}

PROCESSED = {
    "orders_enriched": {
        "product_id": "string",
        "customer_id": "string",
        "order_id": "string",
        "order_date": "date",
        "run_date": "string",
        "order_quantity": "double",
        "order_price": "double",
        "order_country": "string",
        "customer_name": "string",
        "email": "string",
        "customer_country": "string",
        "signup_date": "date",
        "category": "string",
        "product_name": "string",
        "cost": "double",
        "price": "double",
        "total_amount": "decimal(18,2)",
    },
    "customers_revenue": {
        "customer_id": "string",
        "customer_name": "string",
        "run_date": "string",
        "total_revenue": "decimal(28,2)",
    },
    "products_sales": {
        "product_id": "string",
        "product_name": "string",
        "category": "string",
        "run_date": "string",
        "total_quantity_sold": "double",
        "total_revenue": "decimal(28,2)",
    },
    "category_revenue": {
        "category": "string",
        "run_date": "string",
        "category_revenue": "decimal(28,2)",
    },
    "payments_summary": {
        "run_date": "string",
        "payment_method": "string",
        "total_amount": "double",
        "total_count": "bigint",
    },
}

# The tables of the warehouse: the processed ones and the cleaned category table.
WAREHOUSE = PROCESSED | {"category_revenue_clean": {"category": "string", "category_revenue": "double"}}

# Columns that must be filled on every row.
REQUIRED = {
    "orders_enriched": ["order_id", "customer_id", "product_id", "run_date"],
    "customers_revenue": ["customer_id", "run_date"],
    "products_sales": ["product_id", "run_date"],
    "category_revenue": ["category", "run_date"],
    "payments_summary": ["payment_method", "run_date"],
    "category_revenue_clean": ["category", "category_revenue"],
}


def ddl(contract: dict[str, str]) -> str:
    """The contract as a schema string for ``spark.read.schema``."""
    return ", ".join(f"{name} {kind}" for name, kind in contract.items())
