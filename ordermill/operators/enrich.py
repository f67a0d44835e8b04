"""Orders with their customer and product attributes and the line total."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.functions.money import line_total
from ordermill.schemas import PROCESSED


def enrich_orders(
    orders: DataFrame, customers: DataFrame, products: DataFrame, run_date: str | None = None
) -> DataFrame:
    """Left-join clean orders to clean customers and products.

    With ``run_date`` the frames are taken as that one run and stamped with it; without, they
    carry ``run_date`` and are joined run by run.
    """
    by_run = ["run_date"]
    if run_date is not None:
        orders = orders.withColumn("run_date", F.lit(run_date))
        customers, products = customers.drop("run_date"), products.drop("run_date")
        by_run = []
    # Spark splits a hot customer or product (or all the NULL keys) across tasks only when both
    # join sides come straight from a shuffle; the rebalance puts one between dedup and join.
    # Whether a side is broadcast is left to Spark, which knows its size at run time.
    customers, products = customers.hint("rebalance"), products.hint("rebalance")
    return (
        orders.join(customers, ["customer_id", *by_run], "left")
        .join(products, ["product_id", *by_run], "left")
        .withColumns(
            {
                "order_quantity": F.col("order_quantity").cast("double"),
                "order_price": F.col("order_price").cast("double"),
            }
        )
        .withColumn("total_amount", line_total(F.col("order_quantity"), F.col("order_price")))
        .select(*PROCESSED["orders_enriched"])
    )
