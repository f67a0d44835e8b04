"""Revenue, sales and payment totals.

Each is a hash aggregate with partial sums before the shuffle, so a hot key costs one row per
task. Give them the written enriched table: they then read only the columns they need and repeat
neither the dedup nor the joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Wide enough for amounts up to 10^22; a larger one raises.
SUMMED = "decimal(28,6)"


def customers_revenue(enriched: DataFrame) -> DataFrame:
    return enriched.groupBy("customer_id", "customer_name", "run_date").agg(
        F.sum("total_amount").alias("total_revenue")
    )


def products_sales(enriched: DataFrame) -> DataFrame:
    return enriched.groupBy("product_id", "product_name", "category", "run_date").agg(
        F.sum("order_quantity").alias("total_quantity_sold"),
        F.sum("total_amount").alias("total_revenue"),
    )


def category_revenue(enriched: DataFrame) -> DataFrame:
    return enriched.groupBy("category", "run_date").agg(F.sum("total_amount").alias("category_revenue"))


def payments_summary(payments: DataFrame, run_date: str | None = None) -> DataFrame:
    """Sum and count of the non-NULL amounts per method; payments are not deduplicated.

    Amounts are summed as decimals with six places, so the sum is the same to the last bit however the
    rows lie in tasks and whatever task is repeated, and then given as double.
    """
    if run_date is not None:
        payments = payments.withColumn("run_date", F.lit(run_date))
    return (
        payments.groupBy("run_date", "payment_method")
        .agg(
            F.sum(F.col("amount").cast(SUMMED)).cast("double").alias("total_amount"),
            F.count("amount").alias("total_count"),
        )
    )


def enriched_preview(enriched: DataFrame, rows: int = 5) -> DataFrame:
    """The first rows by order id, the same on every call."""
    return enriched.orderBy("order_id").limit(rows)


#: The keys of each total; its measures have other names in the table than in ``totals_in_one_pass``.
TOTAL_KEYS = {
    "customers_revenue": ("customer_id", "customer_name", "run_date"),
    "products_sales": ("product_id", "product_name", "category", "run_date"),
    "category_revenue": ("category", "run_date"),
}


def totals_in_one_pass(enriched: DataFrame) -> DataFrame:
    """All rows of the three totals from one scan and one shuffle: ``table_name``, all keys and both sums.

    Rows are told apart by their grouping, so a NULL key of a group is not mistaken for a key it does not have.
    """
    keys = list(dict.fromkeys(key for of in TOTAL_KEYS.values() for key in of))
    # Bit i from the left of a grouping id says that key i is not one of the group.
    name = F.when(F.lit(False), "")
    for table, of in TOTAL_KEYS.items():
        without = sum(1 << (len(keys) - 1 - i) for i, key in enumerate(keys) if key not in of)
        name = name.when(F.grouping_id(*keys) == without, table)
    return (
        enriched.groupingSets([[F.col(key) for key in of] for of in TOTAL_KEYS.values()], *keys)
        .agg(
            name.alias("table_name"),
            F.sum("order_quantity").alias("total_quantity_sold"),
            F.sum("total_amount").alias("total_revenue"),
        )
        .select("table_name", *keys, "total_quantity_sold", "total_revenue")
    )


def total_of(totals: DataFrame, table: str) -> DataFrame:
    """One of the three tables from the rows of all of them."""
    rows = totals.where(F.col("table_name") == table)
    measures = {
        "customers_revenue": [F.col("total_revenue")],
        "products_sales": [F.col("total_quantity_sold"), F.col("total_revenue")],
        "category_revenue": [F.col("total_revenue").alias("category_revenue")],
    }
    return rows.select(*TOTAL_KEYS[table], *measures[table])
