"""The eight checks of a loaded run, one DataFrame each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.functions.money import within_tolerance


def orders_quantities(enriched: DataFrame) -> DataFrame:
    """There are no more orders than units sold."""
    return enriched.agg(
        F.count_distinct("order_id").alias("n_orders"), F.sum("order_quantity").alias("total_quantity")
    ).withColumn("passed", _holds(F.col("n_orders") <= F.col("total_quantity")))


def entities_exist(enriched: DataFrame) -> DataFrame:
    """There is at least one customer and one product."""
    return enriched.agg(
        F.count_distinct("customer_id").alias("n_customers"), F.count_distinct("product_id").alias("n_products")
    ).withColumn("passed", (F.col("n_customers") > 0) & (F.col("n_products") > 0))


def product_name_conflicts(enriched: DataFrame) -> DataFrame:
    """The products with more than one name; none when the check passes."""
    return (
        enriched.groupBy("product_id").agg(F.count_distinct("product_name").alias("cnt")).where(F.col("cnt") > 1)
    )


def missing_keys(enriched: DataFrame) -> DataFrame:
    """No order lacks its customer or product id."""
    return (
        enriched.where(missing_key())
        .agg(F.count("*").alias("missing"))
        .withColumn("passed", F.col("missing") == 0)
    )


def duplicate_orders(enriched: DataFrame) -> DataFrame:
    """The order ids on more than one row; none when the check passes."""
    return enriched.groupBy("order_id").agg(F.count("*").alias("cnt")).where(F.col("cnt") > 1)


def global_revenue(enriched: DataFrame, customers_revenue: DataFrame, products_sales: DataFrame) -> DataFrame:
    """Order, customer and product totals agree."""
    totals = enriched.sparkSession.sql(
        """
        SELECT (SELECT sum(total_amount) FROM {orders}) AS orders_total,
               (SELECT sum(total_revenue) FROM {customers}) AS customers_total,
               (SELECT sum(total_revenue) FROM {products}) AS products_total
        """,
        orders=enriched,
        customers=customers_revenue,
        products=products_sales,
    )
    return totals.withColumn(
        "passed",
        within_tolerance(F.col("orders_total"), F.col("customers_total"))
        & within_tolerance(F.col("orders_total"), F.col("products_total")),
    )


def customer_recon(enriched: DataFrame, customers_revenue: DataFrame) -> DataFrame:
    """Revenue recomputed per customer and run equals the stored revenue."""
    keys = ["customer_id", "run_date"]
    recalculated = enriched.groupBy(*keys).agg(F.sum("total_amount").alias("true_revenue"))
    pairs = recalculated.join(_stored(customers_revenue, keys, ["total_revenue"]), keys)
    return pairs.agg(
        F.sum(paired("true_revenue")).alias("recomputed"), F.sum("total_revenue").alias("stored")
    ).withColumn("passed", within_tolerance(F.col("recomputed"), F.col("stored")))


def product_recon(enriched: DataFrame, products_sales: DataFrame) -> DataFrame:
    """Quantity and revenue recomputed per product and run equal the stored ones."""
    keys = ["product_id", "run_date"]
    recalculated = enriched.groupBy(*keys).agg(
        F.sum("order_quantity").alias("true_quantity"), F.sum("total_amount").alias("true_revenue")
    )
    pairs = recalculated.join(_stored(products_sales, keys, ["total_quantity_sold", "total_revenue"]), keys)
    return pairs.agg(
        F.sum(paired("true_quantity")).alias("recomputed_qty"),
        F.sum("total_quantity_sold").alias("stored_qty"),
        F.sum(paired("true_revenue")).alias("recomputed_rev"),
        F.sum("total_revenue").alias("stored_rev"),
    ).withColumn(
        "passed",
        within_tolerance(F.col("recomputed_qty"), F.col("stored_qty"))
        & within_tolerance(F.col("recomputed_rev"), F.col("stored_rev")),
    )


def missing_key() -> Column:
    return F.col("customer_id").isNull() | F.col("product_id").isNull()


def paired(recomputed: str) -> Column:
    """A recomputed value once per stored row it joins to."""
    return F.col(recomputed) * F.col("stored_rows")


def _stored(table: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """Stored measures summed per key with the number of rows.

    Joining these gives the sums of the row-by-row join, but a key stored many times stays one row.
    """
    return table.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures], F.count("*").alias("stored_rows"))


def _holds(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))
