"""Shape the star-schema Parquet tables into the four raw tables.

``run_dates`` lists the runs: every run carries all customers and products, while order lines
are spread over the runs by order number. A payment is made from an order line.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.functions.keys import days_after, display_name, line_key, order_id, padded_id, pick

# Fixed values.
PAYMENT_METHODS = ["Credit Card", "PayPal", "Bank Transfer"]
SIGNUP_START = "1995-01-01"
SIGNUP_DAYS = 730
PAYMENT_DAYS = 3


def star_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _customers_with_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = star_table(spark, sf_dir, "nation")
    return star_table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")


def _orders_of(spark: SparkSession, sf_dir: str, headers: DataFrame, run_dates: Sequence[str]) -> DataFrame:
    """Every line once, with NULLs where its header is unknown."""
    run_date = pick(run_dates, F.col("l_orderkey"))
    country = F.col("n_name") if "n_name" in headers.columns else F.lit(None).cast("string")
    return (
        star_table(spark, sf_dir, "lineitem")
        .join(headers, F.col("l_orderkey") == F.col("o_orderkey"), "left")
        .withColumn("run_date", run_date)
        .select(
            order_id(F.col("run_date"), F.col("l_orderkey"), F.col("l_linenumber")).alias("order_id"),
            F.col("o_orderdate").cast("date").alias("order_date"),
            padded_id("C", F.col("o_custkey")).alias("customer_id"),
            padded_id("P", F.col("l_partkey")).alias("product_id"),
            F.col("l_quantity").cast("bigint").alias("quantity"),
            F.col("l_extendedprice").alias("price"),
            country.alias("country"),
            "run_date",
        )
    )


def _every_run(run_dates: Sequence[str]):
    return F.explode(F.array(*map(F.lit, run_dates))).alias("run_date")


def raw_customers(spark: SparkSession, sf_dir: str, run_dates: Sequence[str]) -> DataFrame:
    return _customers_with_country(spark, sf_dir).select(
        padded_id("C", F.col("c_custkey")).alias("customer_id"),
        F.col("c_name").alias("name"),
        F.concat(F.replace(F.lower("c_name"), F.lit("#"), F.lit(".")), F.lit("@example.com")).alias("email"),
        F.col("n_name").alias("country"),
        days_after(F.lit(SIGNUP_START).cast("date"), F.col("c_custkey"), SIGNUP_DAYS).alias("signup_date"),
        _every_run(run_dates),
    )


def raw_products(spark: SparkSession, sf_dir: str, run_dates: Sequence[str]) -> DataFrame:
    """The category is the type of the part."""
    category = F.col("p_type")
    return star_table(spark, sf_dir, "part").select(
        padded_id("P", F.col("p_partkey")).alias("product_id"),
        category.alias("category"),
        display_name(category, F.col("p_partkey")).alias("name"),
        F.round(F.col("p_retailprice") / 2, 2).alias("cost"),
        F.round("p_retailprice", 2).alias("price"),
        _every_run(run_dates),
    )


def raw_orders(spark: SparkSession, sf_dir: str, run_dates: Sequence[str]) -> DataFrame:
    # Headers meet customers first, so that the far larger line table is shuffled once only.
    headers = star_table(spark, sf_dir, "orders").join(
        _customers_with_country(spark, sf_dir), F.col("o_custkey") == F.col("c_custkey"), "left"
    )
    return _orders_of(spark, sf_dir, headers, run_dates)


def payments_of(orders: DataFrame) -> DataFrame:
    """One payment per raw order, from its columns alone; no other table is joined."""
    number, line = line_key(F.col("order_id"))
    return orders.select(
        F.concat(F.lit("PAY"), F.substring("order_id", 10, 1000)).alias("payment_id"),
        "order_id",
        pick(PAYMENT_METHODS, number + line).alias("payment_method"),
        days_after(F.col("order_date"), line, PAYMENT_DAYS).alias("payment_date"),
        F.round(F.col("quantity") * F.col("price"), 2).alias("amount"),
        "run_date",
    )


def raw_payments(spark: SparkSession, sf_dir: str, run_dates: Sequence[str]) -> DataFrame:
    return payments_of(_orders_of(spark, sf_dir, star_table(spark, sf_dir, "orders"), run_dates))


RAW_BUILDERS = {
    "customers": raw_customers,
    "products": raw_products,
    "orders": raw_orders,
    "payments": raw_payments,
}


def raw_tables(spark: SparkSession, sf_dir: str, run_dates: Sequence[str]) -> dict:
    """What ``ingest_raw`` takes: payments are made from the orders once these are stored."""
    built = {t: RAW_BUILDERS[t](spark, sf_dir, run_dates) for t in ("customers", "products", "orders")}
    return built | {"payments": lambda stored: payments_of(stored("orders"))}
