"""All eight checks as one report, from three passes over the enriched table.

Run one by one the checks scan the enriched table eight times. Here those that need the same
grouping share it: by order (1, 5), by customer (2, 4, 6, 7) and by product (2, 3, 6, 8).
"""

from __future__ import annotations

import logging
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from ordermill.functions.money import COMPARABLE, TOLERANCE
from ordermill.quality.checks import missing_key, paired

logger = logging.getLogger(__name__)


def _gap(left: str, right: str) -> str:
    return f"abs({left} - {right})"


def _close(left: str, right: str) -> str:
    return f"{_gap(left, right)} <= {TOLERANCE}"


# Name (fixed labels), measured value, bound and condition; a NULL condition is a failure.
CHECKS = [
    ("Orders & quantities", "n_orders", "total_quantity", "n_orders <= total_quantity"),
    ("Customers & products existence", "least(n_customers, n_products)", "1", "n_customers > 0 AND n_products > 0"),
    ("Product name consistency", "name_conflicts", "0", "name_conflicts = 0"),
    ("Missing customers/products", "coalesce(missing, 0)", "0", "coalesce(missing, 0) = 0"),
    ("Duplicate orders", "duplicates", "0", "duplicates = 0"),
    (
        "Global revenue consistency",
        f"greatest({_gap('orders_total', 'customers_total')}, {_gap('orders_total', 'products_total')})",
        str(TOLERANCE),
        f"{_close('orders_total', 'customers_total')} AND {_close('orders_total', 'products_total')}",
    ),
    (
        "Customer aggregation correctness",
        _gap("customer_recomputed", "customer_stored"),
        str(TOLERANCE),
        _close("customer_recomputed", "customer_stored"),
    ),
    (
        "Product aggregation correctness",
        f"greatest({_gap('quantity_recomputed', 'quantity_stored')}, {_gap('revenue_recomputed', 'revenue_stored')})",
        str(TOLERANCE),
        f"{_close('quantity_recomputed', 'quantity_stored')} AND {_close('revenue_recomputed', 'revenue_stored')}",
    ),
]


METRICS = [
    "n_orders", "total_quantity", "duplicates", "n_customers", "missing", "orders_total", "customers_total",
    "customer_recomputed", "customer_stored", "n_products", "name_conflicts", "products_total",
    "quantity_recomputed", "quantity_stored", "revenue_recomputed", "revenue_stored",
]


def check_suite(
    enriched: DataFrame,
    customers_revenue: DataFrame,
    products_sales: DataFrame,
    product_names: DataFrame | None = None,
) -> DataFrame:
    """One row per check: ``check_id, check_name, measured, expected, passed``.

    ``product_names`` (product_id, product_name) are compared in place of those of the orders, where
    the orders are those of some runs only.

    ``expected`` is the bound: at most (1, 3 to 8) or at least (2) that value.
    """
    return report(
        [
            _by_order(enriched),
            _by_customer(enriched, customers_revenue),
            _by_product(enriched, products_sales, product_names is None),
            *([] if product_names is None else [_name_conflicts(product_names)]),
        ]
    )


def report(parts: list[DataFrame]) -> DataFrame:
    """The rows of the report from one-row frames that have all ``METRICS`` between them."""
    rows = ", ".join(
        f"{number}, '{name}', CAST({measured} AS double), CAST({expected} AS double), coalesce({passed}, false)"
        for number, (name, measured, expected, passed) in enumerate(CHECKS, start=1)
    )
    return _gather(parts).selectExpr(f"stack({len(CHECKS)}, {rows}) AS (check_id, check_name, measured, expected, passed)")


def assert_checks(report: DataFrame, verbose: bool = False) -> list[Row]:
    """Run the report, log it, and raise one error that names every failed check."""
    rows = report.orderBy("check_id").collect()
    failed = [row for row in rows if not row.passed]
    for row in rows:
        if not row.passed:
            logger.error("check %s failed: %s", row.check_id, row.asDict())
        elif verbose:
            logger.info("check %s passed: %s", row.check_id, row.asDict())
    if failed:
        names = "; ".join(f"{r.check_id} {r.check_name}: {r.measured} against {r.expected}" for r in failed)
        raise AssertionError(f"{len(failed)} data-quality checks failed: {names}")
    return rows


def _by_order(enriched: DataFrame) -> DataFrame:
    orders = enriched.groupBy("order_id").agg(
        F.count("*").alias("copies"), F.sum("order_quantity").alias("quantity")
    )
    return orders.agg(
        F.count("order_id").alias("n_orders"),
        F.sum("quantity").alias("total_quantity"),
        F.count_if(F.col("copies") > 1).alias("duplicates"),
    )


def _by_customer(enriched: DataFrame, customers_revenue: DataFrame) -> DataFrame:
    keys = ["customer_id", "run_date"]
    groups = side_by_side(
        enriched.select(*keys, "total_amount", missing_key().alias("missing")),
        customers_revenue.select(*keys, "total_revenue"),
    )
    per_run = groups.groupBy(*keys).agg(
        F.sum("total_amount").alias("true_revenue"),
        F.count_if("missing").alias("missing"),
        F.count("in_orders").alias("order_rows"),
        F.sum("total_revenue").alias("total_revenue"),
        F.count("in_stored").alias("stored_rows"),
    )
    both = joined_on_both(*keys)
    return per_run.agg(
        F.count_distinct(F.when(_ordered(), F.col("customer_id"))).alias("n_customers"),
        F.sum("missing").alias("missing"),
        F.sum("true_revenue").alias("orders_total"),
        F.sum("total_revenue").alias("customers_total"),
        F.sum(F.when(both, paired("true_revenue"))).alias("customer_recomputed"),
        F.sum(F.when(both, F.col("total_revenue"))).alias("customer_stored"),
    )


def _name_conflicts(product_names: DataFrame) -> DataFrame:
    per_product = product_names.groupBy("product_id").agg(
        F.min("product_name").alias("low_name"), F.max("product_name").alias("high_name")
    )
    return per_product.agg(F.count_if(F.col("low_name") != F.col("high_name")).alias("name_conflicts"))


def _by_product(enriched: DataFrame, products_sales: DataFrame, with_names: bool) -> DataFrame:
    keys = ["product_id", "run_date"]
    groups = side_by_side(
        enriched.select(*keys, "product_name", "order_quantity", "total_amount"),
        products_sales.select(*keys, "total_quantity_sold", "total_revenue"),
    )
    # By name first: hash aggregates on the large side, and the name comparison sees few rows.
    per_name = groups.groupBy(*keys, "product_name").agg(
        F.sum("order_quantity").alias("true_quantity"),
        F.sum("total_amount").alias("true_revenue"),
        F.count("in_orders").alias("order_rows"),
        F.sum("total_quantity_sold").alias("total_quantity_sold"),
        F.sum("total_revenue").alias("total_revenue"),
        F.count("in_stored").alias("stored_rows"),
    )
    summed = [name for name in per_name.columns if name not in [*keys, "product_name"]]
    per_run = per_name.groupBy(*keys).agg(
        *[F.sum(name).alias(name) for name in summed],
        F.min("product_name").alias("low_name"),
        F.max("product_name").alias("high_name"),
    )
    both = joined_on_both(*keys)
    per_product = per_run.groupBy("product_id").agg(
        F.sum("order_rows").alias("order_rows"),
        F.min("low_name").alias("low_name"),
        F.max("high_name").alias("high_name"),
        F.sum("total_revenue").alias("total_revenue"),
        F.sum(F.when(both, paired("true_quantity"))).alias("true_quantity"),
        F.sum(F.when(both, F.col("total_quantity_sold"))).alias("stored_quantity"),
        F.sum(F.when(both, paired("true_revenue"))).alias("true_revenue"),
        F.sum(F.when(both, F.col("total_revenue"))).alias("stored_revenue"),
    )
    return per_product.agg(
        F.count(F.when(_ordered(), F.col("product_id"))).alias("n_products"),
        *([F.count_if(F.col("low_name") != F.col("high_name")).alias("name_conflicts")] if with_names else []),
        F.sum("total_revenue").alias("products_total"),
        F.sum("true_quantity").alias("quantity_recomputed"),
        F.sum("stored_quantity").alias("quantity_stored"),
        F.sum("true_revenue").alias("revenue_recomputed"),
        F.sum("stored_revenue").alias("revenue_stored"),
    )


def side_by_side(orders: DataFrame, stored: DataFrame) -> DataFrame:
    """Order rows and stored rows in one frame, to be summed by key in one shuffle, without a join."""
    return orders.withColumn("in_orders", F.lit(1)).unionByName(
        stored.withColumn("in_stored", F.lit(1)), allowMissingColumns=True
    )


def _ordered() -> Column:
    return F.col("order_rows") > 0


def joined_on_both(*keys: str) -> Column:
    """Whether an equi-join of the two sides would give this key: on both, and no part NULL."""
    condition = _ordered() & (F.col("stored_rows") > 0)
    return reduce(Column.__and__, [F.col(key).isNotNull() for key in keys], condition)


def _gather(parts: list[DataFrame]) -> DataFrame:
    """One-row frames side by side: as (metric, value) rows, put back into one row."""
    long = [
        part.selectExpr(
            f"stack({len(part.columns)}, "
            + ", ".join(f"'{name}', CAST({name} AS {COMPARABLE})" for name in part.columns)
            + ") AS (metric, value)"
        )
        for part in parts
    ]
    metrics = [name for part in parts for name in part.columns]
    return reduce(DataFrame.unionAll, long).agg(
        *[F.expr(f"max(value) FILTER (WHERE metric = '{name}')").alias(name) for name in metrics]
    )
