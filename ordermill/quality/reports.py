"""Further reports: completeness, types and formats, join quality, reconciliation, anomalies."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.functions.money import COMPARABLE, within_tolerance

DATE_PATTERN = "^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
NO_ROWS = "CAST(0 AS bigint)"


def completeness(frames: dict[str, DataFrame], required: dict[str, list[str]]) -> DataFrame:
    """Per required column: whether it is there, rows of the table, and rows where it is filled.

    Passes when the table has rows and the column is filled on all of them.
    """

    def cells(df: DataFrame, column: str) -> tuple[str, ...]:
        present = column in df.columns
        return f"'{column}'", str(present).lower(), f"count(`{column}`)" if present else NO_ROWS

    reports = [
        _per_column(table, df, [cells(df, column) for column in required[table]], "column_name, present, filled")
        for table, df in frames.items()
    ]
    return reduce(DataFrame.unionAll, reports).withColumn(
        "passed", F.expr("present AND total_rows > 0 AND filled = total_rows")
    )


def type_format(frames: dict[str, DataFrame], contracts: dict[str, dict[str, str]]) -> DataFrame:
    """Per contract column: expected and actual type, and the malformed values.

    Malformed are run dates that are no ``yyyy-MM-dd`` date and doubles that are no finite number.
    """

    def cells(actual: dict[str, str], column: str, kind: str) -> tuple[str, ...]:
        found = actual.get(column)
        found_cell = f"'{found}'" if found else "CAST(NULL AS string)"
        return f"'{column}'", f"'{kind}'", found_cell, _malformed(column, found)

    reports = [
        _per_column(
            table,
            df,
            [cells(dict(df.dtypes), column, kind) for column, kind in contracts[table].items()],
            "column_name, expected_type, actual_type, malformed",
        )
        for table, df in frames.items()
    ]
    return reduce(DataFrame.unionAll, reports).withColumn(
        "passed", F.expr("coalesce(expected_type = actual_type, false) AND malformed = 0")
    )


def join_quality(orders: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Orders without a customer, and without a product, of their run.

    Orders are counted per key before the anti join, so hot and NULL keys stay small.
    """

    def unmatched(dimension: str, key: str, other: DataFrame) -> DataFrame:
        keys = [key, "run_date"]
        counts = orders.groupBy(*keys).count()
        return (
            counts.join(other.select(*keys).distinct(), keys, "left_anti")
            .agg(F.coalesce(F.sum("count"), F.lit(0)).alias("unmatched"))
            .select(F.lit(dimension).alias("dimension"), "unmatched", (F.col("unmatched") == 0).alias("passed"))
        )

    return unmatched("customers", "customer_id", customers).unionAll(unmatched("products", "product_id", products))


def reconcile(
    detail: DataFrame, stored: DataFrame, keys: list[str], measures: list[tuple[str, str]]
) -> DataFrame:
    """Sums of both sides per key and (detail column, stored column) pair, and whether they agree.

    Gives ``keys, measure, recomputed, stored, passed``. A union and one aggregate in place of a
    full join: NULL keys meet, a key missing on one side shows, and both sides are summed before
    the shuffle.
    """
    kinds = [(detail.schema[left].dataType, stored.schema[right].dataType) for left, right in measures]

    def side(df: DataFrame, in_detail: bool) -> DataFrame:
        columns = []
        for i, ((left, right), (left_kind, right_kind)) in enumerate(zip(measures, kinds)):
            recomputed = F.col(left) if in_detail else F.lit(None).cast(left_kind)
            kept = F.lit(None).cast(right_kind) if in_detail else F.col(right)
            columns += [recomputed.alias(f"recomputed_{i}"), kept.alias(f"stored_{i}")]
        return df.select(*keys, F.lit(in_detail).alias("in_detail"), *columns)

    sides = side(detail, True).unionAll(side(stored, False))
    sums = [name for name in sides.columns if name not in [*keys, "in_detail"]]
    per_key = sides.groupBy(*keys).agg(
        *[F.sum(name).alias(name) for name in sums],
        (F.bool_or("in_detail") & F.bool_or(~F.col("in_detail"))).alias("in_both"),
    )
    rows = [
        F.struct(
            F.lit(stored_column).alias("measure"),
            F.col(f"recomputed_{i}").cast(COMPARABLE).alias("recomputed"),
            F.col(f"stored_{i}").cast(COMPARABLE).alias("stored"),
        )
        for i, (_, stored_column) in enumerate(measures)
    ]
    recomputed, kept = F.col("recomputed"), F.col("stored")
    return (
        per_key.select(*keys, "in_both", F.inline(F.array(*rows)))
        .withColumn(
            "passed",
            F.col("in_both") & (within_tolerance(recomputed, kept) | (recomputed.isNull() & kept.isNull())),
        )
        .drop("in_both")
    )


def category_recon(category_revenue: DataFrame, products_sales: DataFrame) -> DataFrame:
    """Category revenue against the product sales of the category, per run."""
    measures = [("total_revenue", "category_revenue")]
    return reconcile(products_sales, category_revenue, ["category", "run_date"], measures).drop("measure")


def anomaly_report(
    enriched: DataFrame, customers_revenue: DataFrame, products_sales: DataFrame, category_revenue: DataFrame
) -> DataFrame:
    """Every stored total that differs from the one recomputed from the enriched table."""
    revenue = ("total_amount", "total_revenue")
    compared = [
        ("customers_revenue", customers_revenue, "customer_id", [revenue]),
        ("products_sales", products_sales, "product_id", [("order_quantity", "total_quantity_sold"), revenue]),
        ("category_revenue", category_revenue, "category", [("total_amount", "category_revenue")]),
    ]
    found = [
        reconcile(enriched, stored, [key, "run_date"], measures)
        .where(~F.col("passed"))
        .select(
            F.lit(table).alias("table_name"),
            "measure",
            F.col(key).alias("key"),
            "run_date",
            "recomputed",
            "stored",
            (F.col("stored") - F.col("recomputed")).cast(COMPARABLE).alias("difference"),
        )
        for table, stored, key, measures in compared
    ]
    return reduce(DataFrame.unionAll, found)


def _malformed(column: str, kind: str | None) -> str:
    if kind is not None and column == "run_date":
        well_formed = f"CAST({column} AS string) RLIKE '{DATE_PATTERN}' AND try_cast({column} AS date) IS NOT NULL"
        return f"count_if({column} IS NOT NULL AND NOT ({well_formed}))"
    if kind == "double":
        return f"count_if(isnan(`{column}`) OR abs(`{column}`) = double('infinity'))"
    return NO_ROWS


def _per_column(table: str, df: DataFrame, rows: list[tuple[str, ...]], names: str) -> DataFrame:
    """One aggregate over the table, as one row per reported column.

    Each of ``rows`` holds SQL cells: constants, and an aggregate as the last one.
    """
    values = [f"{row[-1]} AS value_{index}" for index, row in enumerate(rows)]
    cells = ", ".join(", ".join([*row[:-1], f"value_{index}"]) for index, row in enumerate(rows))
    return df.selectExpr("count(*) AS total_rows", *values).selectExpr(
        f"'{table}' AS table_name", "total_rows", f"stack({len(rows)}, {cells}) AS ({names})"
    )
