"""The registered queries: each takes (spark, sf_dir) and returns a DataFrame.

All run over two run dates of the whole input. Queries on written raw, processed or warehouse
tables share them per session and input folder: each layer is written when a query first needs it.
Money is cast to double at the very end, for comparison with engines whose decimal sums have
another width.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.functions.money import safe_double
from ordermill.operators import aggregates, clean
from ordermill.operators.enrich import enrich_orders
from ordermill.plans.daily_run import (
    Places,
    ingest_raw,
    load_warehouse,
    prepare_runs,
    process_runs,
    run_daily,
)
from ordermill.plans.ledger import Ledger
from ordermill.plans.scratch import scratch_dir
from ordermill.quality import checks, reports, state
from ordermill.quality.suite import check_suite
from ordermill.schemas import PROCESSED, RAW, REQUIRED, WAREHOUSE
from ordermill.session import bound_tasks, size_shuffles
from ordermill.sinks.files import WRITTEN
from ordermill.sinks.partitions import run_counts, write_runs
from ordermill.sinks.warehouse import ensure_database, load_table
from ordermill.sources.runs import read_runs
from ordermill.sources.star import RAW_BUILDERS, raw_tables, star_table

RUN_DATES = ["2025-12-01", "2025-12-02"]
REVENUE = {
    "orders_enriched": "total_amount",
    "customers_revenue": "total_revenue",
    "products_sales": "total_revenue",
    "category_revenue": "category_revenue",
    "payments_summary": "total_amount",
}


# --- shared inputs -------------------------------------------------------------------------


@dataclass
class Staged:
    """The steps of one daily run over both dates, each taken when its tables are asked for."""

    spark: SparkSession
    sf_dir: str
    places: Places
    steps_done: int = 0

    def _up_to(self, step: int) -> None:
        spark, places = self.spark, self.places
        steps = [
            lambda: ingest_raw(spark, raw_tables(spark, self.sf_dir, RUN_DATES), places.raw, RUN_DATES),
            lambda: process_runs(spark, places.raw, places.processed, RUN_DATES),
            lambda: load_warehouse(
                spark, places.processed, places.database, RUN_DATES, location=places.database_location
            ),
        ]
        while self.steps_done < step:
            steps[self.steps_done]()
            self.steps_done += 1

    def raw(self, table: str) -> DataFrame:
        self._up_to(1)
        return self._sized(read_runs(self.spark, self.places.raw, table, RUN_DATES, RAW[table]))

    def processed(self, table: str) -> DataFrame:
        self._up_to(2)
        return self._sized(read_runs(self.spark, self.places.processed, table, RUN_DATES, PROCESSED[table]))

    def warehouse(self, table: str) -> DataFrame:
        self._up_to(3)
        bound_tasks(self.spark)  # The size of a table is not in the catalog.
        return self.spark.table(f"{self.places.database}.{table}")

    def _sized(self, df: DataFrame) -> DataFrame:
        """The settings that bound a task may be gone again since the step that wrote the files."""
        size_shuffles(self.spark, df)
        return df


_staged: dict[tuple[str, str], Staged] = {}


def staged(spark: SparkSession, sf_dir: str) -> Staged:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _staged:
        _staged[key] = Staged(spark, sf_dir, new_places(spark, "daily"))
    return _staged[key]


def use_staged(spark: SparkSession, sf_dir: str, places: Places) -> None:
    """Let the queries use a daily run that is already there."""
    _staged[(spark.sparkContext.applicationId, sf_dir)] = Staged(spark, sf_dir, places, steps_done=3)


def new_places(spark: SparkSession, label: str) -> Places:
    root = scratch_dir(spark, label)
    return Places(f"{root}/raw", f"{root}/processed", f"ordermill_{uuid.uuid4().hex}", f"{root}/warehouse")


def _raw(table: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark, sf_dir):
        df = RAW_BUILDERS[table](spark, sf_dir, RUN_DATES)
        size_shuffles(spark, df)
        return df

    return query


def _as_double(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({column: F.col(column).cast("double") for column in columns})


# --- sources and raw tables ----------------------------------------------------------------


def raw_run_scan(spark, sf_dir):
    """The second of two written runs of the orders, read back alone."""
    run = staged(spark, sf_dir)
    run.raw("orders")
    return read_runs(spark, run.places.raw, "orders", RUN_DATES[1:], RAW["orders"])


def ingest(spark, sf_dir):
    """All raw tables of both runs written; rows stored per table and run."""
    raw = f"{scratch_dir(spark, 'ingest')}/raw"
    return ingest_raw(spark, raw_tables(spark, sf_dir, RUN_DATES), raw, RUN_DATES)


def safe_cast_numeric(spark, sf_dir):
    """Order priorities and their first character as numbers, NULL where they are none."""
    priority = F.col("o_orderpriority")
    return star_table(spark, sf_dir, "orders").select(
        "o_orderkey",
        safe_double(priority).alias("priority_number"),
        safe_double(F.substring(priority, 1, 1)).alias("first_character"),
    )


# --- clean, enrich, aggregate --------------------------------------------------------------


def orders_clean(spark, sf_dir):
    return clean.clean_orders(staged(spark, sf_dir).raw("orders"))


def customers_clean(spark, sf_dir):
    return clean.clean_customers(staged(spark, sf_dir).raw("customers"))


def products_clean(spark, sf_dir):
    return clean.clean_products(staged(spark, sf_dir).raw("products"))


def _enrich(orders: DataFrame, run: Staged) -> DataFrame:
    return enrich_orders(orders, clean.clean_customers(run.raw("customers")), clean.clean_products(run.raw("products")))


def orders_enriched(spark, sf_dir):
    run = staged(spark, sf_dir)
    return _as_double(_enrich(clean.clean_orders(run.raw("orders")), run), "total_amount")


def enriched_preview(spark, sf_dir):
    return _as_double(
        aggregates.enriched_preview(staged(spark, sf_dir).processed("orders_enriched")), "total_amount"
    )


def customers_revenue(spark, sf_dir):
    enriched = staged(spark, sf_dir).processed("orders_enriched")
    return _as_double(aggregates.customers_revenue(enriched), "total_revenue")


def products_sales(spark, sf_dir):
    enriched = staged(spark, sf_dir).processed("orders_enriched")
    return _as_double(aggregates.products_sales(enriched), "total_revenue")


def category_revenue(spark, sf_dir):
    enriched = staged(spark, sf_dir).processed("orders_enriched")
    return _as_double(aggregates.category_revenue(enriched), "category_revenue")


def totals_in_one_pass(spark, sf_dir):
    """The rows of all three totals from one scan of the enriched table."""
    enriched = staged(spark, sf_dir).processed("orders_enriched")
    return _as_double(aggregates.totals_in_one_pass(enriched), "total_revenue")


def payments_summary(spark, sf_dir):
    return aggregates.payments_summary(staged(spark, sf_dir).raw("payments"))


# --- sinks and warehouse -------------------------------------------------------------------


def _per_run(frames: dict[str, DataFrame]) -> DataFrame:
    """Rows and revenue per table and run."""
    totals = [
        df.groupBy("run_date")
        .agg(F.count("*").alias("row_count"), F.sum(REVENUE[table]).alias("revenue"))
        .select(
            F.lit(table).alias("table_name"),
            "run_date",
            "row_count",
            F.round(F.col("revenue").cast("double"), 2).alias("revenue"),
        )
        for table, df in frames.items()
    ]
    combined = totals[0]
    for df in totals[1:]:
        combined = combined.unionAll(df)
    return combined


def processed_roundtrip(spark, sf_dir):
    """The five processed tables as written by run and read back."""
    run = staged(spark, sf_dir)
    return _per_run({table: run.processed(table) for table in PROCESSED})


def two_date_run(spark, sf_dir):
    """The whole daily run over both dates, checks included: what the warehouse tables then hold."""
    places = new_places(spark, "two-dates")
    run_daily(spark, raw_tables(spark, sf_dir, RUN_DATES), places, RUN_DATES)
    return _per_run({table: spark.table(f"{places.database}.{table}") for table in PROCESSED})


def rerun_with_empty_table(spark, sf_dir):
    """Both dates run, then the first one again without orders and payments: rows per raw table, and totals."""
    places = new_places(spark, "rerun")
    prepare_runs(spark, raw_tables(spark, sf_dir, RUN_DATES), places, RUN_DATES)
    again = {table: build(spark, sf_dir, RUN_DATES[:1]) for table, build in RAW_BUILDERS.items()}
    again |= {table: again[table].limit(0) for table in ("orders", "payments")}
    prepare_runs(spark, again, places, RUN_DATES[:1])
    raw = run_counts({table: read_runs(spark, places.raw, table, RUN_DATES, RAW[table]) for table in RAW})
    kept = raw.select("table_name", "run_date", "row_count", F.lit(None).cast("double").alias("revenue"))
    return kept.unionAll(_per_run({table: spark.table(f"{places.database}.{table}") for table in PROCESSED}))


def resumed_run(spark, sf_dir):
    """A run of both dates that fails while it loads, goes on, and is asked for again with nothing to do.

    Per run date and step: how often it was started, and the rows that are there now.
    """
    places = new_places(spark, "resumed")
    tables = raw_tables(spark, sf_dir, RUN_DATES)

    def fail(step, run_dates):
        if step == "load products_sales":
            raise ConnectionError("made to fail")

    try:
        prepare_runs(spark, tables, places, RUN_DATES, before_step=fail)
    except ConnectionError:
        pass
    for _ in range(2):
        prepare_runs(spark, tables, places, RUN_DATES, resume=True)
    raw = run_counts({table: read_runs(spark, places.raw, table, RUN_DATES, RAW[table]) for table in RAW})
    processed = run_counts({table: read_runs(spark, places.processed, table, RUN_DATES) for table in PROCESSED})
    loaded = run_counts({table: spark.table(f"{places.database}.{table}") for table in PROCESSED})
    rows = raw.withColumn("step", F.lit("ingest")).unionAll(processed.withColumn("step", F.lit("process")))
    rows = rows.unionAll(loaded.withColumn("step", F.concat(F.lit("load "), "table_name")))
    per_step = rows.groupBy("run_date", "step").agg(F.sum("row_count").alias("row_count"))
    noted = Ledger(spark, places.ledger).frame(RUN_DATES).select("run_date", "step", "state", "attempts")
    return noted.join(per_step, ["run_date", "step"], "left")


def warehouse_widened(spark, sf_dir):
    """Product sales of the first run with narrower types, then of the second with their own: totals kept."""
    sales = staged(spark, sf_dir).processed("products_sales")
    places = new_places(spark, "widened")
    ensure_database(spark, places.database, places.database_location)
    narrow = {"total_quantity_sold": "int", "total_revenue": "decimal(16,2)"}
    first = sales.where(F.col("run_date") == RUN_DATES[0])
    first = first.withColumns({column: F.col(column).cast(kind) for column, kind in narrow.items()})
    load_table(first, places.database, "products_sales", RUN_DATES[:1])
    second = sales.where(F.col("run_date") == RUN_DATES[1])
    load_table(second, places.database, "products_sales", RUN_DATES[1:], widen=True)
    table = spark.table(f"{places.database}.products_sales")
    kinds = {column: table.schema[column].dataType.simpleString() for column in narrow}
    return table.groupBy("run_date").agg(
        F.count("*").alias("row_count"),
        F.sum("total_quantity_sold").alias("total_quantity_sold"),
        F.sum("total_revenue").cast("double").alias("total_revenue"),
        *[F.lit(kind).alias(f"{column}_type") for column, kind in kinds.items()],
    )


def _loaded_twice(spark, sf_dir, mode: str, second: list[str]) -> DataFrame:
    run = staged(spark, sf_dir)
    run.processed("orders_enriched")
    places = new_places(spark, mode)
    load_warehouse(spark, run.places.processed, places.database, RUN_DATES, mode, places.database_location)
    load_warehouse(spark, run.places.processed, places.database, second, mode)
    return _per_run({table: spark.table(f"{places.database}.{table}") for table in PROCESSED})


def warehouse_append(spark, sf_dir):
    """Both runs appended twice: every row is there twice."""
    return _loaded_twice(spark, sf_dir, "append", RUN_DATES)


def warehouse_truncate(spark, sf_dir):
    """Both runs loaded, then the table replaced by the second run."""
    return _loaded_twice(spark, sf_dir, "truncate", RUN_DATES[1:])


def warehouse_reload_idempotent(spark, sf_dir):
    """Both runs loaded, the first one again: nothing is there twice."""
    return _loaded_twice(spark, sf_dir, "reload", RUN_DATES[:1])


def category_revenue_clean(spark, sf_dir):
    return staged(spark, sf_dir).warehouse("category_revenue_clean")


# --- data quality --------------------------------------------------------------------------


def _loaded(spark, sf_dir, *tables: str) -> list[DataFrame]:
    run = staged(spark, sf_dir)
    return [run.warehouse(table) for table in tables]


def dq_orders_quantities(spark, sf_dir):
    return checks.orders_quantities(*_loaded(spark, sf_dir, "orders_enriched"))


def dq_entities_exist(spark, sf_dir):
    return checks.entities_exist(*_loaded(spark, sf_dir, "orders_enriched"))


def dq_product_name_consistency(spark, sf_dir):
    return checks.product_name_conflicts(*_loaded(spark, sf_dir, "orders_enriched"))


def dq_missing_keys(spark, sf_dir):
    return checks.missing_keys(*_loaded(spark, sf_dir, "orders_enriched"))


def dq_duplicate_orders(spark, sf_dir):
    return checks.duplicate_orders(*_loaded(spark, sf_dir, "orders_enriched"))


def dq_duplicate_orders_raw(spark, sf_dir):
    """The same check on the raw orders, where ids do repeat."""
    return checks.duplicate_orders(staged(spark, sf_dir).raw("orders"))


def dq_product_names_by_country(spark, sf_dir):
    """The same check where it does find something: countries taken as names."""
    orders = staged(spark, sf_dir).raw("orders")
    return checks.product_name_conflicts(orders.withColumn("product_name", F.col("country")))


def dq_global_revenue(spark, sf_dir):
    totals = checks.global_revenue(*_loaded(spark, sf_dir, "orders_enriched", "customers_revenue", "products_sales"))
    return _as_double(totals, "orders_total", "customers_total", "products_total")


def dq_customer_recon(spark, sf_dir):
    sums = checks.customer_recon(*_loaded(spark, sf_dir, "orders_enriched", "customers_revenue"))
    return _as_double(sums, "recomputed", "stored")


def dq_product_recon(spark, sf_dir):
    sums = checks.product_recon(*_loaded(spark, sf_dir, "orders_enriched", "products_sales"))
    return _as_double(sums, "recomputed_qty", "stored_qty", "recomputed_rev", "stored_rev")


def dq_suite(spark, sf_dir):
    return check_suite(*_loaded(spark, sf_dir, "orders_enriched", "customers_revenue", "products_sales"))


def dq_suite_merged(spark, sf_dir):
    """The same report over all runs, merged from what is stored per run: the second run is added to the first."""
    run = staged(spark, sf_dir)
    run.processed("orders_enriched")
    places = new_places(spark, "merged")
    for run_date in RUN_DATES:
        load_warehouse(spark, run.places.processed, places.database, [run_date], location=places.database_location)
        state.refresh(spark, places.database)
    return state.check_all_runs(spark, places.database)


def product_name_register(spark, sf_dir):
    """Every name of a product with its first and last run."""
    run = staged(spark, sf_dir)
    run.warehouse("orders_enriched")
    return state.name_register(spark, run.places.database)


def dq_category_recon(spark, sf_dir):
    sums = reports.category_recon(*_loaded(spark, sf_dir, "category_revenue", "products_sales"))
    return _as_double(sums, "recomputed", "stored")


def dq_completeness(spark, sf_dir):
    run = staged(spark, sf_dir)
    return reports.completeness({table: run.warehouse(table) for table in WAREHOUSE}, REQUIRED)


def dq_type_format(spark, sf_dir):
    run = staged(spark, sf_dir)
    return reports.type_format({table: run.warehouse(table) for table in WAREHOUSE}, WAREHOUSE)


def dq_raw_schema(spark, sf_dir):
    """The raw files as they are, against the contract."""
    run = staged(spark, sf_dir)
    run.raw("orders")
    files = {table: read_runs(spark, run.places.raw, table, RUN_DATES) for table in RAW}
    return reports.type_format(files, {table: _without_run_date(contract) for table, contract in RAW.items()})


def dq_raw_schema_differs(spark, sf_dir):
    """The same report on order files without a country and with quantities as text."""
    root = scratch_dir(spark, "differs")
    orders = staged(spark, sf_dir).raw("orders").drop("country")
    write_runs(orders.withColumn("quantity", F.col("quantity").cast("string")), root, "orders", RUN_DATES)
    files = {"orders": read_runs(spark, root, "orders", RUN_DATES)}
    return reports.type_format(files, {"orders": _without_run_date(RAW["orders"])})


def _without_run_date(contract: dict[str, str]) -> dict[str, str]:
    """The run date is a folder name, not a column of the files."""
    return {name: kind for name, kind in contract.items() if name != "run_date"}


def dq_join_quality(spark, sf_dir):
    run = staged(spark, sf_dir)
    return reports.join_quality(run.raw("orders"), run.raw("customers"), run.raw("products"))


def dq_anomaly_report(spark, sf_dir):
    """Totals computed before the dedup, against the enriched table: every copy is an anomaly."""
    run = staged(spark, sf_dir)
    copies = _enrich(run.raw("orders").withColumnsRenamed(clean.ORDER_NAMES), run)
    # Written once for the comparisons: the compared columns only, summed by all keys at once.
    by_all = copies.groupBy("customer_id", "product_id", "category", "run_date").agg(
        F.sum("order_quantity").alias("total_quantity_sold"), F.sum("total_amount").alias("total_revenue")
    )
    root = scratch_dir(spark, "copies")
    by_all.write.options(**WRITTEN).parquet(root)
    by_all = spark.read.parquet(root)
    found = reports.anomaly_report(
        run.warehouse("orders_enriched"), by_all, by_all, by_all.withColumnRenamed("total_revenue", "category_revenue")
    )
    return _as_double(found, "recomputed", "stored", "difference")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "raw_customers": _raw("customers"),
    "raw_products": _raw("products"),
    "raw_orders": _raw("orders"),
    "raw_payments": _raw("payments"),
    "raw_run_scan": raw_run_scan,
    "ingest_raw": ingest,
    "safe_cast_numeric": safe_cast_numeric,
    "orders_clean": orders_clean,
    "customers_clean": customers_clean,
    "products_clean": products_clean,
    "orders_enriched": orders_enriched,
    "enriched_preview": enriched_preview,
    "customers_revenue": customers_revenue,
    "products_sales": products_sales,
    "category_revenue": category_revenue,
    "totals_in_one_pass": totals_in_one_pass,
    "payments_summary": payments_summary,
    "processed_roundtrip": processed_roundtrip,
    "two_date_run": two_date_run,
    "rerun_with_empty_table": rerun_with_empty_table,
    "resumed_run": resumed_run,
    "warehouse_append": warehouse_append,
    "warehouse_truncate": warehouse_truncate,
    "warehouse_reload_idempotent": warehouse_reload_idempotent,
    "warehouse_widened": warehouse_widened,
    "category_revenue_clean": category_revenue_clean,
    "dq_orders_quantities": dq_orders_quantities,
    "dq_entities_exist": dq_entities_exist,
    "dq_product_name_consistency": dq_product_name_consistency,
    "dq_product_names_by_country": dq_product_names_by_country,
    "dq_missing_keys": dq_missing_keys,
    "dq_duplicate_orders": dq_duplicate_orders,
    "dq_duplicate_orders_raw": dq_duplicate_orders_raw,
    "dq_global_revenue": dq_global_revenue,
    "dq_customer_recon": dq_customer_recon,
    "dq_product_recon": dq_product_recon,
    "dq_suite": dq_suite,
    "dq_suite_merged": dq_suite_merged,
    "product_name_register": product_name_register,
    "dq_category_recon": dq_category_recon,
    "dq_completeness": dq_completeness,
    "dq_type_format": dq_type_format,
    "dq_raw_schema": dq_raw_schema,
    "dq_raw_schema_differs": dq_raw_schema_differs,
    "dq_join_quality": dq_join_quality,
    "dq_anomaly_report": dq_anomaly_report,
}
