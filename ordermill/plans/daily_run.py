"""The daily run: ingest, process, load and check one or more run dates."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ordermill.operators.aggregates import TOTAL_KEYS, payments_summary, total_of, totals_in_one_pass
from ordermill.operators.clean import clean_customers, clean_orders, clean_products
from ordermill.operators.enrich import enrich_orders
from ordermill.plans.ledger import Ledger, digest, input_fingerprint
from ordermill.plans.scratch import scratch_dir
from ordermill.plans.together import run_together
from ordermill.quality import reports
from ordermill.quality.state import check_all_runs
from ordermill.quality.suite import assert_checks, check_suite
from ordermill.schemas import PROCESSED, RAW, REQUIRED, WAREHOUSE
from ordermill.session import bound_tasks, size_shuffles
from ordermill.sinks.files import WRITTEN, Files
from ordermill.sinks.partitions import run_counts, write_runs
from ordermill.sinks.warehouse import ensure_database, load_table, rebuild_category_revenue_clean
from ordermill.sources.runs import checked_runs, read_runs

logger = logging.getLogger(__name__)

# A raw table, or how it is derived from raw tables already stored, given a reader of these.
RawTable = DataFrame | Callable[[Callable[[str], DataFrame]], DataFrame]


@dataclass(frozen=True)
class Places:
    """Roots on any file system Spark can reach, and the warehouse database."""

    raw: str
    processed: str
    database: str
    database_location: str | None = None

    @property
    def ledger(self) -> str:
        return f"{self.processed}/_ledger"


def landing_tables(spark: SparkSession, landing: str, run_dates: Sequence[str]) -> dict[str, DataFrame]:
    """The landing files; raises, naming the column, if they do not keep to the contract."""
    return {table: checked_runs(spark, landing, table, run_dates, contract) for table, contract in RAW.items()}


def ingest_raw(spark: SparkSession, tables: dict[str, RawTable], raw: str, run_dates: Sequence[str]) -> DataFrame:
    """Write the raw tables by run and return the rows now stored per table and run."""
    given = {table: df for table, df in tables.items() if isinstance(df, DataFrame)}
    size_shuffles(spark, *given.values())
    run_together(spark, [partial(write_runs, df, raw, table, run_dates) for table, df in given.items()])
    stored = partial(_stored_raw, spark, raw, run_dates)
    derived = {table: derive(stored) for table, derive in tables.items() if table not in given}
    if derived:
        run_together(spark, [partial(write_runs, df, raw, table, run_dates) for table, df in derived.items()])
    return run_counts({table: stored(table) for table in tables})


def _stored_raw(spark: SparkSession, raw: str, run_dates: Sequence[str], table: str) -> DataFrame:
    return read_runs(spark, raw, table, run_dates, RAW[table])


def process_runs(spark: SparkSession, raw: str, processed: str, run_dates: Sequence[str]) -> None:
    """Raw to processed tables. The enriched table is written once and read once, for all three totals."""
    orders, customers, products, payments = (
        _stored_raw(spark, raw, run_dates, table) for table in ("orders", "customers", "products", "payments")
    )
    size_shuffles(spark, orders, customers, products, payments)
    single = run_dates[0] if len(run_dates) == 1 else None
    enriched = enrich_orders(clean_orders(orders), clean_customers(customers), clean_products(products), single)
    run_together(
        spark,
        [
            partial(write_runs, enriched, processed, "orders_enriched", run_dates),
            partial(write_runs, payments_summary(payments, single), processed, "payments_summary", run_dates),
        ],
    )
    stored = read_runs(spark, processed, "orders_enriched", run_dates, PROCESSED["orders_enriched"])
    # Written by table, so that each of them reads its own rows only.
    place = scratch_dir(spark, "totals")
    all_totals = totals_in_one_pass(stored)
    all_totals.write.options(**WRITTEN).partitionBy("table_name").parquet(place)
    # Runs without orders leave no file that has the columns.
    totals = spark.read.schema(all_totals.schema).parquet(place)
    run_together(
        spark, [partial(write_runs, total_of(totals, table), processed, table, run_dates) for table in TOTAL_KEYS]
    )
    Files(spark).delete(place)


def load_warehouse(
    spark: SparkSession,
    processed: str,
    database: str,
    run_dates: Sequence[str],
    mode: str = "reload",
    location: str | None = None,
    widen: bool = False,
) -> None:
    """Load the five processed tables, as their files are, and rebuild the cleaned category table."""
    bound_tasks(spark)
    ensure_database(spark, database, location)
    load = partial(_load_processed, spark, processed, database, mode=mode, widen=widen)
    run_together(spark, [partial(load, table, run_dates) for table in PROCESSED])
    rebuild_category_revenue_clean(spark, database)


def _load_processed(
    spark: SparkSession, processed: str, database: str, table: str, run_dates: Sequence[str], mode: str, widen: bool
) -> None:
    load_table(read_runs(spark, processed, table, run_dates), database, table, run_dates, mode, widen=widen)


def loaded_runs(spark: SparkSession, database: str, table: str, run_dates: Sequence[str] | None) -> DataFrame:
    """A warehouse table, or the partitions of some of its runs."""
    df = spark.table(f"{database}.{table}")
    return df if run_dates is None or "run_date" not in df.columns else df.where(F.col("run_date").isin(*run_dates))


def validate_warehouse(spark: SparkSession, database: str, run_dates: Sequence[str] | None = None) -> DataFrame:
    """The report of the eight checks over the loaded tables: over some runs, or over all.

    The names of a product are compared over all runs in any case, from the product sales, which have
    a row per product and run.
    """
    frames = (loaded_runs(spark, database, t, run_dates) for t in ("orders_enriched", "customers_revenue", "products_sales"))
    names = None if run_dates is None else spark.table(f"{database}.products_sales").select("product_id", "product_name")
    return check_suite(*frames, names)


def validation_reports(
    spark: SparkSession, database: str, run_dates: Sequence[str] | None = None
) -> dict[str, DataFrame]:
    """Completeness, types and category totals of the loaded tables."""
    frames = {table: loaded_runs(spark, database, table, run_dates) for table in WAREHOUSE}
    return {
        "completeness": reports.completeness(frames, REQUIRED),
        "type_format": reports.type_format(frames, WAREHOUSE),
        "category_recon": reports.category_recon(frames["category_revenue"], frames["products_sales"]),
    }


def differing_totals(spark: SparkSession, database: str, run_dates: Sequence[str] | None = None) -> DataFrame:
    """Every stored total that differs from the enriched table: what failed checks 6 to 8 are about."""
    tables = ("orders_enriched", "customers_revenue", "products_sales", "category_revenue")
    return reports.anomaly_report(*(loaded_runs(spark, database, table, run_dates) for table in tables))


@dataclass(frozen=True)
class Steps:
    """The steps of a daily run, noted in the ledger; with ``resume`` only what is not done for its input.

    A step that is done again has the steps after it done again, too. ``before`` is called with the name of
    each step and its dates; what it raises counts as a failure of the step.
    """

    ledger: Ledger
    inputs: dict[str, str]
    resume: bool
    before: Callable[[str, Sequence[str]], None] | None
    redone: set[str]

    def run(self, step: str, work: Callable[[Sequence[str]], None], after: str = "") -> None:
        wanted = {run_date: digest(fingerprint, step, after) for run_date, fingerprint in self.inputs.items()}
        if self.resume:
            done = {d for d, f in wanted.items() if d not in self.redone and self.ledger.is_done(d, step, f)}
            wanted = {run_date: fingerprint for run_date, fingerprint in wanted.items() if run_date not in done}
        if not wanted:
            logger.info("%s: nothing to do", step)
            return
        with self.ledger.working(step, wanted):
            if self.before:
                self.before(step, list(wanted))
            work(list(wanted))
        if not step.startswith("load"):
            self.redone.update(wanted)
        logger.info("%s: %s", step, list(wanted))


def _of_runs(tables: dict[str, RawTable], run_dates: Sequence[str]) -> dict[str, RawTable]:
    return {t: df.where(F.col("run_date").isin(*run_dates)) if isinstance(df, DataFrame) else df for t, df in tables.items()}


def prepare_runs(
    spark: SparkSession,
    tables: dict[str, RawTable],
    places: Places,
    run_dates: Sequence[str],
    mode: str = "reload",
    resume: bool = False,
    before_step: Callable[[str, Sequence[str]], None] | None = None,
    widen: bool = False,
) -> Steps:
    """Ingest, process and load; raises on a missing run and is safe to run again.

    Every step is noted in the ledger of ``places``, the load table by table. With ``resume`` a run goes on
    at the step that failed, and a date whose input files are the same as when it was done is left alone.
    """
    inputs = {run_date: input_fingerprint(spark, tables, run_date) for run_date in run_dates}
    steps = Steps(Ledger(spark, places.ledger), inputs, resume, before_step, set())
    whole = set(run_dates)

    def ingest(dates: Sequence[str]) -> None:
        ingest_raw(spark, tables if set(dates) == whole else _of_runs(tables, dates), places.raw, dates)

    steps.run("ingest", ingest)
    steps.run("process", lambda dates: process_runs(spark, places.raw, places.processed, dates))
    ensure_database(spark, places.database, places.database_location)
    load = partial(_load_processed, spark, places.processed, places.database, mode=mode, widen=widen)
    run_together(spark, [partial(steps.run, f"load {table}", partial(load, table), mode) for table in PROCESSED])
    rebuild = lambda _: rebuild_category_revenue_clean(spark, places.database)
    steps.run("load category_revenue_clean", rebuild, mode)
    return steps


def run_daily(
    spark: SparkSession,
    tables: dict[str, RawTable],
    places: Places,
    run_dates: Sequence[str],
    mode: str = "reload",
    verbose: bool = False,
    all_runs: bool = False,
    resume: bool = False,
    before_step: Callable[[str, Sequence[str]], None] | None = None,
    widen: bool = False,
) -> list[Row]:
    """All steps, then the checks and reports over what was loaded; raises if one of them fails.

    Checked are the runs of ``run_dates``, or with ``all_runs`` all that the warehouse has, of which only those
    that have changed since they were last checked are read. The error of
    a failed check has the totals that differ as ``differences``, a DataFrame, and that of a failed report its
    failing rows. Columns that are not filled on every row, or have no rows, are logged: a day without
    payments is no failure. With ``resume`` steps that are done for the same input are left out; the checks
    are always made.
    """
    steps = prepare_runs(spark, tables, places, run_dates, mode, resume, before_step, widen)
    checked = None if all_runs else run_dates
    rows: list[Row] = []

    def check(_: Sequence[str]) -> None:
        try:
            found = check_all_runs(spark, places.database) if all_runs else validate_warehouse(spark, places.database, checked)
            rows.extend(assert_checks(found, verbose))
        except AssertionError as failure:
            failure.differences = differing_totals(spark, places.database, checked)
            raise
        for name, report in validation_reports(spark, places.database, checked).items():
            _raise_failed(name, report.where("NOT coalesce(passed, false)"))

    steps.redone.update(run_dates)
    steps.run("check", check, mode)
    return rows


#: Failing rows of a report that its error message spells out; ``differences`` of the error has all of them.
SPELLED_OUT = 50


def _raise_failed(name: str, failed: DataFrame) -> None:
    first = failed.limit(SPELLED_OUT + 1).collect()
    if not first:
        return
    listed = [row.asDict() for row in first[:SPELLED_OUT]]
    more = f" and {failed.count() - SPELLED_OUT} more" if len(first) > SPELLED_OUT else ""
    for row in listed:
        logger.warning("%s: %s", name, row)
    if more:
        logger.warning("%s:%s", name, more)
    if name != "completeness":
        failure = AssertionError(f"{name} failed: {listed}{more}")
        failure.differences = failed
        raise failure
