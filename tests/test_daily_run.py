import re

import pandas as pd
import pytest
from frames import DAY, NEXT_RUN, RUN

from ordermill.__main__ import main
from ordermill.plans.daily_run import (
    Places,
    _of_runs,
    _raise_failed,
    differing_totals,
    ingest_raw,
    landing_tables,
    load_warehouse,
    process_runs,
    run_daily,
    validate_warehouse,
)
from ordermill.plans.ledger import Ledger
from ordermill.plans.scratch import scratch_dir
from ordermill.quality.state import refresh
from ordermill.schemas import PROCESSED
from ordermill.sinks.warehouse import load_table
from ordermill.sources.runs import SchemaMismatch, read_runs


def land(root, run_date, suffix=""):
    """Landing files as another tool leaves them: one Parquet file per table and run, written by pandas."""
    tables = {
        "customers": {"customer_id": ["C001", "C002"], "name": [f"Ann{suffix}", "Bob"], "email": ["a", "b"],
                      "country": ["FR", "DE"], "signup_date": [DAY, DAY]},
        "products": {"product_id": ["P001", "P002"], "category": ["Books", "Sports"],
                     "name": ["Books Product 01", "Sports Product 02"], "cost": [5.0, 6.0], "price": [10.0, 20.5]},
        "orders": {"order_id": [f"O{run_date.replace('-', '')}{n}" for n in ("001", "002", "003", "001")],
                   "order_date": [DAY] * 4, "run_date": [run_date] * 4, "customer_id": ["C001", "C002", "C001", "C001"],
                   "product_id": ["P001", "P002", "P002", "P001"], "quantity": [2, 1, 3, 2],
                   "price": [10.0, 20.5, 20.5, 10.0], "country": ["FR", "DE", "FR", "FR"]},
        "payments": {"payment_id": ["PAY001", "PAY002"], "order_id": ["x", "y"],
                     "payment_method": ["PayPal", "Credit Card"], "payment_date": [DAY, DAY], "amount": [20.0, 20.5]},
    }
    for table, columns in tables.items():
        folder = root / table / f"run_date={run_date}"
        folder.mkdir(parents=True)
        pd.DataFrame(columns).to_parquet(folder / f"{table}.parquet", index=False)


@pytest.fixture
def places(spark, tmp_path, request):
    name = f"daily_{abs(hash(request.node.name))}"
    yield Places(str(tmp_path / "raw"), str(tmp_path / "processed"), name, str(tmp_path / "db"))
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def test_two_runs_one_after_the_other_and_one_again(spark, tmp_path, places):
    landing = tmp_path / "landing"
    land(landing, RUN)
    land(landing, NEXT_RUN, suffix="a")
    for run_date in (RUN, NEXT_RUN, RUN):
        tables = landing_tables(spark, str(landing), [run_date])
        assert all(row.passed for row in run_daily(spark, tables, places, [run_date]))

    def rows(table):
        return sorted(tuple(r) for r in spark.table(f"{places.database}.{table}").collect())

    assert {t: len(rows(t)) for t in PROCESSED} == {
        "orders_enriched": 6, "customers_revenue": 4, "products_sales": 4, "category_revenue": 4, "payments_summary": 4,
    }
    assert rows("category_revenue_clean") == [("Books", 20.0), ("Books", 20.0), ("Sports", 82.0), ("Sports", 82.0)]
    names = {(r.run_date, r.customer_name) for r in spark.table(f"{places.database}.customers_revenue").collect()}
    assert names == {(RUN, "Ann"), (RUN, "Bob"), (NEXT_RUN, "Anna"), (NEXT_RUN, "Bob")}


def test_runs_together_equal_runs_one_by_one(spark, tmp_path, places):
    landing = tmp_path / "landing"
    land(landing, RUN)
    land(landing, NEXT_RUN, suffix="a")
    both = [RUN, NEXT_RUN]
    run_daily(spark, landing_tables(spark, str(landing), both), places, both)

    def contents():
        return {
            t: sorted((tuple(r) for r in spark.table(f"{places.database}.{t}").select(*PROCESSED[t]).collect()), key=repr)
            for t in PROCESSED
        }

    together = contents()
    for run_date in both:
        run_daily(spark, landing_tables(spark, str(landing), [run_date]), places, [run_date])
    assert contents() == together


def test_appending_a_run_again_is_found(spark, tmp_path, places):
    land(tmp_path / "landing", RUN)
    tables = landing_tables(spark, str(tmp_path / "landing"), [RUN])
    run_daily(spark, tables, places, [RUN], mode="append")
    with pytest.raises(AssertionError, match="Duplicate orders"):
        run_daily(spark, tables, places, [RUN], mode="append")
    load_warehouse(spark, places.processed, places.database, [RUN], "reload")
    assert all(r.passed for r in validate_warehouse(spark, places.database).collect())


def test_a_day_without_payments_goes_on_and_is_replaced(spark, tmp_path, places):
    landing = tmp_path / "landing"
    land(landing, RUN)
    tables = landing_tables(spark, str(landing), [RUN])
    none = tables | {"payments": tables["payments"].limit(0)}
    run_daily(spark, none, places, [RUN])  # the first run of a date
    counts = lambda t: spark.table(f"{places.database}.{t}").count()
    assert (counts("payments_summary"), counts("orders_enriched")) == (0, 3)
    run_daily(spark, tables, places, [RUN])
    assert counts("payments_summary") == 2
    run_daily(spark, none, places, [RUN])  # a rerun
    assert (counts("payments_summary"), counts("orders_enriched")) == (0, 3)


def test_a_rerun_without_orders_leaves_none_and_fails_the_checks(spark, tmp_path, places):
    landing = tmp_path / "landing"
    for run_date in (RUN, NEXT_RUN):
        land(landing, run_date)
        run_daily(spark, landing_tables(spark, str(landing), [run_date]), places, [run_date])
    tables = landing_tables(spark, str(landing), [RUN])
    with pytest.raises(AssertionError, match="Customers & products existence") as raised:
        run_daily(spark, tables | {"orders": tables["orders"].limit(0)}, places, [RUN])
    assert raised.value.differences.count() == 0
    left = {r.run_date for r in spark.table(f"{places.database}.orders_enriched").select("run_date").collect()}
    assert left == {NEXT_RUN}


def test_runs_without_orders_have_empty_totals_with_their_columns(spark, tmp_path):
    landing, raw, processed = (str(tmp_path / name) for name in ("landing", "raw", "processed"))
    both = [RUN, NEXT_RUN]
    for run_date in both:
        land(tmp_path / "landing", run_date)
    tables = landing_tables(spark, landing, both)
    for runs in (both, [RUN]):
        ingest_raw(spark, _of_runs(tables, runs) | {"orders": _of_runs(tables, runs)["orders"].limit(0)}, raw, runs)
        process_runs(spark, raw, processed, runs)
        for table in ("orders_enriched", "customers_revenue", "products_sales", "category_revenue"):
            stored = read_runs(spark, processed, table, runs)
            assert stored.count() == 0 and dict(stored.dtypes) == PROCESSED[table]


def test_failed_totals_come_with_the_rows_that_differ(spark, tmp_path, places):
    land(tmp_path / "landing", RUN)
    run_daily(spark, landing_tables(spark, str(tmp_path / "landing"), [RUN]), places, [RUN])
    wrong = spark.table(f"{places.database}.customers_revenue").collect()
    rows = [(*r[:-2], r.total_revenue + (5 if r.customer_id == "C001" else 0), r.run_date) for r in wrong]
    columns = [c for c in spark.table(f"{places.database}.customers_revenue").columns]
    fixed = spark.createDataFrame(rows, spark.table(f"{places.database}.customers_revenue").select(*columns).schema)
    load_table(fixed, places.database, "customers_revenue", [RUN])
    found = differing_totals(spark, places.database, [RUN]).collect()
    assert [(r.table_name, r.key, float(r.difference)) for r in found] == [("customers_revenue", "C001", 5.0)]


def test_checks_read_their_runs_only(spark, tmp_path, places):
    landing = tmp_path / "landing"
    for run_date in (RUN, NEXT_RUN):
        land(landing, run_date)
    both = [RUN, NEXT_RUN]
    run_daily(spark, landing_tables(spark, str(landing), both), places, both)
    plan = validate_warehouse(spark, places.database, [NEXT_RUN])._jdf.queryExecution().executedPlan().toString()
    scans = re.findall(r"FileScan parquet \S*orders_enriched.*?PartitionFilters: \[([^\]]*)\]", plan)
    assert len(scans) == 3 and all(NEXT_RUN in filters for filters in scans)
    assert [r.passed for r in validate_warehouse(spark, places.database).collect()] == [True] * 8


def test_checking_all_runs_reads_those_that_changed(spark, tmp_path, places):
    landing = tmp_path / "landing"
    for run_date in (RUN, NEXT_RUN):
        land(landing, run_date)
        rows = run_daily(spark, landing_tables(spark, str(landing), [run_date]), places, [run_date], all_runs=True)
        assert [r.passed for r in rows] == [True] * 8
        assert refresh(spark, places.database) == []
    assert sorted(map(tuple, rows)) == sorted(map(tuple, validate_warehouse(spark, places.database).collect()))
    load_warehouse(spark, places.processed, places.database, [RUN], "append")
    with pytest.raises(AssertionError, match="Duplicate orders"):
        run_daily(spark, landing_tables(spark, str(landing), [NEXT_RUN]), places, [NEXT_RUN], all_runs=True)


def test_landing_files_that_differ_raise_before_ingest(spark, tmp_path):
    landing = tmp_path / "landing"
    land(landing, RUN)
    file = landing / "customers" / f"run_date={RUN}" / "customers.parquet"
    pd.read_parquet(file).drop(columns=["email", "country"]).to_parquet(file, index=False)
    with pytest.raises(SchemaMismatch, match="email should be string and is absent.*country"):
        landing_tables(spark, str(landing), [RUN])


def test_missing_run_raises(spark, tmp_path, places):
    land(tmp_path / "landing", RUN)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        landing_tables(spark, str(tmp_path / "landing"), [RUN, NEXT_RUN])


def steps_of(spark, places, run_date):
    return {r.step: (r.state, r.attempts) for r in Ledger(spark, places.ledger).frame([run_date]).collect()}


def test_a_run_goes_on_where_it_failed_and_leaves_unchanged_dates_alone(spark, tmp_path, places):
    landing, both = tmp_path / "landing", [RUN, NEXT_RUN]
    for run_date in both:
        land(landing, run_date)
    seen = []

    def failing(step, dates):
        seen.append((step, dates))
        if step == "load products_sales":
            raise RuntimeError("no warehouse")

    with pytest.raises(RuntimeError, match="no warehouse"):
        run_daily(spark, landing_tables(spark, str(landing), both), places, both, before_step=failing)
    first = steps_of(spark, places, RUN)
    assert first["process"] == ("done", 1) and first["load products_sales"] == ("failed", 1) and "check" not in first

    def resumed(**options):
        seen.clear()
        tables = landing_tables(spark, str(landing), both)
        rows = run_daily(spark, tables, places, both, resume=True, before_step=lambda *step: seen.append(step), **options)
        assert all(row.passed for row in rows)
        return {step: dates for step, dates in seen}

    assert resumed() == {step: both for step in ("load products_sales", "load category_revenue_clean", "check")}
    assert steps_of(spark, places, NEXT_RUN)["load products_sales"] == ("done", 2)
    assert resumed() == {"check": both}
    # Other files for one date: that date is done again, the other one is not.
    file = landing / "customers" / f"run_date={RUN}" / "customers.parquet"
    pd.read_parquet(file).assign(name=["Zoe", "Bob"]).to_parquet(file, index=False)
    redone = resumed()
    assert redone.pop("check") == both and set(map(tuple, redone.values())) == {(RUN,)} and len(redone) == 8
    names = {(r.run_date, r.customer_name) for r in spark.table(f"{places.database}.customers_revenue").collect()}
    assert names == {(RUN, "Zoe"), (RUN, "Bob"), (NEXT_RUN, "Ann"), (NEXT_RUN, "Bob")}
    # Without resume all is done.
    run_daily(spark, landing_tables(spark, str(landing), both), places, both)
    assert steps_of(spark, places, NEXT_RUN)["ingest"] == ("done", 2)


def test_appending_goes_on_without_doubling(spark, tmp_path, places):
    land(tmp_path / "landing", RUN)

    def failing(step, dates):
        if step == "check":
            raise RuntimeError("stopped")

    tables = landing_tables(spark, str(tmp_path / "landing"), [RUN])
    with pytest.raises(RuntimeError):
        run_daily(spark, tables, places, [RUN], mode="append", before_step=failing)
    run_daily(spark, tables, places, [RUN], mode="append", resume=True)
    assert spark.table(f"{places.database}.orders_enriched").count() == 3


def test_a_failed_report_says_how_many_rows_it_leaves_out(spark):
    failed = spark.range(70).selectExpr("id AS key", "false AS passed")
    with pytest.raises(AssertionError, match="and 20 more") as raised:
        _raise_failed("category_recon", failed)
    assert raised.value.differences.count() == 70 and "'key': 49" in str(raised.value)
    _raise_failed("completeness", failed)
    _raise_failed("category_recon", failed.limit(0))


def test_ingest_counts(spark, tmp_path, places):
    land(tmp_path / "landing", RUN)
    counts = ingest_raw(spark, landing_tables(spark, str(tmp_path / "landing"), [RUN]), places.raw, [RUN])
    assert sorted(map(tuple, counts.collect())) == [
        ("customers", RUN, 2), ("orders", RUN, 4), ("payments", RUN, 2), ("products", RUN, 2),
    ]


def test_command_line(spark, tmp_path, places):
    land(tmp_path / "landing", RUN)
    arguments = ["--run_date", RUN, "--landing", str(tmp_path / "landing"), "--raw", places.raw, "--processed",
                 places.processed, "--database", places.database, "--database_location", places.database_location]
    main(arguments)
    assert spark.table(f"{places.database}.orders_enriched").count() == 3
    with pytest.raises(AssertionError):
        main([*arguments, "--mode", "append"])


def test_scratch_is_under_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_dir(spark, "a"), scratch_dir(spark, "a")
    assert first.startswith(shared) and first != second
