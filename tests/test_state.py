"""The checks merged from stored sums against the full pass over all runs."""

import pytest
from frames import NEXT_RUN, RUN, enriched

from ordermill.operators.aggregates import customers_revenue, products_sales
from ordermill.plans.daily_run import validate_warehouse
from ordermill.quality import state
from ordermill.sinks.warehouse import ensure_database, load_table

THIRD = "2025-12-03"


@pytest.fixture
def database(spark, tmp_path, request):
    name = f"state_{abs(hash(request.node.name))}"
    ensure_database(spark, name, str(tmp_path / "db"))
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def load(spark, database, rows, runs, totals_of=None):
    orders = enriched(spark, rows)
    load_table(orders, database, "orders_enriched", runs)
    stored = orders if totals_of is None else enriched(spark, totals_of)
    load_table(customers_revenue(stored), database, "customers_revenue", runs)
    load_table(products_sales(stored), database, "products_sales", runs)


def rows_of(run, *, prefix=None, name="Book 1"):
    day = (prefix or run).replace("-", "")
    return [
        (f"O{day}1", "C001", "P001", name, "Books", 2.0, "20.00", run),
        (f"O{day}2", "C001", "P002", "Ball 2", "Sports", 1.0, "0.01", run),
        (f"O{day}3", "C002", "P001", name, "Books", 1.0, "10.50", run),
        (f"O{day}3", None, "P999", None, None, 4.0, "5.00", run),
    ]


def same_report(spark, database):
    merged = sorted(map(tuple, state.check_all_runs(spark, database).collect()))
    assert merged == sorted(map(tuple, validate_warehouse(spark, database).collect()))
    return {row[0]: row[-1] for row in merged}


def test_only_runs_that_changed_are_read(spark, database):
    load(spark, database, rows_of(RUN) + rows_of(NEXT_RUN), [RUN, NEXT_RUN])
    assert state.refresh(spark, database) == [RUN, NEXT_RUN]
    assert state.refresh(spark, database) == []
    passed = same_report(spark, database)
    assert not passed[4] and not passed[5] and passed[6] and passed[7]
    load(spark, database, rows_of(RUN)[:3], [RUN])
    load(spark, database, rows_of(THIRD)[:2], [THIRD])
    assert state.refresh(spark, database) == [RUN, THIRD]
    same_report(spark, database)
    load_table(enriched(spark, rows_of(THIRD)[2:3]), database, "orders_enriched", [THIRD], "append")
    assert state.refresh(spark, database) == [THIRD]
    assert not same_report(spark, database)[6]


def test_wrong_totals_and_empty_runs(spark, database):
    wrong = [(*row[:6], "99.00", row[7]) for row in rows_of(NEXT_RUN)]
    load(spark, database, rows_of(RUN)[:3], [RUN])
    load(spark, database, rows_of(NEXT_RUN)[:3], [NEXT_RUN], totals_of=wrong)
    load(spark, database, [], [THIRD])
    passed = same_report(spark, database)
    assert not passed[6] and not passed[7] and not passed[8] and passed[5]
    load(spark, database, [], [RUN, NEXT_RUN])
    assert not same_report(spark, database)[2]


@pytest.mark.parametrize("ids", ["shared", "interleaved", "null", "null in one"])
def test_order_ids_of_several_runs(spark, database, ids):
    """Ids that are in two runs, or between those of another, are compared one by one."""
    second = rows_of(NEXT_RUN, prefix=RUN if ids == "shared" else None)
    first = rows_of(RUN)
    if ids == "interleaved":
        first = [("O1", *row[1:]) if i else ("O9", *row[1:]) for i, row in enumerate(first[:2])]
        second = [("O5", *row[1:]) for row in second[:1]]
    if ids.startswith("null"):
        first = [(None, *first[0][1:]), *first[1:3]]
        second = [(None, *second[0][1:]), *second[1:3]] if ids == "null" else second[:3]
    load(spark, database, first, [RUN])
    load(spark, database, second, [NEXT_RUN])
    load(spark, database, rows_of(THIRD)[:3], [THIRD])
    assert same_report(spark, database)[5] == (ids in ("interleaved", "null in one"))


def test_the_name_register_follows_reloads(spark, database):
    load(spark, database, rows_of(RUN), [RUN])
    load(spark, database, rows_of(NEXT_RUN, name="Tome 1"), [NEXT_RUN])
    register = lambda: sorted(map(tuple, state.name_register(spark, database).collect()), key=repr)
    assert register() == [
        ("P001", "Book 1", RUN, RUN), ("P001", "Tome 1", NEXT_RUN, NEXT_RUN),
        ("P002", "Ball 2", RUN, NEXT_RUN), ("P999", None, RUN, NEXT_RUN),
    ]
    assert not same_report(spark, database)[3]
    load(spark, database, rows_of(NEXT_RUN), [NEXT_RUN])
    assert ("P001", "Book 1", RUN, NEXT_RUN) in register() and len(register()) == 3
    assert same_report(spark, database)[3]


def test_only_ids_are_shuffled_by_order(spark):
    orders = enriched(spark, rows_of(RUN))
    text = state.run_sums(orders, customers_revenue(orders), products_sales(orders))._jdf.queryExecution().optimizedPlan().toString()
    by_id = [line for line in text.splitlines() if "Aggregate [run_date" in line and "order_id" in line.partition("],")[0]]
    assert by_id and not any("sum(" in line for line in by_id)
