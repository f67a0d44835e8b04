"""Each check passes on good data and fails on the defect it is for, alone and in the suite."""

from decimal import Decimal

import pytest
from frames import NEXT_RUN, RUN, enriched, frame

from ordermill.operators.aggregates import customers_revenue, products_sales
from ordermill.quality import checks
from ordermill.quality.suite import assert_checks, check_suite
from ordermill.schemas import PROCESSED

GOOD = [
    ("O1", "C001", "P001", "Book 1", "Books", 2.0, "20.00", RUN),
    ("O2", "C001", "P002", "Ball 2", "Sports", 1.0, "0.10", RUN),
    ("O3", "C002", "P001", "Book 1", "Books", 1.0, "10.50", NEXT_RUN),
]


def tables(spark, rows, stored_rows=None):
    stored = enriched(spark, rows if stored_rows is None else stored_rows)
    return enriched(spark, rows), customers_revenue(stored), products_sales(stored)


def passed_alone(orders, customers, products):
    """The literal checks, in order."""
    return [
        checks.orders_quantities(orders).collect()[0].passed,
        checks.entities_exist(orders).collect()[0].passed,
        checks.product_name_conflicts(orders).isEmpty(),
        checks.missing_keys(orders).collect()[0].passed,
        checks.duplicate_orders(orders).isEmpty(),
        checks.global_revenue(orders, customers, products).collect()[0].passed,
        checks.customer_recon(orders, customers).collect()[0].passed,
        checks.product_recon(orders, products).collect()[0].passed,
    ]


def off_by(amount):
    return GOOD[:2] + [("O3", "C002", "P001", "Book 1", "Books", 1.0, str(Decimal("10.50") + Decimal(amount)), NEXT_RUN)]


CASES = {
    "good": (GOOD, None, []),
    "more orders than units": ([(*r[:5], 0.1, *r[6:]) for r in GOOD], None, [1]),
    "no customer at all": ([(r[0], None, *r[2:]) for r in GOOD], None, [2, 4, 7]),
    "no product at all": ([(*r[:2], None, *r[3:]) for r in GOOD], None, [2, 3, 4, 8]),
    "two names": (GOOD + [("O4", "C001", "P001", "Other", "Books", 1.0, "1.00", RUN)], None, [3, 8]),
    "two names in two runs": (
        GOOD + [("O4", "C001", "P002", "Other", "Sports", 1.0, "1.00", NEXT_RUN)], None, [3],
    ),
    "a missing key": (GOOD + [("O4", None, "P001", "Book 1", "Books", 1.0, "1.00", RUN)], None, [4]),
    "an order twice": (GOOD + GOOD[:1], None, [5]),
    "no order id twice": (GOOD + [(None, *GOOD[0][1:])] * 2, None, [5]),
    "off by a cent": (GOOD, off_by("0.01"), []),
    "off by two cents": (GOOD, off_by("0.02"), [6, 7, 8]),
    "a run missing in the totals": (GOOD, GOOD[:2], [6]),
    "empty": ([], None, [1, 2, 6, 7, 8]),
}


@pytest.mark.parametrize("case", CASES)
def test_alone_and_in_suite(spark, case):
    rows, stored_rows, failing = CASES[case]
    given = tables(spark, rows, stored_rows)
    expected = [number not in failing for number in range(1, 9)]
    assert passed_alone(*given) == expected
    report = check_suite(*given).orderBy("check_id").collect()
    assert [r.check_id for r in report] == list(range(1, 9))
    assert [r.passed for r in report] == expected


def test_totals_loaded_twice_fail_where_the_join_fans_out(spark):
    orders, customers, products = tables(spark, GOOD)
    given = orders, customers.unionAll(customers), products.unionAll(products)
    # Both sides of the row-by-row join double, so 7 and 8 still hold and 6 finds it.
    assert passed_alone(*given) == [True, True, True, True, True, False, True, True]
    assert [r.passed for r in check_suite(*given).orderBy("check_id").collect()] == passed_alone(*given)


def test_pre_aggregated_joins_equal_the_row_by_row_join(spark):
    orders, customers, products = tables(spark, GOOD + GOOD[:1])
    customers, products = customers.unionAll(customers.limit(1)), products.unionAll(products.limit(2))
    for table in ("orders", "customers", "products"):
        locals()[table].createOrReplaceTempView(f"fan_{table}")
    by_row = spark.sql(
        """
        WITH r AS (SELECT customer_id, run_date, sum(total_amount) AS v FROM fan_orders GROUP BY ALL)
        SELECT sum(r.v) AS recomputed, sum(c.total_revenue) AS stored
        FROM r JOIN fan_customers c ON r.customer_id = c.customer_id AND r.run_date = c.run_date
        """
    ).collect()[0]
    got = checks.customer_recon(orders, customers).collect()[0]
    assert (got.recomputed, got.stored) == (by_row.recomputed, by_row.stored)
    by_row = spark.sql(
        """
        WITH r AS (SELECT product_id, run_date, sum(order_quantity) AS q, sum(total_amount) AS v
                   FROM fan_orders GROUP BY ALL)
        SELECT sum(r.q) AS a, sum(p.total_quantity_sold) AS b, sum(r.v) AS c, sum(p.total_revenue) AS d
        FROM r JOIN fan_products p ON r.product_id = p.product_id AND r.run_date = p.run_date
        """
    ).collect()[0]
    got = checks.product_recon(orders, products).collect()[0]
    assert (got.recomputed_qty, got.stored_qty, got.recomputed_rev, got.stored_rev) == tuple(by_row)


def test_details_name_the_rows(spark):
    df = enriched(spark, GOOD + GOOD[:1] + [("O4", "C001", "P001", "Other", "Books", 1.0, "1.00", RUN)])
    assert [tuple(r) for r in checks.duplicate_orders(df).collect()] == [("O1", 2)]
    assert [tuple(r) for r in checks.product_name_conflicts(df).collect()] == [("P001", 2)]


def test_assert_checks(spark, caplog):
    assert len(assert_checks(check_suite(*tables(spark, GOOD)))) == 8
    broken = check_suite(*tables(spark, GOOD + GOOD[:1], off_by("1.00")))
    with pytest.raises(AssertionError, match="5 Duplicate orders.*6 Global revenue"):
        assert_checks(broken)
    assert "check 5 failed" in caplog.text


def test_verbose_logs_passed_checks(spark, caplog):
    with caplog.at_level("INFO"):
        assert_checks(check_suite(*tables(spark, GOOD)), verbose=True)
    assert caplog.text.count("passed:") == 8


def test_measured_values(spark):
    report = {r.check_id: (r.measured, r.expected) for r in check_suite(*tables(spark, GOOD, off_by("0.02"))).collect()}
    assert report[1] == (3.0, 4.0)
    assert report[2] == (2.0, 1.0)
    assert report[6] == (0.02, 0.01)
    assert report[8] == (0.02, 0.01)


def test_empty_stored_contracts(spark):
    none = {table: frame(spark, PROCESSED[table], []) for table in PROCESSED}
    report = check_suite(none["orders_enriched"], none["customers_revenue"], none["products_sales"])
    assert [r.passed for r in report.orderBy("check_id").collect()] == [False, False, True, True, True, False, False, False]
