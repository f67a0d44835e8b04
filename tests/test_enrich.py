from decimal import Decimal

import pytest
from frames import NEXT_RUN, RUN, customers, orders, products

from ordermill.operators.clean import clean_customers, clean_orders, clean_products
from ordermill.operators.enrich import enrich_orders
from ordermill.schemas import PROCESSED


def enrich(spark, rows, run_date=None):
    return enrich_orders(
        clean_orders(orders(spark, rows)), clean_customers(customers(spark)), clean_products(products(spark)), run_date
    )


@pytest.mark.parametrize("run_date", [None, RUN])
def test_columns_and_types(spark, run_date):
    assert dict(enrich(spark, [], run_date).dtypes) == PROCESSED["orders_enriched"]
    assert enrich(spark, [], run_date).columns == list(PROCESSED["orders_enriched"])


@pytest.mark.parametrize("run_date", [None, RUN])
def test_unknown_and_null_keys_stay_with_null_attributes(spark, run_date):
    rows = [
        ("O1", "C001", "P001", 1, 2.0),
        ("O2", "C999", "P001", 1, 2.0),
        ("O3", "C001", "P999", 1, 2.0),
        ("O4", None, None, 1, 2.0),
    ]
    got = {r.order_id: r for r in enrich(spark, rows, run_date).collect()}
    assert {o: (r.customer_id, r.customer_name, r.product_id, r.category) for o, r in got.items()} == {
        "O1": ("C001", "Ann", "P001", "Books"),
        "O2": ("C999", None, "P001", "Books"),
        "O3": ("C001", "Ann", "P999", None),
        "O4": (None, None, None, None),
    }
    assert got["O1"].price == 10.0 and got["O1"].order_price == 2.0


@pytest.mark.parametrize(
    ("quantity", "price", "total"),
    [(2, 1.005, "2.01"), (1, 2.675, "2.68"), (3, 0.1, "0.30"), (None, 1.0, None), (1, None, None)],
)
def test_total_is_rounded_half_up(spark, quantity, price, total):
    row = enrich(spark, [("O1", "C001", "P001", quantity, price)]).collect()[0]
    assert row.total_amount == (None if total is None else Decimal(total))


def test_overflow_raises(spark):
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE|cannot be represented"):
        enrich(spark, [("O1", "C001", "P001", 1, 1e17)]).collect()


def test_run_date_is_stamped(spark):
    rows = [("O1", "C001", "P001", 1, 2.0)]
    assert [r.run_date for r in enrich(spark, rows, "2026-01-01").collect()] == ["2026-01-01"]


def test_runs_join_their_own_attributes(spark):
    two_runs = orders(spark, [("O1", "C001", "P001", 1, 2.0)]).unionAll(
        orders(spark, [("O2", "C001", "P001", 1, 2.0), ("O3", "C002", "P001", 1, 2.0)], NEXT_RUN)
    )
    people = customers(spark).unionAll(customers(spark, [("C001", "Zoe")], NEXT_RUN))
    things = products(spark).unionAll(products(spark, [("P001", "Art")], NEXT_RUN))
    got = enrich_orders(clean_orders(two_runs), clean_customers(people), clean_products(things)).collect()
    assert sorted((r.order_id, r.run_date, r.customer_name, r.category) for r in got if r.customer_name) == [
        ("O1", RUN, "Ann", "Books"),
        ("O2", NEXT_RUN, "Zoe", "Art"),
    ]
    assert [r.customer_name for r in got if r.order_id == "O3"] == [None]
