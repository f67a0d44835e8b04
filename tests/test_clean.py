import pytest
from frames import NEXT_RUN, RUN, customers, orders, products

from ordermill.operators.clean import clean_customers, clean_orders, clean_products, dedup_first


@pytest.mark.parametrize("backwards", [False, True])
def test_keeps_smallest_row_in_any_input_order(spark, backwards):
    rows = [("O1", "C001", "P001", 2, 9.0), ("O1", "C001", "P001", 1, 10.0), ("O2", "C001", "P001", 3, 1.0)]
    kept = clean_orders(orders(spark, rows[::-1] if backwards else rows)).orderBy("order_id").collect()
    assert [(r.order_id, r.order_quantity, r.order_price) for r in kept] == [("O1", 1, 10.0), ("O2", 3, 1.0)]


def test_null_comes_first(spark):
    rows = [("O1", "C001", "P001", 2, 1.0), ("O1", "C001", "P001", None, 1.0)]
    assert [r.order_quantity for r in clean_orders(orders(spark, rows)).collect()] == [None]


def test_null_key_is_one_key(spark):
    rows = [(None, "C001", "P001", 2, 1.0), (None, "C001", "P001", 1, 1.0)]
    assert [r.order_quantity for r in clean_orders(orders(spark, rows)).collect()] == [1]


def test_result_does_not_depend_on_partitioning(spark):
    rows = [(f"O{i % 7}", f"C{i:03d}", "P001", i % 5, 1.0 * (i % 3)) for i in range(200)]
    results = {
        tuple(sorted(map(tuple, clean_orders(orders(spark, rows).repartition(parts)).collect())))
        for parts in (1, 3, 8)
    }
    assert len(results) == 1
    assert len(results.pop()) == 7


def test_ids_of_two_runs_are_two_keys(spark):
    both = customers(spark, [("C001", "Ann")]).unionAll(customers(spark, [("C001", "Zoe")], NEXT_RUN))
    kept = clean_customers(both).orderBy("run_date").collect()
    assert [(r.customer_name, r.run_date) for r in kept] == [("Ann", RUN), ("Zoe", NEXT_RUN)]


def test_renames(spark):
    assert clean_orders(orders(spark, [])).columns == [
        "order_id", "order_date", "customer_id", "product_id", "order_quantity", "order_price", "order_country", "run_date",
    ]
    assert clean_customers(customers(spark)).columns == [
        "customer_id", "customer_name", "email", "customer_country", "signup_date", "run_date",
    ]
    assert clean_products(products(spark)).columns == [
        "product_id", "category", "product_name", "cost", "price", "run_date",
    ]


def test_without_run_date_the_id_alone_is_the_key(spark):
    df = products(spark, [("P001", "Books"), ("P001", "Art")]).drop("run_date")
    assert [r.category for r in clean_products(df).collect()] == ["Art"]


def test_keys_only(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert sorted(r.k for r in dedup_first(df, ["k"]).collect()) == [1, 2]
