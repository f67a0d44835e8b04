from decimal import Decimal

from frames import NEXT_RUN, RUN, customers, enriched, frame, orders, products

from pyspark.sql import functions as F

from ordermill.operators.aggregates import category_revenue, customers_revenue, products_sales
from ordermill.quality import reports
from ordermill.schemas import PROCESSED, RAW, REQUIRED

ROWS = [
    ("O1", "C001", "P001", "Book 1", "Books", 2.0, "20.00", RUN),
    ("O2", "C002", "P002", "Ball 2", "Sports", 1.0, "0.10", RUN),
    ("O3", None, "P999", None, None, 1.0, "3.00", NEXT_RUN),
]


def test_completeness(spark):
    frames = {"orders_enriched": enriched(spark, ROWS), "category_revenue": frame(spark, PROCESSED["category_revenue"], [])}
    got = {(r.table_name, r.column_name): (r.present, r.filled, r.total_rows, r.passed)
           for r in reports.completeness(frames, REQUIRED).collect()}
    assert got[("orders_enriched", "order_id")] == (True, 3, 3, True)
    assert got[("orders_enriched", "customer_id")] == (True, 2, 3, False)
    assert got[("category_revenue", "category")] == (True, 0, 0, False)


def test_completeness_names_an_absent_column(spark):
    frames = {"customers_revenue": customers_revenue(enriched(spark, ROWS)).drop("customer_id")}
    got = {r.column_name: (r.present, r.filled, r.passed) for r in reports.completeness(frames, REQUIRED).collect()}
    assert got == {"customer_id": (False, 0, False), "run_date": (True, 3, True)}


def test_type_format(spark):
    df = frame(spark, RAW["payments"], [
        ("PAY1", "O1", "PayPal", None, 1.0, "2025-12-01"),
        ("PAY2", "O2", "PayPal", None, float("nan"), "01/12/2025"),
        ("PAY3", "O3", "PayPal", None, float("inf"), None),
        ("PAY4", "O4", "PayPal", None, 1.0, "2025-02-30"),
        ("PAY5", "O5", "PayPal", None, 1.0, "2025-2-3"),
        ("PAY6", "O6", "PayPal", None, None, "2025-12-01 "),
    ])
    got = {r.column_name: (r.actual_type, r.malformed, r.passed)
           for r in reports.type_format({"payments": df}, RAW).collect()}
    assert got["amount"] == ("double", 2, False)
    assert got["run_date"] == ("string", 4, False)
    assert got["payment_date"] == ("date", 0, True)


def test_type_format_finds_wrong_and_absent_columns(spark):
    df = customers(spark).withColumn("signup_date", F.col("signup_date").cast("string")).drop("email")
    got = {r.column_name: (r.expected_type, r.actual_type, r.passed)
           for r in reports.type_format({"customers": df}, RAW).collect()}
    assert got["signup_date"] == ("date", "string", False)
    assert got["email"] == ("string", None, False)
    assert got["name"] == ("string", "string", True)


def test_join_quality(spark):
    placed = orders(spark, [("O1", "C001", "P001", 1, 1.0), ("O2", "C999", "P001", 1, 1.0), ("O3", None, "P999", 1, 1.0)])
    placed = placed.unionAll(orders(spark, [("O4", "C001", "P001", 1, 1.0)], NEXT_RUN))
    got = reports.join_quality(placed, customers(spark).unionAll(customers(spark)), products(spark))
    assert sorted(map(tuple, got.collect())) == [("customers", 3, False), ("products", 2, False)]
    matched = placed.where("order_id = 'O1'")
    assert {r.passed for r in reports.join_quality(matched, customers(spark), products(spark)).collect()} == {True}
    assert {r.unmatched for r in reports.join_quality(placed.limit(0), customers(spark), products(spark)).collect()} == {0}


def test_category_recon_meets_null_keys(spark):
    df = enriched(spark, ROWS)
    got = reports.category_recon(category_revenue(df), products_sales(df))
    assert got.columns == ["category", "run_date", "recomputed", "stored", "passed"]
    assert sorted([(r.category, r.passed) for r in got.collect()], key=repr) == [("Books", True), ("Sports", True), (None, True)]


def test_category_recon_finds_differences_and_lone_keys(spark):
    sold = products_sales(enriched(spark, ROWS))
    other = category_revenue(
        enriched(spark, [(*ROWS[0][:6], "20.01", RUN), (*ROWS[1][:6], "0.12", RUN), (*ROWS[2][:4], "Toys", 1.0, "3.00", NEXT_RUN)])
    )
    got = {r.category: (r.recomputed, r.stored, r.passed) for r in reports.category_recon(other, sold).collect()}
    assert {k: v[2] for k, v in got.items()} == {"Books": True, "Sports": False, None: False, "Toys": False}
    assert got[None][1] is None and got["Toys"][0] is None


def test_sums_null_on_both_sides_agree(spark):
    df = enriched(spark, [("O1", "C001", "P001", "Book 1", "Books", 1.0, None, RUN)])
    assert reports.anomaly_report(df, customers_revenue(df), products_sales(df), category_revenue(df)).isEmpty()


def test_anomaly_report(spark):
    df = enriched(spark, ROWS)
    right = customers_revenue(df), products_sales(df), category_revenue(df)
    assert reports.anomaly_report(df, *right).isEmpty()
    changed = enriched(spark, [(*ROWS[0][:5], 3.0, "20.00", RUN), ROWS[1], (*ROWS[2][:6], "3.50", NEXT_RUN)])
    got = reports.anomaly_report(df, *[build(changed) for build in (customers_revenue, products_sales, category_revenue)])
    assert sorted(((r.table_name, r.measure, r.key, r.difference) for r in got.collect()), key=repr) == sorted(
        [
            ("products_sales", "total_quantity_sold", "P001", Decimal("1.000000")),
            ("products_sales", "total_revenue", "P999", Decimal("0.500000")),
            ("customers_revenue", "total_revenue", None, Decimal("0.500000")),
            ("category_revenue", "category_revenue", None, Decimal("0.500000")),
        ],
        key=repr,
    )
