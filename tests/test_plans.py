"""The plans that matter at scale: pruning, join removal, partial aggregation, skew handling."""

import re

import pytest
from pyspark.sql import functions as F

from ordermill.operators.aggregates import category_revenue, customers_revenue, totals_in_one_pass
from ordermill.operators.clean import clean_customers, clean_orders, clean_products, dedup_first
from ordermill.operators.enrich import enrich_orders
from ordermill.plans.queries import QUERIES, RUN_DATES, staged
from ordermill.schemas import RAW
from ordermill.sources.runs import read_runs
from ordermill.sources.star import raw_tables

SF_DIR = "/root/testdata/sf0.001"


def plan(df, executed=False):
    execution = df._jdf.queryExecution()
    if executed:
        df.collect()
    return execution.executedPlan().toString()


def enriched(spark):
    run = staged(spark, SF_DIR)
    run.raw("orders")
    raw = run.places.raw
    orders, customers, products = (read_runs(spark, raw, t, RUN_DATES, RAW[t]) for t in ("orders", "customers", "products"))
    return enrich_orders(clean_orders(orders), clean_customers(customers), clean_products(products))


@pytest.fixture
def settings(spark):
    before = {}

    def change(**values):
        for key, value in values.items():
            key = key.replace("__", ".")
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield change
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_and_no_python_rows(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert unwanted not in text


def test_only_asked_runs_are_listed_and_filters_prune_partitions(spark):
    run = staged(spark, SF_DIR)
    run.raw("orders")
    raw = run.places.raw
    one = read_runs(spark, raw, "orders", RUN_DATES[:1], RAW["orders"])
    assert all(f"run_date={RUN_DATES[0]}" in path for path in one.inputFiles())
    text = plan(read_runs(spark, raw, "orders", None, RAW["orders"]).where(F.col("run_date") == RUN_DATES[1]))
    assert re.search(r"PartitionFilters: \[[^\]]*run_date", text)


def test_totals_read_only_their_columns(spark):
    stored = staged(spark, SF_DIR).processed("orders_enriched")
    text = plan(customers_revenue(stored))
    assert "ReadSchema: struct<customer_id:string,customer_name:string,total_amount:decimal(18,2)>" in text
    assert text.count("Exchange") == 1 and "partial_sum" in text


def test_all_totals_need_one_scan_and_one_shuffle(spark):
    text = plan(totals_in_one_pass(staged(spark, SF_DIR).processed("orders_enriched")))
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1 and "partial_sum" in text


def test_joins_an_aggregate_does_not_need_are_removed(spark):
    df = enriched(spark)
    assert len(re.findall(r"Join \[", plan(category_revenue(df)))) == 1
    assert len(re.findall(r"Join \[", plan(customers_revenue(df)))) == 1
    assert len(re.findall(r"Join \[", plan(df))) == 2


def test_dedup_reduces_copies_before_the_shuffle(spark):
    orders = raw_tables(spark, SF_DIR, RUN_DATES)["orders"]
    text = plan(clean_orders(orders))
    assert text.index("min(struct") < text.index("Exchange hashpartitioning(order_id") < text.index("partial_min(struct")
    # One key on every row.
    hot = spark.range(0, 10_000, 1, 8).select(F.lit("k").alias("k"), F.col("id").alias("v"))
    df = dedup_first(hot, ["k"])
    assert [tuple(r) for r in df.collect()] == [("k", 0)]


def test_single_run_write_needs_no_sort_by_run(spark):
    run = staged(spark, SF_DIR)
    run.raw("orders")
    raw = run.places.raw
    orders, customers, products = (
        read_runs(spark, raw, t, RUN_DATES[:1], RAW[t]) for t in ("orders", "customers", "products")
    )
    df = enrich_orders(clean_orders(orders), clean_customers(customers), clean_products(products), RUN_DATES[0])
    optimized = df._jdf.queryExecution().optimizedPlan().toString()
    assert f"{RUN_DATES[0]} AS run_date" in optimized
    assert not re.search(r"Join LeftOuter.*run_date", optimized)


def test_hot_and_null_keys_are_split_across_tasks(spark, settings):
    """A customer with a third of all orders and a third without product, with no side small enough to broadcast."""
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__shuffle__partitions="32",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20k",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20k",
        spark__sql__adaptive__coalescePartitions__minPartitionSize="1k",
    )
    sf_dir = "/root/testdata/sf0.01"
    raw = raw_tables(spark, sf_dir, RUN_DATES)
    turn = F.pmod(F.xxhash64("order_id"), F.lit(3))
    orders = (
        raw["orders"]
        .withColumn("customer_id", F.when(turn == 0, "C007").otherwise(F.col("customer_id")))
        .withColumn("product_id", F.when(turn != 1, F.col("product_id")))
    )
    orders, customers, products = clean_orders(orders), clean_customers(raw["customers"]), clean_products(raw["products"])
    df = enrich_orders(orders, customers, products)
    execution = df._jdf.queryExecution()
    rows = df.collect()
    assert execution.executedPlan().toString().count("skew=true") == 2
    assert len(rows) == orders.count()
    settings(spark__sql__autoBroadcastJoinThreshold="10m", spark__sql__adaptive__skewJoin__enabled="false")
    assert sorted(map(tuple, rows), key=repr) == sorted(map(tuple, enrich_orders(orders, customers, products).collect()), key=repr)
