"""The eight checks over all runs from stored sums, so that only runs that have changed are read.

For every run three small tables are kept beside the checked ones, each a partition per run: ``check_sums``, a row
of sums and counts that add up over runs; ``customer_ids``; and ``product_names``, which is the register of what
every product was called. A row of ``check_sums`` has the fingerprint of the files it was made from. A run whose
files are others now is read again, and its partitions are replaced, which takes its former names out of the
register, too.

Order ids do not add up over runs, as one might be in two. But ids carry their run date, so the ids of a run
lie between two bounds where other runs have none; only runs whose bounds overlap are compared id by id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.plans.ledger import digest
from ordermill.quality.checks import missing_key, paired
from ordermill.quality.suite import METRICS, joined_on_both, report, side_by_side
from ordermill.session import bound_tasks
from ordermill.sinks.files import Files
from ordermill.sinks.warehouse import load_table, partition_places

CHECKED = ("orders_enriched", "customers_revenue", "products_sales")
SUMS, CUSTOMERS, PRODUCTS = "check_sums", "customer_ids", "product_names"
#: Metrics that add up over runs.
ADDED = [
    "missing", "orders_total", "customers_total", "customer_recomputed", "customer_stored", "products_total",
    "quantity_recomputed", "quantity_stored", "revenue_recomputed", "revenue_stored",
]


def run_sums(enriched: DataFrame, customers_revenue: DataFrame, products_sales: DataFrame) -> DataFrame:
    """A row per run: everything that the checks need and that adds up, and the bounds of its order ids."""
    # Only the ids are shuffled; what needs no grouping by id is summed in the scan.
    ids = enriched.groupBy("run_date", "order_id").agg(F.count("*").alias("copies"))
    ids_per_run = ids.groupBy("run_date").agg(
        F.count("order_id").alias("n_orders"),
        F.count_if(F.col("copies") > 1).alias("duplicates"),
        F.min("order_id").alias("first_order"),
        F.max("order_id").alias("last_order"),
        F.count_if(F.col("order_id").isNull()).alias("without_id"),
    )
    sums_per_run = enriched.groupBy("run_date").agg(
        F.sum("order_quantity").alias("total_quantity"),
        F.count_if(missing_key()).alias("missing"),
        F.sum("total_amount").alias("orders_total"),
    )
    per_run = ids_per_run.join(sums_per_run, "run_date", "full")
    customers = _reconciled(
        enriched, customers_revenue, "customer_id",
        {"total_amount": ("total_revenue", "customer_recomputed", "customer_stored")}, "customers_total",
    )
    products = _reconciled(
        enriched, products_sales, "product_id",
        {
            "order_quantity": ("total_quantity_sold", "quantity_recomputed", "quantity_stored"),
            "total_amount": ("total_revenue", "revenue_recomputed", "revenue_stored"),
        },
        "products_total",
    )
    return per_run.join(customers, "run_date", "full").join(products, "run_date", "full")


def _reconciled(
    enriched: DataFrame, stored: DataFrame, key: str, measures: dict[str, tuple[str, str, str]], total: str
) -> DataFrame:
    """Per run: recomputed and stored sums of the keys on both sides, and the stored revenue of all."""
    keys = [key, "run_date"]
    kept = [names[0] for names in measures.values()]
    both = side_by_side(enriched.select(*keys, *measures), stored.select(*keys, *kept))
    per_key = both.groupBy(*keys).agg(
        *[F.sum(column).alias(column) for column in (*measures, *kept)],
        F.count("in_orders").alias("order_rows"),
        F.count("in_stored").alias("stored_rows"),
    )
    on_both = joined_on_both(*keys)
    sums = []
    for computed, (column, recomputed, of_stored) in measures.items():
        sums.append(F.sum(F.when(on_both, paired(computed))).alias(recomputed))
        sums.append(F.sum(F.when(on_both, F.col(column))).alias(of_stored))
    return per_key.groupBy("run_date").agg(F.sum("total_revenue").alias(total), *sums)


def refresh(spark: SparkSession, database: str) -> list[str]:
    """Bring the stored sums up to date; returns the runs that were read for it."""
    places = {table: partition_places(spark, f"{database}.{table}") for table in CHECKED}
    runs = sorted(set().union(*places.values()))
    files = Files(spark)
    prints = {run: digest(*[f"{t} {files.stamps(places[t].get(run))}" for t in CHECKED]) for run in runs}
    known = {}
    if spark.catalog.tableExists(f"{database}.{SUMS}"):
        # One row per run.
        known = {row["run_date"]: row["fingerprint"] for row in spark.table(f"{database}.{SUMS}").select("run_date", "fingerprint").collect()}
    changed = [run for run in runs if known.get(run) != prints[run]]
    if not changed:
        return []
    bound_tasks(spark)
    enriched, customers, products = (_of_runs(spark, database, table, changed) for table in CHECKED)
    # The sums come last: without their fingerprint the run is read again.
    load_table(enriched.select("customer_id", "run_date").distinct(), database, CUSTOMERS, changed)
    load_table(enriched.select("product_id", "product_name", "run_date").distinct(), database, PRODUCTS, changed)
    labels = spark.createDataFrame([(run, prints[run]) for run in changed], "run_date string, fingerprint string")
    sums = labels.join(run_sums(enriched, customers, products), "run_date", "left")
    load_table(sums, database, SUMS, changed)
    return changed


def check_all_runs(spark: SparkSession, database: str) -> DataFrame:
    """The report of the eight checks over all runs, from the stored sums, which are brought up to date first."""
    refresh(spark, database)
    runs = sorted(set().union(*[partition_places(spark, f"{database}.{table}") for table in CHECKED]))
    sums, customers, products = (_of_runs(spark, database, table, runs) for table in (SUMS, CUSTOMERS, PRODUCTS))
    names = products.groupBy("product_id").agg(F.count_distinct("product_name").alias("names"))
    parts = [
        sums.agg(*[F.sum(name).alias(name) for name in ADDED]),
        _orders(spark, database, sums),
        customers.agg(F.count_distinct("customer_id").alias("n_customers")),
        names.agg(F.count("product_id").alias("n_products"), F.count_if(F.col("names") > 1).alias("name_conflicts")),
    ]
    assert sorted(name for part in parts for name in part.columns) == sorted(METRICS)
    return report(parts)


def name_register(spark: SparkSession, database: str) -> DataFrame:
    """Every name of every product with the first and the last run that has it."""
    refresh(spark, database)
    runs = sorted(partition_places(spark, f"{database}.orders_enriched"))
    return (
        _of_runs(spark, database, PRODUCTS, runs)
        .groupBy("product_id", "product_name")
        .agg(F.min("run_date").alias("first_run"), F.max("run_date").alias("last_run"))
    )


def _orders(spark: SparkSession, database: str, sums: DataFrame) -> DataFrame:
    """Distinct and repeated order ids over all runs; ids are read only of runs whose bounds overlap."""
    bounds = sums.where("first_order IS NOT NULL").select("run_date", "first_order", "last_order").collect()
    # As UTF-8, which is how Spark compares strings.
    rows = sorted((row["first_order"].encode(), row["last_order"].encode(), row["run_date"]) for row in bounds)
    without = [row["run_date"] for row in sums.where("without_id > 0").select("run_date").collect()]
    shared: set[str] = set(without) if len(without) > 1 else set()
    reached, reaching = b"", ""
    for first, last, run in rows:
        if reaching and first <= reached:
            shared |= {reaching, run}
        if last > reached or not reaching:
            reached, reaching = last, run
    count, quantity = F.coalesce(F.sum("n_orders"), F.lit(0)), F.sum("total_quantity")
    alone = sums.where(~F.col("run_date").isin(*shared)) if shared else sums
    added = alone.agg(count.alias("n_orders"), quantity.alias("total_quantity"), F.coalesce(F.sum("duplicates"), F.lit(0)).alias("duplicates"))
    if not shared:
        return added
    ids = _of_runs(spark, database, "orders_enriched", sorted(shared)).groupBy("order_id")
    ids = ids.agg(F.count("*").alias("copies"), F.sum("order_quantity").alias("quantity"))
    compared = ids.agg(
        F.count("order_id").alias("n_orders"), F.sum("quantity").alias("total_quantity"), F.count_if(F.col("copies") > 1).alias("duplicates")
    )
    return added.unionByName(compared).agg(*[F.sum(name).alias(name) for name in added.columns])


def _of_runs(spark: SparkSession, database: str, table: str, runs: list[str]) -> DataFrame:
    return spark.table(f"{database}.{table}").where(F.col("run_date").isin(*runs))
