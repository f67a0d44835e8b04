import re
import uuid

import pytest
from frames import NEXT_RUN, RUN, orders
from pyspark.sql import functions as F

from ordermill.schemas import RAW, ddl
from ordermill.sinks import warehouse
from ordermill.sinks.columns import TypeClash
from ordermill.sinks.files import Files
from ordermill.sinks.partitions import manifest, remove_abandoned, run_counts, write_runs
from ordermill.sinks.warehouse import (
    category_revenue_clean,
    ensure_database,
    load_table,
    rebuild_category_revenue_clean,
    replace_table,
    settle,
)
from ordermill.sources.runs import SchemaMismatch, checked_runs, read_runs


def run_of(spark, run_date, *ids):
    return orders(spark, [(i, "C001", "P001", 1, 1.0) for i in ids], run_date)


def stored(df):
    return sorted((r.run_date, r.order_id) for r in df.collect())


def test_writing_a_run_again_replaces_only_that_run(spark, tmp_path):
    root = str(tmp_path)
    write_runs(run_of(spark, RUN, "A", "B"), root, "orders", [RUN])
    write_runs(run_of(spark, NEXT_RUN, "C"), root, "orders", [NEXT_RUN])
    write_runs(run_of(spark, RUN, "D"), root, "orders", [RUN])
    assert stored(read_runs(spark, root, "orders", None, RAW["orders"])) == [(RUN, "D"), (NEXT_RUN, "C")]


def test_many_runs_make_few_files_each(spark, tmp_path):
    dates = [f"2025-12-{day:02d}" for day in range(1, 10)]
    frames = [run_of(spark, date, *map(str, range(5))) for date in dates]
    combined = frames[0]
    for df in frames[1:]:
        combined = combined.unionAll(df)
    write_runs(combined, str(tmp_path), "orders", dates, one_file_each=True)
    for date in dates:
        assert len(list((tmp_path / "orders" / f"run_date={date}").glob("*.parquet"))) == 1
    assert read_runs(spark, str(tmp_path), "orders").count() == 5 * len(dates)


@pytest.mark.parametrize("dates", [[RUN], [RUN, NEXT_RUN]])
def test_runs_without_rows_are_emptied(spark, tmp_path, dates):
    root = str(tmp_path)
    write_runs(run_of(spark, RUN, "A").unionAll(run_of(spark, NEXT_RUN, "B")), root, "orders", [RUN, NEXT_RUN])
    rows = run_of(spark, RUN, "A").limit(0) if len(dates) == 1 else run_of(spark, NEXT_RUN, "C")
    write_runs(rows, root, "orders", dates)
    left = [(NEXT_RUN, "B")] if len(dates) == 1 else [(NEXT_RUN, "C")]
    assert stored(read_runs(spark, root, "orders", [RUN, NEXT_RUN], RAW["orders"])) == left
    assert read_runs(spark, root, "orders", [RUN]).columns == run_of(spark, RUN).columns


def test_rows_of_runs_that_are_not_named_raise(spark, tmp_path):
    for rows in (run_of(spark, NEXT_RUN, "B"), run_of(spark, None, "B")):
        for dates in ([RUN], [RUN, "2025-12-03"]):
            with pytest.raises(Exception, match="run that is not written"):
                write_runs(rows, str(tmp_path), "orders", dates)
    with pytest.raises(ValueError):
        write_runs(run_of(spark, RUN, "A"), str(tmp_path), "orders", [])


def test_files_must_keep_to_the_contract(spark, tmp_path):
    good = run_of(spark, RUN, "A").withColumn("quantity", F.col("quantity").cast("int"))
    write_runs(good, str(tmp_path), "orders", [RUN])
    checked = checked_runs(spark, str(tmp_path), "orders", [RUN], RAW["orders"])
    assert dict(checked.dtypes) == RAW["orders"] and stored(checked) == [(RUN, "A")]
    bad = run_of(spark, NEXT_RUN, "B").drop("country").withColumn("price", F.col("price").cast("string"))
    write_runs(bad.withColumn("colour", F.lit("red")), str(tmp_path), "orders", [NEXT_RUN])
    with pytest.raises(SchemaMismatch) as raised:
        checked_runs(spark, str(tmp_path), "orders", [RUN, NEXT_RUN], RAW["orders"])
    for part in (NEXT_RUN, "country should be string and is absent", "price should be double and is string", "colour"):
        assert part in str(raised.value)
    assert f"run {RUN}" not in str(raised.value)


def test_read_gives_string_run_date_and_a_missing_run_raises(spark, tmp_path):
    root = str(tmp_path)
    write_runs(run_of(spark, RUN, "A"), root, "orders", [RUN])
    df = read_runs(spark, root, "orders", [RUN], RAW["orders"])
    assert dict(df.dtypes) == RAW["orders"]
    assert stored(df) == [(RUN, "A")]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_runs(spark, root, "orders", [RUN, NEXT_RUN], RAW["orders"])
    with pytest.raises(ValueError):
        read_runs(spark, root, "orders", [])


def test_schema_from_the_files(spark, tmp_path):
    root = str(tmp_path)
    write_runs(run_of(spark, RUN, "A").drop("country"), root, "orders", [RUN])
    write_runs(run_of(spark, NEXT_RUN, "B"), root, "orders", [NEXT_RUN])
    one = read_runs(spark, root, "orders", [RUN])
    assert "country" not in one.columns and dict(one.dtypes)["run_date"] == "string"
    merged = read_runs(spark, root, "orders", merge_schema=True)
    assert sorted((r.run_date, r.country) for r in merged.collect()) == [(RUN, None), (NEXT_RUN, "FR")]
    text = merged.where("run_date = '2025-12-02'")._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*2025-12-02", text)


def test_run_counts(spark, tmp_path):
    write_runs(run_of(spark, RUN, "A", "B").unionAll(run_of(spark, NEXT_RUN, "C")), str(tmp_path), "orders", [RUN, NEXT_RUN])
    counts = run_counts({"orders": read_runs(spark, str(tmp_path), "orders", None, RAW["orders"])})
    assert sorted(map(tuple, counts.collect())) == [("orders", RUN, 2), ("orders", NEXT_RUN, 1)]


class Killed(BaseException):
    """What stands for the end of a process."""


def two_runs(spark, *ids):
    return run_of(spark, RUN, *ids).unionAll(run_of(spark, NEXT_RUN, *ids))


def killed_at(monkeypatch, method, call):
    """End the process at the given call of a file operation."""
    real, calls = getattr(Files, method), []

    def counted(self, *arguments):
        calls.append(arguments)
        if len(calls) == call:
            raise Killed
        return real(self, *arguments)

    monkeypatch.setattr(Files, method, counted)
    return calls


@pytest.mark.parametrize("method", ["write", "move", "delete"])
def test_a_write_that_is_killed_at_any_step_replaces_all_runs_or_none(spark, tmp_path, monkeypatch, method):
    both = [RUN, NEXT_RUN]
    for call in range(1, 12):
        root = str(tmp_path / f"{method}{call}")
        write_runs(two_runs(spark, "old"), root, "orders", both)
        with monkeypatch.context() as patch:
            calls = killed_at(patch, method, call)
            try:
                write_runs(two_runs(spark, "new"), root, "orders", both)
            except Killed:
                pass
            finished = len(calls) < call
        for dates in (both, None):
            found = stored(read_runs(spark, root, "orders", dates, RAW["orders"]))
            assert found in ([(RUN, i), (NEXT_RUN, i)] for i in ("old", "new"))
        assert stored(read_runs(spark, root, "orders", [NEXT_RUN])) == found[1:]
        write_runs(two_runs(spark, "last"), root, "orders", both)
        assert stored(read_runs(spark, root, "orders", both)) == [(RUN, "last"), (NEXT_RUN, "last")]
        remove_abandoned(spark, root, "orders")
        assert Files(spark).names(f"{root}/orders/_staged") == []
        if finished:
            break
    assert finished


def test_a_failing_job_leaves_the_old_runs(spark, tmp_path):
    both = [RUN, NEXT_RUN]
    write_runs(two_runs(spark, "old"), str(tmp_path), "orders", both)
    failing = two_runs(spark, "new").withColumn("country", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        write_runs(failing, str(tmp_path), "orders", both)
    assert stored(read_runs(spark, str(tmp_path), "orders", both)) == [(RUN, "old"), (NEXT_RUN, "old")]
    assert len(remove_abandoned(spark, str(tmp_path), "orders")) == 1


def test_the_manifest_lists_what_each_write_replaced(spark, tmp_path):
    write_runs(two_runs(spark, "A"), str(tmp_path), "orders", [RUN, NEXT_RUN])
    write_runs(run_of(spark, RUN, "B"), str(tmp_path), "orders", [RUN])
    assert sorted(manifest(spark, str(tmp_path), "orders").values()) == [[RUN], [RUN, NEXT_RUN]]


def jobs_of(spark, work):
    """Spark jobs that the work runs."""
    tracker, group = spark.sparkContext.statusTracker(), uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, "counted")
    try:
        work()
        return len(tracker.getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def many(spark, dates, ids=("A",)):
    rows = run_of(spark, RUN, *ids).drop("run_date").withColumn("run_date", F.explode(F.array(*map(F.lit, dates))))
    return rows.select(*RAW["orders"])


def test_jobs_of_a_write_and_a_load_do_not_grow_with_the_runs(spark, tmp_path, database):
    few, more = ([f"2025-11-{day:02d}" for day in range(1, days)] for days in (4, 25))
    counts = []
    for i, dates in enumerate((few, more)):
        rows = many(spark, dates[:-1])  # the last run is empty
        writing = jobs_of(spark, lambda: write_runs(rows, str(tmp_path), f"orders{i}", dates))
        loading = [jobs_of(spark, lambda: load_table(rows, database, f"t{i}", dates, mode)) for mode in ("reload", "reload", "append", "truncate")]
        counts.append((writing, loading))
        partitions = [r.partition for r in spark.sql(f"SHOW PARTITIONS {database}.t{i}").collect()]
        assert partitions == [f"run_date={date}" for date in dates]
    assert counts[0] == counts[1]


@pytest.fixture
def database(spark, tmp_path, request):
    name = f"db_{abs(hash(request.node.name))}"
    ensure_database(spark, name, str(tmp_path / "db"))
    ensure_database(spark, name, str(tmp_path / "db"))
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_append_adds(spark, database):
    for _ in range(2):
        load_table(run_of(spark, RUN, "A"), database, "orders", [RUN], "append")
    assert stored(spark.table(f"{database}.orders")) == [(RUN, "A"), (RUN, "A")]


def test_truncate_replaces_all(spark, database):
    load_table(run_of(spark, RUN, "A"), database, "orders", [RUN], "append")
    load_table(run_of(spark, NEXT_RUN, "B"), database, "orders", [NEXT_RUN], "truncate")
    assert stored(spark.table(f"{database}.orders")) == [(NEXT_RUN, "B")]


def test_reload_replaces_its_runs_only(spark, database):
    both = run_of(spark, RUN, "A", "B").unionAll(run_of(spark, NEXT_RUN, "C"))
    load_table(both, database, "orders", [RUN, NEXT_RUN], "reload")
    load_table(both, database, "orders", [RUN, NEXT_RUN], "reload")
    assert stored(spark.table(f"{database}.orders")) == [(RUN, "A"), (RUN, "B"), (NEXT_RUN, "C")]
    load_table(run_of(spark, RUN, "D"), database, "orders", [RUN], "reload")
    assert stored(spark.table(f"{database}.orders")) == [(RUN, "D"), (NEXT_RUN, "C")]


def test_reload_matches_columns_by_name(spark, database):
    load_table(run_of(spark, RUN, "A"), database, "orders", [RUN], "reload")
    shuffled = run_of(spark, RUN, "B").select(*reversed(list(RAW["orders"])))
    load_table(shuffled, database, "orders", [RUN], "reload")
    row = spark.table(f"{database}.orders").collect()[0]
    assert (row.order_id, row.customer_id, row.product_id, row.quantity) == ("B", "C001", "P001", 1)


@pytest.mark.parametrize("mode", ["append", "reload"])
def test_columns_are_never_left_out(spark, database, mode):
    load_table(run_of(spark, RUN, "A"), database, "orders", [RUN])
    wider = run_of(spark, NEXT_RUN, "B").withColumn("colour", F.lit("red"))
    with pytest.raises(ValueError, match="colour"):
        load_table(wider, database, "orders", [NEXT_RUN], mode)
    with pytest.raises(ValueError, match="country"):
        load_table(run_of(spark, NEXT_RUN, "B").drop("country"), database, "orders", [NEXT_RUN], mode)
    load_table(wider, database, "orders", [NEXT_RUN], mode, add_columns=True)
    rows = spark.table(f"{database}.orders").collect()
    assert sorted((r.order_id, r.colour) for r in rows) == [("A", None), ("B", "red")]


@pytest.mark.parametrize("mode", ["append", "reload"])
def test_a_narrower_column_raises_before_any_row_is_written(spark, database, mode):
    load_table(run_of(spark, RUN, "A"), database, "orders", [RUN])
    before = spark.table(f"{database}.orders").collect()
    for kind in ("double", "string", "decimal(20,1)"):
        lossy = run_of(spark, RUN, "B").withColumn("quantity", F.lit("2.7").cast(kind))
        with pytest.raises(TypeClash, match=f"quantity is bigint and would get {re.escape(kind)}"):
            load_table(lossy, database, "orders", [RUN], mode)
    assert spark.table(f"{database}.orders").collect() == before


@pytest.mark.parametrize("mode", ["append", "reload"])
def test_narrower_rows_are_widened_to_the_table(spark, database, mode):
    load_table(run_of(spark, RUN, "A"), database, "orders", [RUN])
    narrow = run_of(spark, NEXT_RUN, "B").withColumns({"quantity": F.lit(7).cast("tinyint"), "price": F.lit(0.5).cast("float")})
    load_table(narrow, database, "orders", [NEXT_RUN], mode)
    df = spark.table(f"{database}.orders")
    assert dict(df.dtypes)["quantity"] == "bigint"
    assert sorted((r.order_id, r.quantity, r.price) for r in df.collect()) == [("A", 1, 1.0), ("B", 7, 0.5)]


@pytest.mark.parametrize("mode", ["append", "reload"])
def test_a_table_is_widened_on_request_and_keeps_every_value(spark, database, mode):
    rows = run_of(spark, RUN, "A").withColumns({"quantity": F.lit(2**31 - 1), "price": F.lit("1.25").cast("decimal(5,2)")})
    none = "2025-12-03"
    load_table(rows, database, "orders", [RUN, none])
    wider = run_of(spark, NEXT_RUN, "B").withColumns({"quantity": F.lit(2**40), "price": F.lit("1234567.125").cast("decimal(12,3)")})
    with pytest.raises(TypeClash, match="quantity is int and would get bigint; widen=True makes it bigint"):
        load_table(wider, database, "orders", [NEXT_RUN], mode)
    load_table(wider, database, "orders", [NEXT_RUN], mode, widen=True)
    df = spark.table(f"{database}.orders")
    assert (dict(df.dtypes)["quantity"], dict(df.dtypes)["price"]) == ("bigint", "decimal(12,3)")
    got = sorted((r.order_id, r.quantity, str(r.price)) for r in df.collect())
    assert got == [("A", 2**31 - 1, "1.250"), ("B", 2**40, "1234567.125")]
    assert [r.partition[-10:] for r in spark.sql(f"SHOW PARTITIONS {database}.orders").collect()] == [RUN, NEXT_RUN, none]
    load_table(rows.withColumn("order_id", F.lit("C")), database, "orders", [RUN])
    assert stored(df.sparkSession.table(f"{database}.orders")) == [(RUN, "C"), (NEXT_RUN, "B")]


def test_rows_of_runs_that_are_not_loaded_raise(spark, database):
    for mode in ("append", "reload", "truncate"):
        with pytest.raises(Exception, match="run that is not written"):
            load_table(two_runs(spark, "A"), database, "orders", [RUN], mode)


@pytest.mark.parametrize("mode", ["reload", "truncate"])
def test_a_load_that_fails_leaves_the_table(spark, database, mode):
    load_table(two_runs(spark, "old"), database, "orders", [RUN, NEXT_RUN])
    failing = two_runs(spark, "new").withColumn("country", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        load_table(failing, database, "orders", [RUN, NEXT_RUN], mode)
    assert stored(spark.table(f"{database}.orders")) == [(RUN, "old"), (NEXT_RUN, "old")]


def test_replaced_files_are_removed(spark, database, tmp_path):
    folder = tmp_path / "db" / "_loads" / "orders"
    for mode in ("reload", "reload", "truncate"):
        load_table(two_runs(spark, mode), database, "orders", [RUN, NEXT_RUN], mode)
        assert stored(spark.table(f"{database}.orders")) == [(RUN, mode), (NEXT_RUN, mode)]
    assert len({file.parts[-3] for file in folder.glob("*/run_date=*/*.parquet")}) == 1


def revenue(spark, value):
    schema = "category string, category_revenue decimal(28,2), run_date string"
    return spark.createDataFrame([("Books", value)], "c string, v int").selectExpr("c", "v", f"'{RUN}'").toDF(
        "category", "category_revenue", "run_date"
    ).to(spark.createDataFrame([], schema).schema)


def test_a_rebuild_that_fails_leaves_the_cleaned_table(spark, database, monkeypatch):
    load_table(revenue(spark, 5), database, "category_revenue", [RUN])
    rebuild_category_revenue_clean(spark, database)
    load_table(revenue(spark, 7), database, "category_revenue", [RUN])

    def failing(df):
        return category_revenue_clean(df).withColumn("category", F.raise_error(F.lit("lost")).cast("string"))

    clean = lambda: [tuple(r) for r in spark.table(f"{database}.category_revenue_clean").collect()]
    with monkeypatch.context() as patch:
        patch.setattr(warehouse, "category_revenue_clean", failing)
        with pytest.raises(Exception, match="lost"):
            rebuild_category_revenue_clean(spark, database)
    assert clean() == [("Books", 5.0)]
    rebuild_category_revenue_clean(spark, database)
    assert clean() == [("Books", 7.0)]


def test_a_replacement_that_died_between_its_renames_is_settled(spark, database):
    name = f"{database}.orders"
    load_table(run_of(spark, RUN, "old"), database, "orders", [RUN])
    load_table(run_of(spark, RUN, "new"), database, "other", [RUN])
    # The new table was complete and the old one had given up its name.
    spark.sql(f"ALTER TABLE {database}.other RENAME TO {name}__following")
    spark.sql(f"ALTER TABLE {name} RENAME TO {name}__former")
    settle(spark, name)
    assert stored(spark.table(name)) == [(RUN, "new")]
    # Nothing but the old one was there.
    spark.sql(f"ALTER TABLE {name} RENAME TO {name}__former")
    settle(spark, name)
    assert stored(spark.table(name)) == [(RUN, "new")]
    # The new one was not complete.
    spark.sql(f"CREATE TABLE {name}__following (a int) USING parquet")
    load_table(run_of(spark, RUN, "last"), database, "orders", [RUN])
    assert stored(spark.table(name)) == [(RUN, "last")]
    assert {t.name for t in spark.catalog.listTables(database)} == {"orders"}


def test_a_table_of_other_columns_is_replaced(spark, database, tmp_path):
    name = f"{database}.plain"
    for i, df in enumerate((spark.range(3).toDF("a"), spark.range(2).toDF("a"), spark.range(4).selectExpr("id AS b", "1 AS c"))):
        place = str(tmp_path / f"plain{i}")
        df.write.parquet(place)
        replace_table(spark, name, df.schema, place)
        assert spark.table(name).columns == df.columns and spark.table(name).count() == df.count()


def test_a_location_with_a_quote(spark, tmp_path):
    ensure_database(spark, "quoted_place", str(tmp_path / "it's"))
    spark.sql("DROP DATABASE quoted_place")


def test_bad_mode_and_bad_run_date(spark, database):
    with pytest.raises(ValueError):
        load_table(run_of(spark, RUN, "A"), database, "orders", [RUN], "merge")
    load_table(run_of(spark, RUN, "A"), database, "orders", [RUN])
    with pytest.raises(ValueError):
        load_table(run_of(spark, RUN, "A"), database, "orders", ["x' OR '1"])


def test_category_revenue_clean_gives_null_for_text(spark):
    df = spark.createDataFrame([("Books", "12.50", RUN), (None, "abc", RUN)], "category string, category_revenue string, run_date string")
    assert sorted(map(tuple, category_revenue_clean(df).collect()), key=repr) == [("Books", 12.5), (None, None)]
    assert ddl({"a": "int", "b": "string"}) == "a int, b string"
