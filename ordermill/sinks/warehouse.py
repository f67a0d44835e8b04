"""Warehouse tables, partitioned by run date.

The rows of a load are written to a new folder, by one job for all runs, and only then does the catalog point
to them. So a load that fails or is killed while it writes has changed nothing. A run is replaced by
giving its partition the new place. A table is replaced by building the new one under another name and
renaming both; ``settle`` finishes or undoes what a process left that died between the renames. Files that
nothing points to any more are removed last.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ordermill.functions.money import safe_double
from ordermill.sinks.columns import match_columns
from ordermill.sinks.files import WRITTEN, Files
from ordermill.sinks.partitions import only_runs

MODES = ("append", "truncate", "reload")
RUN_DATE = re.compile(r"\d{4}-\d{2}-\d{2}")
BY_RUN = "run_date"
#: Partitions that one statement adds.
ADDED = 200


def ensure_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    where = f" LOCATION {_quoted(location)}" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{where}")


def load_table(
    df: DataFrame,
    database: str,
    table: str,
    run_dates: Sequence[str],
    mode: str = "reload",
    add_columns: bool = False,
    widen: bool = False,
) -> None:
    """Load the runs ``run_dates`` of ``df`` into ``database.table``; a row of another run raises.

    ``append`` adds the rows to what is there, ``truncate`` replaces the whole table, ``reload``
    replaces the given runs only, so that loading a run twice does not double it. A run without rows
    becomes an empty partition.

    Into a table that stays (append, reload), ``df`` must have the same columns, in any order, of the
    same types or of types that widen to them without loss; else ``TypeClash`` is raised before any row is
    written. With ``add_columns`` new columns are added to the table, where earlier runs have NULL. With
    ``widen`` a column of the table gets the least type that holds its old values and the new ones, where
    there is one; the table is then written anew, as other readers rely on the types in its files.
    """
    if mode not in MODES:
        raise ValueError(f"mode is one of {MODES}, not {mode!r}")
    for run_date in run_dates:
        if not RUN_DATE.fullmatch(run_date):
            raise ValueError(f"not a run date: {run_date!r}")
    spark, name = df.sparkSession, f"{database}.{table}"
    settle(spark, name)
    if not spark.catalog.tableExists(name) or mode == "truncate":
        place = _write(only_runs(df, name, run_dates), database, table)
        replace_table(spark, name, df.schema, place, run_dates)
        return
    match = match_columns(df.schema, spark.table(name).schema, name, add_columns, widen)
    if match.wider:
        _widen(spark, database, table, match.wider)
    if match.new:
        added = ", ".join(f"{_name(field.name)} {field.dataType.simpleString()}" for field in match.new)
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({added})")
    kinds = {field.name: field.dataType for field in spark.table(name).schema.fields}
    rows = only_runs(df, name, run_dates).select(*[F.col(_name(c)).cast(kind).alias(c) for c, kind in kinds.items()])
    if mode == "append":
        _add_partitions(spark, name, {run: None for run in run_dates})
        rows.write.insertInto(name)
    else:
        _swap_partitions(spark, name, _write(rows, database, table), run_dates)
    spark.catalog.refreshTable(name)


def replace_table(
    spark: SparkSession, name: str, schema: StructType, place: str, run_dates: Sequence[str] | None = None
) -> None:
    """Create the table or replace it by the files at ``place``, partitioned by run if ``run_dates`` are given.

    Where only the place of an unpartitioned table changes, that is a single change in the catalog.
    Otherwise the new table is complete under another name before the old one gives up its own.
    """
    settle(spark, name)
    exists = spark.catalog.tableExists(name)
    old = _places(spark, name) if exists else []
    if exists and run_dates is None and _same(spark.table(name).schema, schema):
        spark.sql(f"ALTER TABLE {name} SET LOCATION {_quoted(place)}")
    else:
        partitioned = run_dates is not None
        fields = [f for f in schema.fields if not (partitioned and f.name == BY_RUN)]
        columns = [f"{_name(field.name)} {field.dataType.simpleString()}" for field in fields]
        by = f" PARTITIONED BY ({BY_RUN})" if partitioned else ""
        if partitioned:
            columns.append(f"{BY_RUN} string")
        following, former = _following(name), _former(name)
        spark.sql(f"CREATE TABLE {following} ({', '.join(columns)}) USING parquet{by} LOCATION {_quoted(place)}")
        if partitioned:
            _add_partitions(spark, following, {run: f"{place}/{BY_RUN}={run}" for run in run_dates})
        if exists:
            spark.sql(f"ALTER TABLE {name} RENAME TO {former}")
        spark.sql(f"ALTER TABLE {following} RENAME TO {name}")
        if exists:
            spark.sql(f"DROP TABLE {former}")
    spark.catalog.refreshTable(name)
    _remove(spark, name, old)


def settle(spark: SparkSession, name: str) -> None:
    """Finish or undo the replacement of a table by a process that died between two steps of it."""
    tables = spark.catalog.tableExists
    following, former = _following(name), _former(name)
    if not tables(name):
        if tables(former):
            spark.sql(f"ALTER TABLE {following if tables(following) else former} RENAME TO {name}")
    for left in (following, former):
        # Without the table itself the one that was to follow may not be complete.
        if tables(left):
            spark.sql(f"DROP TABLE {left}")


def _write(df: DataFrame, database: str, table: str) -> str:
    """Rows by run, if they have one, in a new folder of the table; returns the folder."""
    place = f"{_database_place(df.sparkSession, database)}/_loads/{table}/{uuid.uuid4().hex}"
    writer = df.write.options(**WRITTEN)
    (writer.partitionBy(BY_RUN) if BY_RUN in df.columns else writer).parquet(place)
    return place


def _widen(spark: SparkSession, database: str, table: str, wider: dict) -> None:
    name = f"{database}.{table}"
    old = spark.table(name)
    rows = old.withColumns({column: F.col(_name(column)).cast(kind) for column, kind in wider.items()})
    replace_table(spark, name, rows.schema, _write(rows, database, table), _runs(spark, name))


def _swap_partitions(spark: SparkSession, name: str, place: str, run_dates: Sequence[str]) -> None:
    """Point the partitions of the runs to their new places, one change each, then remove the old files."""
    new = {run: f"{place}/{BY_RUN}={run}" for run in run_dates}
    known = set(_runs(spark, name))
    old = [_partition_place(spark, name, run) for run in new if run in known]
    _add_partitions(spark, name, new)
    for run, folder in new.items():
        if run in known:
            spark.sql(f"ALTER TABLE {name} PARTITION ({BY_RUN} = '{run}') SET LOCATION {_quoted(folder)}")
    spark.catalog.refreshTable(name)
    _remove(spark, name, old)


def _add_partitions(spark: SparkSession, name: str, places: dict[str, str | None]) -> None:
    """Register runs that the table does not have; their folders are made if there are no rows in them."""
    files, known = Files(spark), set(_runs(spark, name))
    missing = {run: place for run, place in places.items() if run not in known}
    for place in places.values():
        if place is not None:
            files.make_folder(place)
    runs = list(missing)
    for at in range(0, len(runs), ADDED):
        parts = [
            f"PARTITION ({BY_RUN} = '{run}')" + (f" LOCATION {_quoted(missing[run])}" if missing[run] else "")
            for run in runs[at : at + ADDED]
        ]
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {' '.join(parts)}")


def _runs(spark: SparkSession, name: str) -> list[str]:
    return [row.partition.partition("=")[2] for row in spark.sql(f"SHOW PARTITIONS {name}").collect()]


def _described(spark: SparkSession, what: str) -> str | None:
    rows = spark.sql(f"DESCRIBE {what}").collect()
    # The first column differs by statement: col_name or info_name.
    return next((row[1] for row in rows if row[0].rstrip(":") == "Location"), None)


def _database_place(spark: SparkSession, database: str) -> str:
    return _described(spark, f"DATABASE EXTENDED {database}").rstrip("/")


def _partition_place(spark: SparkSession, name: str, run: str) -> str:
    return _described(spark, f"TABLE EXTENDED {name} PARTITION ({BY_RUN} = '{run}')")


def partition_places(spark: SparkSession, name: str) -> dict[str, str]:
    """The runs of a table and where their files are."""
    return {run: _partition_place(spark, name, run) for run in _runs(spark, name)}


def _places(spark: SparkSession, name: str) -> list[str]:
    """Where the files of a table are: its own place and those of its partitions."""
    table = _described(spark, f"TABLE EXTENDED {name}")
    if BY_RUN not in spark.table(name).columns:
        return [table]
    return [table, *partition_places(spark, name).values()]


def _remove(spark: SparkSession, name: str, places: list[str]) -> None:
    """Remove folders that loads have written; anything elsewhere is not ours."""
    database, _, table = name.rpartition(".")
    home = f"/_loads/{table}/"
    for place in places:
        if place and home in place:
            Files(spark).delete(place)


def _same(left: StructType, right: StructType) -> bool:
    shape = lambda schema: [(f.name, f.dataType.simpleString()) for f in schema.fields]
    return shape(left) == shape(right)


def _following(name: str) -> str:
    return f"{name}__following"


def _former(name: str) -> str:
    return f"{name}__former"


def _name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def category_revenue_clean(category_revenue: DataFrame) -> DataFrame:
    """Category and revenue as double. The run date is dropped: one row per category and run."""
    return category_revenue.select(
        "category", safe_double(F.col("category_revenue")).alias("category_revenue")
    )


def rebuild_category_revenue_clean(spark: SparkSession, database: str) -> None:
    """Write the cleaned table anew and put it in the place of the old one, which stays if that fails."""
    table = "category_revenue_clean"
    clean = category_revenue_clean(spark.table(f"{database}.category_revenue"))
    replace_table(spark, f"{database}.{table}", clean.schema, _write(clean, database, table))
