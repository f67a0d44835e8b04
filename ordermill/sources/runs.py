"""Read run-date partitions laid out as ``<root>/<table>/run_date=YYYY-MM-DD/``."""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.schemas import ddl
from ordermill.sinks.files import Files
from ordermill.sinks.partitions import pending_runs

# What a contract type may be in the files: the type itself or one that widens to it without loss.
NARROWER = {"bigint": {"tinyint", "smallint", "int"}, "double": {"float"}}


class SchemaMismatch(ValueError):
    """Files that do not have the columns of their contract."""


def read_runs(
    spark: SparkSession,
    root: str,
    table: str,
    run_dates: Sequence[str] | None = None,
    contract: dict[str, str] | None = None,
    merge_schema: bool = False,
) -> DataFrame:
    """The given runs of a table, or all of them.

    Named runs are read by path, so that only their folders are listed, and a missing run raises
    instead of reading as empty. With a contract the schema is fixed; without one it is taken from
    the files, from all of them if ``merge_schema`` says that they differ. ``run_date`` is a string
    either way. A run that is committed and not yet moved to its place is read where it is.
    """
    base = f"{root}/{table}"
    if run_dates is not None and not run_dates:
        raise ValueError("name at least one run date")

    def read(home: str, dates: Sequence[str] | None) -> DataFrame:
        paths = [home] if dates is None else [f"{home}/run_date={run_date}" for run_date in dates]
        reader = spark.read.option("basePath", home)
        if contract:
            return reader.schema(ddl(contract)).parquet(*paths)
        found = reader.option("mergeSchema", str(merge_schema).lower()).parquet(*paths)
        return found.withColumn("run_date", F.col("run_date").cast("string"))

    files = Files(spark)
    pending = pending_runs(files, base)
    if run_dates is not None:
        pending = {run_date: home for run_date, home in pending.items() if run_date in run_dates}
    if not pending:
        return read(base, run_dates)
    placed = [name.removeprefix("run_date=") for name in files.names(base) if name.startswith("run_date=")]
    settled = [run_date for run_date in (run_dates or placed) if run_date not in pending]
    parts = [read(base, settled)] if settled else []
    parts += [read(home, [run_date]) for run_date, home in sorted(pending.items())]
    return reduce(partial(DataFrame.unionByName, allowMissingColumns=merge_schema), parts)


def checked_runs(
    spark: SparkSession, root: str, table: str, run_dates: Sequence[str], contract: dict[str, str]
) -> DataFrame:
    """The given runs, of files by others: every run must have the columns of the contract and no other.

    Types must be those of the contract or widen to them. Raises ``SchemaMismatch`` that names table,
    run, column, expected and found type, before any row is read.
    """
    problems = []
    for run_date in run_dates:
        found = dict(read_runs(spark, root, table, [run_date], merge_schema=True).dtypes)
        for column, kind in contract.items():
            actual = found.get(column)
            if actual != kind and actual not in NARROWER.get(kind, ()):
                problems.append(f"{table}, run {run_date}: {column} should be {kind} and is {actual or 'absent'}")
        problems += [
            f"{table}, run {run_date}: {column} ({found[column]}) is not in the contract"
            for column in found
            if column not in contract
        ]
    if problems:
        raise SchemaMismatch("; ".join(problems))
    runs = [read_runs(spark, root, table, [run_date], merge_schema=True) for run_date in run_dates]
    typed = [df.select(*[F.col(column).cast(kind).alias(column) for column, kind in contract.items()]) for df in runs]
    combined = typed[0]
    for df in typed[1:]:
        combined = combined.unionAll(df)
    return combined
