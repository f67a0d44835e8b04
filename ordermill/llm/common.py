"""Helpers shared by the operators: input tables, written intermediate tables, row numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.plans.scratch import scratch_dir
from ordermill.sinks.files import Files

#: Whether Spark removes the shuffle files of a query as soon as it has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Added to the rows of an input table; not a name that a user would give a column.
ROW = "__row"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """The frame written to the shared folder and read back.

    That cuts its lineage: what follows survives the loss of an executor without computing it again,
    sees the same rows in every retry, and Spark knows its size. Nothing reads the shuffle files of the write
    after it, so they go at once, not when the driver happens to collect garbage.
    """
    path, conf = scratch_dir(df.sparkSession, label), df.sparkSession.conf
    before = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        conf.unset(CLEANUP) if before is None else conf.set(CLEANUP, before)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back.written_to = path
    return back


def release(*frames: DataFrame) -> None:
    """Remove what ``written`` has written, once nothing reads it any more."""
    for df in frames:
        Files(df.sparkSession).delete(df.written_to)


def numbered(df: DataFrame, label: str) -> DataFrame:
    """``df`` written with a distinct number per row, so that equal rows can be told apart."""
    return written(df.withColumn(ROW, F.monotonically_increasing_id()), label)


def groups_for(rows: int, rows_each: int, most: int) -> int:
    """Groups of about ``rows_each`` rows, ``most`` of them at the utmost."""
    return min(max(-(-rows // rows_each), 1), most)


def replace_columns(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without the columns that an operator is about to add under these names."""
    wanted = {name.lower() for name in names}
    return df.select(*[F.col(f"`{name}`") for name in df.columns if name.lower() not in wanted])
