"""Write run-date partitions laid out as ``<root>/<table>/run_date=YYYY-MM-DD/``.

All runs of a write are first staged, by one job, beside the table. One small file then commits them: from
that moment on the new runs are the ones that count, whatever happens to the process that moves them to their
places. Before it, every old run is as it was.

    <root>/<table>/_staged/<commit>/run_date=.../   rows of a write, until they are moved
    <root>/<table>/_commits/<commit>.json           the runs of a commit that is being moved in
    <root>/<table>/_commits/done/<commit>.json      and of one that has been: the manifest of the table
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.sinks.files import WRITTEN, Files

STAGED, COMMITS, REPLACED = "_staged", "_commits", "_replaced"


def write_runs(
    df: DataFrame, root: str, table: str, run_dates: Sequence[str], one_file_each: bool = False
) -> None:
    """Replace the partitions of the runs ``run_dates`` by the rows of ``df``; other runs stay.

    A run without rows becomes a folder with the schema only, so nothing of an earlier attempt is left and
    the run reads as empty. A row of a run that is not named raises. Either all runs are replaced or none:
    a job that fails or is killed leaves the old ones, and one that is killed while its runs are moved in
    has committed them, which ``read_runs`` and the next write know. One process writes a run at a time.

    ``one_file_each`` groups the rows by run before they are written, at the cost of a shuffle, for many
    runs of few rows.
    """
    if not run_dates:
        raise ValueError("name at least one run date")
    files, base = Files(df.sparkSession), f"{root}/{table}"
    finish_commits(files, base, run_dates)
    commit = uuid.uuid4().hex
    stage(only_runs(df, table, run_dates), f"{base}/{STAGED}/{commit}", run_dates, one_file_each)
    files.write(f"{base}/{COMMITS}/{commit}.json", json.dumps({"runs": sorted(set(run_dates))}))
    _move_in(files, base, commit)


def only_runs(df: DataFrame, table: str, run_dates: Sequence[str]) -> DataFrame:
    """The rows as they are; one of a run that is not among ``run_dates`` raises when it is read."""
    named = F.coalesce(F.col("run_date").isin(*run_dates), F.lit(False))
    strange = F.concat(F.lit(f"{table}: row of a run that is not written, "), F.coalesce("run_date", F.lit("NULL")))
    return df.where(F.when(named, F.lit(True)).otherwise(F.raise_error(strange).cast("boolean")))


def stage(df: DataFrame, place: str, run_dates: Sequence[str], one_file_each: bool = False) -> None:
    """Write the rows by run under a new folder, with a schema-only file for each run without rows.

    The number of jobs does not depend on the number of runs.
    """
    files, spark = Files(df.sparkSession), df.sparkSession
    if len(set(run_dates)) == 1:
        # No partition column to sort or group by.
        df.drop("run_date").write.options(**WRITTEN).parquet(f"{place}/run_date={run_dates[0]}")
        return
    rows = df.hint("rebalance", "run_date") if one_file_each else df
    rows.write.options(**WRITTEN).partitionBy("run_date").parquet(place)
    empty = sorted({f"run_date={run_date}" for run_date in run_dates} - set(files.names(place)))
    if empty:
        spark.createDataFrame([], df.drop("run_date").schema).coalesce(1).write.parquet(f"{place}/_none")
        (schema_only,) = [name for name in files.names(f"{place}/_none") if name.endswith(".parquet")]
        for folder in empty:
            files.make_folder(f"{place}/{folder}")
            files.copy(f"{place}/_none/{schema_only}", f"{place}/{folder}/{schema_only}")
        files.delete(f"{place}/_none")


def pending_runs(files: Files, base: str) -> dict[str, str]:
    """Runs that are committed and not yet in their places, with the folder that holds ``run_date=...``."""
    found = {}
    for commit in _open_commits(files, base):
        for run_date in _runs_of(files, base, commit):
            if files.exists(f"{base}/{STAGED}/{commit}/run_date={run_date}"):
                found[run_date] = f"{base}/{STAGED}/{commit}"
    return found


def finish_commits(files: Files, base: str, run_dates: Sequence[str]) -> None:
    """Move in what a process that died had committed of any of these runs."""
    for commit in _open_commits(files, base):
        if set(_runs_of(files, base, commit)) & set(run_dates):
            _move_in(files, base, commit)


def manifest(spark: SparkSession, root: str, table: str) -> dict[str, list[str]]:
    """The runs of every commit that is in place."""
    files, folder = Files(spark), f"{root}/{table}/{COMMITS}/done"
    return {name.removesuffix(".json"): json.loads(files.read(f"{folder}/{name}"))["runs"] for name in files.names(folder)}


def remove_abandoned(spark: SparkSession, root: str, table: str) -> list[str]:
    """Remove what was staged and never committed. For when no other process is writing the table."""
    files, base = Files(spark), f"{root}/{table}"
    left = sorted(set(files.names(f"{base}/{STAGED}")) - set(_open_commits(files, base)))
    for commit in left:
        files.delete(f"{base}/{STAGED}/{commit}")
    return left


def _open_commits(files: Files, base: str) -> list[str]:
    return [name.removesuffix(".json") for name in files.names(f"{base}/{COMMITS}") if name.endswith(".json")]


def _runs_of(files: Files, base: str, commit: str) -> list[str]:
    return json.loads(files.read(f"{base}/{COMMITS}/{commit}.json"))["runs"]


def _move_in(files: Files, base: str, commit: str) -> None:
    """Each step can be repeated: a run whose staged folder is gone has been moved before."""
    for run_date in _runs_of(files, base, commit):
        new, place = f"{base}/{STAGED}/{commit}/run_date={run_date}", f"{base}/run_date={run_date}"
        if files.exists(new):
            if files.exists(place):
                files.move(place, f"{base}/{REPLACED}/{commit}/run_date={run_date}")
            files.move(new, place)
    files.move(f"{base}/{COMMITS}/{commit}.json", f"{base}/{COMMITS}/done/{commit}.json")
    files.delete(f"{base}/{STAGED}/{commit}")
    files.delete(f"{base}/{REPLACED}/{commit}")


def run_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """Rows per table and run; on Parquet this reads row counts from file footers."""
    counts = [
        df.groupBy("run_date")
        .agg(F.count("*").alias("row_count"))
        .select(F.lit(table).alias("table_name"), "run_date", "row_count")
        for table, df in frames.items()
    ]
    return reduce(DataFrame.unionAll, counts)
