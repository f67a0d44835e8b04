"""Submit independent Spark jobs at the same time."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession


def run_together(spark: SparkSession, jobs: Iterable[Callable[[], None]]) -> None:
    """Run the jobs in threads and wait for all of them; the first error is raised.

    A small job then fills the cores that the last tasks of a large one leave idle.
    """
    jobs = list(jobs)
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
    for job in running:
        job.result()
