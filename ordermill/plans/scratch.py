"""Folders for tables that a query writes and reads back."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder under the shared ``spark.checkpoint.dir``, or where that is unset under the warehouse."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{shared.rstrip('/')}/ordermill/{label}-{uuid.uuid4().hex}"

