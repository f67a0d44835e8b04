"""What the daily run has done: one small record per run date and step, beside the processed tables.

A record has the fingerprint of the input that the step worked on. A step is done for a date if its last
record says so for the same fingerprint; a date whose input has changed is not.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ordermill.sinks.files import Files

SCHEMA = "run_date string, step string, state string, attempts int, fingerprint string"
STARTED, DONE, FAILED = "started", "done", "failed"


def digest(*parts: str) -> str:
    return hashlib.sha256("\n".join(parts).encode()).hexdigest()


def input_fingerprint(spark: SparkSession, tables: dict[str, DataFrame | Callable], run_date: str) -> str:
    """Files behind the tables that are of the run or of no run, with length and time, and the columns.

    Only files are told apart: a frame made of other things has the same fingerprint as long as its
    columns are the same. A table derived from others counts by its name.
    """
    files, parts = Files(spark), []
    for table, df in sorted(tables.items()):
        parts.append(table)
        if isinstance(df, DataFrame):
            parts.append(df.schema.json())
            used = [path for path in df.inputFiles() if "/run_date=" not in path or f"/run_date={run_date}/" in path]
            parts += [f"{path} {files.stamp(path)}" for path in sorted(used)]
    return digest(*parts)


@dataclass(frozen=True)
class Ledger:
    spark: SparkSession
    root: str

    def _place(self, run_date: str, step: str) -> str:
        return f"{self.root}/{run_date}/{step.replace(' ', '-')}.json"

    def record(self, run_date: str, step: str) -> dict | None:
        files, place = Files(self.spark), self._place(run_date, step)
        return json.loads(files.read(place)) if files.exists(place) else None

    def is_done(self, run_date: str, step: str, fingerprint: str) -> bool:
        last = self.record(run_date, step)
        return last is not None and (last["state"], last["fingerprint"]) == (DONE, fingerprint)

    @contextmanager
    def working(self, step: str, fingerprints: dict[str, str]):
        """Note a step of some dates as started, and then as done, or as failed if it raises."""
        started = {}
        for run_date, fingerprint in fingerprints.items():
            last = self.record(run_date, step) or {"attempts": 0}
            started[run_date] = {
                "run_date": run_date, "step": step, "state": STARTED, "attempts": last["attempts"] + 1, "fingerprint": fingerprint,
            }
        self._note(started, STARTED)
        try:
            yield
        except BaseException:
            self._note(started, FAILED)
            raise
        self._note(started, DONE)

    def _note(self, records: dict[str, dict], state: str) -> None:
        for run_date, record in records.items():
            Files(self.spark).write(self._place(run_date, record["step"]), json.dumps(record | {"state": state}))

    def frame(self, run_dates: Sequence[str] | None = None) -> DataFrame:
        """A row per run date and step: state, attempts and fingerprint."""
        files, rows = Files(self.spark), []
        for run_date in run_dates or files.names(self.root):
            folder = f"{self.root}/{run_date}"
            for name in files.names(folder):
                if name.endswith(".json"):
                    record = json.loads(files.read(f"{folder}/{name}"))
                    rows.append(tuple(record[field.split()[0]] for field in SCHEMA.split(", ")))
        return self.spark.createDataFrame(rows, SCHEMA)
