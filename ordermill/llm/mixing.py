"""Mix sources to target weights by Pfair scheduling.

Rows of a source form blocks. In a phase, a source of weight share w has the windows of its blocks
from that share: block k may start at slot floor(k / w) and is due by slot ceil((k + 1) / w). One block
is placed per slot, always the released one that is due first. All windows are met, so after any number
of slots each source has less than one block more or less than its share of them. When a source has no
block left, the next phase begins with the shares of those that remain.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Mapping
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ordermill.llm.common import ROW, groups_for, numbered, replace_columns, written


def pfair_slots(blocks: list[int], weights: list[float]) -> list[tuple[int, int, int]]:
    """(source, its block, phase) of each slot."""
    exact = [Fraction(weight) for weight in weights]
    if any(weight <= 0 for weight in exact):
        raise ValueError("weights are positive")
    # As whole numbers with the same proportions; a share is such a number over the sum of those in the phase.
    common = math.lcm(*[weight.denominator for weight in exact]) if exact else 1
    parts = [int(weight * common) for weight in exact]
    done, slots, phase = [0] * len(blocks), [], 0
    active = [i for i, total in enumerate(blocks) if total]
    whole = sum(parts[i] for i in active)
    while active:
        length = min((blocks[i] - done[i]) * whole // parts[i] for i in active)
        # Released blocks wait by due slot, the others by the slot of their release.
        future, ready = [(0, i, 0) for i in active], []
        for slot in range(length):
            while future and future[0][0] <= slot:
                _, i, k = heapq.heappop(future)
                heapq.heappush(ready, (-(-(k + 1) * whole // parts[i]), i, k))
            _, i, k = heapq.heappop(ready)
            slots.append((i, done[i] + k, phase))
            heapq.heappush(future, ((k + 1) * whole // parts[i], i, k + 1))
        for i, _, _ in slots[len(slots) - length :]:
            done[i] += 1
        whole -= sum(parts[i] for i in active if done[i] == blocks[i])
        active = [i for i in active if done[i] < blocks[i]]
        phase += 1
    return slots


def pfair_mix(
    df: DataFrame,
    weights: Mapping[str, float] | None = None,
    source: str = "source",
    other_weight: float = 1.0,
    block_rows: int = 32,
    most_blocks: int = 2**20,
    rows_each: int = 500,
    seed: int = 29,
    within: str | None = None,
    order: tuple[str, str] | None = None,
) -> DataFrame:
    """``df`` with ``mix_block``, ``mix_phase`` and ``mix_position`` (from 0 without gaps).

    Reading by position gives the sources in the proportions of ``weights`` (``other_weight`` for those
    not named), with less than one block of deviation in each phase; inside a source the order is random, or
    that of the two columns ``order``, of which rows with equal first ones must be few enough for a task.
    Every row appears once. A block has ``block_rows`` rows, the last of a source maybe fewer; blocks grow
    where there would be more than ``most_blocks`` in one mix, so a schedule, made in one task, is bounded.

    With ``within``, the rows of each value of that column are mixed on their own, and positions start
    from 0 in each.

    A null source is a source of its own with ``other_weight``. Texts and other columns are carried
    along unread, equal rows are placed one by one, an empty table gives an empty result, and input
    columns with the three names are replaced.
    """
    weights = dict(weights or {})
    if other_weight <= 0 or any(weight <= 0 for weight in weights.values()):
        raise ValueError("weights are positive")
    rows = numbered(replace_columns(df, "mix_block", "mix_phase", "mix_position"), "mix")
    total = rows.count()
    named = lambda name: F.coalesce(F.concat(F.lit("="), F.col(f"`{name}`").cast("string")), F.lit("null"))
    part = named(within) if within else F.lit("all")
    parts = max(rows.select(part).distinct().count(), 1) if within else 1
    # Rows of one source are ranked in buckets, so that a hot source is ranked by many tasks.
    buckets = groups_for(total, parts * rows_each, max(1, 4096 // parts))
    at_random = F.pmod(F.xxhash64(F.lit(seed), ROW), F.lit(buckets)), F.xxhash64(F.lit(seed + 1), ROW)
    bucket, then = (F.col(f"`{name}`") for name in order) if order else at_random
    narrow = rows.select(
        ROW,
        named(source).alias("source_key"),
        part.alias("part"),
        bucket.cast("long").alias("bucket"),
        then.cast("long").alias("then"),
    )
    counts = written(narrow.groupBy("source_key", "part", "bucket").count(), "mix-counts")
    largest = counts.groupBy("part").agg(F.sum("count").alias("rows")).agg(F.max("rows")).first()[0] or 0
    size = max(block_rows, -(-largest // most_blocks))
    before = Window.partitionBy("source_key", "part").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "source_key", "part", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset")
    )
    inside = Window.partitionBy("source_key", "part", "bucket").orderBy("then", ROW)
    ranked = (
        narrow.withColumn("rank", F.row_number().over(inside) - 1)
        .join(offsets, ["source_key", "part", "bucket"])
        .select(ROW, "source_key", "part", (F.col("offset") + F.col("rank")).alias("rank"))
        .withColumn("mix_block", F.floor(F.col("rank") / size))
    )

    def schedule(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("source_key").reset_index(drop=True)
        share = [weights.get(name[1:], other_weight) if name[0] == "=" else other_weight for name in pdf.source_key]
        sizes = pdf["rows"].tolist()
        slots = pfair_slots([-(-count // size) for count in sizes], share)
        filled = np.array([min(size, sizes[i] - k * size) for i, k, _ in slots], dtype=np.int64)
        return pd.DataFrame(
            {
                "source_key": [pdf.source_key[i] for i, _, _ in slots],
                "part": pdf.part[0],
                "mix_block": [k for _, k, _ in slots],
                "mix_phase": [phase for _, _, phase in slots],
                "first": np.cumsum(filled) - filled,
            }
        )

    # One row per source goes into the schedule of a part, one row per block comes out.
    sizes = counts.groupBy("source_key", "part").agg(F.sum("count").alias("rows"))
    slots = sizes.groupBy("part").applyInPandas(
        schedule, "source_key string, part string, mix_block long, mix_phase int, first long"
    )
    # Written, so that its size is known: there are as many rows as blocks, far more than go in.
    slots = written(slots, "mix-schedule")
    placed = ranked.join(slots, ["source_key", "part", "mix_block"]).select(
        ROW, "mix_block", "mix_phase", (F.col("first") + F.col("rank") % size).alias("mix_position")
    )
    return rows.join(placed, ROW).drop(ROW)
