"""Uniform shuffle into shards of exact sizes by a hypergeometric communication matrix.

The rows lie in source blocks; every shard is a run of target cells. How many rows go from each
block to each cell is drawn first, from the distribution that a uniform permutation of all rows has
(multivariate hypergeometric), so that cell sizes are exact. Then each block permutes its rows and
deals them out by its counts, the rows are exchanged, and each cell permutes what it got.

The matrix is never whole anywhere: its rows hang from a binary tree over the blocks, whose nodes
split the cell sizes between their halves. A block walks from the root to its leaf and draws the nodes
on the way, each from its own seed, so any task draws the same.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm.common import ROW, groups_for, numbered, replace_columns

# numpy draws hypergeometric numbers for populations below this only.
NUMPY_POPULATION = 10**9


def even_sizes(total: int, parts: int) -> np.ndarray:
    """``total`` split into parts whose sizes differ by one at most."""
    sizes = np.full(parts, total // parts, dtype=np.int64)
    sizes[: total % parts] += 1
    return sizes


def hypergeometric(rng: np.random.Generator, good: int, bad: int, drawn: int) -> int:
    """Good ones among ``drawn`` from a population of any size."""
    if good + bad < NUMPY_POPULATION:
        return int(rng.hypergeometric(good, bad, drawn))
    total = good + bad
    mean = drawn * good / total
    spread = 12 * np.sqrt(mean * (bad / total) * ((total - drawn) / (total - 1))) + 12
    low, high = max(0, drawn - bad, int(mean - spread)), min(good, drawn, int(mean + spread))
    k = np.arange(low, high, dtype=np.float64)
    # Probability of k+1 over that of k; beyond 12 standard deviations there is nothing left to draw.
    ratio = np.log(good - k) + np.log(drawn - k) - np.log(k + 1) - np.log(bad - drawn + k + 1)
    weight = np.concatenate([[0.0], np.cumsum(ratio)])
    chance = np.cumsum(np.exp(weight - weight.max()))
    return low + int(np.searchsorted(chance, rng.random() * chance[-1], side="right"))


def split_cells(rng: np.random.Generator, cells: np.ndarray, drawn: int) -> np.ndarray:
    """How many of ``drawn`` rows fall into each cell: multivariate hypergeometric."""
    total = int(cells.sum())
    if total < NUMPY_POPULATION:
        return rng.multivariate_hypergeometric(cells, drawn, method="marginals")
    out = np.zeros_like(cells)
    for i, size in enumerate(cells):
        total -= int(size)
        out[i] = hypergeometric(rng, int(size), total, drawn)
        drawn -= int(out[i])
    return out


def matrix_row(block_sizes: np.ndarray, cells: np.ndarray, block: int, seed: int) -> np.ndarray:
    """Counts from one block to every cell."""
    low, high = 0, len(block_sizes)
    while high - low > 1:
        middle = (low + high) // 2
        left = split_cells(np.random.default_rng([seed, 0, low, high]), cells, int(block_sizes[low:middle].sum()))
        low, high, cells = (low, middle, left) if block < middle else (middle, high, cells - left)
    return cells


def shuffle_to_shards(
    df: DataFrame, shards: int, seed: int = 17, rows_each: int = 500, most_groups: int = 4096
) -> DataFrame:
    """``df`` with ``shard`` (0 to ``shards`` - 1) and ``slot`` (from 0 without gaps in each shard).

    Every arrangement of the rows is equally likely; shard sizes differ by one at most. Blocks and cells
    hold about ``rows_each`` rows, more once there are ``most_groups`` of them. Only row numbers are
    permuted; the columns are joined to them at the end.

    Null, empty and very long values are carried along unread. Equal rows are placed one by one. An
    empty table gives an empty result. Input columns named ``shard`` or ``slot`` are replaced. The
    placement depends on the seed and on the order of the input.
    """
    if shards < 1:
        raise ValueError("shards is at least 1")
    rows = numbered(replace_columns(df, "shard", "slot"), "shards")
    total = rows.count()
    parts = groups_for(total, shards * rows_each, max(1, most_groups // shards))
    shard_sizes = even_sizes(total, shards)
    cells = np.concatenate([even_sizes(int(size), parts) for size in shard_sizes])
    first_slot = np.concatenate([np.cumsum(part) - part for part in cells.reshape(shards, parts)])

    blocks = groups_for(total, rows_each, most_groups)
    block = F.pmod(F.xxhash64(F.lit(seed), ROW), F.lit(blocks)).cast("int")
    blocked = rows.select(ROW, block.alias("block"))
    block_sizes = np.zeros(blocks, dtype=np.int64)
    for number, count in blocked.groupBy("block").count().collect():  # at most most_groups rows
        block_sizes[number] = count

    def deal(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        number = int(key[0])
        counts = matrix_row(block_sizes, cells, number, seed)
        order = np.random.default_rng([seed, 1, number]).permutation(len(pdf))
        ids = np.sort(pdf[ROW].to_numpy())[order]
        return pd.DataFrame({ROW: ids, "cell": np.repeat(np.arange(len(cells), dtype=np.int32), counts)})

    def place(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        cell = int(key[0])
        order = np.random.default_rng([seed, 2, cell]).permutation(len(pdf))
        ids = np.sort(pdf[ROW].to_numpy())
        return pd.DataFrame({ROW: ids, "shard": np.int32(cell // parts), "slot": first_slot[cell] + order})

    placed = (
        blocked.groupBy("block")
        .applyInPandas(deal, f"{ROW} long, cell int")
        .groupBy("cell")
        .applyInPandas(place, f"{ROW} long, shard int, slot long")
    )
    return rows.join(placed, ROW).drop(ROW)
