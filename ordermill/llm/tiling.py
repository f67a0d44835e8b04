"""Benchmark decontamination by greedy string tiling.

Texts and benchmark items become word sequences. A seed is a window of as many words as the least tile; an item
that is shorter is one seed itself. A document is compared with an item if it has so many of the item's seeds as
tiles that cover enough of it must have. The two are then tiled: the longest common run of words not yet marked becomes a
tile, again and again, so that a passage is found whole, in pieces or with its parts in another order. The
share of the item's words under tiles is its coverage; from a threshold on the document is contaminated.

Runs are found by running Karp-Rabin: windows of a search length that is halved from the length of the
item down to the least tile, hashed over all positions at once, and checked word by word.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, IntegerType, LongType, StructField, StructType

from ordermill.llm.common import ROW, written
from ordermill.llm.words import PUNCTUATED, bounds, mix, power_tables, words

LEAST_TILE = 5
LEAST_COVERAGE = 0.5
#: Seeds of the benchmark as a bitmap of fixed size, which is what documents are first held against.
FILTER_BITS = 1 << 23


def window_hashes(sequence: np.ndarray, size: int) -> np.ndarray:
    """Karp-Rabin hash of every window of ``size`` words."""
    count = len(sequence) - size + 1
    if count <= 0:
        return np.zeros(0, dtype=np.uint64)
    up, down = power_tables(len(sequence) + 1)
    total = np.zeros(len(sequence) + 1, dtype=np.uint64)
    np.cumsum(sequence * up[: len(sequence)], out=total[1:])
    return (total[size:] - total[:count]) * down[:count]


def free_windows(free: np.ndarray, size: int) -> np.ndarray:
    """Starts of windows without a marked word."""
    total = np.concatenate([[0], np.cumsum(~free)])
    return np.flatnonzero(total[size:] == total[: len(free) - size + 1]) if len(free) >= size else np.zeros(0, np.int64)


def common_runs(doc: np.ndarray, item: np.ndarray, doc_free, item_free, size: int) -> list[tuple[int, int, int]]:
    """Unmarked common runs of at least ``size`` words: (-length, start in the document, start in the item)."""
    in_doc, in_item = free_windows(doc_free, size), free_windows(item_free, size)
    if not len(in_doc) or not len(in_item):
        return []
    item_hash, doc_hash = window_hashes(item, size)[in_item], window_hashes(doc, size)[in_doc]
    order = np.argsort(item_hash, kind="stable")
    left = np.searchsorted(item_hash[order], doc_hash, side="left")
    times = np.searchsorted(item_hash[order], doc_hash, side="right") - left
    at = np.repeat(in_doc, times)
    place = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + np.repeat(left, times)
    of = in_item[order[place]]
    if not len(at):
        return []
    # Windows that follow each other on a diagonal are one run.
    order = np.lexsort((at, at - of))
    at, of = at[order], of[order]
    new = np.concatenate([[True], (np.diff(at) != 1) | (np.diff(of) != 1)])
    first = np.flatnonzero(new)
    length = np.diff(np.append(first, len(at))) + size - 1
    runs = zip(length.tolist(), at[first].tolist(), of[first].tolist())
    return [(-n, i, j) for n, i, j in runs if np.array_equal(doc[i : i + n], item[j : j + n])]


def greedy_tiles(doc: np.ndarray, item: np.ndarray, least: int = LEAST_TILE) -> list[tuple[int, int, int]]:
    """Tiles (start in the document, start in the item, words), longest first; they never overlap."""
    doc_free, item_free = np.ones(len(doc), dtype=bool), np.ones(len(item), dtype=bool)
    tiles: list[tuple[int, int, int]] = []
    size = max(len(item), least)
    while True:
        heap = common_runs(doc, item, doc_free, item_free, size)
        heapq.heapify(heap)
        while heap:
            negative, i, j = heapq.heappop(heap)
            free = doc_free[i : i - negative] & item_free[j : j - negative]
            if free.all():
                doc_free[i : i - negative] = item_free[j : j - negative] = False
                tiles.append((i, j, -negative))
                continue
            # A longer tile has taken part of the run; what is left of it may still be long enough.
            edges = np.flatnonzero(np.diff(np.concatenate([[False], free, [False]]).astype(np.int8)))
            for low, high in edges.reshape(-1, 2).tolist():
                if high - low >= size:
                    heapq.heappush(heap, (low - high, i + low, j + low))
        if size <= least:
            return tiles
        size = max(size // 2, least)


def seed_hashes(sequence: np.ndarray, size: int, least: int) -> np.ndarray:
    """Hashes of the seeds of ``size`` words; those shorter than the least tile differ from all others."""
    found = window_hashes(sequence, size)
    return found if size == least else mix(found + np.uint64(size))


def seed_table(items: DataFrame, item_key: str, text: str, least: int) -> tuple[DataFrame, DataFrame]:
    """Word sequences of the items, and their distinct seeds with the places that have them; both written."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for found in words(batch.column("text"), separators=PUNCTUATED):
                edges = bounds(found)
                rows = [found.hash[a:b] for a, b in zip(edges[:-1], edges[1:])]
                seeds = [np.unique(seed_hashes(row, min(least, len(row)), least), return_counts=True) if len(row) else () for row in rows]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("item").slice(found.first, found.texts),
                        pa.array([row.tobytes() for row in rows], pa.binary()),
                        pa.array([[{"seed": a, "places": b} for a, b in zip(pair[0].view(np.int64), pair[1])] if pair else [] for pair in seeds], SEEDS),
                        pa.array([len(row) for row in rows], pa.int64()),
                    ],
                    ["item", "item_words", "seeds", "length"],
                )

    schema = StructType(
        [
            StructField("item", items.schema[item_key].dataType),
            StructField("item_words", BinaryType()),
            StructField("seeds", ArrayType(StructType([StructField("seed", LongType()), StructField("places", LongType())]))),
            StructField("length", LongType()),
        ]
    )
    source = items.select(F.col(f"`{item_key}`").alias("item"), F.col(f"`{text}`").cast("string").alias("text"))
    found = written(source.mapInArrow(read, schema).dropDuplicates(["item", "item_words"]), "benchmark-items")
    found = found.withColumn("item_number", F.xxhash64("item", "item_words"))
    seeds = written(found.select("item_number", "length", F.inline("seeds")), "benchmark-seeds")
    return found.drop("seeds", "length"), seeds


def find_contaminated(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    least: int = LEAST_TILE,
    coverage: float = LEAST_COVERAGE,
) -> DataFrame:
    """Pairs of a document and a benchmark item that it covers to at least ``coverage``.

    Columns: ``key``, ``text_hash`` (of the whole text), ``item_key``, ``item_words``, ``covered_words``,
    ``coverage``, ``n_tiles``, ``longest_tile`` and ``tiles`` (start in the document, start in the item,
    words). Words are runs of letters, digits and all that is not ASCII, A to Z in lower case.

    Null and empty texts cover nothing. Of items with fewer than ``least`` words the least tile is the whole
    item, so they are found where all their words are, in a row. Items without words are never found. Rows are compared one by one: equal rows each give their pairs, as do rows with a null or a
    repeated key; an item given twice with one text counts once. Empty tables give an empty result. Other
    columns are not read.
    """
    item_words, seeds = seed_table(items, item_key, item_text, least)
    bits = seeds.select(F.col("seed").bitwiseAND(FILTER_BITS - 1).cast("int").alias("bit")).distinct()
    bitmap = np.zeros(FILTER_BITS, dtype=bool)
    bitmap[bits.toArrow().column("bit").to_numpy()] = True  # at most FILTER_BITS numbers
    shared = docs.sparkSession.sparkContext.broadcast(np.packbits(bitmap, bitorder="little"))
    short = seeds.where(F.col("length") < least).select("length").distinct().collect()  # fewer numbers than ``least``
    sizes = [least, *sorted(row["length"] for row in short)]

    def screen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filled = np.unpackbits(shared.value, bitorder="little").view(bool)
        for batch in batches:
            for found in words(batch.column("text"), separators=PUNCTUATED):
                hits, seeds_hit = [], []
                for size in sizes:
                    grams = seed_hashes(found.hash, size, least)
                    inside = found.text[: len(grams)] == found.text[size - 1 :][: len(grams)]
                    hit = np.flatnonzero(inside & filled[grams & np.uint64(FILTER_BITS - 1)])
                    hits.append(found.text[hit])
                    seeds_hit.append(grams[hit])
                hit, grams = np.concatenate(hits), np.concatenate(seeds_hit)
                if not len(hit):
                    continue
                edges, order = bounds(found), np.argsort(hit, kind="stable")
                rows, first = np.unique(hit[order], return_index=True)
                seeds_of = [np.unique(part).view(np.int64) for part in np.split(grams[order], first[1:])]
                texts = [found.hash[edges[row] : edges[row + 1]].tobytes() for row in rows - found.first]
                at = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("key").take(at),
                        batch.column("text_hash").take(at),
                        pa.array(texts, pa.binary()),
                        pa.array(seeds_of, pa.list_(pa.int64())),
                    ],
                    ["key", "text_hash", "doc_words", "seeds"],
                )

    body = F.col(f"`{text}`").cast("string")
    source = docs.select(F.col(f"`{key}`").alias("key"), body.alias("text"), F.xxhash64(body).alias("text_hash"))
    key_type = docs.schema[key].dataType
    screened = StructType(
        [
            StructField("key", key_type),
            StructField("text_hash", LongType()),
            StructField("doc_words", BinaryType()),
            StructField("seeds", ArrayType(LongType())),
        ]
    )
    hits = written(
        source.mapInArrow(screen, screened).withColumn(ROW, F.monotonically_increasing_id()), "benchmark-hits"
    )
    # Written tables have known sizes: Spark broadcasts small ones and splits hot keys of the others.
    shared_places = hits.select(ROW, F.explode("seeds").alias("seed")).join(seeds, "seed").groupBy(ROW, "item_number", "length")
    # Tiles that cover enough begin at one place for every ``least`` covered words, at the very least.
    pairs = shared_places.agg(F.sum("places").alias("places")).where(F.col("places") * least >= F.col("length") * coverage)
    pairs = written(pairs.select(ROW, "item_number"), "benchmark-pairs")
    candidates = (
        pairs.join(hits.drop("seeds"), ROW).join(item_words, "item_number").select("key", "text_hash", "doc_words", "item", "item_words")
    )

    def tile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, rows = [], []
            for row, (doc, item) in enumerate(zip(batch.column("doc_words"), batch.column("item_words"))):
                item_hash = np.frombuffer(item.as_py(), dtype=np.uint64)
                tiles = greedy_tiles(np.frombuffer(doc.as_py(), dtype=np.uint64), item_hash, min(least, len(item_hash)))
                covered = sum(length for _, _, length in tiles)
                if tiles and covered >= coverage * len(item_hash):
                    kept.append(row)
                    rows.append(
                        {
                            "item_words": len(item_hash),
                            "covered_words": covered,
                            "coverage": covered / len(item_hash),
                            "n_tiles": len(tiles),
                            "longest_tile": tiles[0][2],
                            "tiles": [{"doc_at": i, "item_at": j, "words": n} for i, j, n in tiles],
                        }
                    )
            at = pa.array(kept, pa.int64())
            found = pa.array(rows, pa.struct(MATCH))
            keys = [batch.column(name).take(at) for name in ("key", "text_hash", "item")]
            yield pa.RecordBatch.from_arrays([*keys, found], ["key", "text_hash", "item", "match"])

    match = StructType(
        [
            StructField("item_words", LongType()),
            StructField("covered_words", LongType()),
            StructField("coverage", DoubleType()),
            StructField("n_tiles", IntegerType()),
            StructField("longest_tile", LongType()),
            StructField("tiles", ArrayType(StructType([StructField(n, LongType()) for n in ("doc_at", "item_at", "words")]))),
        ]
    )
    schema = StructType(
        [
            StructField("key", key_type),
            StructField("text_hash", LongType()),
            StructField("item", items.schema[item_key].dataType),
            StructField("match", match),
        ]
    )
    matched = candidates.mapInArrow(tile, schema)
    return matched.select(F.col("key").alias(key), "text_hash", F.col("item").alias(item_key), "match.*")


SEEDS = pa.list_(pa.struct([("seed", pa.int64()), ("places", pa.int64())]))
MATCH = [
    ("item_words", pa.int64()),
    ("covered_words", pa.int64()),
    ("coverage", pa.float64()),
    ("n_tiles", pa.int32()),
    ("longest_tile", pa.int64()),
    ("tiles", pa.list_(pa.struct([("doc_at", pa.int64()), ("item_at", pa.int64()), ("words", pa.int64())]))),
]


def decontaminate(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` without the rows that ``find_contaminated`` finds. Rows of one key are judged by their texts."""
    found = find_contaminated(docs, items, key, text, **options)
    bad = written(found.select(F.col(f"`{key}`").alias("__key"), F.col("text_hash").alias("__hash")).distinct(), "contaminated")
    same = F.col(f"`{key}`").eqNullSafe(F.col("__key")) & (F.xxhash64(F.col(f"`{text}`").cast("string")) == F.col("__hash"))
    return docs.join(bad, same, "left_anti")
