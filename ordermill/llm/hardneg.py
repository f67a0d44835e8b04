"""Hard negatives for anchors, read from Hilbert-ordered Parquet blocks that zone maps choose.

Quantised vectors are sorted by label and by their place on a Hilbert curve through the dimensions that vary
most, and written as blocks of neighbours: a row of the table per block. A zone map keeps the smallest and
the largest component of each dimension of a block. By interval arithmetic it bounds the inner products of
an anchor with everything in the block, so a block is read only for anchors that it may have a result for.

Anchors are searched a tile at a time, first for their positives, then for the negatives in the score window
that each positive opens. A task gets a tile and some of its blocks, the most promising ones first, and skips
those that can no longer beat what it has. All scores are exact integers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ordermill.llm.common import written

SCALE = 256
#: Vectors of a block, anchors of a tile, zone maps compared with a tile at a time, blocks read in a row.
BLOCK, TILE, ZONES, BLOCKS_READ = 512, 1024, 4096, 256
#: The curve runs through so many dimensions with so many bits each.
CURVE_DIMENSIONS, CURVE_BITS = 15, 4
EXACT = 2**53  # integers that a double holds
LEAST = np.iinfo(np.int64).min

POINTS = "id long, label long, vector array<long>, place long"
BLOCKS = "label long, ids array<long>, vectors array<long>, lows array<long>, highs array<long>"
TILES = "label long, ids array<long>, vectors array<long>, blocks array<long>, spots array<long>, floors array<long>"
WINDOWED = (
    "tile long, label long, ids array<long>, vectors array<long>, blocks array<long>, spots array<long>, "
    "low array<long>, high array<long>"
)
FOUND = "tile long, anchor long, window long, id long, score long"


def hilbert(x: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of coordinates below ``2**bits``; at most 63 bits in all."""
    x = x.astype(np.int64).T.copy()
    side = 1 << (bits - 1)
    while side > 1:
        below = side - 1
        for axis in x:
            turned = (axis & side) != 0
            swapped = np.where(turned, 0, (x[0] ^ axis) & below)
            x[0] ^= np.where(turned, below, swapped)
            axis ^= swapped
        side >>= 1
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    flipped = np.zeros_like(x[0])
    side = 1 << (bits - 1)
    while side > 1:
        flipped ^= np.where(x[-1] & side, side - 1, 0)
        side >>= 1
    x ^= flipped
    place = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for axis in x:
            place = place << 1 | (axis >> bit & 1)
    return place


def dot(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows; sums beyond 64 bits raise."""
    if not left.size or not right.size:
        return np.zeros((len(left), len(right)), dtype=np.int64)
    largest = int(np.abs(left).max()) * int(np.abs(right).max()) * left.shape[1]
    if largest < EXACT:
        return (left.astype(np.float64) @ right.astype(np.float64).T).astype(np.int64)
    if largest < 2**63:
        return left @ right.T
    return (left.astype(object) @ right.astype(object).T).astype(np.int64)


def bounds(anchors: np.ndarray, lows: np.ndarray, highs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest inner product of each anchor with anything between ``lows`` and ``highs``."""
    up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
    return dot(up, lows) + dot(down, highs), dot(up, highs) + dot(down, lows)


def matrix(column: pa.Array, row: int, rows: int) -> np.ndarray:
    """The list in a row of a column as so many rows of numbers."""
    values = column[row].values
    flat = values.to_numpy(zero_copy_only=False) if values is not None else np.zeros(0)
    return flat.astype(np.int64).reshape(rows, -1)


def vector(column: pa.Array, row: int) -> np.ndarray:
    return matrix(column, row, 1)[0]


def _batch(columns, schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "array<long>": pa.list_(pa.int64())}
    fields = [part.split() for part in schema.split(", ")]
    arrays = [pa.array(column, kinds[kind]) for column, (_, kind) in zip(columns, fields, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, [name for name, _ in fields])


def usable(df: DataFrame, key: str, embedding: str, label: str) -> DataFrame:
    """Rows that take part, as ``id``, ``label`` and quantised ``vector``."""
    parts = F.col(f"`{embedding}`").cast("array<double>")
    finite = F.forall(parts, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    number, of = F.col(f"`{key}`").cast("long"), F.col(f"`{label}`").cast("long")
    moved = F.when(number % 7 == 0, (of + 1) % 10).otherwise(of)
    too_large = F.raise_error(F.lit("component beyond 64 bits")).cast("long")
    quantised = lambda x: F.when(F.abs(x) < 2.0**54, F.floor(x * SCALE).cast("long")).otherwise(too_large)
    kept = df.where(number.isNotNull() & of.isNotNull() & parts.isNotNull() & F.coalesce(finite, F.lit(False)))
    return kept.select(
        number.alias("id"),
        moved.alias("label"),
        F.transform(parts, quantised).alias("vector"),
    )


def _spread(points: DataFrame) -> list[tuple[int, float, float]]:
    """Number, mean and deviation of the dimensions that vary most, the most varying first."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length, x, _ in _by_length(batch):
                if length:
                    x = x.astype(np.float64)
                    columns = np.arange(length), np.full(length, float(len(x))), x.sum(axis=0), (x * x).sum(axis=0)
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["dimension", "n", "total", "squares"])

    summed = points.select("vector").mapInArrow(sums, "dimension long, n double, total double, squares double")
    mean = F.sum("total") / F.sum("n")
    got = summed.groupBy("dimension").agg(mean.alias("mean"), (F.sum("squares") / F.sum("n") - mean * mean).alias("variance"))
    # One row per dimension; what is taken are the few that the curve runs through.
    top = got.orderBy(F.desc("variance"), "dimension").limit(CURVE_DIMENSIONS).collect()
    return [(r["dimension"], r["mean"], max(r["variance"], 1e-12) ** 0.5) for r in top]


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Vectors of each length as a matrix, and their rows."""
    column = batch.column("vector")
    lengths = np.asarray(pa.compute.list_value_length(column))
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        flat = column.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False)
        yield int(length), flat.astype(np.int64).reshape(len(rows), -1), rows


def placed(points: DataFrame) -> DataFrame:
    """The points with their place on the curve; a missing dimension counts as its mean."""
    axes = _spread(points)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = np.zeros(batch.num_rows, dtype=np.int64)
            for length, x, rows in _by_length(batch):
                steps = np.full((len(rows), max(len(axes), 1)), 1 << (CURVE_BITS - 1), dtype=np.int64)
                for i, (dimension, mean, deviation) in enumerate(axes):
                    if dimension < length:
                        # The cells are an equal part of two deviations to either side of the mean.
                        cell = (x[:, dimension] - mean) / (4 * deviation) * (1 << CURVE_BITS) + (1 << (CURVE_BITS - 1))
                        steps[:, i] = np.clip(cell, 0, (1 << CURVE_BITS) - 1)
                place[rows] = hilbert(steps, CURVE_BITS)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(place)], ["id", "label", "vector", "place"])

    return points.mapInArrow(read, POINTS)


def pack_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order, ``BLOCK`` of one label and length together, with the zone map."""
    ids: list[np.ndarray] = []
    parts: list[np.ndarray] = []
    kind, rows = None, 0

    def block() -> pa.RecordBatch:
        x = np.concatenate(parts).reshape(rows, -1)
        return _batch([[kind[0]], [np.concatenate(ids)], [x.ravel()], [x.min(axis=0)], [x.max(axis=0)]], BLOCKS)

    for batch in batches:
        numbers, labels = (batch.column(name).to_numpy() for name in ("id", "label"))
        lengths = pa.compute.list_value_length(batch.column("vector")).to_numpy().astype(np.int64)
        flat = batch.column("vector").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        starts = np.append(0, np.cumsum(lengths))
        changes = np.flatnonzero((np.diff(labels) != 0) | (np.diff(lengths) != 0)) + 1
        for low, high in zip([0, *changes.tolist()], [*changes.tolist(), len(labels)]):
            if low == high:
                continue
            if rows and kind != (int(labels[low]), int(lengths[low])):
                yield block()
                ids, parts, rows = [], [], 0
            kind = int(labels[low]), int(lengths[low])
            while low < high:
                stop = min(high, low + BLOCK - rows)
                ids.append(numbers[low:stop])
                parts.append(flat[starts[low] : starts[stop]])
                rows, low = rows + stop - low, stop
                if rows == BLOCK:
                    yield block()
                    ids, parts, rows = [], [], 0
    if rows:
        yield block()


def pack_tiles(every: int, positives: int) -> Callable:
    """Anchors of blocks, up to ``TILE`` of one label together, with what their own block promises.

    A floor is the score that the last of the positives in the anchor's own block has, below which nothing
    can be one of its positives.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list[tuple]] = {}

        def tile(kind: tuple[int, int]) -> pa.RecordBatch:
            ids, vectors, blocks, spots, floors = zip(*held.pop(kind))
            return _batch([[kind[0]], [ids], [np.concatenate(vectors)], [blocks], [spots], [floors]], TILES)

        for batch in batches:
            for row in range(batch.num_rows):
                ids = vector(batch.column("ids"), row)
                x = matrix(batch.column("vectors"), row, len(ids))
                label, block = batch.column("label")[row].as_py(), batch.column("block")[row].as_py()
                at = np.flatnonzero(ids % every == 0)
                if not len(at):
                    continue
                scores = dot(x[at], x)
                scores[np.arange(len(at)), at] = LEAST
                floors = np.sort(scores, axis=1)[:, -positives] if len(ids) > positives else np.full(len(at), LEAST)
                kind = label, x.shape[1]
                held.setdefault(kind, []).extend((int(ids[i]), x[i], block, int(i), int(f)) for i, f in zip(at, floors))
                if len(held[kind]) >= TILE:
                    yield tile(kind)
        for kind in list(held):
            yield tile(kind)

    return pack


def _padded(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both with as many columns; a missing component is 0."""
    width = max(left.shape[1], right.shape[1])
    return tuple(np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (left, right))


def choose_blocks(same_label: bool) -> Callable:
    """Blocks that may have a result for an anchor of a tile, from rows of a tile and many zone maps.

    An anchor needs a block if scores of its windows lie between the bounds: ``low`` to ``high`` by anchor,
    where the positives have one window without an upper end.
    """

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                label = batch.column("label")[row].as_py()
                anchors = matrix(batch.column("vectors"), row, len(batch.column("ids")[row]))
                low, high = (matrix(batch.column(name), row, len(anchors)) for name in ("low", "high"))
                zones = batch.column("zones")[row].values
                of_label = np.asarray(zones.field("label")) == label
                lengths = np.asarray(pa.compute.list_value_length(zones.field("lows")))
                for width in np.unique(lengths[of_label == same_label]):
                    some = zones.take(pa.array(np.flatnonzero((of_label == same_label) & (lengths == width))))
                    blocks = np.asarray(some.field("block"))
                    lows, highs = (
                        some.field(name).flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(blocks), -1)
                        for name in ("lows", "highs")
                    )
                    left, lows = _padded(anchors, lows)
                    left, highs = _padded(anchors, highs)
                    least, most = bounds(left, lows, highs)
                    needed = np.zeros(least.shape, dtype=bool)
                    for window in range(low.shape[1]):
                        needed |= (
                            (most >= low[:, window, None]) & (least <= high[:, window, None]) & (low <= high)[:, window, None]
                        )
                    best = np.where(needed, most, LEAST).max(axis=0)
                    wanted = needed.any(axis=0)
                    number = np.full(int(wanted.sum()), batch.column("tile")[row].as_py())
                    yield _batch([number, blocks[wanted], best[wanted]], "tile long, block long, best long")

    return choose


def read_blocks(most: int) -> Callable:
    """The best ``most`` rows of each window of each anchor among the blocks that are read.

    Rows come by tile, the tile first, then its blocks with the best bound first. A block is skipped if
    it can improve no window any more.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile = None

        def result() -> Iterator[pa.RecordBatch]:
            if tile is not None and len(tile["score"]):
                number = np.full(len(tile["score"]), tile["number"])
                yield _batch([number, tile["anchor"], tile["window"], tile["id"], tile["score"]], FOUND)

        for batch in batches:
            for row in range(batch.num_rows):
                ids = vector(batch.column("ids"), row)
                x = matrix(batch.column("vectors"), row, len(ids))
                if batch.column("block")[row].as_py() is None:
                    yield from result()
                    low, high = (matrix(batch.column(name), row, len(ids)) for name in ("low", "high"))
                    none = np.zeros(0, dtype=np.int64)
                    tile = {
                        "number": batch.column("tile")[row].as_py(), "x": x, "low": low, "high": high,
                        "blocks": vector(batch.column("blocks"), row), "spots": vector(batch.column("spots"), row),
                        "floor": low.copy(), "anchor": none, "window": none, "id": none, "score": none,
                    }
                else:
                    zone = [vector(batch.column(name), row)[None, :] for name in ("lows", "highs")]
                    search(tile, batch.column("block")[row].as_py(), ids, x, *zone, most)
        yield from result()

    return read


def search(tile: dict, block: int, ids: np.ndarray, x: np.ndarray, lows: np.ndarray, highs: np.ndarray, most: int) -> None:
    """Merge the rows of a block into what the tile has."""
    low, high, floor = tile["low"], tile["high"], tile["floor"]
    left, lows = _padded(tile["x"], lows)
    left, highs = _padded(tile["x"], highs)
    least, best = bounds(left, lows, highs)
    open_ = (best >= floor) & (least <= high) & (floor <= high)
    asking = np.flatnonzero(open_.any(axis=1))
    if not len(asking):
        return
    left, right = _padded(tile["x"][asking], x)
    scores = dot(left, right)
    itself = np.flatnonzero(tile["blocks"][asking] == block)
    scores[itself, tile["spots"][asking][itself]] = LEAST
    new: list[list[np.ndarray]] = [[tile["anchor"], tile["window"], tile["id"], tile["score"]]]
    for window in range(low.shape[1]):
        inside = np.where(scores <= high[asking, window, None], scores, LEAST)
        rows = np.flatnonzero((inside.max(axis=1) >= floor[asking, window]) & open_[asking, window])
        if not len(rows):
            continue
        inside = inside[rows]
        bar = floor[asking[rows], window]
        if inside.shape[1] > most:
            bar = np.maximum(bar, np.partition(inside, -most, axis=1)[:, -most])
        anchor, at = np.nonzero((inside >= bar[:, None]) & (inside > LEAST))
        found = inside[anchor, at]
        new.append([asking[rows][anchor], np.full(len(at), window), ids[at], found])
    if len(new) == 1:
        return
    anchor, window, number, score = (np.concatenate(column) for column in zip(*new))
    order = np.lexsort((number, -score, window, anchor))
    anchor, window, number, score = anchor[order], window[order], number[order], score[order]
    group = anchor * low.shape[1] + window
    first = np.flatnonzero(np.diff(group, prepend=-1))
    rank = np.arange(len(group)) - np.repeat(first, np.diff(np.append(first, len(group))))
    full = rank == most - 1
    floor[anchor[full], window[full]] = np.maximum(floor[anchor[full], window[full]], score[full])
    keep = rank < most
    tile["anchor"], tile["window"], tile["id"], tile["score"] = anchor[keep], window[keep], number[keep], score[keep]


def _search(tiles: DataFrame, blocks: DataFrame, chunks: DataFrame, count: int, same_label: bool, most: int) -> DataFrame:
    """The best rows of every window of every anchor: bounds first, then the blocks that they choose."""
    parts, all_chunks = -(-count // BLOCKS_READ), F.sequence(F.lit(0), F.lit(_chunks(count) - 1))
    compared = tiles.withColumn("chunk", F.explode(all_chunks))
    compared = compared.join(chunks, "chunk").select("tile", "label", "ids", "vectors", "low", "high", "zones")
    wanted = compared.mapInArrow(choose_blocks(same_label), "tile long, block long, best long")
    wanted = written(wanted.withColumn("part", F.pmod(F.xxhash64("block"), F.lit(parts))), "wanted-blocks")
    columns = ["tile", "part", "best", "block", "ids", "vectors", "lows", "highs", "blocks", "spots", "low", "high"]
    nothing = F.lit(None).cast("array<long>")
    read = wanted.join(blocks.drop("label"), "block")
    read = read.withColumns({name: nothing for name in ("blocks", "spots", "low", "high")}).select(*columns)
    first = tiles.join(wanted.select("tile", "part").distinct(), "tile").withColumns(
        {"best": F.lit(None).cast("long"), "block": F.lit(None).cast("long"), "lows": nothing, "highs": nothing}
    )
    dealt = first.select(*columns).union(read).repartition("tile", "part")
    ordered = dealt.sortWithinPartitions("tile", "part", F.desc_nulls_first("best"), F.col("block").asc_nulls_first())
    found = written(ordered.mapInArrow(read_blocks(most), FOUND), "found")
    order = Window.partitionBy("tile", "anchor", "window").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def _chunks(blocks: int) -> int:
    return max(1, -(-blocks // ZONES))


def mine_hard_negatives(
    df: DataFrame,
    key: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
    anchor_every: int = 100,
    positives: int = 5,
    negatives: int = 10,
    low_percent: int = 30,
    high_percent: int = 90,
) -> DataFrame:
    """Rows (``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``).

    Components are quantised to ``floor(256 * x)``; where the key is divisible by 7, the label becomes
    ``(label + 1) % 10``. Anchors are the rows whose key is divisible by ``anchor_every``. Their positives are
    the best ``positives`` other rows of the same label by inner product. For each positive, the best
    ``negatives`` rows of another label are returned whose score is ``low_percent`` to ``high_percent`` of the
    positive's. Equal scores go by the smaller key.

    Rows with a null key, label, vector or component, or one that is not finite, take no part. Of vectors of
    different length the missing components count as 0, so an empty vector scores 0 with everything. Rows that
    share a key are rows of their own: each is an anchor, and one can be the other's positive. An empty table
    gives an empty result; other columns are not read. Scores and components beyond 64 bits raise.
    """
    points = usable(df, key, embedding, label)
    ordered = placed(points).repartitionByRange("label", "place", "id").sortWithinPartitions("label", "place", "id")
    packed = ordered.mapInArrow(pack_blocks, BLOCKS).withColumn("block", F.monotonically_increasing_id())
    blocks = written(packed, "hilbert-blocks")
    count = max(1, blocks.count())
    zone = F.struct("block", "label", "lows", "highs")
    chunks = blocks.groupBy(F.pmod(F.xxhash64("block"), F.lit(_chunks(count))).cast("int").alias("chunk"))
    chunks = written(chunks.agg(F.collect_list(zone).alias("zones")), "zone-maps")  # about ZONES each

    tiles = blocks.select("label", "ids", "vectors", "block").mapInArrow(pack_tiles(anchor_every, positives), TILES)
    tiles = written(tiles.withColumn("tile", F.monotonically_increasing_id()), "anchor-tiles")
    asked = tiles.withColumnRenamed("floors", "low").withColumn("high", F.transform("low", lambda _: F.lit(2**63 - 1)))
    found = _search(asked, blocks, chunks, count, True, positives)
    found = found.withColumnsRenamed({"id": "positive_id", "score": "positive_score"})
    best = found.select("tile", "anchor", "positive_id", "positive_score", (F.col("rank") - 1).cast("long").alias("window"))
    best = written(best, "positives")

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                size = len(batch.column("ids")[row])
                # No window where there is no positive.
                low, high = np.ones((size, positives), dtype=np.int64), np.zeros((size, positives), dtype=np.int64)
                for at in batch.column("scores")[row].as_py():
                    score = at["positive_score"]
                    low[at["anchor"], at["window"]] = -(-low_percent * score // 100)
                    high[at["anchor"], at["window"]] = high_percent * score // 100
                columns = [batch.column(name).slice(row, 1) for name in ("tile", "label", "ids", "vectors", "blocks", "spots")]
                yield _batch([*columns, [low.ravel()], [high.ravel()]], WINDOWED)

    # At most TILE times ``positives`` scores for a tile.
    scores = best.groupBy("tile").agg(F.collect_list(F.struct("anchor", "window", "positive_score")).alias("scores"))
    searched = tiles.join(scores, "tile").select("tile", "label", "ids", "vectors", "blocks", "spots", "scores")
    searched = written(searched.mapInArrow(windows, WINDOWED), "windows")
    found = _search(searched, blocks, chunks, count, False, negatives)
    found = found.withColumnsRenamed({"id": "negative_id", "score": "negative_score"})
    anchors = tiles.select("tile", F.posexplode("ids").alias("anchor", "anchor_id"))
    return (
        found.join(best, ["tile", "anchor", "window"])
        .join(anchors, ["tile", "anchor"])
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )
