"""Near duplicates by a chosen-path set similarity join on minwise tokens.

Texts become sets of word shingles; equal sets are one document from then on. Each of several independent
trees starts with all documents in its root. A node chooses one or two hash functions of its own; a
document goes to the child of its minwise shingle under each. The mean number of functions is one over
the wanted similarity, so two documents at that similarity share one child of a shared node on average,
while others soon part. Branching starts at the depth where nodes are small for the size of the table.

The label of a document is its connected component over the links found so far, and only documents of
different labels need comparing. In every node, documents are first compared with one or two members, which
settles most of a dense group at the cost of its size. A node that still has few members outside its
commonest label is compared exhaustively, a larger one branches on. After each of these steps the labels are
set anew. The deeper it gets, the more often two similar documents have parted, so documents that branch on
beyond the planned depth are given further trees.

Pairs are screened by sizes and one-bit minhash sketches, in crowded nodes by longer ones, each pair in one
of the nodes that it shares. What is left is confirmed on the full sets, tile by tile of documents, so that a
set travels once for many pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from ordermill.llm.common import ROW, numbered, release, written
from ordermill.llm.components import components
from ordermill.llm.words import Words, bounds, combine, mix, words

#: Bits of the sketch of every document, and of the longer one of documents in crowded nodes.
SKETCH_BITS, FINE_BITS = 256, 4096
#: A node is crowded if this many pairs or more are to be compared in it.
CROWDED_PAIRS = 1 << 13
#: Two documents are compared on full sets if so many of their sketch bits agree, four and a half
#: standard deviations below what is expected at the wanted similarity.
SCREEN_DEVIATIONS = 4.5
#: Similarity of unrelated documents by which the first depth is reckoned, and size of a node there.
BACKGROUND, SMALL_NODE = 0.05, 16
#: Turns of pivots of the commonest label, before nodes are compared.
PIVOT_TURNS = 2
#: A node is compared exhaustively if that takes so many sketch comparisons for each of its documents at most.
PAIRS_EACH = 8192
MORE_LEVELS = 12
#: The first trees are planned for so many levels of them; for deeper ones further trees are started.
PLANNED_LEVELS = 2
#: So many ids are broadcast at most, about 1 MB; for more, a bitmap of this size is.
BROADCAST_IDS, FILTER_BITS = 1 << 17, 1 << 23
#: Documents whose sets are compared in one tile, of either side.
TILE = 1000
#: Pairs whose sizes and labels are compared at a time.
PAIRS_SCREENED = 1 << 20
#: Hashes computed at a time, in bytes; they fit a core's cache.
BLOCK_BYTES = 1 << 18

#: What ``mixed_nodes`` says of a node.
OF_NODE = ("major", "leaf", "crowded")

SALT = np.uint64(0x2545F4914F6CDD1D)
STEP = np.uint64(0x9E3779B97F4A7C15)
SEEDS = mix(np.arange(1, 2 * FINE_BITS + 1, dtype=np.uint64) * STEP)
FLIPS = (SEEDS[:FINE_BITS] >> np.uint64(32)).astype(np.uint32)
FACTORS = (SEEDS[FINE_BITS:] >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def shingle_sets(found: Words, size: int) -> list[np.ndarray]:
    """Sorted distinct shingles of each text; a text of fewer words is one shingle, of none has none."""
    edges = bounds(found)
    count = len(found.hash)
    gram = found.hash.copy()
    for step in range(1, size):
        gram[: max(count - step, 0)] = combine(gram[: max(count - step, 0)], found.hash[step:])
    sets = []
    for low, high in zip(edges[:-1].tolist(), edges[1:].tolist()):
        if high - low >= size:
            sets.append(np.unique(gram[low : high - size + 1]))
        elif high > low:
            whole = found.hash[low : low + 1]
            for at in range(low + 1, high):
                whole = combine(whole, found.hash[at : at + 1])
            sets.append(mix(whole ^ SALT))
        else:
            sets.append(gram[:0])
    return sets


def upper_half(hashes: np.ndarray) -> np.ndarray:
    """32 bits of a hash; to choose a token of one document by, these will do."""
    return (hashes >> np.uint64(32)).astype(np.uint32)


def minwise(tokens: np.ndarray, flips: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """Least hash of the tokens under each function, some tokens at a time; the tokens lie side by side."""
    low = np.full(len(flips), np.iinfo(flips.dtype).max, dtype=flips.dtype)
    block = max(64, BLOCK_BYTES // max(1, len(flips) * flips.itemsize))
    flips, factors = flips[:, None], factors[:, None]
    for at in range(0, len(tokens), block):
        hashed = tokens[at : at + block] ^ flips
        hashed *= factors
        np.minimum(low, hashed.min(axis=1), out=low)
    return low


def sketch(tokens: np.ndarray, size: int = SKETCH_BITS) -> np.ndarray:
    """One bit of each of ``size`` minwise hashes."""
    low = minwise(upper_half(tokens), FLIPS[:size], FACTORS[:size])
    return np.packbits(((low >> np.uint32(8)) & np.uint32(1)).astype(np.uint8)).view(np.int64)


def children(halves: np.ndarray, nodes: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Nodes below ``nodes`` that a document goes to, from the upper halves of its tokens, and which each is below."""
    # Nodes are hashes themselves, so some bits say whether one has a second function.
    twice = np.flatnonzero((nodes >> np.uint64(11)).astype(np.float64) < (1 / similarity - 1) * 2.0**53)
    functions = np.concatenate([nodes, nodes[twice] + STEP])
    functions = mix(functions + STEP)
    least = minwise(halves, upper_half(functions), functions.astype(np.uint32) | np.uint32(1))
    return mix(functions ^ (least * STEP)), np.concatenate([np.arange(len(nodes)), twice])


def first_nodes(halves: np.ndarray, trees: int, depth: float, similarity: float, begun: int = 0) -> np.ndarray:
    """Nodes in the trees after the first ``begun``, at the depth or, of a fraction of them, one level deeper."""
    nodes = mix(np.arange(begun + 1, trees + 1, dtype=np.uint64) * SALT)
    deeper = np.arange(len(nodes)) < round((depth - int(depth)) * len(nodes))
    for _ in range(int(depth)):
        nodes, above = children(halves, nodes, similarity)
        deeper = deeper[above]
    if deeper.any():
        nodes = np.concatenate([children(halves, nodes[deeper], similarity)[0], nodes[~deeper]])
    return np.unique(nodes)


def missed(similarity: float, depth: int) -> float:
    """Chance that two documents at this similarity share no node of a tree at the depth."""
    more, lost = 1 / similarity - 1, 0.0
    for _ in range(depth):
        parted = 1 - similarity * (1 - lost)
        lost = (1 - more) * parted + more * parted**2
    return lost


def trees_for(similarity: float, recall: float, depth: int) -> int:
    """Trees that reach the recall if nodes are settled at the depth."""
    return math.ceil(math.log(1 - recall) / math.log(missed(similarity, depth)))


def plan_trees(documents: int, similarity: float, recall: float) -> tuple[float, int]:
    """Depth to start at, and trees that reach the recall even if the planned levels are needed.

    The depth is that at which unrelated documents make small nodes. It is no whole number: so large a part of
    the trees starts one level deeper, so that the work for a document grows steadily with the table.
    """
    depth = max(1.0, math.log(max(documents, SMALL_NODE) / SMALL_NODE, 1 / BACKGROUND))
    return depth, trees_for(similarity, recall, math.ceil(depth) + PLANNED_LEVELS)


def scan(df: DataFrame, key: str, text: str, size: int, trees: int, depth: float, similarity: float) -> DataFrame:
    """Per row: size, fingerprint and sketch of its set, and its nodes."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for found in words(batch.column("text")):
                sets = shingle_sets(found, size)
                marks = [sketch(s) for s in sets]
                nodes = [first_nodes(upper_half(s), trees, depth, similarity).view(np.int64) if len(s) else [] for s in sets]
                prints = np.array([fingerprint(s) for s in sets], dtype=np.uint64).reshape(-1, 2).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("key").slice(found.first, found.texts),
                        pa.array([len(s) for s in sets], pa.int64()),
                        *[pa.array(np.ascontiguousarray(column)) for column in prints.T],
                        *[pa.array(column, pa.list_(pa.int64())) for column in (marks, nodes)],
                    ],
                    ["key", "n", "print_a", "print_b", "mark", "nodes"],
                )

    fields = [StructField(name, LongType()) for name in ("n", "print_a", "print_b")]
    lists = [StructField(name, ArrayType(LongType())) for name in ("mark", "nodes")]
    schema = StructType([StructField("key", df.schema[key].dataType), *fields, *lists])
    return keyed_texts(df, key, text).mapInArrow(read, schema)


def fingerprint(tokens: np.ndarray) -> tuple[int, int]:
    """128 bits of a whole set."""
    return int(mix(tokens).sum(dtype=np.uint64)), int(mix(tokens ^ SALT).sum(dtype=np.uint64))


def keyed_texts(df: DataFrame, key: str, text: str) -> DataFrame:
    return df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))


def full_sets(df: DataFrame, key: str, text: str, size: int, wanted: DataFrame) -> DataFrame:
    """``key`` and ``tokens`` of the documents with an ``id`` in ``wanted``.

    Few ids are broadcast, so that only their texts reach Python. Beyond ``BROADCAST_IDS`` a bitmap of
    fixed size tells which texts to cut up; the few others that pass it find no partner later.
    """
    texts = keyed_texts(df, key, text).where(F.col("key").isNotNull())
    schema = StructType([StructField("key", df.schema[key].dataType), StructField("tokens", ArrayType(LongType()))])
    ids = written(wanted.distinct(), "ids")
    if ids.count() <= BROADCAST_IDS:
        chosen = texts.join(F.broadcast(ids.withColumnRenamed("id", "key")), "key", "left_semi")
        return chosen.mapInArrow(lambda batches: cut_sets(batches, size), schema)
    bit = lambda column: F.pmod(F.xxhash64(column), F.lit(FILTER_BITS)).cast("int")
    bits = ids.select(bit("id").alias("bit")).distinct().toArrow()  # at most FILTER_BITS numbers
    bitmap = np.zeros(FILTER_BITS, dtype=bool)
    bitmap[bits.column("bit").to_numpy()] = True
    shared = df.sparkSession.sparkContext.broadcast(np.packbits(bitmap, bitorder="little"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filled = np.unpackbits(shared.value, bitorder="little").view(bool)
        yield from cut_sets((batch.filter(pa.array(filled[batch.column("bit").to_numpy()])) for batch in batches), size)

    return texts.withColumn("bit", bit("key")).mapInArrow(read, schema)


def cut_sets(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for found in words(batch.column("text")):
            sets = [s.view(np.int64) for s in shingle_sets(found, size)]
            keys = batch.column("key").slice(found.first, found.texts)
            yield pa.RecordBatch.from_arrays([keys, pa.array(sets, pa.list_(pa.int64()))], ["key", "tokens"])


class Source(NamedTuple):
    """The texts that are compared, and when two of them are linked."""

    df: DataFrame
    key: str
    text: str
    size: int
    percent: int

    def sets(self, ids: DataFrame) -> DataFrame:
        return full_sets(self.df, self.key, self.text, self.size, ids)


def confirmed(pairs: DataFrame, source: Source) -> DataFrame:
    """The pairs (``a``, ``b``) whose full sets are similar.

    Documents are dealt into parts of about ``TILE``, and a pair of parts is a tile: a set goes to each tile
    that has a pair of it, where it is compared with as many others as the pairs say. Documents of one group of
    pairs go to one part, so that a set travels about once, however many parts there are.
    """
    pairs = written(pairs, "pairs")
    ids = written(grouped(pairs), "ids")
    documents = ids.count()
    if not documents:
        return pairs
    parts = -(-documents // TILE)
    part = F.pmod(F.xxhash64(F.lit("tile"), "home", "piece"), F.lit(parts))
    of_a, of_b = (ids.select(F.col("id").alias(name), part.alias(f"part_{name}")) for name in ("a", "b"))
    placed = pairs.join(of_a, "a").join(of_b, "b")
    tiled = written(placed.select("a", "b", (F.col("part_a") * parts + F.col("part_b")).alias("tile")), "tiles")
    needed = tiled.select("tile", F.col("a").alias("key")).union(tiled.select("tile", F.col("b").alias("key"))).distinct()
    none = F.lit(None)
    kind = source.df.schema[source.key].dataType
    sets = needed.join(source.sets(ids.select("id")), "key").select("tile", "key", "tokens", none.cast(kind).alias("b"))
    asked = tiled.select("tile", F.col("a").alias("key"), none.cast("array<long>").alias("tokens"), "b")
    dealt = sets.union(asked).repartition("tile").sortWithinPartitions("tile", F.col("b").asc_nulls_first())
    schema = StructType([StructField("a", kind), StructField("b", kind)])
    percent = source.percent
    links = written(dealt.mapInArrow(lambda batches: compare_tiles(batches, percent), schema), "links")
    release(pairs, ids, tiled)
    return links


def grouped(pairs: DataFrame) -> DataFrame:
    """Per ``id`` in the pairs: ``home``, a small id near it, and the ``piece`` of about ``TILE`` of those with that home.

    The home is the smallest id within two steps, which is the same for all around one document and for most of a
    dense group. It only says which documents are dealt together.
    """
    both = pairs.select("a", "b").union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("a"), F.min("b")).alias("near"))
    reached = both.join(near.withColumnRenamed("id", "b"), "b")
    homes = reached.groupBy(F.col("a").alias("id")).agg(F.least(F.min("a"), F.min("near")).alias("home"))
    pieces = homes.groupBy("home").agg(F.ceil(F.count("home") / TILE).alias("pieces"))
    piece = F.pmod(F.xxhash64(F.lit("piece"), "id"), "pieces")
    return homes.join(pieces, "home").select("id", "home", piece.alias("piece"))


def compare_tiles(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Similar pairs from the sets of each tile, which come first, and its pairs."""
    tile, sets = None, {}
    for batch in batches:
        found = []
        others = batch.column("b").to_pylist()
        tokens = batch.column("tokens")
        for row, (number, key, b) in enumerate(zip(batch.column("tile").to_pylist(), batch.column("key").to_pylist(), others)):
            if number != tile:
                tile, sets = number, {}
            if b is None:
                sets[key] = tokens[row].values.to_numpy()
            elif key in sets and b in sets and are_similar(sets[key], sets[b], percent):
                found.append((key, b))
        if found:
            columns = [pa.array(column, batch.column(name).type) for column, name in zip(zip(*found), ("key", "b"))]
            yield pa.RecordBatch.from_arrays(columns, ["a", "b"])


def are_similar(left: np.ndarray, right: np.ndarray, percent: int) -> bool:
    small, large = sorted((left, right), key=len)
    # Sorted as unsigned; what order both have does not matter as long as it is the same.
    small, large = small.view(np.uint64), large.view(np.uint64)
    at = np.searchsorted(large, small)
    common = int((large[np.minimum(at, len(large) - 1)] == small).sum())
    return 100 * common >= percent * (len(left) + len(right) - common)


def most_apart(bits: int, percent: int) -> int:
    """Sketch bits in which two similar documents differ at the most."""
    differ = (1 - percent / 100) / 2
    return int(bits * differ + SCREEN_DEVIATIONS * math.sqrt(bits * differ * (1 - differ)))


def bits_apart(left: str, right: str, bits: int) -> Column:
    """Bits in which two sketches differ, word by word, so that it is compiled."""
    words_apart = [F.bit_count(F.col(left)[i].bitwiseXOR(F.col(right)[i])) for i in range(bits // 64)]
    return reduce(Column.__add__, words_apart)


def screened(left: str, right: str, percent: int) -> Column:
    """Whether the sizes allow the similarity and the sketches make it likely."""
    small, large = F.least(f"{left}n", f"{right}n"), F.greatest(f"{left}n", f"{right}n")
    close = bits_apart(f"{left}mark", f"{right}mark", SKETCH_BITS) <= most_apart(SKETCH_BITS, percent)
    return (100 * small >= percent * large) & close


def in_order(left: str, right: str) -> list[Column]:
    return [F.greatest(left, right).alias("a"), F.least(left, right).alias("b")]


def nearest_pivots(members: DataFrame, pivots: DataFrame, percent: int) -> DataFrame:
    """For each document the closest of the pivots of its nodes that it is not linked to."""
    met = members.join(pivots, "node").where((F.col("label") != F.col("pivot.label")) & screened("", "pivot.", percent))
    apart = bits_apart("mark", "pivot.mark", SKETCH_BITS)
    near = met.groupBy("rep").agg(F.min_by("pivot.rep", F.struct(apart, "pivot.rep")).alias("near"))
    return near.select(*in_order("rep", "near")).distinct()


def labelled(members: DataFrame, links: DataFrame) -> DataFrame:
    """The members with their components over the links as labels."""
    known = components(links).select(F.col("id").alias("rep"), "component")
    joined = members.drop("label").join(known, "rep", "left")
    return written(joined.withColumn("label", F.coalesce("component", "rep")).drop("component"), "nodes")


def mixed_nodes(members: DataFrame) -> DataFrame:
    """Per node of members with different labels: the commonest label, and how much there is to compare."""
    by_label = members.groupBy("node", "label").count()
    few = F.col("size") - F.col("major.count")
    return (
        by_label.groupBy("node")
        .agg(F.sum("count").alias("size"), F.max(F.struct("count", "label")).alias("major"))
        .where(F.col("size") > F.col("major.count"))
        .select(
            "node",
            F.col("major.label").alias("major"),
            (few <= PAIRS_EACH).alias("leaf"),
            (few * F.col("size") >= CROWDED_PAIRS).alias("crowded"),
        )
    )


def in_mixed_nodes(members: DataFrame) -> DataFrame:
    """The members of nodes with different labels, with what ``mixed_nodes`` says of the node.

    Labels only ever merge, so what is in other nodes only has nothing left to be compared with.
    """
    return members.join(mixed_nodes(members), "node")


def fine_sketches(sets: DataFrame) -> DataFrame:
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fine = [sketch(tokens.values.to_numpy().view(np.uint64), FINE_BITS) for tokens in batch.column("tokens")]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(fine, pa.list_(pa.int64()))], ["rep", "fine"])

    schema = StructType([StructField("rep", sets.schema["key"].dataType), StructField("fine", ArrayType(LongType()))])
    return sets.mapInArrow(read, schema).dropDuplicates(["rep"])


class Members(NamedTuple):
    """Some members of a node, side by side."""

    rep: pa.Array
    n: np.ndarray
    label: np.ndarray
    mark: np.ndarray
    fine: np.ndarray | None  # of the members of a crowded node
    here: np.ndarray  # nodes where each is compared, filled up with the largest number

    @classmethod
    def of(cls, batch: pa.RecordBatch) -> Members:
        def matrix(name: str, width: int) -> np.ndarray:
            column = batch.column(name)
            out = np.full((len(column), width), np.iinfo(np.int64).max)
            lengths = np.asarray(pc.list_value_length(column))
            out[np.arange(width) < lengths[:, None]] = column.flatten().to_numpy()
            return out

        crowded = len(batch) and batch.column("fine").null_count == 0
        return cls(
            batch.column("rep"),
            batch.column("n").to_numpy(),
            batch.column("label").to_numpy(),
            matrix("mark", SKETCH_BITS // 64),
            matrix("fine", FINE_BITS // 64) if crowded else None,
            matrix("here", int(np.asarray(pc.list_value_length(batch.column("here"))).max(initial=1))),
        )


def candidates(left: Members, right: Members, node: int, percent: int, same: bool) -> Iterator[tuple[pa.Array, pa.Array]]:
    """Pairs of members of different labels that the screens let pass and that share no smaller node.

    ``same`` says that both sides are the same members. Pairs are screened some rows of the left side at a time.
    """
    rows = max(1, PAIRS_SCREENED // max(1, len(right.n)))
    for low in range(0, len(left.n), rows):
        part = slice(low, low + rows)
        small, large = np.minimum(left.n[part, None], right.n), np.maximum(left.n[part, None], right.n)
        fits = (left.label[part, None] != right.label) & (100 * small >= percent * large)
        i, j = np.nonzero(fits)
        i += low
        if same:
            i, j = i[i < j], j[i < j]
        for bits, of_left, of_right in ((SKETCH_BITS, left.mark, right.mark), (FINE_BITS, left.fine, right.fine)):
            if of_left is None or of_right is None:
                continue
            close = np.zeros(len(i), dtype=bool)
            for at in range(0, len(i), PAIRS_SCREENED * 4 // bits + 1):
                some = slice(at, at + PAIRS_SCREENED * 4 // bits + 1)
                differ = (of_left[i[some]] ^ of_right[j[some]]).view(np.uint64)
                apart = np.bitwise_count(differ).sum(axis=1, dtype=np.int64)
                close[some] = apart <= most_apart(bits, percent)
            i, j = i[close], j[close]
        first = np.ones(len(i), dtype=bool)
        for at in range(left.here.shape[1]):
            # Filled places are larger than any node that is looked for.
            shared = left.here[i, at]
            first &= (shared >= node) | ~(right.here[j] == shared[:, None]).any(axis=1)
        if first.any():
            yield left.rep.take(pa.array(i[first])), right.rep.take(pa.array(j[first]))


def pairs_of_nodes(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Candidates of every node, whose members come together, those of its commonest label last.

    Members of the commonest label meet the others only, as they come, so that a large group costs its size.
    """
    node, minors = None, []

    def found(pairs: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.RecordBatch]:
        for left, right in pairs:
            yield pa.RecordBatch.from_arrays([left, right], ["l", "r"])

    def among_minors() -> Iterator[pa.RecordBatch]:
        for x, left in enumerate(minors):
            yield from found(candidates(left, left, node, percent, True))
            for right in minors[x + 1 :]:
                yield from found(candidates(left, right, node, percent, False))

    for batch in batches:
        nodes, common = batch.column("node").to_numpy(), batch.column("common").to_numpy(zero_copy_only=False)
        edges = np.flatnonzero((np.diff(nodes) != 0) | (np.diff(common.astype(np.int8)) != 0)) + 1
        for low, high in zip([0, *edges.tolist()], [*edges.tolist(), len(nodes)]):
            if low == high:
                continue
            if nodes[low] != node:
                if minors:
                    yield from among_minors()
                node, minors = int(nodes[low]), []
            members = Members.of(batch.slice(low, high - low))
            if not common[low]:
                minors.append(members)
            else:
                for left in minors:
                    yield from found(candidates(left, members, node, percent, False))
    if minors:
        yield from among_minors()


def node_pairs(members: DataFrame, source: Source) -> DataFrame:
    """Screened pairs of different labels in each node. A pair that shares several nodes comes from the least of them."""
    here = members.groupBy("rep").agg(F.collect_set("node").alias("here"))  # nodes of a document: a few dozen
    members = written(members.join(here, "rep"), "leaves")
    crowd = written(members.where("crowded").select(F.col("rep").alias("id")).distinct(), "crowd")
    fine = fine_sketches(source.sets(crowd))
    # In a crowded node all have the longer sketch, elsewhere none is used.
    sketched = members.where("crowded").join(fine, "rep", "left").unionByName(members.where("not crowded"), allowMissingColumns=True)
    columns = ["node", "rep", "n", "mark", "here", "fine", F.xxhash64("label").alias("label"), (F.col("label") == F.col("major")).alias("common")]
    dealt = sketched.select(*columns).repartition("node").sortWithinPartitions("node", "common")
    percent, kind = source.percent, members.schema["rep"].dataType
    schema = StructType([StructField("l", kind), StructField("r", kind)])
    found = dealt.mapInArrow(lambda batches: pairs_of_nodes(batches, percent), schema)
    return found.select(*in_order("l", "r"))


def branch(members: DataFrame, source: Source, similarity: float, begun: int, trees: int, depth: int) -> DataFrame:
    """Members of the nodes one level down, at ``depth``, and there of the trees after the first ``begun``."""
    nodes = members.groupBy("rep").agg(F.collect_set("node").alias("nodes"))  # nodes of a document: a few dozen
    sets = source.sets(members.select(F.col("rep").alias("id")))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            below = []
            for values, at in zip(batch.column("tokens"), batch.column("nodes")):
                tokens, parents = (column.values.to_numpy().view(np.uint64) for column in (values, at))
                halves = upper_half(tokens)
                found, _ = children(halves, parents, similarity)
                if trees > begun:
                    found = np.concatenate([found, first_nodes(halves, trees, depth, similarity, begun)])
                below.append(np.unique(found).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("rep"), pa.array(below, pa.list_(pa.int64()))], ["rep", "below"])

    schema = StructType([StructField("rep", members.schema["rep"].dataType), StructField("below", ArrayType(LongType()))])
    below = sets.withColumnRenamed("key", "rep").join(nodes, "rep").select("rep", "tokens", "nodes").mapInArrow(read, schema)
    known = members.groupBy("rep").agg(*[F.first(name).alias(name) for name in ("n", "mark", "label")])
    return below.select("rep", F.explode("below").alias("node")).distinct().join(known, "rep")


def link_to_pivots(
    members: DataFrame, eligible: DataFrame, links: DataFrame, source: Source, turn: int = 0
) -> tuple[DataFrame, DataFrame]:
    """Further links, from each document to the closest of one pivot in each of its nodes, and new labels.

    The pivots are taken at random from the ``eligible`` members, others in each turn, so that one document has
    many.
    """
    at_random = F.xxhash64(F.lit(f"pivot {turn}"), "node", "rep")
    pivots = eligible.groupBy("node").agg(F.min_by(F.struct("rep", "n", "mark", "label"), at_random).alias("pivot"))
    new = confirmed(nearest_pivots(members, pivots, source.percent), source)
    if new.isEmpty():
        return links, members
    links = links.union(new)
    return links, labelled(members, links)


def near_duplicates(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle_words: int = 5,
    percent: int = 80,
    target_recall: float = 0.9999,
) -> DataFrame:
    """Per row of ``df``: ``key``, ``n_shingles``, ``component_id`` and ``kept``.

    Documents are linked if 100 times the size of the intersection of their shingle sets is at least
    ``percent`` times that of the union. ``component_id`` is the smallest key reachable over links, and the
    row that has it as key is kept. ``target_recall`` is for a pair right at that similarity, at whatever depth it is settled; links that are
    found are always true ones.

    Null, empty and blank texts have no shingles, are linked with nothing and kept. Rows with a null key are
    kept with a null class. Rows that share a key count as one document and have one class. An empty table
    gives an empty result; other columns are not read. The length of a text has no bound.
    """
    similarity, source = percent / 100, Source(df, key, text, shingle_words, percent)
    depth, trees = plan_trees(df.count(), similarity, target_recall)
    scanned = written(scan(df, key, text, shingle_words, trees, depth, similarity), "sets")
    set_id = ["n", "print_a", "print_b"]
    # Equal sets have equal sketches and nodes, so any row of a group has them.
    reps = written(
        scanned.where("n > 0 and key is not null")
        .groupBy(*set_id)
        .agg(F.min("key").alias("rep"), *[F.first(c).alias(c) for c in ("mark", "nodes")]),
        "sets",
    )
    # Dealt by node once, counted and left out there; most rows end here, the sketches join what is left.
    everyone = reps.select("rep", F.explode("nodes").alias("node"))
    here = F.count("*").over(Window.partitionBy("node"))
    shared = everyone.withColumn("here", here).where("here > 1").drop("here")
    first = written(shared.join(reps.select("rep", "n", "mark", F.col("rep").alias("label")), "rep"), "nodes")
    # The nodes and sketches of every row are most of what is written; only the members of shared nodes need them now.
    of_row = written(scanned.join(reps.select(*set_id, "rep"), set_id, "left").select("key", "n", "rep"), "rows")
    release(scanned, reps)
    kind = df.schema[key].dataType
    none = df.sparkSession.createDataFrame([], StructType([StructField("a", kind), StructField("b", kind)]))
    links, members = link_to_pivots(first, first, none, source)
    if members is not first:
        release(first)
    for level in range(MORE_LEVELS + 1):
        unsettled = written(in_mixed_nodes(members), "nodes")
        release(members)
        if unsettled.isEmpty():
            break
        # Those of the commonest label in a node have what most others may be linked to.
        for turn in range(1, PIVOT_TURNS + 1):
            members = unsettled.drop(*OF_NODE)
            links, again = link_to_pivots(members, unsettled.where("label = major"), links, source, turn)
            if again is members:
                break
            settled, unsettled = unsettled, written(in_mixed_nodes(again), "nodes")
            release(settled, again)
        # On the last level there is nothing left to tell the documents of a node apart by.
        leaves = unsettled if level == MORE_LEVELS else unsettled.where("leaf")
        links = links.union(confirmed(node_pairs(leaves, source), source))
        larger = unsettled.where("not leaf").drop(*OF_NODE)
        if level == MORE_LEVELS or larger.isEmpty():
            release(unsettled)
            break
        # A pair that is not settled yet is in these nodes with both documents, or has parted in all trees so far.
        deeper, begun = math.ceil(depth) + level + 1, trees
        trees = max(trees, trees_for(similarity, target_recall, deeper))
        members = labelled(branch(larger, source, similarity, begun, trees, deeper), links)
        release(unsettled)

    found = of_row.join(components(links).withColumnRenamed("id", "rep"), "rep", "left")
    component = F.when(F.col("key").isNotNull(), F.coalesce("component", "rep", "key"))
    return found.select(
        F.col("key").alias(key),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("key") == component, F.lit(True)).alias("kept"),
    )


def keep_one_of_each(df: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``df`` with one row of each class of near duplicates, one with the smallest key (null after all others).

    Rows are told apart by number where keys repeat or are null, so a row goes only if its own text is in the
    class of one that stays. Rows without a word stay, all of them.
    """
    names = [F.col(f"`{name}`") for name in df.columns]
    of_key = df.groupBy(F.col(f"`{key}`").alias("key")).count()
    if of_key.where("key IS NULL OR count > 1").isEmpty():
        found = near_duplicates(df, key, text, **options)
        gone = written(found.where("not kept").select(F.col(key).alias("__gone")), "gone")
        return df.join(gone, F.col(f"`{key}`") == F.col("__gone"), "left_anti")
    rows = numbered(df.select(*[column.alias(f"c{i}") for i, column in enumerate(names)]), "rows")
    at = {name: f"c{i}" for i, name in enumerate(df.columns)}
    found = near_duplicates(rows, ROW, at[text], **options)
    placed = found.join(rows.select(ROW, F.col(at[key]).alias("key")), ROW)
    first = F.min(F.struct(F.col("key").isNull(), F.col("key"), F.col(ROW))).alias("first")
    stay = written(placed.groupBy("component_id").agg(first).select(F.col(f"first.{ROW}").alias(ROW)), "stay")
    return rows.join(stay, ROW).select(*[F.col(column).alias(name) for name, column in at.items()])


__all__ = ["keep_one_of_each", "near_duplicates"]
