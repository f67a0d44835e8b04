"""Katz backoff language model: Good-Turing discounted bigrams over unigrams, exactly normalised.

Counting and scoring a corpus asks for the count of nearly every pair of words that occurs in it, most of
them rare. One row per pair and task would be many times the corpus, so rows hold sorted arrays instead:

1. Tasks cut texts into blocks. A block keeps its texts as numbers of its own vocabulary, and sends each
   bucket of words a packet with its words and their counts in training texts.
2. A bucket of words adds up its packets. It answers each with counts and numbers of the words.
3. A block sends each bucket of pairs a packet with its distinct pairs. Pairs with one first word lie in one
   bucket, those of a very frequent one are spread by their second word.
4. A bucket of pairs adds up its packets: its part of the bigram table. It answers with the counts, and
   tells the buckets of words what follows each first word.
5. A bucket of words reckons the backoff weights of its words and answers with those.
6. A block scores its texts, token by token: the bigram if it was seen, else the backoff weight times the
   unigram.

All tables are written, partitioned by bucket or block, so a lost executor costs the tasks it had.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, LongType, StructField, StructType

from ordermill.llm.common import written
from ordermill.llm.words import bounds, mix, words

#: Counts up to this are discounted.
REACH = 5
BLOCK_TOKENS = 1 << 21
BUCKET_TOKENS = 1 << 20
LEAST_BUCKETS = 64
#: The pairs of a first word are spread over a bucket more for each so many occurrences.
HEAD_TOKENS = 1 << 17
END = np.uint64(0x1F83D9ABFB41BD6B)
START, UNKNOWN = 0, -1

PACKET = "kind string, block long, bucket int, a binary, b binary, c binary, d binary, stats array<long>"
PACKET_FIELDS = pa.schema(
    [
        ("kind", pa.string()),
        ("block", pa.int64()),
        ("bucket", pa.int32()),
        *[(name, pa.binary()) for name in "abcd"],
        ("stats", pa.list_(pa.int64())),
    ]
)


def pack(numbers: np.ndarray) -> bytes:
    """Numbers in the narrowest type that holds them, byte by byte of each in turn, compressed."""
    stored = numbers
    if numbers.dtype.kind != "f" and len(numbers):
        fits = [np.dtype(kind) for kind in ("BHI" if numbers.min() >= 0 else "bhi")]
        fits = [kind for kind in fits if np.iinfo(kind).min <= numbers.min() and numbers.max() <= np.iinfo(kind).max]
        stored = numbers.astype(fits[0]) if fits else numbers
    planes = np.ascontiguousarray(stored).view(np.uint8).reshape(len(numbers), stored.itemsize).T
    return (numbers.dtype.str + stored.dtype.str).encode("ascii") + zstandard.compress(planes.tobytes(), 3)


def unpack(data: bytes) -> np.ndarray:
    kind, stored = np.dtype(data[:3].decode("ascii")), np.dtype(data[3:6].decode("ascii"))
    planes = np.frombuffer(zstandard.decompress(data[6:]), dtype=np.uint8).reshape(stored.itemsize, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(stored).astype(kind)


def pack_sorted(numbers: np.ndarray) -> bytes:
    return pack(np.diff(numbers, prepend=numbers.dtype.type(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    steps = unpack(data)
    return np.cumsum(steps, dtype=steps.dtype)


def packet(kind: str, block: int | None, bucket: int | None, *parts: bytes, stats: list[int] | None = None) -> dict:
    named = dict(zip("abcd", parts))
    return {"kind": kind, "block": block, "bucket": bucket, **{n: named.get(n) for n in "abcd"}, "stats": stats}


class Discounts(NamedTuple):
    """Share of a count that is kept, by count (those beyond the last keep all)."""

    kept: np.ndarray

    def of(self, counts: np.ndarray) -> np.ndarray:
        """Discounted counts."""
        return counts * np.where(counts <= REACH, self.kept[np.minimum(counts, REACH)], 1.0)


def good_turing(times: list[int]) -> Discounts:
    """Katz's discounts from how many entries have counts 1, 2, ... ``REACH`` + 1.

    Where these numbers are too few to give a discount between 0 and 1, half a count is taken off.
    """
    n = [0, *times]
    kept = np.ones(REACH + 1)
    common = (REACH + 1) * n[REACH + 1] / n[1] if n[1] else 1.0
    for r in range(1, REACH + 1):
        value = ((r + 1) * n[r + 1] / (r * n[r]) - common) / (1 - common) if n[r] and common < 1 else 0.0
        kept[r] = value if 0 < value < 1 else (r - 0.5) / r
    return Discounts(kept)


class Unigrams(NamedTuple):
    """What every task knows of the single words: totals only."""

    tokens: int  # in training
    kinds: int
    discounts: Discounts
    unknown: float  # probability of all words that training has not
    room: float  # what is left for the others where no count was discounted

    def probability(self, counts: np.ndarray) -> np.ndarray:
        if not self.tokens:
            return np.ones(len(counts))
        return np.where(counts > 0, self.discounts.of(counts) / self.tokens * self.room, self.unknown)

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 0.1) / (self.tokens + 0.1 * (self.kinds + 1)))


def unigrams(stats: np.ndarray) -> Unigrams:
    """From totals of: counts of 1 to ``REACH`` + 1, tokens, kinds."""
    *times, tokens, kinds = (int(x) for x in stats)
    discounts = good_turing(times)
    freed = sum(n * r * (1 - discounts.kept[r]) for r, n in enumerate(times[:REACH], 1))
    if freed:
        return Unigrams(tokens, kinds, discounts, freed / tokens, 1.0)
    # Nothing was discounted: one more token is reckoned with, so that something is left.
    return Unigrams(tokens, kinds, discounts, 1 / (tokens + 1), tokens / (tokens + 1))


def count_stats(counts: np.ndarray) -> list[int]:
    return [int((counts == r).sum()) for r in range(1, REACH + 2)]


def cut(df: DataFrame, key: str, text: str, held: Column, buckets: int) -> DataFrame:
    """Step 1: a row per block (kind ``text``) and its packets (kind ``word``)."""

    def flush(block: int, keys: list, held_out: list, docs: list[np.ndarray]) -> Iterator[dict]:
        tokens = np.concatenate(docs)
        train = np.repeat(~np.array(held_out, dtype=bool), [len(doc) for doc in docs])
        vocabulary, inverse, counts = np.unique(tokens, return_inverse=True, return_counts=True)
        trained = np.bincount(inverse, train, len(vocabulary)).astype(np.int64)
        # Frequent words get small numbers; ``place`` says where in the packets they are.
        order = np.argsort(-counts, kind="stable")
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.arange(len(order))
        bucket = (vocabulary % np.uint64(buckets)).astype(np.int64)
        by_bucket = np.argsort(bucket, kind="stable")
        lengths = np.array([len(doc) for doc in docs], dtype=np.int64)
        own = packet("text", block, None, pack(rank[inverse]), pack(lengths), pack(rank[by_bucket]))
        yield own | {"keys": keys, "held": held_out}
        edges = np.searchsorted(bucket[by_bucket], np.arange(buckets + 1))
        for b in np.flatnonzero(np.diff(edges)).tolist():
            part = by_bucket[edges[b] : edges[b + 1]]
            yield packet("word", block, b, pack_sorted(vocabulary[part]), pack(trained[part])) | {"keys": None, "held": None}

    key_type = df.schema[key].dataType

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24
        keys, held_out, docs, size, fields = [], [], [], 0, None
        for batch in batches:
            if fields is None:
                kind = batch.schema.field("key").type
                fields = pa.schema([*PACKET_FIELDS, ("keys", pa.list_(kind)), ("held", pa.list_(pa.bool_()))])
            of_key, of_held = batch.column("key").to_pylist(), batch.column("held").to_pylist()
            for found in words(batch.column("text")):
                edges = bounds(found)
                for row in range(found.texts):
                    keys.append(of_key[found.first + row])
                    held_out.append(of_held[found.first + row])
                    docs.append(np.append(found.hash[edges[row] : edges[row + 1]], END))
                    size += len(docs[-1])
                    if size >= BLOCK_TOKENS:
                        yield pa.RecordBatch.from_pylist(list(flush(number, keys, held_out, docs)), fields)
                        keys, held_out, docs, size, number = [], [], [], 0, number + 1
        if docs:
            yield pa.RecordBatch.from_pylist(list(flush(number, keys, held_out, docs)), fields)

    schema = StructType(
        [
            *spark_fields(df),
            StructField("keys", ArrayType(key_type)),
            StructField("held", ArrayType(BooleanType())),
        ]
    )
    source = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"), held.alias("held"))
    return source.mapInArrow(read, schema)


def spark_fields(df: DataFrame) -> list[StructField]:
    return df.sparkSession.createDataFrame([], PACKET).schema.fields


def count_words(table: pa.Table, buckets: int) -> pa.Table:
    """Step 2: totals of one bucket of words, and an answer to each packet."""
    rows = table.to_pylist()
    parts = [(unpack_sorted(row["a"]), unpack(row["b"])) for row in rows]
    every = np.concatenate([part for part, _ in parts])
    known, inverse = np.unique(every, return_inverse=True)
    total = np.bincount(inverse, np.concatenate([counts for _, counts in parts]), len(known)).astype(np.int64)
    trained = total > 0
    bucket = rows[0]["bucket"]
    # Numbers are distinct over all buckets; number 0 is the start of a text.
    number = np.where(trained, 1 + bucket + buckets * (np.cumsum(trained) - 1), UNKNOWN)
    out = [
        packet(
            "unigrams", None, bucket, pack_sorted(known[trained]), pack(total[trained]),
            stats=[*count_stats(total), int(total.sum()), int(trained.sum())],
        )
    ]
    at = 0
    for row, (part, _) in zip(rows, parts):
        here = inverse[at : at + len(part)]
        out.append(packet("word", row["block"], bucket, pack(total[here]), pack(number[here])))
        at += len(part)
    return pa.Table.from_pylist(out, PACKET_FIELDS)


class Block:
    """A block's texts and distinct pairs, from its own row and the answers of the buckets of words."""

    def __init__(self, own: dict, answers: list[dict], start_count: int, buckets: int):
        self.ids, self.lengths = unpack(own["a"]), unpack(own["b"])
        place = unpack(own["c"])
        answers = sorted(answers, key=lambda row: row["bucket"])
        self.count, self.number = np.empty(len(place), np.int64), np.empty(len(place), np.int64)
        self.count[place] = np.concatenate([unpack(row["a"]) for row in answers])
        self.number[place] = np.concatenate([unpack(row["b"]) for row in answers])
        ends = np.cumsum(self.lengths)
        self.text = np.repeat(np.arange(len(self.lengths)), self.lengths)
        before = np.empty_like(self.ids)
        before[1:] = self.ids[:-1]
        # One more word of the vocabulary stands for the start of a text.
        before[ends - self.lengths] = len(place)
        self.count, self.number = np.append(self.count, start_count), np.append(self.number, START)
        self.before = before
        asked = (self.number[before] != UNKNOWN) & (self.number[self.ids] != UNKNOWN)
        size = len(place) + 1
        pair, self.inverse = np.unique((before * size + self.ids)[asked], return_inverse=True)
        self.asked = asked
        self.head, self.tail = pair // size, pair % size
        spread = 1 + self.count[self.head] // HEAD_TOKENS
        number = self.number[self.tail].astype(np.uint64)
        share = (mix(number) % spread.astype(np.uint64)).astype(np.uint64)
        self.bucket = (mix(self.number[self.head].astype(np.uint64) + (share << np.uint64(44))) % np.uint64(buckets)).astype(np.int64)
        self.order = np.lexsort((self.number[self.tail], self.number[self.head], self.bucket))
        self.edges = np.searchsorted(self.bucket[self.order], np.arange(buckets + 1))


def ask_pairs(texts: pa.Table, answers: pa.Table, start_count: int, buckets: int) -> pa.Table:
    """Step 3: packets of the distinct pairs of one block, with counts in its training texts."""
    out = []
    for own in texts.to_pylist():
        block = Block(own, answers.to_pylist(), start_count, buckets)
        train = np.repeat(~np.array(own["held"], dtype=bool), block.lengths)[block.asked]
        times = np.bincount(block.inverse, train, len(block.head)).astype(np.int64)
        for b in np.flatnonzero(np.diff(block.edges)).tolist():
            part = block.order[block.edges[b] : block.edges[b + 1]]
            head, tail = block.number[block.head[part]], block.number[block.tail[part]]
            parts = (pack_sorted(head), pack(tail), pack(times[part]), pack(block.count[block.tail[part]]))
            out.append(packet("pair", own["block"], b, *parts))
    return pa.Table.from_pylist(out, PACKET_FIELDS)


def count_pairs(table: pa.Table, single: Unigrams, buckets: int) -> pa.Table:
    """Step 4: totals of one bucket of pairs, answers, and what follows each first word."""
    rows = table.to_pylist()
    parts = [[unpack_sorted(row["a"]), unpack(row["b"]), unpack(row["c"]), unpack(row["d"])] for row in rows]
    head, tail, times, tail_count = (np.concatenate(column) for column in zip(*parts))
    order = np.lexsort((tail, head))
    new = np.append(True, (np.diff(head[order]) != 0) | (np.diff(tail[order]) != 0))
    group = np.cumsum(new) - 1
    inverse = np.empty(len(order), dtype=np.int64)
    inverse[order] = group
    total = np.bincount(group, times[order]).astype(np.int64)
    head, tail, tail_count = (column[order][new] for column in (head, tail, tail_count))
    bucket = rows[0]["bucket"]
    out, at = [], 0
    for row, (part, *_) in zip(rows, parts):
        out.append(packet("pair", row["block"], bucket, pack(total[inverse[at : at + len(part)]])))
        at += len(part)
    seen = total > 0
    head, tail, tail_count, total = head[seen], tail[seen], tail_count[seen], total[seen]
    out.append(packet("bigrams", None, bucket, pack_sorted(head), pack(tail), pack(total), stats=count_stats(total)))
    first = np.flatnonzero(np.diff(head, prepend=-1))
    if len(first):
        times = np.stack([np.add.reduceat((total == r).astype(np.int64), first) for r in range(1, REACH + 1)])
        large = np.add.reduceat(np.where(total > REACH, total, 0), first)
        mass = np.add.reduceat(single.probability(tail_count), first)
        heads = head[first]
        home = np.where(heads == START, 0, (heads - 1) % buckets)
        for b in np.unique(home).tolist():
            here = home == b
            parts = (pack_sorted(heads[here]), pack(np.append(times[:, here].ravel(), large[here])), pack(mass[here]))
            out.append(packet("head", None, b, *parts))
    return pa.Table.from_pylist(out, PACKET_FIELDS)


def weigh(heads: pa.Table, answers: pa.Table, pairs: Discounts) -> pa.Table:
    """Step 5: backoff weights of the words of one bucket; logarithms, with that of what seen pairs keep."""
    parts = []
    for row in heads.to_pylist():
        number = unpack_sorted(row["a"])
        parts.append((number, unpack(row["b"]).reshape(REACH + 1, -1), unpack(row["c"])))
    known, inverse = np.unique(np.concatenate([np.zeros(0, np.int64), *[p[0] for p in parts]]), return_inverse=True)
    times = np.zeros((REACH + 1, len(known)))
    mass, at = np.zeros(len(known)), 0
    for number, counts, share in parts:
        here = inverse[at : at + len(number)]
        np.add.at(times, (slice(None), here), counts)
        np.add.at(mass, here, share)
        at += len(number)
    r = np.arange(1, REACH + 1)[:, None]
    occurs = (times[:REACH] * r).sum(axis=0) + times[REACH]
    freed = (times[:REACH] * r * (1 - pairs.kept[1:, None])).sum(axis=0) / np.maximum(occurs, 1)
    kept = np.where(freed > 0, 1.0, occurs / (occurs + 1))
    freed = np.where(freed > 0, freed, 1 / (occurs + 1))
    weight, kept = np.log10(freed / (1 - mass)), np.log10(kept)
    bucket = (heads if len(heads) else answers).column("bucket")[0].as_py()
    out = [packet("weights", None, bucket, pack_sorted(known), pack(weight), pack(kept))]
    for row in answers.to_pylist():
        number = unpack(row["b"])
        index = np.minimum(np.searchsorted(known, number), max(len(known) - 1, 0))
        # Words that nothing follows in training, and unknown ones, leave all to the unigrams.
        found = known[index] == number if len(known) else np.zeros(len(number), dtype=bool)
        values = [np.where(found, column[index] if len(known) else 0.0, 0.0) for column in (weight, kept)]
        out.append(packet("weight", row["block"], bucket, *map(pack, values)))
    return pa.Table.from_pylist(out, PACKET_FIELDS)


def score(texts: pa.Table, answers: pa.Table, single: Unigrams, pairs: Discounts, start, buckets: int) -> pa.Table:
    """Step 6: scores of the texts of one block. ``start``: count, weight and kept share of text starts."""
    out = []
    rows = answers.to_pylist()
    of = lambda kind: sorted((row for row in rows if row["kind"] == kind), key=lambda row: row["bucket"])
    for own in texts.to_pylist():
        block = Block(own, of("word"), start[0], buckets)
        place = unpack(own["c"])
        weight, kept = np.empty(len(place)), np.empty(len(place))
        weight[place] = np.concatenate([unpack(row["a"]) for row in of("weight")])
        kept[place] = np.concatenate([unpack(row["b"]) for row in of("weight")])
        weight, kept = np.append(weight, start[1]), np.append(kept, start[2])
        # The unigram with the weight, unless the pair was seen.
        logs = np.log10(single.probability(block.count[:-1]))[block.ids] + weight[block.before]
        if len(block.head):
            total = np.empty(len(block.head), dtype=np.int64)
            total[block.order] = np.concatenate([unpack(row["a"]) for row in of("pair")])
            head = block.head
            with np.errstate(divide="ignore"):
                own_log = np.log10(pairs.of(total) / np.maximum(block.count[head], 1)) + kept[head]
            asked = np.flatnonzero(block.asked)
            seen = total[block.inverse] > 0
            logs[asked[seen]] = own_log[block.inverse[seen]]
        texts_in = len(block.lengths)
        count = block.count[:-1]
        known = np.bincount(block.text, (count > 0)[block.ids], texts_in).astype(np.int64)
        out.append(
            pa.table(
                {
                    "key": texts.column("keys")[len(out)].values,
                    "held_out": pa.array(own["held"], pa.bool_()),
                    "n_tokens": block.lengths,
                    "n_known": known,
                    "train_tokens": np.full(texts_in, single.tokens, dtype=np.int64),
                    "base_score": np.bincount(block.text, single.base(count)[block.ids], texts_in),
                    "score": np.bincount(block.text, logs, texts_in),
                }
            )
        )
    return pa.concat_tables(out)


def summed(packets: DataFrame) -> list:
    """The ``stats`` of all buckets, summed place by place; a few numbers, however many buckets there are."""
    places = packets.select(F.posexplode("stats")).groupBy("pos").agg(F.sum("col").alias("total"))
    return [row["total"] for row in places.orderBy("pos").collect()]


def katz_scores(df: DataFrame, held: Column, key: str = "doc_id", text: str = "text", out: dict | None = None) -> DataFrame:
    """Per row: ``key``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``.

    Tokens are the words, A to Z in lower case, then one end. The model learns from the rows where ``held``
    is false. ``base_score`` is that of add-a-tenth unigrams, ``score`` the base-10 logarithm of the
    probability of the text under the Katz model; a word that training has not counts as the one unknown
    word. ``out``, if given, receives the written tables ``unigrams``, ``bigrams`` and ``weights``.

    A null or empty text is its end alone. Rows are counted and scored one by one, so equal rows, and null
    or repeated keys, give rows of their own. An empty table gives an empty result. Other columns are not
    read. A text longer than a block is a block of its own.
    """
    # Words are at least two bytes apart; few texts have more tokens than a third of their bytes.
    size = df.select(F.sum(F.octet_length(F.col(f"`{text}`").cast("string")))).first()[0] or 0
    buckets = max(LEAST_BUCKETS, size // 4 // BUCKET_TOKENS)
    packets = PACKET
    rows = written(cut(df, key, text, held, buckets), "katz-blocks")
    texts = rows.where("kind = 'text'").drop("kind", "bucket", "d", "stats")
    asked = rows.where("kind = 'word'").drop("keys", "held")
    names = written(
        asked.groupBy("bucket").applyInArrow(lambda table: count_words(table, buckets), packets), "katz-words"
    )
    zeros = [0] * (REACH + 1)
    single = unigrams(summed(names.where("kind = 'unigrams'")) or [*zeros, 0, 0])
    starts = texts.select(F.sum(F.size(F.filter("held", lambda flag: ~flag)))).first()[0] or 0
    word_answers = names.where("kind = 'word'")

    pairs_asked = texts.groupBy("block").cogroup(word_answers.groupBy("block")).applyInArrow(
        lambda own, answers: ask_pairs(own, answers, starts, buckets), packets
    )
    counted = written(
        pairs_asked.groupBy("bucket").applyInArrow(lambda table: count_pairs(table, single, buckets), packets), "katz-pairs"
    )
    pairs = good_turing(summed(counted.where("kind = 'bigrams'")) or zeros)

    heads = counted.where("kind = 'head'")
    weights = written(
        heads.groupBy("bucket").cogroup(word_answers.groupBy("bucket")).applyInArrow(
            lambda found, answers: weigh(found, answers, pairs), packets
        ),
        "katz-weights",
    )
    start = (starts, 0.0, 0.0)
    for row in weights.where("kind = 'weights' AND bucket = 0").select("a", "b", "c").collect():
        known = unpack_sorted(row.a)
        if len(known) and known[0] == START:
            start = (starts, float(unpack(row.b)[0]), float(unpack(row.c)[0]))
    if out is not None:
        out.update(
            unigrams=names.where("kind = 'unigrams'"),
            bigrams=counted.where("kind = 'bigrams'"),
            weights=weights.where("kind = 'weights'"),
        )
    answers = (
        word_answers.unionAll(counted.where("kind = 'pair'")).unionAll(weights.where("kind = 'weight'")).drop("c", "d", "stats")
    )
    fields = [
        StructField("key", df.schema[key].dataType),
        StructField("held_out", BooleanType()),
        *[StructField(name, LongType()) for name in ("n_tokens", "n_known", "train_tokens")],
        *[StructField(name, DoubleType()) for name in ("base_score", "score")],
    ]
    scored = texts.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        lambda own, found: score(own, found, single, pairs, start, buckets), StructType(fields)
    )
    return scored.withColumnRenamed("key", key)
