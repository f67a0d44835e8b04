"""Encoding into sentence pieces with the bytes of the original text that each piece stands for.

A text is normalised by longest-prefix replacement through the character map that is compiled into the
model, and every character of the result knows the byte of the source that it comes from. Byte-pair merging
then cuts the normalised text into pieces, and each piece is projected through that alignment to a span of
source bytes. Merges never cross a space mark that follows another character, so the text between two such
places is cut once per task and remembered.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

MARK = "▁"  # stands for a space
# Kinds of pieces, and the kind of model, in a model file.
NORMAL, BYTE, BPE = 1, 6, 2
#: Texts cut at a time, in bytes, and cuts that are remembered; a cut beyond that length is not.
SLICE_BYTES, REMEMBERED, LONG = 1 << 20, 1 << 19, 64
NEVER = float("inf")


def fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of the fields of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(message):
        key = varint()
        kind = key & 7
        if kind == 0:
            value = varint()
        else:
            size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
            value, at = message[at : at + size], at + size
        yield key >> 3, value


def compiled_map(blob: bytes) -> dict[str, str]:
    """All replacements of a compiled character map: a double-array trie over UTF-8, then the new strings."""
    if not blob:
        return {}
    size = int.from_bytes(blob[:4], "little")
    units = np.frombuffer(blob, dtype="<u4", count=size // 4, offset=4)
    strings = blob[4 + size :]
    base = ((units >> 10) << ((units & 512) >> 6)).astype(np.int64)
    label = units & 0x800000FF
    letters = np.arange(1, 256)
    found = {}
    open_nodes = [(int(base[0]), b"")]
    while open_nodes:
        node, prefix = open_nodes.pop()
        spots = node ^ letters
        inside = spots < len(units)
        for letter in letters[inside][label[spots[inside]] == letters[inside]].tolist():
            child = node ^ letter
            below = child ^ int(base[child])
            key = prefix + bytes([letter])
            if units[child] >> 8 & 1:
                start = int(units[below] & 0x7FFFFFFF)
                found[key.decode()] = strings[start : strings.index(b"\0", start)].decode()
            open_nodes.append((below, key))
    return found


class Normalized(NamedTuple):
    text: str
    origin: np.ndarray  # source byte at which each character begins, and the one after the last


class PieceModel:
    """A byte-pair model with byte fallback, read from the bytes of a model file."""

    def __init__(self, proto: bytes):
        self.ids: dict[str, int] = {}
        self.costs: dict[str, float] = {}
        self.pieces = 0
        self.byte_ids = [-1] * 256
        trainer = normalizer = b""
        for number, value in fields(proto):
            if number == 1:
                self._add(dict(fields(value)))
            elif number == 2:
                trainer = value
            elif number == 3:
                normalizer = value
        trained = dict(fields(trainer))
        if trained.get(3, 1) != BPE or min(self.byte_ids) < 0 or trained.get(24, 0):
            raise ValueError("the model is byte-pair encoding with byte fallback and leading space marks")
        self.begin, self.end = trained.get(41, 1), trained.get(42, 2)
        rules = dict(fields(normalizer))
        self.replacements = compiled_map(rules.get(2, b""))
        self.prefix, self.squeeze, self.escape = (bool(rules.get(number, 1)) for number in (3, 4, 5))
        # The lengths of the replaced strings that begin with each character, the longest first.
        lengths: dict[str, set[int]] = {}
        for key in self.replacements:
            lengths.setdefault(key[0], set()).add(len(key))
        self.lengths = {first: sorted(sizes, reverse=True) for first, sizes in lengths.items()}
        self.replaced = re.compile("[" + "".join(map(re.escape, lengths)) + "]") if lengths else None
        apart = all(MARK not in piece.lstrip(MARK) for piece in self.ids)
        self.cuts = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+" if apart else "(?s:.+)")
        self.neighbours = {piece[i - 1 : i + 1] for piece in self.ids for i in range(1, len(piece))}
        self.known: dict[str, tuple[bytes, bytes]] = {}

    def _add(self, piece: dict) -> None:
        number, text, kind = self.pieces, piece.get(1, b"").decode(), piece.get(3, NORMAL)
        self.pieces += 1
        if kind == BYTE:
            self.byte_ids[int(text[3:5], 16)] = number
        elif kind == NORMAL:
            self.ids[text] = number
            self.costs[text] = -float(np.frombuffer(piece.get(2, bytes(4)), "<f4")[0])
        elif kind > 3:
            raise ValueError("user-defined and unused pieces are not supported")

    def _replace(self, text: str) -> tuple[str, np.ndarray]:
        """The text after longest-prefix replacement, and the source character of each of its characters."""
        if self.replaced is None:
            return text, np.arange(len(text))
        parts, origins, done = [], [], 0
        for match in self.replaced.finditer(text):
            at = match.start()
            if at < done:
                continue
            for size in self.lengths[text[at]]:
                new = self.replacements.get(text[at : at + size])
                if new is not None:
                    parts += (text[done:at], new)
                    origins += (np.arange(done, at), np.full(len(new), at))
                    done = at + size
                    break
        return "".join([*parts, text[done:]]), np.concatenate([*origins, np.arange(done, len(text))])

    def normalize(self, text: str) -> Normalized:
        codes = np.frombuffer(text.encode("utf-32-le"), dtype="<u4")
        byte_of = np.zeros(len(codes) + 1, dtype=np.int64)
        np.cumsum(1 + (codes >= 0x80) + (codes >= 0x800) + (codes >= 0x10000), out=byte_of[1:])
        text, source = self._replace(text)
        origin = byte_of[np.append(source, len(codes)).astype(np.int64)]
        if self.squeeze:
            spaces = np.frombuffer(text.encode("utf-32-le"), dtype="<u4") == 32
            keep = ~(spaces & np.append(True, spaces[:-1])[: len(spaces)])
            if not keep.any():
                return Normalized("", origin[-1:])
            text = "".join([c for c, kept in zip(text, keep.tolist()) if kept])
            origin = origin[np.append(keep, True)]
        if not text:
            return Normalized("", origin[-1:])
        if self.escape:
            text = text.replace(" ", MARK)
        if self.prefix:
            text = (MARK if self.escape else " ") + text
            origin = np.append(origin[:1], origin)
        if self.squeeze:
            text = text.rstrip(MARK if self.escape else " ")
            origin = origin[: len(text) + 1]
        return Normalized(text, origin)

    def merge(self, text: str) -> list[str]:
        """The pieces of a text: the best pair of neighbours is merged first, the leftmost of equal ones."""
        if len(text) > LONG:
            return self._merge_long(text)
        parts = list(text)
        cost = self.costs.get
        costs = [cost(left + right, NEVER) for left, right in zip(parts, parts[1:])]
        while costs:
            best = min(costs)
            if best is NEVER:
                break
            at = costs.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del costs[at]
            if at < len(costs):
                costs[at] = cost(parts[at] + parts[at + 1], NEVER)
            if at:
                costs[at - 1] = cost(parts[at - 1] + parts[at], NEVER)
        return parts

    def _merge_long(self, text: str) -> list[str]:
        """The same with a queue, for texts without a space in reach."""
        parts: list[str | None] = list(text)
        after = list(range(1, len(parts) + 1))
        before = list(range(-1, len(parts) - 1))
        queue: list[tuple[float, int, int, str]] = []

        def offer(left: int, right: int) -> None:
            if left >= 0 and right < len(parts):
                pair = parts[left] + parts[right]
                if pair in self.costs:
                    heapq.heappush(queue, (self.costs[pair], left, right, pair))

        for left in range(len(parts) - 1):
            offer(left, left + 1)
        while queue:
            _, left, right, pair = heapq.heappop(queue)
            if parts[left] is None or parts[right] is None or parts[left] + parts[right] != pair or after[left] != right:
                continue
            parts[left], parts[right] = pair, None
            after[left] = after[right]
            if after[left] < len(parts):
                before[after[left]] = left
            offer(before[left], left)
            offer(left, after[left])
        return [part for part in parts if part is not None]

    def cut(self, text: str) -> tuple[bytes, bytes]:
        """Ids of the pieces and how many characters each has, as 32-bit integers.

        No merge crosses two characters that are neighbours in no piece, so a text is cut there first. A
        character without a piece becomes a piece per byte; the last of them has the character.
        """
        apart = [i for i in range(1, len(text)) if text[i - 1 : i + 1] not in self.neighbours]
        if apart:
            parts = [text[low:high] for low, high in zip([0, *apart], [*apart, len(text)])]
            some = [self.known.get(part) or self.cut(part) for part in parts]
            return self._remember(text, b"".join([ids for ids, _ in some]), b"".join([widths for _, widths in some]))
        ids, widths = [], []
        for piece in self.merge(text):
            number = self.ids.get(piece)
            if number is not None:
                ids.append(number)
                widths.append(len(piece))
            else:
                raw = piece.encode()
                ids += [self.byte_ids[byte] for byte in raw]
                widths += [0] * (len(raw) - 1) + [1]
        return self._remember(text, array("I", ids).tobytes(), array("I", widths).tobytes())

    def _remember(self, text: str, ids: bytes, widths: bytes) -> tuple[bytes, bytes]:
        if len(text) <= LONG:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            self.known[text] = ids, widths
        return ids, widths

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids with begin and end, and the source bytes where each piece begins and ends."""
        normal, origin = self.normalize(text)
        known = self.known
        cuts = [known.get(part) or self.cut(part) for part in self.cuts.findall(normal)]
        ids = np.frombuffer(b"".join([ids for ids, _ in cuts]), np.uint32)
        edges = np.zeros(len(ids) + 1, dtype=np.int64)
        np.cumsum(np.frombuffer(b"".join([widths for _, widths in cuts]), np.uint32), out=edges[1:])
        spans = origin[edges]
        last = len(text.encode()) if not len(ids) else int(origin[-1])
        framed = np.concatenate([[self.begin], ids, [self.end]]).astype("<u4")
        return framed, np.concatenate([spans[:1] * 0, spans[:-1], [last]]), np.concatenate([spans[:1] * 0, spans[1:], [last]])


@lru_cache(maxsize=2)
def piece_model(proto: bytes) -> tuple[PieceModel, sentencepiece.SentencePieceProcessor]:
    """The model for encoding, and the library's own, whose ``decode`` turns ids into text."""
    return PieceModel(proto), sentencepiece.SentencePieceProcessor(model_proto=proto)


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, list[str]]]:
    """Keys and texts of a batch, about ``SLICE_BYTES`` at a time; null reads as empty."""
    column = pc.fill_null(batch.column("text"), "")
    ends = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False), dtype=np.int64)
    low = 0
    while low < len(column):
        high = int(np.searchsorted(ends, (ends[low - 1] if low else 0) + SLICE_BYTES, side="right"))
        high = max(high, low + 1)
        yield batch.column("key").slice(low, high - low), column.slice(low, high - low).to_pylist()
        low = high


def _read_model(df: DataFrame, path: str):
    """The model file, read on the driver and broadcast: a vocabulary, whose size no data changes."""
    with open(path, "rb") as file:
        return df.sparkSession.sparkContext.broadcast(file.read())


def _keyed(df: DataFrame, key: str, text: str) -> DataFrame:
    return df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))


def encode_with_spans(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``df``: ``key``, ``ids``, and the source bytes ``begins`` to ``ends`` of each id.

    ``ids`` are those of the library, with begin and end; these two have empty spans at the ends of the
    text. The spans of the others follow each other without gaps, except that spaces which the model
    removes belong to the piece before them or to none. Null and empty texts have begin and end only.
    Repeated rows and null keys are rows like others; other columns are not read. An empty table gives an
    empty result; the length of a text has no bound.
    """
    shared = _read_model(df, path)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, _ = piece_model(shared.value)
        for batch in batches:
            for keys, texts in _texts(batch):
                encoded = [model.encode(text) for text in texts]
                offsets = np.cumsum([0] + [len(ids) for ids, _, _ in encoded]).astype(np.int32)
                ids, begins, ends = (np.concatenate(column) for column in zip(*encoded))
                columns = (pa.array(ids.astype(np.int32)), pa.array(begins), pa.array(ends))
                yield pa.RecordBatch.from_arrays(
                    [keys, *[pa.ListArray.from_arrays(offsets, column) for column in columns]],
                    ["key", "ids", "begins", "ends"],
                )

    schema = StructType(
        [
            StructField("key", df.schema[key].dataType),
            StructField("ids", ArrayType(IntegerType())),
            StructField("begins", ArrayType(LongType())),
            StructField("ends", ArrayType(LongType())),
        ]
    )
    return _keyed(df, key, text).mapInArrow(read, schema).withColumnRenamed("key", key)


def decode_ids(df: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """``key`` columns of ``df`` as they are, with ``decoded`` in the place of ``ids``; null ids decode to null."""
    shared = _read_model(df, path)
    kept = [field for field in df.schema.fields if field.name != ids and field.name != "decoded"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, library = piece_model(shared.value)
        for batch in batches:
            texts = [None if row is None else library.decode(row) for row in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(field.name) for field in kept], pa.array(texts, pa.string())],
                [*[field.name for field in kept], "decoded"],
            )

    names = [F.col(f"`{field.name}`") for field in kept]
    return df.select(*names, F.col(f"`{ids}`")).mapInArrow(read, StructType([*kept, StructField("decoded", StringType())]))


def encoding_digests(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``key``, ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` and ``covered_bytes``.

    The same encoding, digested where it is made, so that ids and spans need not leave the task.
    ``ids_sha256`` is over the ids as little-endian 32-bit integers, ``decoded_sha256`` over the UTF-8 of
    the library's ``decode`` of them; ``covered_bytes`` are the source bytes in the spans of the pieces.
    """
    shared = _read_model(df, path)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, library = piece_model(shared.value)
        for batch in batches:
            for keys, texts in _texts(batch):
                rows = [(ids, int((ends - begins).sum())) for ids, begins, ends in map(model.encode, texts)]
                decoded = [library.decode(ids.tolist()) for ids, _ in rows]
                yield pa.RecordBatch.from_arrays(
                    [
                        keys,
                        pa.array([len(ids) for ids, _ in rows], pa.int64()),
                        pa.array([hashlib.sha256(ids.tobytes()).hexdigest() for ids, _ in rows]),
                        pa.array([hashlib.sha256(text.encode()).hexdigest() for text in decoded]),
                        pa.array([covered for _, covered in rows], pa.int64()),
                    ],
                    ["key", "n_tokens", "ids_sha256", "decoded_sha256", "covered_bytes"],
                )

    schema = StructType(
        [
            StructField("key", df.schema[key].dataType),
            StructField("n_tokens", LongType()),
            StructField("ids_sha256", StringType()),
            StructField("decoded_sha256", StringType()),
            StructField("covered_bytes", LongType()),
        ]
    )
    return _keyed(df, key, text).mapInArrow(read, schema).withColumnRenamed("key", key)
