"""Token counts per section of a text by offset-mapped attribution.

A document is encoded once as a whole, because tokens at a section's border depend on what is beyond it.
The character span of every token is then joined to the intervals of the sections. A token belongs to the
section that has most of its characters, the earlier one of two with equally many; a token without
characters in any section belongs to none and is counted under section -1. So the counts of a document
always add up to its tokens.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

# Fixed value: how byte-level BPE vocabularies of this kind cut a text before merging.
PIECES = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

BETWEEN = -1


@lru_cache(maxsize=2)
def encoding(path: str) -> tuple[tiktoken.Encoding, np.ndarray]:
    """The encoder of a rank file, and the length in bytes of each of its tokens."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}
    lengths = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
    for token, rank in ranks.items():
        lengths[rank] = len(token)
    return tiktoken.Encoding("ranks", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={}), lengths


def token_spans(text: str, path: str) -> tuple[np.ndarray, np.ndarray]:
    """First character of each token and the one after its last.

    A token that ends inside a character has that character, as has the token that goes on with it.
    """
    encoder, lengths = encoding(path)
    ids = np.fromiter(encoder.encode_ordinary(text), dtype=np.int64)
    after = np.cumsum(lengths[ids])
    raw = np.frombuffer(text.encode("utf-8"), dtype=np.uint8)
    # The character that each byte belongs to, and one more for the end of the text.
    character = np.append(np.cumsum((raw & 0xC0) != 0x80) - 1, 0)
    return character[after - lengths[ids]], character[after - 1] + 1


def attribute(start: np.ndarray, end: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Section of every token, -1 for none, and whether the token crosses a border.

    Sections ``low`` to ``high`` are in order and do not overlap. A token of many characters may span
    several short sections, so each token is paired with all sections it meets.
    """
    owner = np.full(len(start), BETWEEN, dtype=np.int64)
    if not len(low) or not len(start):
        return owner, np.zeros(len(start), dtype=bool)
    first = np.searchsorted(high, start, side="right")
    last = np.searchsorted(low, end, side="left")
    met = np.maximum(last - first, 0)
    token = np.repeat(np.arange(len(start)), met)
    section = np.arange(met.sum()) - np.repeat(np.cumsum(met) - met, met) + np.repeat(first, met)
    shared = np.minimum(end[token], high[section]) - np.maximum(start[token], low[section])
    token, section, shared = token[shared > 0], section[shared > 0], shared[shared > 0]
    # By token, most characters first, then the earlier section.
    order = np.lexsort((section, -shared, token))
    best = order[np.unique(token[order], return_index=True)[1]]
    owner[token[best]] = section[best]
    inside = np.zeros(len(start), dtype=bool)
    inside[token[best]] = shared[best] == (end - start)[token[best]]
    return owner, (owner != BETWEEN) & ~inside


def section_token_counts(
    df: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", sections: str | None = None
) -> DataFrame:
    """Per document and section: ``key``, ``section``, ``n_chars``, ``n_tokens``, ``n_crossing``.

    ``sections`` names a column with the intervals of each document, an array of structs ``start`` and
    ``end`` in characters, in order and not overlapping; without it the lines of the text are taken.
    ``n_tokens`` are the tokens of the section, ``n_crossing`` those of them that also have characters
    outside it. Section -1 has the tokens and characters outside all sections and is always there, so a
    document with a null or empty text gives that one row (and one per empty section) with zeros.

    ``tokenizer`` is the path of a rank file that every executor can read. Each row counts on its own:
    rows with equal or null keys give rows of their own. An empty table gives an empty result. Only the
    named columns are read, so others may have any name.
    """
    names = ("section", "n_chars", "n_tokens", "n_crossing")
    key_field = StructField(key, df.schema[key].dataType)
    schema = StructType([key_field, StructField("section", IntegerType()), *[StructField(n, LongType()) for n in names[1:]]])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list[np.ndarray]] = {name: [] for name in ("row", *names)}
            for row in range(batch.num_rows):
                body = batch.column("body")[row].as_py() or ""
                start, end = token_spans(body, tokenizer)
                if sections:
                    pairs = [(item["start"], item["end"]) for item in batch.column("sections")[row].as_py() or ()]
                    low, high = np.array(pairs, dtype=np.int64).reshape(-1, 2).T
                else:
                    feeds = np.array([found.start() for found in re.finditer("\n", body)], dtype=np.int64)
                    low, high = np.append(0, feeds + 1), np.append(feeds, len(body))
                owner, crossing = attribute(start, end, low, high)
                size = len(low) + 1
                out["row"].append(np.full(size, row))
                out["section"].append(np.arange(BETWEEN, size - 1, dtype=np.int32))
                out["n_chars"].append(np.append(len(body) - (high - low).sum(), high - low))
                out["n_tokens"].append(np.bincount(owner + 1, minlength=size))
                out["n_crossing"].append(np.bincount(owner[crossing] + 1, minlength=size))
            if out["row"]:
                made = {name: np.concatenate(parts) for name, parts in out.items()}
                keys = batch.column("key").take(pa.array(made.pop("row")))
                yield pa.RecordBatch.from_arrays([keys, *[pa.array(made[name]) for name in names]], [key, *names])

    columns = [F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("body")]
    if sections:
        columns.append(F.col(f"`{sections}`").alias("sections"))
    return df.select(*columns).mapInArrow(count, schema)
