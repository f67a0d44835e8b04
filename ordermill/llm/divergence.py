"""How the sources of each language differ in their terms, priced exactly from one-hot level products.

Every kept term has a level in each source of its language: its smoothed share there, in billionths. A
divergence is a sum over terms of a price that depends on the two levels only, so it can be read from the
joint table of levels of two sources. For a block of terms, let X have a row per term and an indicator column
for each (source, level) that occurs. The product of X transposed and X has all joint tables of the block at
once, and on its diagonal how many terms have each level. X has columns only for terms that the source does
have; what is left of the marginal counts belongs to the level of terms it does not have.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermill.llm.common import written

SCALE = 1_000_000_000
TERM = re.compile(rb"[A-Za-z\x80-\xff]+")  # of UTF-8: ASCII letters and all characters beyond ASCII
#: Rows and columns of a block. Its counts are at most the rows, which 32-bit floats hold exactly.
ROWS, COLUMNS = 4096, 512
#: Entries that are cut into blocks at a time.
ENTRIES = 1 << 16
COUNTS = "lang string, source string, term string, n long, docs long"
CELLS = "lang string, a string, a_p long, b string, b_p long, n long"


def count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of each term by group, summed over a batch.

    A group has a row with an empty term, too, so that groups without terms are known.
    """
    for batch in batches:
        counts, docs = defaultdict(Counter), defaultdict(Counter)
        *names, texts = batch.columns
        for lang, source, text in zip(*[column.to_pylist() for column in names], texts):
            found = TERM.findall(text.as_py().encode().lower())  # bytes: lowers A to Z only
            counts[lang, source].update(found)
            docs[lang, source].update(set(found))
        rows = []
        for (lang, source), of_group in counts.items():
            rows.append((lang, source, "", 0, 0))
            rows += [(lang, source, term.decode(), n, docs[lang, source][term]) for term, n in of_group.items()]
        for at in range(0, len(rows), ENTRIES):
            yield pa.RecordBatch.from_arrays(
                [pa.array(column) for column in zip(*rows[at : at + ENTRIES])], ["lang", "source", "term", "n", "docs"]
            )


def products(column: np.ndarray, row: np.ndarray, columns: int, rows: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Non-zero cells on and above the diagonal of X transposed times X, a tile of columns at a time."""
    tiles = range(0, columns, COLUMNS)

    def indicators(low: int) -> np.ndarray:
        x = np.zeros((rows, min(COLUMNS, columns - low)), dtype=np.float32)
        inside = (column >= low) & (column < low + COLUMNS)
        x[row[inside], column[inside] - low] = 1
        return x

    for low in tiles:
        left = indicators(low)
        for other in tiles[low // COLUMNS :]:
            joint = left.T @ (left if other == low else indicators(other))
            i, j = np.nonzero(np.triu(joint) if other == low else joint)
            yield i + low, j + other, joint[i, j].astype(np.int64)


def blocks(term: np.ndarray, column: np.ndarray) -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of whole terms with as many rows as keep the columns in bounds; a single term may have more."""
    starts = np.flatnonzero(np.diff(term, prepend=-1))
    edges = np.append(starts, len(term))
    at = 0
    while at < len(starts):
        rows = min(ROWS, len(starts) - at)
        while True:
            part = slice(edges[at], edges[at + rows])
            used, local = np.unique(column[part], return_inverse=True)
            if len(used) <= COLUMNS or rows == 1:
                break
            rows = max(1, min(rows - 1, rows * COLUMNS // len(used)))
        row = np.searchsorted(starts[at : at + rows], np.arange(part.start, part.stop), side="right") - 1
        yield part, used, local, row
        at += rows


def joint_tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cells of the joint tables from rows (lang, term, source, p), those of a term next to each other.

    A cell with the same source and level on both sides is the count of that level. Otherwise the sources
    are in order.
    """

    def cells(entries: pa.Table) -> Iterator[pa.RecordBatch]:
        lang, term, source = (entries.column(name).combine_chunks().dictionary_encode() for name in ("lang", "term", "source"))
        names = source.dictionary.to_pylist()
        rank = np.empty(len(names), dtype=np.int64)
        rank[sorted(range(len(names)), key=lambda i: names[i].encode())] = np.arange(len(names))
        p = entries.column("p").to_numpy()
        lang_at, source_at = lang.indices.to_numpy(), rank[source.indices.to_numpy()]
        by_rank = source.dictionary.take(pa.array(np.argsort(rank)))
        _, level = np.unique(p, return_inverse=True)
        column = source_at * (int(level.max()) + 1) + level
        changes = np.flatnonzero((np.diff(lang_at, prepend=-1) != 0) | (np.diff(term.indices.to_numpy(), prepend=-1) != 0))
        row_of = np.searchsorted(changes, np.arange(len(p)), side="right")
        for low, high in zip(*_runs(lang_at)):
            for part, used, local, row in blocks(row_of[low:high], column[low:high]):
                first = low + part.start + np.unique(local, return_index=True)[1]  # an entry of each column
                for i, j, n in products(local, row, len(used), int(row[-1]) + 1):
                    yield pa.RecordBatch.from_arrays(
                        [
                            lang.dictionary.take(pa.array(np.full(len(n), lang_at[low]))),
                            *chain.from_iterable(
                                (by_rank.take(pa.array(source_at[first[side]])), pa.array(p[first[side]])) for side in (i, j)
                            ),
                            pa.array(n),
                        ],
                        ["lang", "a", "a_p", "b", "b_p", "n"],
                    )

    held: pa.Table | None = None
    for batch in batches:
        part = pa.Table.from_batches([batch])
        held = part if held is None else pa.concat_tables([held, part])
        if held.num_rows < ENTRIES:
            continue
        # The last term may go on in the next batch.
        last = held.slice(held.num_rows - 1).to_pylist()[0]
        same = held.num_rows
        while same and all(held.column(name)[same - 1].as_py() == last[name] for name in ("lang", "term")):
            same -= 1
        if same:
            yield from cells(held.slice(0, same))
            held = held.slice(same)
    if held is not None and held.num_rows:
        yield from cells(held)


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    low = np.flatnonzero(np.diff(values, prepend=values[0] - 1))
    return low, np.append(low[1:], len(values))


def level_of(n: Column, total: Column, terms: Column) -> Column:
    """Smoothed share in billionths, counted exactly: 1 + floor(SCALE * (n + 1) / (total + terms))."""
    wide = lambda column: column.cast("decimal(20,0)")
    parts = wide(F.lit(SCALE)) * wide(n + 1)
    return 1 + F.call_function("div", parts, wide(total + terms))


def price(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q); below 2^63, as levels are at most SCALE + 1."""
    return F.call_function("div", (p - q) * (p - q), q)


def divergence_audit(
    df: DataFrame,
    least_documents: int = 3,
    top_terms: int = 200,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
) -> DataFrame:
    """Rows (``lang``, ``source``, ``part``, ``item``, ``value``, ``rank``) for every group of lang and source.

    A term is kept in a lang if ``least_documents`` of its documents have it. ``pair``: each other source of
    the lang with the divergence of the two, all ranks. ``term``: terms more frequent in the group than in its
    lang, up to rank ``top_terms``. Equal values rank by item in UTF-8 order.

    Null texts, langs and sources read as empty strings. Every row is a document of its own, so repeated rows
    count again. A lang without kept terms has divergences of 0; an empty table gives an empty result. Other
    columns are not read. Values beyond 64 bits raise.
    """
    fields = [F.coalesce(F.col(f"`{name}`").cast("string"), F.lit("")) for name in (lang, source, text)]
    counted = df.select(*fields).mapInArrow(count_terms, COUNTS)
    counts = written(counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "terms")
    groups = counts.where("term = ''").select("lang", "source")
    kept = written(
        counts.where("term <> ''")
        .groupBy("lang", "term")
        .agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
        .where(F.col("docs") >= least_documents)
        .drop("docs"),
        "kept-terms",
    )
    found = written(counts.drop("docs").join(kept, ["lang", "term"]), "kept-counts")
    langs = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("lang_n").alias("lang_total"))
    sizes = groups.join(found.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left")
    sizes = sizes.join(langs, "lang", "left").na.fill(0, ["total", "terms", "lang_total"])
    none = F.when(F.col("terms") > 0, level_of(F.lit(0), F.col("total"), F.col("terms"))).otherwise(1)
    sizes = written(sizes.withColumn("none", none), "groups")

    levels = found.join(sizes, ["lang", "source"]).withColumn("p", level_of(F.col("n"), F.col("total"), F.col("terms")))
    over = levels.withColumn("q", level_of(F.col("lang_n"), F.col("lang_total"), F.col("terms"))).where("p > q")
    value = price(F.col("p"), F.col("q"))
    terms = over.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), value.alias("value"))
    pairs = _pair_values(levels.select("lang", "term", "source", "p", "lang_n"), sizes)
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = lambda part: part.withColumn("rank", F.row_number().over(order))
    return ranked(pairs).union(ranked(terms).where(F.col("rank") <= top_terms))


def _pair_values(levels: DataFrame, sizes: DataFrame) -> DataFrame:
    """Divergence of every two sources of a lang, both ways, from their joint tables.

    With ``o`` for the level of an absent term, the sum over all terms of the price is that of (o, o) for all
    of them, corrected for the terms that the one source has, that the other has, and that both have.
    """
    # Rare terms come first, so a block of many of them has few levels.
    dealt = levels.repartition("lang", "term").sortWithinPartitions("lang", "lang_n", "term").select("lang", "term", "source", "p")
    cells = dealt.mapInArrow(joint_tables, CELLS).groupBy("lang", "a", "a_p", "b", "b_p").agg(F.sum("n").alias("n"))
    cells = written(cells, "joint-tables")
    side = lambda name: sizes.select("lang", F.col("source").alias(name), F.col("none").alias(f"{name}_o"))
    both = side("a").join(side("b").join(sizes.select("lang", F.col("source").alias("b"), "terms"), ["lang", "b"]), "lang")
    both = written(both.where("a <> b"), "pairs")
    col, o = F.col, price(F.col("a_o"), F.col("b_o"))
    counts = cells.where("a = b")
    marginal_a = counts.select("lang", "a", "a_p", "n").join(both, ["lang", "a"])
    marginal_b = counts.select("lang", "b", "b_p", "n").join(both, ["lang", "b"])
    joint = cells.where("a <> b")
    mirrored = joint.select("lang", col("b").alias("a"), col("b_p").alias("a_p"), col("a").alias("b"), col("a_p").alias("b_p"), "n")
    joint = joint.union(mirrored).join(both, ["lang", "a", "b"])
    with_joint = price(col("a_p"), col("b_p")) - price(col("a_p"), col("b_o")) - price(col("a_o"), col("b_p")) + o
    amounts = [
        (both, col("terms"), o),
        (marginal_a, col("n"), price(col("a_p"), col("b_o")) - o),
        (marginal_b, col("n"), price(col("a_o"), col("b_p")) - o),
        (joint, col("n"), with_joint),
    ]
    summed = [
        frame.groupBy("lang", "a", "b").agg(F.sum(n.cast("decimal(18,0)") * each.cast("decimal(19,0)")).alias("value"))
        for frame, n, each in amounts
    ]
    value = F.sum("value").cast("bigint").alias("value")
    total = reduce(DataFrame.unionAll, summed).groupBy("lang", "a", "b").agg(value)
    return total.select("lang", col("a").alias("source"), F.lit("pair").alias("part"), col("b").alias("item"), "value")
