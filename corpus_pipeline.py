"""From raw documents to training shards: five stages, each applying one operator to all rows it gets.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame that is
written as Parquet and read again for the next stage. All but the last return the columns of documents.
Every stage keeps rows with null or empty texts, and what it does with ties, repeated rows and empty tables
is said at its operator.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.llm.common import ROW, numbered, table, written
from ordermill.llm.mixing import pfair_mix
from ordermill.llm.neardup import keep_one_of_each
from ordermill.llm.sharding import shuffle_to_shards
from ordermill.llm.tiling import decontaminate
from ordermill.llm.toxicity import score_texts, train

SHARDS = 16
FILE, AT = "__file", "__at"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go: score 0.5 or more.

    The model learns from the labelled rows among the documents that it gets. A text without words has
    no evidence against it and stays. Without labelled texts of both kinds nothing tells texts apart, and all stay.
    """
    model = train(docs, table(spark, sf_dir, "labels"))
    if not model.tells_apart:
        return docs
    scored = score_texts(docs, model, score="__score")
    return scored.where((F.col("__score") < 0.5) | F.coalesce(F.trim("text") == "", F.lit(True))).drop("__score")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays: five-word shingles, similarity 0.8."""
    return keep_one_of_each(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that cover half of a benchmark item or more go."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of a mix of all sources to equal weights.

    Files and rows follow the mix. Once a source has no document left, the others go on without it. The next
    stage reads the order back from the files.
    """
    mixed = pfair_mix(docs)
    return mixed.orderBy("mix_position").select(*[F.col(f"`{name}`") for name in docs.columns])


def with_place(docs: DataFrame) -> DataFrame:
    """``docs`` with the number of the file and of the row in it that each one comes from.

    Files written in one go are numbered in the order of their rows. Rows that do not come from files are
    taken as they come.
    """
    try:
        docs.select("_metadata.row_index")
    except AnalysisException:
        return docs.withColumns({FILE: F.lit(0), AT: F.monotonically_increasing_id()})
    number = F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1)
    return docs.withColumns({FILE: F.expr(f"coalesce(try_cast({{number}} AS bigint), 0)", number=number) if False else F.coalesce(number.try_cast("bigint"), F.lit(0)), AT: F.col("_metadata.row_index")})


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with ``shard`` and ``slot``: a uniform shuffle into shards of equal row counts, each in mix order.

    Which rows a shard gets does not depend on their source. Its slots are a mix of all sources to equal
    weights, row by row: after any number of slots, each source that is not used up has less than one row
    more or less than its share (of larger blocks in shards of more than 2^20 rows). The documents of a source
    take its slots in the order of the mixing stage.
    """
    rows = numbered(with_place(docs), "mixed-shards")
    dealt = shuffle_to_shards(rows.select(F.col(ROW).alias("number"), "source", FILE, AT), SHARDS)
    placed = pfair_mix(dealt, block_rows=1, within="shard", order=(FILE, AT)).select(
        F.col("number").alias(ROW), "shard", F.col("mix_position").alias("slot")
    )
    return rows.join(placed, ROW).drop(ROW, FILE, AT)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("mixing", mix_sources),
    ("sharding", shard),
]

# Models, trees and permutations are not expressible in SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
