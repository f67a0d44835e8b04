"""Session settings the jobs are tuned for. Every operator also runs on a plain Spark session."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Bytes of input files for which shuffles begin with one more partition; shuffled rows are about twice as large.
PARTITION_BYTES = 8 * 1024**2
#: Most bytes that a task is given of files or of shuffled rows. Sorted in memory they are 10 to 20 times as many.
TASK_BYTES = 16 * 1024**2

INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"
#: Only where Spark merges partitions does it begin with the initial number; else every shuffle has the plain one.
MERGES = ("spark.sql.adaptive.enabled", "spark.sql.adaptive.coalescePartitions.enabled")
#: Settings that bound the memory of a task, whatever the size of the input.
BOUNDED = ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes")
#: A few open files per task spare a sort by run_date before a partitioned write.
WRITERS, OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters", 16
#: Rows in memory are many times the size of their files, by which Spark chooses what to broadcast.
PACKED, PACKED_FACTOR = "spark.sql.sources.fileCompressionFactor", 8

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # Skewed join sides are split and small shuffle partitions merged at run time.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Merged partitions, and so files, get about this size where there is enough for every core.
    **dict.fromkeys(BOUNDED, str(TASK_BYTES)),
    WRITERS: str(OPEN_FILES),
    PACKED: str(PACKED_FACTOR),
}


def bound_tasks(spark: SparkSession) -> None:
    """Let no task be given more than ``TASK_BYTES``, and write by run without a sort, in any session.

    A sort then fits into the memory of a task instead of being spilled. Spark plans a broadcast by the size of
    files, and adaptive execution does not take it back where that would need another shuffle; so files count
    as what they unpack to. Lower sizes, more writers and a larger factor that are already set stay.
    """
    for name in BOUNDED:
        known = spark.conf.get(name)
        if _bytes(spark, known) > TASK_BYTES:
            spark.conf.set(name, str(TASK_BYTES))
    if int(spark.conf.get(WRITERS)) < OPEN_FILES:
        spark.conf.set(WRITERS, str(OPEN_FILES))
    if float(spark.conf.get(PACKED)) < PACKED_FACTOR:
        spark.conf.set(PACKED, str(PACKED_FACTOR))


def _bytes(spark: SparkSession, size: str) -> int:
    return int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(size))


def size_shuffles(spark: SparkSession, *frames: DataFrame) -> int:
    """Raise the number of partitions that shuffles begin with to what the frames need; returns it.

    Their sizes are Spark's own estimates, from the files. Adaptive execution then merges small
    partitions; in a session that does not, all shuffles get that number. A larger number that is already set
    stays. What a task is given is bounded, too.
    """
    bound_tasks(spark)
    estimated = sum(_estimated_bytes(df) for df in frames)
    needed = -(-estimated // PARTITION_BYTES)
    merges = all(spark.conf.get(name) == "true" for name in MERGES)
    known = merges and spark.conf.get(INITIAL_PARTITIONS, None) or spark.conf.get(SHUFFLE_PARTITIONS)
    if needed > int(known):
        spark.conf.set(INITIAL_PARTITIONS if merges else SHUFFLE_PARTITIONS, str(needed))
    return max(needed, int(known))


def _estimated_bytes(df: DataFrame) -> int:
    """Bytes of all files that the frame reads; Spark's estimate of a join itself is a product of its sides."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    unpacked = sum(int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.length()))
    return int(unpacked / float(df.sparkSession.conf.get(PACKED)))


def build_session(
    app: str = "ordermill", master: str | None = None, **settings: str
) -> SparkSession:
    """Create or get a session; ``settings`` use ``__`` for the dots of a Spark setting."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    wanted = dict(SETTINGS)
    wanted.update({key.replace("__", "."): value for key, value in settings.items()})
    for key, value in wanted.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
