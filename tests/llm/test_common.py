import os

from ordermill.llm.common import CLEANUP, written


def shuffled(folder):
    return [name for _, _, names in os.walk(folder) for name in names if name.startswith("shuffle_")]


def test_shuffle_files_go_with_the_write(spark):
    def files():
        disks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
        return {name for folder in disks for name in shuffled(folder)}

    before, setting = files(), spark.conf.get(CLEANUP)
    frame = spark.range(1000).selectExpr("id % 7 AS k", "id").repartition(3, "k").groupBy("k").count()
    back = written(frame, "counts")
    assert files() <= before
    assert spark.conf.get(CLEANUP) == setting
    assert {r.k: r["count"] for r in back.collect()} == {k: len(range(k, 1000, 7)) for k in range(7)}
