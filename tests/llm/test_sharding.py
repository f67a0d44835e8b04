from collections import Counter

import numpy as np
import pytest

from ordermill.llm.sharding import even_sizes, hypergeometric, matrix_row, shuffle_to_shards, split_cells


def placed(df):
    return [tuple(row) for row in df.select("doc_id", "shard", "slot").collect()]


def test_exact_sizes_and_gapless_slots(spark):
    df = shuffle_to_shards(spark.range(1003).withColumnRenamed("id", "doc_id"), 7, rows_each=20)
    rows = placed(df)
    assert sorted(i for i, _, _ in rows) == list(range(1003))
    sizes = Counter(shard for _, shard, _ in rows)
    assert sorted(sizes) == list(range(7)) and max(sizes.values()) - min(sizes.values()) <= 1
    for shard in range(7):
        assert sorted(slot for _, s, slot in rows if s == shard) == list(range(sizes[shard]))


def test_same_seed_same_order_other_seed_other_order(spark):
    ids = spark.range(0, 400, 1, 4).withColumnRenamed("id", "doc_id")
    first, again = (sorted(placed(shuffle_to_shards(ids, 4, seed=3, rows_each=30))) for _ in range(2))
    assert first == again != sorted(placed(shuffle_to_shards(ids, 4, seed=4, rows_each=30)))


def test_matrix_rows_add_up_to_cells():
    blocks, cells = np.array([50, 0, 31, 19, 7]), np.array([30, 40, 37])
    rows = np.stack([matrix_row(blocks, cells, block, 5) for block in range(5)])
    assert (rows.sum(axis=0) == cells).all() and (rows.sum(axis=1) == blocks).all() and (rows >= 0).all()


def test_counts_have_the_hypergeometric_mean_and_spread():
    draws = np.array([matrix_row(np.array([40, 60]), np.array([30, 70]), 0, seed)[0] for seed in range(4000)])
    assert abs(draws.mean() - 12) < 0.15
    assert abs(draws.var() - 40 * 0.3 * 0.7 * 60 / 99) < 0.4


def test_large_populations_are_drawn_exactly_enough(monkeypatch):
    rng = np.random.default_rng(1)
    draws = np.array([hypergeometric(rng, 3 * 10**9, 7 * 10**9, 10_000) for _ in range(300)])
    assert abs(draws.mean() - 3000) < 12 and 30 < draws.std() < 62
    monkeypatch.setattr("ordermill.llm.sharding.NUMPY_POPULATION", 10)
    small = np.array([hypergeometric(rng, 30, 70, 40) for _ in range(4000)])
    assert abs(small.mean() - 12) < 0.2 and abs(small.var() - 40 * 0.3 * 0.7 * 60 / 99) < 0.5
    split = split_cells(rng, np.array([30, 0, 70]), 40)
    assert split.sum() == 40 and split[1] == 0


def test_each_row_reaches_each_place_equally_often(spark):
    """Chi-square over shards for one row, and over pairs of neighbours staying together."""
    ids = spark.range(12).withColumnRenamed("id", "doc_id")
    seen = Counter()
    for seed in range(40):
        seen.update((i, shard) for i, shard, _ in placed(shuffle_to_shards(ids, 3, seed=seed, rows_each=2)))
    expected = 40 / 3
    assert sum((seen[i, s] - expected) ** 2 / expected for i in range(12) for s in range(3)) < 70


def test_nulls_repeats_clashing_names_and_empty(spark, documents):
    df = documents([(None, None), (1, ""), (1, ""), (1, ""), (2, "x" * 300_000)], extra=True)
    out = shuffle_to_shards(df, 2)
    assert out.columns == [c for c in df.columns if c not in ("shard", "slot")] + ["shard", "slot"]
    assert sorted(placed(out), key=str) and out.count() == 5
    assert Counter(r.shard for r in out.collect()) == {0: 3, 1: 2}
    assert shuffle_to_shards(df.limit(0), 2).count() == 0
    with pytest.raises(ValueError):
        shuffle_to_shards(df, 0)


def test_even_sizes():
    assert even_sizes(10, 4).tolist() == [3, 3, 2, 2]
