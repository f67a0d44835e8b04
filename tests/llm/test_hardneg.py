import itertools
import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from ordermill.llm import hardneg
from ordermill.llm.hardneg import bounds, dot, hilbert, mine_hard_negatives
from ordermill.llm.queries import ORACLE_SQL, QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, every=100, positives=5, negatives=10):
    """Python integers, every anchor against every row."""
    points = []
    for number, values, label in rows:
        if number is None or label is None or values is None or any(x is None or not math.isfinite(x) for x in values):
            continue
        label = (label + 1) % 10 if number % 7 == 0 else label
        points.append((number, label, [math.floor(256 * float(np.float32(x))) for x in values]))
    out = []
    for i, (anchor, label, a) in enumerate(points):
        if anchor % every:
            continue
        scored = [(-sum(x * y for x, y in zip(a, v)), n, of) for j, (n, of, v) in enumerate(points) if j != i]
        scored.sort()
        for ps, positive, _ in [s for s in scored if s[2] == label][:positives]:
            fit = [s for s in scored if s[2] != label and 30 * -ps <= 100 * -s[0] <= 90 * -ps][:negatives]
            out += [(anchor, positive, rank, n, -ps, -ns) for rank, (ns, n, _) in enumerate(fit, 1)]
    return sorted(out)


def mined(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("tile", "block", "score", "id", "rank"):
        df = df.withColumn(name, F.lit("mine"))
    got = mine_hard_negatives(df, **options)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(row) for row in got.collect())


def clustered(count, dimensions=8, seed=1, spread=0.3):
    """Vectors near one center per label, so that the bounds do tell blocks apart."""
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(10, dimensions))
    labels = rng.integers(0, 10, count)
    x = centers[labels] + spread * rng.normal(size=(count, dimensions))
    return [(i, x[i].tolist(), int(labels[i])) for i in range(count)]


def test_random_rows(spark):
    rows = clustered(900)
    assert mined(spark, rows) == brute(rows)
    assert mined(spark, rows, anchor_every=40, positives=2, negatives=3) == brute(rows, 40, 2, 3)


def test_small_blocks_and_tiles(spark, monkeypatch):
    for name, size in (("BLOCK", 8), ("TILE", 4), ("ZONES", 16), ("BLOCKS_READ", 4)):
        monkeypatch.setattr(hardneg, name, size)
    rows = clustered(700, seed=2)
    assert mined(spark, rows, anchor_every=20) == brute(rows, 20)


def test_ties_copies_and_rows_that_take_no_part(spark):
    rows = [(i, [1.0, 0.5, 0.25], i % 3) for i in range(60)]  # all equal: ties go by id
    rows += [(100, [1.2, 0.6, 0.3], 1), (100, [1.2, 0.6, 0.3], 1), (200, [0.7, 0.5, 0.1], 2)]
    rows += [(300, None, 1), (301, [1.0, None, 0.0], 1), (302, [float("nan"), 0.0, 0.0], 2), (303, [1.0, 0.0, 0.0], None)]
    rows += [(304, [float("inf"), 0.0, 0.0], 2), (None, [1.0, 0.0, 0.0], 2), (400, [-1.0, -0.5, 0.0], 0), (500, [], 1)]
    rows += [(600 + i, [0.6 + i / 100, 0.1, 0.2], (i + 2) % 3) for i in range(40)]
    rows += [(700, [0.5], 1), (701, [0.4, 0.3, 0.2, 0.9], 2)]
    got = mined(spark, rows)
    assert got == brute(rows) and any(row[:2] == (100, 100) for row in got)


def test_empty_table_and_table_without_anchors(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, [1.0], 1), (2, [0.9], 2)]) == []
    assert mined(spark, [(100, [1.0], 1)]) == []


def test_very_large_components(spark):
    # Products that doubles, and bounds that 64 bits, do not hold.
    rows = [(i, [(0.5 + i / 10) * 1e7, -1e6], i % 2) for i in range(5)] + [(100, [0.9e7, 1e6], 1)]
    wanted = brute(rows)
    assert wanted and max(row[4] for row in wanted) > 2**53 and mined(spark, rows) == wanted
    for values, message in (([1e30], "component beyond 64 bits"), ([1e12], "too large")):
        with pytest.raises(Exception, match=message):
            mined(spark, [(100, values, 1), (200, values, 1), (1, values, 2)])


def test_curve_visits_all_cells_one_step_at_a_time():
    for dimensions, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=dimensions)))
        place = hilbert(cells, bits)
        assert sorted(place) == list(range(len(cells)))
        steps = np.abs(np.diff(cells[np.argsort(place)], axis=0)).sum(axis=1)
        assert (steps == 1).all()


def test_bounds_hold_and_products_are_exact():
    rng = np.random.default_rng(4)
    x, anchors = rng.integers(-300, 300, (50, 6)), rng.integers(-300, 300, (9, 6))
    least, most = bounds(anchors, x.min(axis=0)[None, :], x.max(axis=0)[None, :])
    scores = anchors @ x.T
    assert (least[:, 0] <= scores.min(axis=1)).all() and (most[:, 0] >= scores.max(axis=1)).all()
    big = rng.integers(-(2**30), 2**30, (3, 4))
    assert dot(big, big).tolist() == [[sum(int(a) * int(b) for a, b in zip(r, s)) for s in big] for r in big]


def test_bounds_spare_blocks(spark, monkeypatch):
    """On clustered vectors most blocks are never read."""
    monkeypatch.setattr(hardneg, "BLOCK", 16)
    seen = []
    search = hardneg._search

    def counting(tiles, blocks, chunks, count, same_label, most):
        wanted = tiles.crossJoin(chunks).select("tile", "label", "ids", "vectors", "low", "high", "zones")
        chosen = wanted.mapInArrow(hardneg.choose_blocks(same_label), "tile long, block long, best long").count()
        seen.append((chosen, tiles.count() * count))
        return search(tiles, blocks, chunks, count, same_label, most)

    monkeypatch.setattr(hardneg, "_search", counting)
    rows = clustered(2000, spread=0.05, seed=7)
    assert mined(spark, rows) == brute(rows)
    assert seen[0][0] < 0.2 * seen[0][1] and seen[1][0] < 0.8 * seen[1][1]


def test_sql_and_query_agree(spark):
    sf_dir = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{sf_dir}/embeddings.parquet'")
    expected = sorted(con.sql(ORACLE_SQL["op13_hilbert_hard_negatives"]).fetchall())
    got = sorted(tuple(row) for row in QUERIES["op13_hilbert_hard_negatives"](spark, sf_dir).collect())
    assert got == expected and len(got) > 100
