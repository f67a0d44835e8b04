from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ordermill.llm.mixing import pfair_mix, pfair_slots


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 40), st.integers(1, 20)), min_size=1, max_size=6))
def test_less_than_one_block_of_deviation_in_every_phase(sources):
    blocks, weights = [b for b, _ in sources], [w for _, w in sources]
    slots = pfair_slots(blocks, weights)
    assert Counter(i for i, _, _ in slots) == Counter(dict(enumerate(blocks)))
    done = Counter()
    for phase in range(slots[-1][2] + 1):
        active = [i for i in range(len(blocks)) if done[i] < blocks[i]]
        whole, counts = sum(weights[i] for i in active), Counter()
        for n, (i, k, _) in enumerate([s for s in slots if s[2] == phase], 1):
            assert k == done[i] + counts[i]
            counts[i] += 1
            for j in active:
                assert abs(counts[j] - Fraction(n * weights[j], whole)) < 1
        done.update(counts)


def test_brute_force_of_the_operator(spark):
    rows = [(i, "big" if i % 3 else ("a" if i % 2 else None)) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, source string")
    out = pfair_mix(df, {"big": 2.0, "a": 1.0}, block_rows=10, rows_each=40).orderBy("mix_position").collect()
    assert [r.mix_position for r in out] == list(range(300))
    assert sorted(r.doc_id for r in out) == list(range(300))
    # Blocks in order of position are the schedule; each has ten rows of one source.
    sizes, order = Counter(), []
    for r in out:
        if not order or order[-1] != (r.source, r.mix_block):
            order.append((r.source, r.mix_block))
        sizes[r.source, r.mix_block] += 1
    assert set(sizes.values()) == {10} and len(order) == 30
    names = ["a", "big", None]  # in the order of their keys
    expected = [(names[i], k) for i, k, _ in pfair_slots([5, 20, 5], [1.0, 2.0, 1.0])]
    assert order == expected


def test_nulls_repeats_clashing_names_and_empty(spark, documents):
    df = documents([(None, None), (1, ""), (1, ""), (2, "x" * 300_000)], extra=True).selectExpr("*", "0 AS mix_block")
    out = pfair_mix(df)
    assert out.count() == 4 and sorted(r.mix_position for r in out.collect()) == [0, 1, 2, 3]
    assert out.columns == df.columns[:-1] + ["mix_block", "mix_phase", "mix_position"]
    assert pfair_mix(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        pfair_mix(df, {"src1": 0.0})


def test_a_bounded_schedule_makes_blocks_larger(spark):
    df = spark.range(1000).selectExpr("id AS doc_id", "'s' AS source")
    blocks = defaultdict(int)
    for r in pfair_mix(df, block_rows=1, most_blocks=10).collect():
        blocks[r.mix_block] += 1
    assert set(blocks.values()) == {100}


def test_very_small_and_very_uneven_weights_are_exact():
    slots = pfair_slots([3, 2000], [1e-7, 1e-7 * 999])
    first = [n for n, (i, _, _) in enumerate(slots) if i == 0]
    assert len(first) == 3 and first[0] < 1000 <= first[1] + 1 and len(slots) == 2003
    assert pfair_slots([2, 2], [1e-300, 1e-300]) == pfair_slots([2, 2], [1.0, 1.0])
    many = pfair_slots([1 + i % 5 for i in range(300)], [1 + i % 7 for i in range(300)])
    assert Counter(i for i, _, _ in many) == Counter({i: 1 + i % 5 for i in range(300)})
