import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from ordermill.llm.queries import QUERIES
from ordermill.llm.toxicity import (
    DEVIATIONS,
    DISCOUNT,
    ODDS,
    count_levels,
    evidence,
    held_out,
    score_texts,
    train,
)
from ordermill.llm.words import PUNCTUATED, words

LABELS = "doc_id long, quality int, toxic int"


def corpus(n, seed=0):
    """Texts of common and rare words; toxic ones have a few of six words, some with rare endings."""
    rng = random.Random(seed)
    common = [f"c{i}" for i in range(150)]
    rude = ["vile", "foul", "nasty", "grim", "rank", "crud"]
    rows = []
    for i in range(n):
        text = [rng.choice(common) if rng.random() < 0.8 else f"r{rng.randrange(9000)}" for _ in range(rng.randrange(20, 200))]
        toxic = int(rng.random() < 0.15)
        for _ in range(toxic * max(2, len(text) // 30)):
            text.insert(rng.randrange(len(text)), rng.choice(rude) + (f"{rng.randrange(99)}" if rng.random() < 0.3 else ""))
        rows.append((i, " ".join(text), toxic))
    return rows


@pytest.fixture(scope="module")
def trained(spark):
    rows = corpus(900)
    docs = spark.createDataFrame([(i, text) for i, text, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, toxic) for i, _, toxic in rows], LABELS)
    return rows, docs, train(docs, labels)


def test_held_out_accuracy(spark, trained):
    rows, docs, model = trained
    scores = {r.doc_id: r.toxicity for r in score_texts(docs, model).collect()}
    held = [(scores[i] >= 0.5, toxic) for i, _, toxic in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert len(held) > 120
    assert np.mean([p for p, toxic in held if toxic]) > 0.85
    assert np.mean([p for p, toxic in held if not toxic]) < 0.02


def test_levels_against_brute_force(spark):
    """Every level by counting in dictionaries."""
    rows = corpus(250, seed=3)
    sample = spark.createDataFrame([(text, toxic) for _, text, toxic in rows], "text string, toxic int")
    model = count_levels(sample)

    pairs = [Counter(), Counter()]
    for _, text, toxic in rows:
        seq = text.split()
        pairs[toxic].update(zip([None, *seq], seq))
    kinds = [Counter(w for _, w in p) for p in pairs]
    stems = [Counter(), Counter()]
    for side in (0, 1):
        for w, n in kinds[side].items():
            stems[side][w[:4]] += n

    def own(counts, totals, x):
        both = counts[0][x] + counts[1][x]
        likely = [ODDS * t / (sum(totals) + (ODDS - 1) * t) for t in totals]
        chance = [both * q + DEVIATIONS * math.sqrt(both * q * (1 - q)) for q in likely]
        return [max(counts[s][x] - chance[s] - DISCOUNT, 0) for s in (0, 1)]

    def ratios(counts, totals, x, rest, below):
        both = counts[0][x] + counts[1][x]
        extra = own(counts, totals, x) if both else [0, 0]
        return [(extra[s] / totals[s] * sum(totals) / both if both and totals[s] else 0) + rest[s] * below[s] for s in (0, 1)]

    totals = [sum(k.values()) for k in kinds]
    rest = lambda counts: [
        1 - sum(own(counts, totals, x)[s] for x in set(counts[0]) | set(counts[1])) / totals[s] for s in (0, 1)
    ]
    stem_rest, word_rest = rest(stems), rest(kinds)
    heads = [Counter(), Counter()]
    for side in (0, 1):
        for (h, _), n in pairs[side].items():
            heads[side][h] += n
    for text in (rows[0][1], "vile7 vile vilest unknown", next(t for _, t, x in rows if x)):
        expected = []
        for h, w in zip([None, *text.split()], text.split()):
            below = ratios(stems, totals, w[:4], stem_rest, [1, 1])
            below = ratios(kinds, totals, w, word_rest, below)
            after = [heads[0][h], heads[1][h]]
            left = [1.0, 1.0]
            for tail in {t for s in (0, 1) for g, t in pairs[s] if g == h}:
                got = own(pairs, after, (h, tail))
                left = [left[s] - got[s] / max(after[s], 1) for s in (0, 1)]
            if sum(after):
                below = ratios(pairs, after, (h, w), left, below)
            expected.append(math.log(below[1] / below[0]))
        (found,) = words(pa.array([text]), separators=PUNCTUATED)
        assert np.allclose(evidence(model, found), expected)


@pytest.mark.parametrize("share", [0.12, 0.3, 0.5, 0.7])
def test_labels_of_any_balance(spark, share):
    """Rare toxic expressions are found and clean texts kept, however many labelled rows are toxic."""
    rng, rows = random.Random(11), []
    rare = [f"{a}{b}zz" for a in "qxj" for b in "qxjv"]
    for i, text, _ in corpus(900, seed=9):
        seq = [w for w in text.split() if w[0] in "cr" and w[1:].isdigit()]
        toxic = int(rng.random() < share)
        for _ in range(toxic * 3):
            seq.insert(rng.randrange(len(seq)), rng.choice(rare))
        rows.append((i, " ".join(seq), toxic))
    docs = spark.createDataFrame([(i, text) for i, text, _ in rows], "doc_id long, text string")
    model = train(docs, spark.createDataFrame([(i, 1, toxic) for i, _, toxic in rows], LABELS))
    scores = {r.doc_id: r.toxicity for r in score_texts(docs, model).collect()}
    held = [(scores[i] >= 0.5, toxic) for i, _, toxic in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([p for p, toxic in held if toxic]) > 0.85
    assert np.mean([p for p, toxic in held if not toxic]) < 0.05


def test_nulls_empty_repeats_long_and_clashing(spark, documents, trained):
    _, _, model = trained
    texts = [(1, None), (2, ""), (3, "?!"), (4, "vile foul nasty " * 3), (4, "vile foul nasty " * 3), (None, "c1 c2 c3 c4"), (5, "c1 c2 " * 100_000)]
    df = documents(texts, extra=True)
    out = score_texts(df, model, score="score")
    assert out.columns == [c for c in df.columns if c != "score"] + ["score"]
    rows = {(r.doc_id, r.text): r.score for r in out.collect()}
    assert rows[1, None] == rows[2, ""] == rows[3, "?!"] == model.prior
    assert rows[4, texts[3][1]] > 0.9 and rows[None, "c1 c2 c3 c4"] < 0.5 and rows[5, texts[6][1]] < 0.5
    assert all(0 <= score <= 1 for score in rows.values())
    assert score_texts(df.limit(0), model).count() == 0


@pytest.mark.parametrize(("toxic", "expected"), [([], 0.5), ([0] * 30, 0.0), ([1] * 30, 1.0), ([None] * 30, 0.5)])
def test_without_labels_of_both_kinds(spark, documents, toxic, expected):
    docs = documents([f"some words {i}" for i in range(30)])
    labels = spark.createDataFrame([(i, 1, x) for i, x in enumerate(toxic)], LABELS)
    scores = [r.toxicity for r in score_texts(docs, train(docs, labels)).collect()]
    assert np.allclose(scores, expected, atol=1e-6)


def test_training_bound_and_held_out_rows(spark, trained):
    rows, docs, _ = trained
    labels = spark.createDataFrame([(i, 1, toxic) for i, _, toxic in rows], LABELS)
    train(docs, labels, most_rows=200)  # a smaller sample still trains
    # Labels of held-out rows change nothing.
    flipped = spark.createDataFrame(
        [(i, 1, 1 - toxic if zlib.crc32(str(i).encode()) % 5 == 0 else toxic) for i, _, toxic in rows], LABELS
    )
    one, other = train(docs, labels), train(docs, flipped)
    assert np.allclose(one.curve, other.curve) and (one.words.key == other.words.key).all()
    assert docs.where(held_out(docs.doc_id, 5)).count() == sum(zlib.crc32(str(i).encode()) % 5 == 0 for i, *_ in rows)


def test_query_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    got = QUERIES["op7_kneser_ney_toxicity"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    rows = got.where("held_out").select("predicted", "toxic").collect()
    assert np.mean([r.predicted for r in rows if r.toxic]) > 0.8
    assert np.mean([r.predicted for r in rows if not r.toxic]) < 0.01
