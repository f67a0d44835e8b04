import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ordermill.llm import katz
from ordermill.llm.katz import REACH, good_turing, katz_scores, pack, pack_sorted, unigrams, unpack, unpack_sorted
from ordermill.llm.queries import QUERIES
from ordermill.llm.toxicity import held_out

WORD = re.compile(r"[^\x20\x09-\x0D]+")
END = "</end>"


def tokens(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + [END]


class Brute:
    """The same model over dictionaries."""

    def __init__(self, texts):
        seqs = [tokens(text) for text in texts]
        self.single = Counter(w for seq in seqs for w in seq)
        self.pairs = Counter((h, w) for seq in seqs for h, w in zip([None, *seq], seq))
        self.after = Counter()
        for (h, _), n in self.pairs.items():
            self.after[h] += n
        times = lambda counts: [sum(1 for n in counts.values() if n == r) for r in range(1, REACH + 2)]
        self.kept1, self.kept2 = good_turing(times(self.single)).kept, good_turing(times(self.pairs)).kept
        self.n = sum(self.single.values())
        keep = lambda n, kept: n * (kept[n] if n <= REACH else 1)
        self.keep1, self.keep2 = lambda n: keep(n, self.kept1), lambda n: keep(n, self.kept2)
        freed = sum(n - self.keep1(n) for n in self.single.values())
        self.room, self.unknown = (1, freed / self.n) if freed else (self.n / (self.n + 1), 1 / (self.n + 1))

    def p1(self, w):
        return self.keep1(self.single[w]) / self.n * self.room if w in self.single else self.unknown

    def p(self, h, w):
        if not self.after[h]:
            return self.p1(w)
        follow = {t: n for (g, t), n in self.pairs.items() if g == h}
        freed = sum(n - self.keep2(n) for n in follow.values()) / self.after[h]
        room = 1.0
        if freed <= 1e-12:
            room, freed = self.after[h] / (self.after[h] + 1), 1 / (self.after[h] + 1)
        if w in follow:
            return self.keep2(follow[w]) / self.after[h] * room
        return freed / (1 - sum(self.p1(t) for t in follow)) * self.p1(w)

    def score(self, text):
        seq = tokens(text)
        return sum(math.log10(self.p(h, w)) for h, w in zip([None, *seq], seq))

    def base(self, text):
        v = len(self.single)
        return sum(math.log10((self.single[w] + 0.1) / (self.n + 0.1 * (v + 1))) for w in tokens(text))


def corpus(n, seed=0, vocabulary=60):
    rng = random.Random(seed)
    weights = [1 / (i + 1) for i in range(vocabulary)]
    return [(i, " ".join(rng.choices([f"W{j}" for j in range(vocabulary)], weights, k=rng.randrange(0, 30)))) for i in range(n)]


def is_held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 10 == 0


def compare(df, texts):
    model = Brute([text for i, text in texts if not is_held(i)])
    rows = katz_scores(df, held_out(F.col("doc_id"), 10)).collect()
    expected = sorted(
        (i or -1, is_held(i), len(tokens(text)), sum(w in model.single for w in tokens(text)), model.n,
         round(model.base(text), 6), round(model.score(text), 6))
        for i, text in texts
    )
    got = sorted(
        (r.doc_id or -1, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in rows
    )
    assert [g[:5] for g in got] == [e[:5] for e in expected]
    assert np.allclose([g[5:] for g in got], [e[5:] for e in expected], atol=1e-5)


@pytest.mark.parametrize("seed", [0, 1])
def test_scores_against_brute_force(spark, documents, seed):
    texts = corpus(150, seed)
    compare(documents(texts, extra=True).repartition(3), texts)


def test_small_blocks_and_spread_heads(spark, documents, monkeypatch):
    monkeypatch.setattr(katz, "BLOCK_TOKENS", 100)
    monkeypatch.setattr(katz, "HEAD_TOKENS", 20)
    monkeypatch.setattr(katz, "LEAST_BUCKETS", 3)
    texts = corpus(120, 2, vocabulary=25)
    compare(documents(texts), texts)


def test_probabilities_add_up_to_one():
    model = Brute([text for _, text in corpus(100, 3)])
    for head in [None, "w0", "w7", "w59", "never"]:
        assert sum(model.p(head, w) for w in model.single) + model.p(head, "unknown word") == pytest.approx(1)


def test_backoff_weights_are_exactly_normalised(spark, documents):
    """From the written tables: for every first word, seen pairs and weighted unigrams add up to one."""
    texts, out = corpus(150, 4), {}
    katz_scores(documents(texts), held_out(F.col("doc_id"), 10), out=out).count()
    buckets = katz.LEAST_BUCKETS
    count, single_stats, pair_stats = {}, [], []
    for row in out["unigrams"].collect():
        counts = unpack(row.b)
        count |= {1 + row.bucket + buckets * i: int(n) for i, n in enumerate(counts)}
        single_stats.append(row.stats)
    follow = {}
    for row in out["bigrams"].collect():
        pair_stats.append(row.stats)
        for h, w, n in zip(unpack_sorted(row.a).tolist(), unpack(row.b).tolist(), unpack(row.c).tolist()):
            follow.setdefault(h, {})[w] = n
    single = unigrams(np.sum(single_stats, axis=0))
    pairs = good_turing(np.sum(pair_stats, axis=0).tolist())
    p1 = {w: single.probability(np.array([n]))[0] for w, n in count.items()}
    checked = 0
    for row in out["weights"].collect():
        for h, weight, kept in zip(unpack_sorted(row.a).tolist(), unpack(row.b), unpack(row.c)):
            after = sum(follow[h].values())
            seen = sum(pairs.of(np.array([n]))[0] for n in follow[h].values()) / after * 10**kept
            rest = 1 - sum(p1[w] for w in follow[h])
            assert seen + 10**weight * rest == pytest.approx(1, abs=1e-9)
            checked += 1
    assert checked == len(follow) > 40 and sum(p1.values()) + single.unknown == pytest.approx(1)


def test_nulls_empty_long_and_repeated(spark, documents):
    texts = [(None, "a b"), (1, None), (2, ""), (3, "\n \t"), (4, "A b a"), (4, "A b a"), (5, "b a " * 40_000), (10, "é 漢")]
    compare(documents(texts), texts)
    empty = katz_scores(documents(texts).limit(0), held_out(F.col("doc_id"), 10))
    assert empty.count() == 0 and empty.columns[0] == "doc_id"


def test_nothing_to_learn_from(spark, documents):
    held = [i for i in range(200) if is_held(i)][:3]
    rows = katz_scores(documents([(i, "x y") for i in held]), held_out(F.col("doc_id"), 10)).collect()
    assert [(r.n_known, r.train_tokens, r.base_score, r.score) for r in rows] == [(0, 0, 0.0, 0.0)] * 3


def test_good_turing_falls_back_where_counts_are_odd():
    assert good_turing([0] * (REACH + 1)).kept[1:].tolist() == [(r - 0.5) / r for r in range(1, REACH + 1)]
    kept = good_turing([1000, 400, 220, 140, 100, 80]).kept[1:]
    assert (0 < kept).all() and (kept < 1).all() and kept[0] < kept[-1]


@pytest.mark.parametrize("numbers", [[], [0], [5, 3, 300], [-1, 70_000], [2**40, 1], [0.5, -1e300]])
def test_packing(numbers):
    array = np.array(numbers, dtype=np.float64 if any(isinstance(x, float) for x in numbers) else np.int64)
    assert unpack(pack(array)).tolist() == numbers
    ordered = np.sort(array)
    if array.dtype.kind == "i":
        assert unpack_sorted(pack_sorted(ordered)).tolist() == ordered.tolist()
    hashes = np.array([1, 2**63, 2**64 - 1], dtype=np.uint64)
    assert (unpack_sorted(pack_sorted(hashes)) == hashes).all()


def test_katz_beats_the_base_on_held_out_documents(spark):
    rows = QUERIES["op8_katz_backoff"](spark, "/root/testdata/sf0.01").where("held_out").collect()
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)
