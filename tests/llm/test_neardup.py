import random
import re
from itertools import combinations

import pytest

from ordermill.llm import neardup
from ordermill.llm.components import components
from ordermill.llm.neardup import keep_one_of_each, missed, near_duplicates, plan_trees

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, size):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def brute(texts, size, percent=80):
    """All pairs, union-find."""
    sets = {i: shingles(text, size) for i, text in texts}
    parent = {i: i for i, _ in texts}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in combinations(sets, 2):
        common = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    return sorted((i, len(sets[i]), root(i), root(i) == i) for i in sets)


def found(df, size):
    return sorted(tuple(row) for row in near_duplicates(df, shingle_words=size).collect())


def varied(seed, groups, copies, words=80, vocabulary=60, edits=6):
    """Groups of drifting copies over a small vocabulary, so that unrelated texts share shingles, too."""
    rng = random.Random(seed)
    texts = []
    for _ in range(groups):
        base = [f"w{rng.randrange(vocabulary)}" for _ in range(words)]
        for _ in range(copies):
            texts.append(" ".join(base))
            base = list(base)
            for _ in range(rng.randrange(edits)):
                base[rng.randrange(words)] = f"x{rng.randrange(1000)}"
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize(("seed", "size", "crowded", "most_ids"), [(1, 2, 2048, 1 << 17), (2, 2, 2, 0), (3, 5, 2, 1 << 17)])
def test_same_classes_as_all_pairs(spark, documents, monkeypatch, seed, size, crowded, most_ids):
    monkeypatch.setattr(neardup, "CROWDED_PAIRS", crowded)
    monkeypatch.setattr(neardup, "BROADCAST_IDS", most_ids)
    texts = varied(seed, 12, 8)
    assert found(documents(texts), size) == brute(texts, size)


def test_chains_and_thresholds(spark, documents):
    words = [f"a{i}" for i in range(41)]  # 40 shingles of two words
    close = " ".join(words[:-4])  # 36 of 40: linked
    far = " ".join(words[:-9])  # 31 of 40 with the first, 31 of 36 with the second
    texts = [(5, " ".join(words)), (3, close), (9, far), (4, "lonely words here"), (8, " ".join(reversed(words)))]
    assert found(documents(texts), 2) == brute(texts, 2)
    assert {row[0]: row[2] for row in found(documents(texts), 2)} == {5: 3, 3: 3, 9: 3, 4: 4, 8: 8}
    exact = [(1, " ".join(words)), (2, " ".join(words[:33]))]  # 32 of 40: right at the threshold
    assert [row[2] for row in found(documents(exact), 2)] == [1, 1]


def test_large_mixed_nodes_branch_on(spark, documents, monkeypatch):
    monkeypatch.setattr(neardup, "PAIRS_EACH", 1)
    monkeypatch.setattr(neardup, "BACKGROUND", 1e-9)  # start at depth one, where nodes are large
    levels = []
    original = neardup.branch
    monkeypatch.setattr(neardup, "branch", lambda *a: levels.append(1) or original(*a))
    texts = varied(4, 6, 15, words=40, vocabulary=12)
    assert found(documents(texts), 2) == brute(texts, 2)
    assert levels


def test_nulls_empty_long_repeated_and_clashing(spark, documents):
    long = " ".join(f"t{i}" for i in range(60_000))
    texts = [(1, None), (2, ""), (3, " \n\t"), (4, "One"), (5, "one"), (6, long), (7, long + " more"), (None, "one"), (8, "é"), (8, "é")]
    rows = near_duplicates(documents(texts, extra=True), shingle_words=2).collect()
    got = sorted(((r.doc_id or 0), r.n_shingles, r.component_id, r.kept) for r in rows)
    assert got == [
        (0, 1, None, True), (1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (5, 1, 4, False),
        (6, 59_999, 6, True), (7, 60_000, 6, False), (8, 1, 8, True), (8, 1, 8, True),
    ]
    assert near_duplicates(documents([(1, "a")]).limit(0)).count() == 0


def test_one_row_of_each_class_stays(spark, documents):
    texts = [(1, "a b c d e f"), (2, "A b c d e f"), (3, "other words in a row here"), (3, "other words in a row here"), (4, None), (None, "x")]
    df = documents(texts, extra=True)
    kept = keep_one_of_each(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 3, 4]


def test_rows_of_one_key_are_told_apart(spark, documents):
    """A row goes only if its own text is a near copy of one that stays."""
    texts = [(1, "a real text of some words"), (1, ""), (2, "a real text of some words"), (7, "alone here"), (7, "alone here"), (7, "else")]
    kept = sorted((r.doc_id, r.text) for r in keep_one_of_each(documents(texts, extra=True)).collect())
    assert kept == [(1, ""), (1, "a real text of some words"), (7, "alone here"), (7, "else")]
    assert keep_one_of_each(documents(texts).limit(0)).count() == 0


def dense(seed, outsiders, copies, words=120):
    """Copies of one text with a few words changed, some with more: many pairs are similar and not linked."""
    rng = random.Random(seed)
    base = [f"b{i}" for i in range(words)]
    texts = []
    for i in range(copies + outsiders):
        text = list(base)
        for at in rng.sample(range(words), rng.randrange(3, 9) if i < copies else rng.randrange(10, 16)):
            text[at] = f"x{i}y{at}"
        texts.append(" ".join(text))
    rng.shuffle(texts)
    return list(enumerate(texts))


def test_a_dense_group_costs_its_size(spark, documents, monkeypatch):
    """Labels settle most pairs: far fewer than all are compared, and the classes are those of all pairs."""
    texts = dense(6, 60, 240)
    compared = []
    original = neardup.confirmed

    def counted(pairs, source):
        compared.append(pairs.count())
        return original(pairs, source)

    monkeypatch.setattr(neardup, "confirmed", counted)
    monkeypatch.setattr(neardup, "TILE", 50)
    assert found(documents(texts), 2) == brute(texts, 2)
    assert sum(compared) < 300 * 299 / 2 / 5


def test_tiles_compare_as_all_pairs_do(spark):
    rng = random.Random(8)
    sets = {i: sorted(rng.sample(range(40), rng.randrange(1, 30))) for i in range(30)}
    texts = [(i, " ".join(f"w{n}" for n in s)) for i, s in sets.items()]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    pairs = spark.createDataFrame([(b, a) for a, b in combinations(sets, 2)], "a long, b long")
    got = {tuple(r) for r in neardup.confirmed(pairs, neardup.Source(df, "doc_id", "text", 1, 50)).collect()}
    assert got == {(b, a) for a, b in combinations(sets, 2) if 2 * len({*sets[a]} & {*sets[b]}) >= len({*sets[a]} | {*sets[b]})}


def test_recall_is_planned_for_pairs_at_the_threshold():
    depth, trees = plan_trees(10**9, 0.8, 0.9999)
    assert missed(0.8, depth + 2) ** trees <= 1e-4 and missed(0.8, 3) < missed(0.8, 6) and missed(1.0, 9) == 0


def test_components_of_chains_stars_and_rings(spark):
    rng = random.Random(5)
    chain = [(i, i + 1) for i in range(0, 60)]
    star = [(100, i) for i in range(101, 140)]
    ring = [(200 + i, 200 + (i + 1) % 9) for i in range(9)]
    links = [tuple(rng.sample(pair, 2)) for pair in chain + star + ring]
    rng.shuffle(links)
    got = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 140)}, **{200 + i: 200 for i in range(9)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_recall_where_crowded_nodes_branch_on(spark, monkeypatch):
    """Pairs right at the similarity, all in one dense group that is settled on the last level only."""
    monkeypatch.setattr(neardup, "PAIRS_EACH", 0)
    monkeypatch.setattr(neardup, "MORE_LEVELS", 8)
    rows = []
    for i in range(300):
        common = [f"c{n}" for n in range(50)] + [f"p{i}x{n}" for n in range(30)]
        rows += [(2 * i + side, " ".join(common + [f"own{i}s{side}n{n}" for n in range(10)])) for side in (0, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = neardup.near_duplicates(df, shingle_words=1, target_recall=0.66).collect()
    linked = sum(r.component_id != r.doc_id for r in found)
    assert linked >= 0.66 * 300


def test_a_set_travels_once_however_many_parts_there_are(spark, monkeypatch):
    """Small groups of pairs are compared in one tile each, a large one in pieces; no link is lost."""
    monkeypatch.setattr(neardup, "TILE", 10)
    groups = [range(12 * g, 12 * g + 6) for g in range(40)] + [range(1000, 1035)]
    texts = [(i, f"a b c d e f g h i{g} j own{i}") for g, ids in enumerate(groups) for i in ids]
    pairs = [(b, a) for ids in groups for a, b in combinations(ids, 2)]
    rows = spark.createDataFrame(pairs, "a long, b long")
    dealt = {r.id: (r.home, r.piece) for r in neardup.grouped(rows).collect()}
    assert all(len({dealt[i] for i in ids}) == 1 for ids in groups[:-1])
    assert {dealt[i][0] for i in groups[-1]} == {1000} and len({dealt[i] for i in groups[-1]}) == 4
    sent = []
    original = neardup.written

    def watched(df, label):
        back = original(df, label)
        if label == "tiles":
            tiles = back.select("tile", "a").union(back.select("tile", "b")).distinct()
            sent.append(tiles.join(spark.createDataFrame([(i,) for ids in groups[:-1] for i in ids], "a long"), "a").count())
        return back

    monkeypatch.setattr(neardup, "written", watched)
    df = spark.createDataFrame(texts, "doc_id long, text string")
    got = {tuple(r) for r in neardup.confirmed(rows, neardup.Source(df, "doc_id", "text", 1, 80)).collect()}
    assert got == set(pairs)
    assert sent == [240]


def test_what_is_not_read_again_is_removed(spark, documents, monkeypatch):
    """The nodes of all documents go with the step that reads them, and shuffle files with the write that made them."""
    kept, gone = {}, []
    original, remove = neardup.written, neardup.release

    def watched(df, label):
        back = original(df, label)
        kept[back.written_to] = back.columns
        return back

    def removed(*frames):
        gone.extend(df.written_to for df in frames)
        remove(*frames)

    monkeypatch.setattr(neardup, "written", watched)
    monkeypatch.setattr(neardup, "release", removed)
    texts = varied(3, 6, 5)
    assert found(documents(texts), 2) == brute(texts, 2)
    large = [path for path, columns in kept.items() if {"nodes", "mark"} & set(columns) and "here" not in columns]
    assert large and set(large) <= set(gone)


def test_settled_nodes_are_left_out(spark):
    rows = [(1, 1, 7), (1, 2, 7), (2, 1, 7), (2, 3, 9), (3, 3, 9)]
    members = spark.createDataFrame(rows, "node long, rep long, label long")
    assert sorted((r.node, r.rep) for r in neardup.in_mixed_nodes(members).collect()) == [(2, 1), (2, 3)]
