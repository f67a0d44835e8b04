import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from ordermill.llm import divergence
from ordermill.llm.divergence import divergence_audit, products
from ordermill.llm.queries import ORACLE_SQL, QUERIES


def brute(rows, least=3, top=200):
    """Term by term with Python integers; ``rows`` are (text, lang, source)."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    docs, counts, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        words = re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", (text or "").translate(lower))
        docs[lang].update(set(words))
        counts[lang, source].update(words)
        groups[lang].add(source)
    out = set()
    for lang, sources in groups.items():
        kept = [term for term, n in docs[lang].items() if n >= least]
        n_of = {s: {t: counts[lang, s][t] for t in kept} for s in sources}
        whole = {t: sum(n_of[s][t] for s in sources) for t in kept}

        def level(of, kept=kept):
            total = sum(of.values()) + len(kept)
            return {t: 1 + 10**9 * (of[t] + 1) // total for t in kept}

        p, q = {s: level(n_of[s]) for s in sources}, level(whole)
        for s in sources:
            pairs = [(sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in sources if o != s]
            terms = [((p[s][t] - q[t]) ** 2 // q[t], t) for t in kept if n_of[s][t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, None), ("term", terms, top)):
                items.sort(key=lambda pair: (-pair[0], pair[1].encode()))
                out |= {(lang, s, part, item, value, i) for i, (value, item) in enumerate(items[:most], 1)}
    return out


def audit(spark, rows, **options):
    df = spark.createDataFrame(rows, "text string, lang string, source string")
    df = df.withColumn("term", F.lit("mine")).withColumn("n", F.lit(1))
    got = divergence_audit(df, **options)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    rows = [tuple(row) for row in got.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


ROWS = [
    ("The cat, the CAT and Ünïcode ünïcode", "en", "a"),
    ("the dog and the cat", "en", "b"),
    ("the end and then some; Ärger ärger", "en", "c"),
    ("the the the cat cat dog", "en", "a"),
    ("the the the cat cat dog", "en", "a"),
    (None, "en", "d"),
    ("", None, None),
    ("42 1 2 3", "de", "a"),
    ("nur zwei", "de", "b"),
    ("漢字 the 漢字", None, "a"),
    ("漢字 x1y the", None, "b"),
    ("漢字 y", None, "b"),
]


def random_rows(count, seed=3):
    random.seed(seed)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)]
    weights = [1 / (i + 1) for i in range(300)]
    return [
        (" ".join(random.choices(words, weights, k=random.randint(0, 80))), random.choice(["x", "y"]), f"s{random.randint(0, 4)}")
        for _ in range(count)
    ]


def test_small_rows(spark):
    assert audit(spark, ROWS) == brute(ROWS)


def test_random_rows_and_top(spark):
    rows = random_rows(300) + [("hot " * 30_000, "x", "s0")]
    assert audit(spark, rows, top_terms=7) == brute(rows, top=7)
    assert audit(spark, rows, least_documents=1) == brute(rows, least=1)


def test_blocks_do_not_matter(spark, monkeypatch):
    rows = random_rows(200, seed=9)
    entries = [
        {"lang": "x", "term": f"t{t // 3:03}", "source": f"s{t % 3}", "p": int(p)}
        for t, p in enumerate(np.random.default_rng(1).integers(1, 40, 900))
    ]
    tables = []
    for sizes in ((4096, 512, 1 << 16), (5, 7, 40), (1, 2, 10)):
        for name, size in zip(("ROWS", "COLUMNS", "ENTRIES"), sizes):
            monkeypatch.setattr(divergence, name, size)
        batches = [divergence.pa.RecordBatch.from_pylist(entries[at : at + 17]) for at in range(0, 900, 17)]
        cells = Counter()
        for batch in divergence.joint_tables(iter(batches)):
            for cell in batch.to_pylist():
                cells[tuple(cell.values())[:-1]] += cell["n"]
        tables.append(cells)
    assert tables[0] == tables[1] == tables[2]
    assert sum(n for (_, a, _, b, _), n in tables[0].items() if (a, b) == ("s0", "s2")) == 300
    assert rows


def test_products_are_the_joint_counts():
    row, column = np.repeat(np.arange(50), 2), np.random.default_rng(2).integers(0, 600, 100)
    column[1::2] = (column[::2] + 1) % 600
    x = np.zeros((50, 600))
    x[row, column] = 1
    got = np.zeros((600, 600))
    for i, j, n in products(column, row, 600, 50):
        got[i, j] += n
    assert (np.triu(got) == np.triu(x.T @ x)).all()


def test_empty_table(spark):
    assert audit(spark, []) == set()


def test_more_sources_than_columns(spark):
    rows = [("common term" if i % 2 else "common", "x", f"s{i:03}") for i in range(40)]
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(divergence, "COLUMNS", 8)
        assert audit(spark, rows) == brute(rows)


def test_sql_and_query_agree(spark):
    sf_dir = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    expected = set(con.sql(ORACLE_SQL["op12_one_hot_divergence"]).fetchall())
    got = {tuple(row) for row in QUERIES["op12_one_hot_divergence"](spark, sf_dir).collect()}
    assert got == expected and len(got) > 1000
