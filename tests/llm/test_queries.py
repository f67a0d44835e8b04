"""The registered queries, called by name on whole tables, with the columns of their contracts."""

import base64
import hashlib
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
import tiktoken
from test_neardup import brute

from ordermill.llm.html import main_text
from ordermill.llm.queries import MIX_WEIGHTS, QUERIES, TOKENIZER
from ordermill.llm.tokens import encoding

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    read = lambda name: spark.read.parquet(f"{SF}/{name}.parquet").collect()
    return {name: read(name) for name in ("documents", "pages")}


def rows(spark, name):
    df = QUERIES[name](spark, SF)
    return df.columns, df.collect()


def test_op1(spark, tables):
    columns, got = rows(spark, "op1_hypergeometric_shards")
    assert columns[:7] == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    bodies = {r.doc_id: (r.text or "").encode() for r in tables["documents"]}
    assert {r.doc_id: (r.size, r.text_crc32) for r in got} == {i: (len(b) + 1, zlib.crc32(b)) for i, b in bodies.items()}
    assert {r.law for r in got} == {"rows"} and {r.grown_shard for r in got} == {None}
    counts = Counter(r.shard for r in got)
    assert set(counts) == set(range(16)) and max(counts.values()) - min(counts.values()) <= 1
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(of) == list(range(len(of))) for of in slots.values())


def test_op2(spark, tables):
    _, got = rows(spark, "op2_section_token_counts")
    encoder, _ = encoding(TOKENIZER)
    assert isinstance(encoder, tiktoken.Encoding)
    tokens, characters = Counter(), Counter()
    for r in got:
        tokens[r.doc_id] += r.n_tokens
        characters[r.doc_id] += r.n_chars
    for r in tables["documents"]:
        assert tokens[r.doc_id] == len(encoder.encode_ordinary(r.text or "")) and characters[r.doc_id] == len(r.text or "")


def test_op3(spark, tables):
    columns, got = rows(spark, "op3_chosen_path_near_duplicates")
    assert columns[:4] == ["doc_id", "n_shingles", "component_id", "kept"]
    assert sorted(tuple(r)[:4] for r in got) == brute([(r.doc_id, r.text) for r in tables["documents"]], 2)


def test_op5(spark, tables):
    columns, got = rows(spark, "op5_line_block_extraction")
    assert columns[:4] == ["page_id", "url", "text", "n_chars"]
    expected = {r.page_id: (r.url, main_text(r.html)) for r in tables["pages"]}
    assert {r.page_id: (r.url, r.text) for r in got} == expected and all(r.n_chars == len(r.text) for r in got)


def test_op6(spark, tables):
    columns, got = rows(spark, "op6_zstd_warc_roundtrip")
    assert columns[:5] == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    last = {}
    for r in tables["pages"]:
        body = (r.html or "").encode()
        last[body] = max(r.page_id, last.get(body, r.page_id))
    expected = set()
    for r in tables["pages"]:
        body = (r.html or "").encode()
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        response = last[body] == r.page_id
        expected.add((r.page_id, len(body), digest, "response" if response else "revisit", None if response else last[body]))
    assert {tuple(r)[:5] for r in got} == expected and len(got) == len(expected)


def test_op9(spark, tables):
    """Each source has its weight's share of any run of blocks, less than one block off."""
    _, got = rows(spark, "op9_pfair_mixing")
    got.sort(key=lambda r: r.mix_position)
    assert [r.mix_position for r in got] == list(range(len(got)))
    assert {(r.doc_id, r.source) for r in got} == {(r.doc_id, r.source) for r in tables["documents"]}
    blocks = list(dict.fromkeys((r.mix_phase, r.source, r.mix_block) for r in got))
    weight = lambda name: Fraction(MIX_WEIGHTS.get(name, 1.0))
    left = Counter(source for _, source, _ in blocks)
    for phase in sorted({phase for phase, _, _ in blocks}):
        active = [source for source in left if left[source]]
        whole, done = sum(map(weight, active)), Counter()
        for n, (_, source, _) in enumerate([b for b in blocks if b[0] == phase], 1):
            done[source] += 1
            assert all(abs(done[s] - n * weight(s) / whole) < 1 for s in active)
        left.subtract(done)


def test_every_query_is_registered():
    assert [int(name[2:].split("_")[0]) for name in QUERIES if name.startswith("op")] == list(range(1, 14))
    assert "pipeline" in QUERIES
