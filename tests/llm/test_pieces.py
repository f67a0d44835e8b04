import hashlib
import random

import numpy as np
import pytest
import sentencepiece

from ordermill.llm.pieces import PieceModel, compiled_map, decode_ids, encode_with_spans, encoding_digests, fields
from ordermill.llm.queries import PIECES_MODEL, QUERIES

TEXTS = [
    "Hello world, plain words.",
    "  two  spaces, tab\tand\nnewline  ",
    "",
    None,
    " ",
    "▁ literal mark ▁▁x",
    "ünïcödé 漢字かな 😀👩‍👩‍👧 \u0000 � <s> </s> <unk> <0x41>",
    "ｱﾞ ㍿ ﬁ ½ ´x   nbsp ① é",
    "word" * 20_000,
    "many words " * 5_000,
]


def varint(value):
    out = bytearray()
    while value > 127:
        out.append(value & 127 | 128)
        value >>= 7
    return bytes(out + bytes([value]))


def with_rules(rules, **options):
    """The given model with the normalisation of another rule set, which the library has compiled."""
    options = {"add_dummy_prefix": True, "escape_whitespaces": True, "remove_extra_whitespaces": True} | options
    other = sentencepiece.SentencePieceNormalizer(rule_name=rules, **options).serialized_model_proto()
    normalizer = dict(fields(other))[3]
    with open(PIECES_MODEL, "rb") as file:
        proto = file.read()
    # The last of several messages of a field counts, field by field.
    return proto + b"\x1a" + varint(len(normalizer)) + normalizer


@pytest.fixture(scope="module")
def given():
    with open(PIECES_MODEL, "rb") as file:
        return file.read()


def expected(library, text):
    """Ids and byte spans of the library."""
    found = library.encode(text, return_type="proto")
    return [p.id for p in found.pieces], [(p.begin, p.end) for p in found.pieces]


def check(proto, texts):
    model, library = PieceModel(proto), sentencepiece.SentencePieceProcessor(model_proto=proto)
    for text in texts:
        ids, begins, ends = model.encode(text)
        assert ids.tolist() == library.encode(text, add_bos=True, add_eos=True), text[:80]
        wanted, spans = expected(library, text)
        assert ids[1:-1].tolist() == wanted
        assert list(zip(begins[1:-1].tolist(), ends[1:-1].tolist())) == spans, text[:80]


def random_texts(count):
    random.seed(5)
    alphabet = "aeinrst  ▁\n.漢é😀́½ﬁ ab　ﾞｶ"
    return ["".join(random.choices(alphabet, k=random.randint(1, 60))) for _ in range(count)]


def test_ids_and_spans_are_the_librarys(given):
    check(given, [text or "" for text in TEXTS] + random_texts(500))


@pytest.mark.parametrize("rules", ["nmt_nfkc", "nfkc", "nmt_nfkc_cf"])
def test_compiled_character_maps(rules):
    check(with_rules(rules), [text or "" for text in TEXTS] + random_texts(500))


def test_spaces_are_kept_where_the_model_says_so():
    check(with_rules("nfkc", remove_extra_whitespaces=False), random_texts(200))
    check(with_rules("nfkc", add_dummy_prefix=False), random_texts(200))


def test_map_has_all_replacements():
    other = sentencepiece.SentencePieceNormalizer(rule_name="nfkc").serialized_model_proto()
    found = compiled_map(dict(fields(dict(fields(other))[3]))[2])
    assert found["ﬁ"] == "fi" and found["é"] == "é" and len(found) > 10_000
    assert compiled_map(b"") == {}


def test_other_models_are_refused():
    with pytest.raises(ValueError, match="byte fallback"):
        PieceModel(sentencepiece.SentencePieceNormalizer(rule_name="nfkc").serialized_model_proto())


def test_table(spark, documents):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES_MODEL)
    df = documents(TEXTS + [TEXTS[0], (None, "null key")], extra=True)
    encoded = encode_with_spans(df, PIECES_MODEL)
    rows = encoded.collect()
    assert len(rows) == len(TEXTS) + 2
    for row in rows:
        text = "null key" if row.doc_id is None else (TEXTS + [TEXTS[0]])[row.doc_id] or ""
        assert row.ids == library.encode(text, add_bos=True, add_eos=True)
        raw = text.encode()
        # The pieces cut the text up without gaps.
        spans = list(zip(row.begins, row.ends))[1:-1]
        assert b"".join(raw[low:high] for low, high in spans) == raw
    decoded = {r.doc_id: r.decoded for r in decode_ids(encoded, PIECES_MODEL).collect()}
    assert decoded[0] == TEXTS[0] and decoded[2] == ""


def test_digests(spark, documents):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES_MODEL)
    rows = encoding_digests(documents(TEXTS), PIECES_MODEL).collect()
    for row in rows:
        text = TEXTS[row.doc_id] or ""
        ids = library.encode(text, add_bos=True, add_eos=True)
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
        assert row.covered_bytes == len(text.encode())
    assert encoding_digests(documents([]), PIECES_MODEL).count() == 0


def test_query_against_the_library(spark):
    sf_dir = "/root/testdata/sf0.001"
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES_MODEL)
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = QUERIES["op11_offset_preserving_pieces"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = library.encode(texts[row.doc_id], add_bos=True, add_eos=True)
        assert (row.n_tokens, row.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert row.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
