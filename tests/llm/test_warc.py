import base64
import hashlib
import io
import struct

import pytest
import zstandard

from ordermill.llm.warc import (
    DICTIONARY_MAGIC,
    ArchiveError,
    archive_bytes,
    base32_sha1,
    build_record,
    header_value,
    parse_record,
    read_archives,
    read_frames,
    resolved,
    write_archives,
)

PAGES = "page_id long, url string, html string"
DATE = "2024-05-06T07:08:09Z"


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def round_trip(spark, tmp_path, rows, **options):
    df = spark.createDataFrame(rows, PAGES).repartition(2)
    return read_archives(write_archives(df, f"file://{tmp_path}/warc", **options)).collect()


def test_exact_round_trip(spark, tmp_path):
    rows = [(i, f"http://x.example/{i}", f"<p>page {i % 40} é\r\n\r\n😀</p>" * 30) for i in range(100)]
    rows += [(200, None, None), (201, "http://e mpty\r\nX: y", ""), (202, "http://big", "z" * 3_000_000)]
    got = {int(r.key): r for r in round_trip(spark, tmp_path, rows, roll_bytes=20_000)}
    last = {}
    for key, _, html in rows:
        last[html or ""] = max(key, last.get(html or "", -1))
    assert len(got) == len(rows)
    for key, url, html in rows:
        row, newest = got[key], last[html or ""]
        assert row.url == header_value(url or "")
        assert (row.payload_bytes, row.payload_digest) == (len((html or "").encode()), digest(html))
        assert row.record_type == ("response" if key == newest else "revisit")
        assert row.refers_to == (None if key == newest else str(newest))
        assert row.payload == ((html or "").encode() if key == newest else None)


def test_small_payloads_can_be_stored_each(spark, tmp_path):
    rows = [(1, "a", "xx"), (2, "b", "xx"), (3, "c", "xxx"), (4, "d", "xxx")]
    got = {r.key: r.record_type for r in round_trip(spark, tmp_path, rows, least_bytes=3)}
    assert got == {"1": "response", "2": "response", "3": "revisit", "4": "response"}


def test_nulls_repeats_and_empty(spark, tmp_path):
    rows = [(None, None, None), (1, "u", "x"), (1, "u", "x"), (None, "u", "x"), (None, "u", "only")]
    got = sorted((r.key or "", r.record_type, r.refers_to or "") for r in round_trip(spark, tmp_path, rows))
    assert got == [("", "response", ""), ("", "response", ""), ("", "revisit", "1"), ("1", "response", ""), ("1", "response", "")]
    assert round_trip(spark, tmp_path / "none", []) == []


def records(n=40):
    return [build_record(str(i), f"http://x/{i}", f"<p>some page text {i}</p>".encode() * 60, None, DATE) for i in range(n)]


def test_dictionary_comes_first_and_each_record_has_a_frame():
    archive = archive_bytes(records())
    magic, length = struct.unpack("<II", archive[:8])
    assert magic == DICTIONARY_MAGIC and archive[8:12] == struct.pack("<I", 0xEC30A437)
    frames = list(read_frames(io.BytesIO(archive)))
    assert [data for _, data in frames] == records() and frames[0][0] == 8 + length
    plain = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(archive[8 : 8 + length]))
    assert plain.decompress(archive[frames[7][0] : frames[8][0]]) == records()[7]
    few = archive_bytes(records(3))
    assert [data for _, data in read_frames(io.BytesIO(few))] == records(3)


def test_a_compressed_dictionary_is_read():
    archive = archive_bytes(records())
    length = struct.unpack("<I", archive[4:8])[0]
    small = zstandard.compress(archive[8 : 8 + length])
    again = struct.pack("<II", DICTIONARY_MAGIC, len(small)) + small + archive[8 + length :]
    assert [data for _, data in read_frames(io.BytesIO(again))] == records()


@pytest.mark.parametrize("damage", ["cut", "flip", "magic", "short dictionary"])
def test_damaged_archives_raise(damage):
    archive = bytearray(archive_bytes(records()))
    if damage == "cut":
        del archive[-5:]
    elif damage == "flip":
        archive[-40] ^= 0xFF
    elif damage == "magic":
        archive[0] = 0x50
    else:
        del archive[100:]
    with pytest.raises(ArchiveError):
        list(read_frames(io.BytesIO(bytes(archive))))


@pytest.mark.parametrize(
    ("old", "new"),
    [
        (b"WARC/1.1", b"WARC/9.9"),
        (b"WARC-Date: " + DATE.encode() + b"\r\n", b""),
        (b"Content-Type: text/html", b"Content-Typ_: text/html"),
        (b"some page", b"sOme page"),
        (b"WARC-Type: response", b"WARC-Type: mystery"),
        (b"\r\n\r\n", b"\r\n"),
    ],
)
def test_unsound_records_raise(old, new):
    sound = records(1)[0]
    assert parse_record(sound).payload_digest == base32_sha1(parse_record(sound).payload)
    with pytest.raises(ArchiveError):
        parse_record(sound.replace(old, new, 1))
    with pytest.raises(ArchiveError):
        parse_record(sound + sound)


def test_reading_names_archive_and_offset(spark, tmp_path):
    path = tmp_path / "bad.warc.zst"
    path.write_bytes(zstandard.compress(records(1)[0]) + zstandard.compress(b"junk"))
    manifest = spark.createDataFrame([(f"file://{path}", 2, 1)], "archive string, n_records long, n_bytes long")
    with pytest.raises(Exception, match="bad.warc.zst at [1-9]"):
        read_archives(manifest).collect()


def test_a_revisit_needs_its_response(spark, tmp_path):
    rows = [(i, "u", "<p>same</p>" if i % 2 else f"<p>{i}</p>") for i in range(20)]
    df = spark.createDataFrame(rows, PAGES).repartition(4)
    records = read_archives(write_archives(df, f"file://{tmp_path}/warc"))
    whole = resolved(records)
    assert "payload" not in whole.columns and whole.count() == 20
    lost = records.where("key <> '19'")
    with pytest.raises(Exception, match="no response 19 for the revisit"):
        resolved(lost).collect()
    assert resolved(records.where("record_type = 'response'")).count() == 11 and resolved(records.limit(0)).count() == 0


def test_clashing_columns_are_not_read(spark, tmp_path):
    df = spark.createDataFrame([(1, "u", "<p>a</p>"), (2, None, None)], PAGES)
    for name in ("key", "payload", "digest", "last_key", "refers_to", "archive"):
        df = df.selectExpr("*", f"'mine' AS {name}")
    got = read_archives(write_archives(df, f"file://{tmp_path}/wide")).collect()
    assert sorted((r.key, r.payload) for r in got) == [("1", b"<p>a</p>"), ("2", b"")]
