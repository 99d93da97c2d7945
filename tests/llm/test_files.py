"""Packing and archives."""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pytest
import zstandard
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from telemetry_lake.llm import packing, warc
from telemetry_lake.llm.catalog import QUERIES, SQL
from tests.oracle import connect, differences

SF_DIR = "/root/testdata/sf0.001"
ODD = ["", None, "a", "á ́b", "x\xa0y\u2003z\x85w\x1cq\u200bv \x01 w\x01", "A<|endoftext|>b c", "ΣΑΣ don't 's 12", "the " * 9000, "\x1fx\x1ey\x1dz"]


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(packing.default_tokenizer())


@settings(max_examples=150, deadline=None)
@given(st.text(st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" \t\n'a.\x01")), max_size=40))
def test_ids_word_by_word(text):
    own = packing.WordTokenizer(packing.default_tokenizer()) if not packing._TOKENIZERS else next(iter(packing._TOKENIZERS.values()))
    packing._TOKENIZERS.setdefault("x", own)
    assert np.frombuffer(own.encode(text.encode()), "<u4").tolist() == own.tokenizer.encode(text, add_special_tokens=False).ids


def test_pack(spark, plain):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(None if i == 2 else 10**6 + i, t) for i, t in enumerate(ODD)], "doc_id long, text string")
    docs = docs.unionByName(odd).unionByName(odd.limit(3))
    rows = packing.pack(docs, packing.default_tokenizer()).collect()
    expected = []
    for r in docs.collect():
        ids = np.array([*plain.encode(r["text"] or "", add_special_tokens=False).ids, 1], "<u4")
        for k, at in enumerate(range(0, len(ids), 4096)):
            expected.append((str(r["doc_id"]), k, at, len(ids[at : at + 4096]), zlib.crc32(ids[at : at + 4096].tobytes())))
    assert sorted((str(r["doc_id"]), *r[1:5]) for r in rows) == sorted(expected)
    places: dict[int, list] = {}
    for r in rows:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for held in places.values():
        end = 0
        for offset, length in sorted(held):
            assert offset == end
            end += length
        assert end <= 4096
    assert len(places) <= 1.02 * sum(e[3] for e in expected) / 4096 + 1
    assert packing.pack(docs.limit(0), packing.default_tokenizer()).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_configurations_use_up_the_histogram(seed):
    rng = np.random.default_rng(seed)
    histogram = np.zeros(100, np.int64)
    for n in rng.integers(1, 101, 40):
        histogram[n - 1] += rng.integers(1, 50)
    used = packing.configurations(histogram, 100)
    got = np.zeros(100, np.int64)
    for times, row in used:
        assert sum(n * k for n, k in row.items()) <= 100
        for n, k in row.items():
            got[n - 1] += times * k
    assert (got == histogram).all()
    # Best fit decreasing, piece by piece.
    rooms: list[int] = []
    for n in range(100, 0, -1):
        for _ in range(histogram[n - 1]):
            fits = [k for k, room in enumerate(rooms) if room >= n]
            if fits:
                rooms[min(fits, key=rooms.__getitem__)] -= n
            else:
                rooms.append(100 - n)
    assert sum(t for t, _ in used) <= 1.03 * len(rooms) + 2
    assert packing.configurations(np.zeros(100, np.int64), 100) == []


def test_archives_match_sql(spark):
    con = connect(SF_DIR)
    assert differences(QUERIES["op4_warc_zstd"](spark, SF_DIR), con, SQL["op4_warc_zstd"]) == []


def test_odd_pages(spark, tmp_path):
    rows = [(1, "u", None), (2, "u", ""), (3, None, "x"), (3, None, "x"), (None, "v\r\nw", "x"), (None, None, "y"), (5, "z", "P*M\x18\0\0\0\0" * 9), (0, "q", "é" * 200_000)]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, record_type string")
    out = sorted(map(tuple, warc.round_trip(pages).collect()), key=str)
    assert len(out) == len(rows)
    kinds = sorted((str(r[0]), r[1], r[3], str(r[4])) for r in out)
    assert kinds == sorted([
        ("1", 0, "response", "None"), ("2", 0, "revisit", "1"), ("3", 1, "response", "None"), ("3", 1, "revisit", "3"), ("None", 1, "revisit", "3"),
        ("None", 1, "response", "None"), ("5", 72, "response", "None"), ("0", 400_000, "response", "None"),
    ])
    assert warc.round_trip(pages.limit(0)).count() == 0
    path = str(tmp_path / "archives")
    warc.write_archives(pages, path)
    back = {r["page_id"]: r for r in warc.read_archives(spark, path).filter("record_type = 'response'").collect()}
    assert bytes(back[5]["payload"]) == b"P*M\x18\0\0\0\0" * 9 and bytes(back[0]["payload"]) == ("é" * 200_000).encode()


def test_archives_stay_whole_under_a_limit_of_records(spark, tmp_path):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet").select("page_id", "url", "html")
    spark.conf.set("spark.sql.files.maxRecordsPerFile", 3)
    try:
        warc.write_archives(pages, str(tmp_path / "archives"))
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    back = warc.read_archives(spark, str(tmp_path / "archives"), keep_payload=False)
    assert back.select("page_id").distinct().count() == pages.count()


def test_other_archives_and_damage():
    record = warc.record_bytes(7, "u", b"<p>x</p>", warc.base32_sha1(b"<p>x</p>"), None, False)
    shared = warc.dictionary([warc.record_bytes(i, f"u{i}", b"<p>%d</p>" % (i * 7919) * 30, "D", None, False) for i in range(300)])
    assert shared
    own = zstandard.ZstdCompressionDict(shared)
    packed = zstandard.compress(shared)  # a compressed dictionary is allowed
    head = struct.pack("<II", warc.DICTIONARY_MAGIC, len(packed)) + packed
    body = zstandard.ZstdCompressor(dict_data=own, write_checksum=True, write_content_size=False).compress(record)
    ((fields, block),) = warc.read_archive(head + warc.SEPARATOR.encode() + body)
    assert block == b"<p>x</p>" and fields["WARC-Record-ID"] == "<urn:page:7>"
    assert list(warc.read_archive(b"")) == []
    bad = [
        body + head, (head + body)[:-3], head + body[:9], b"nonsense!", zstandard.compress(record[:-1]), zstandard.compress(record.replace(b"Length: 8", b"Length: x")),
        zstandard.compress(record.replace(b"WARC/1.1", b"HTTP/1.1")), zstandard.compress(record.replace(b"<p>x", b"<p>y")),
        zstandard.compress(record.replace(b"WARC-Date:", b"WARC-When:")),
    ]
    for data in bad:
        with pytest.raises(warc.BadArchive):
            list(warc.read_archive(data))
