"""WARC archives and their normaliser against the pages and brute force."""

import gzip
import hashlib
import json
import os
import random
import tempfile
import zlib
from collections import defaultdict

import pytest

import cases
from comparo.llm import queries, warc
from conftest import SF_SMALL

BIG = "<html>" + "copy " * 300 + "</html>"
PAGES = [
    (1, "http://a.example/1", BIG), (2, "http://a.example/2", BIG), (9, "http://a.example/9", BIG), (3, None, "short"),
    (4, "http://b.example/ü x\r\nX: y", "short"), (5, "", ""), (6, "http://c.example", None),
    (7, "http://c.example", "é日😀" * 400), (None, "http://d.example", BIG), (None, None, "alone " * 400), (None, None, None),
    (8, "http://e.example", "x" * 999), (10, "http://e.example", "x" * 999), (11, "http://e.example", "y" * 1000),
    (12, "http://e.example", "y" * 1000), (12, "http://e.example", "y" * 1000), (-3, "http://f.example", BIG),
    (13, "http://g.example", "line\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n" * 40), (14, "http://h.example", "\x00" * 1200),
    (2**62, "http://i.example", "z" * 3_000_000),
]


def pages(spark, rows=PAGES):
    return spark.createDataFrame([(*r, "clash", 7, "clash") for r in rows],
                                 "page_id long, url string, html string, digest string, salt int, head string").repartition(3)


def expected(rows):
    groups = defaultdict(list)
    for i, _, html in rows:
        groups[html or ""].append(i)
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        head = max((k for k in groups[html or ""] if k is not None), default=None)
        refers_to = head if len(data) >= 1000 and head is not None and head != i else None
        out.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if refers_to is not None else "response",
                    refers_to))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def folder(spark):
    return tempfile.mkdtemp(prefix="warc-", dir="/tmp") + "/normalised"


@pytest.fixture(scope="module")
def found(spark, folder):
    return warc.round_trip(pages(spark), folder)


def files(folder, kind):
    top = f"{folder}/kind={kind}"
    return {d.removeprefix("archive="): [os.path.join(top, d, f) for f in os.listdir(os.path.join(top, d)) if f[0] not in "._"]
            for d in os.listdir(top)}


def test_round_trip_awkward_rows(found):
    got = cases.rows_of(found, "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert got == expected(PAGES)
    assert found.where("NOT intact").count() == 0


def test_every_record_is_a_member_at_its_place(spark, folder, found):
    index = sorted(tuple(r) for r in warc.read_index(spark, folder).select("archive", "offset", "length", "type").collect())
    for archive, (path,) in files(folder, "warc").items():
        data = open(path, "rb").read()
        own = [r for r in index if r[0] == archive]
        assert own[0][3] == "warcinfo" and own[0][1] == 0
        for (_, offset, length, kind), after in zip(own, [*own[1:], None]):
            assert after is None or after[1] == offset + length
            whole = zlib.decompress(data[offset:offset + length], 31)
            assert whole.startswith(b"WARC/1.1\r\nWARC-Type: " + kind.encode()) and whole.endswith(b"\r\n\r\n")
        assert gzip.decompress(data).count(b"WARC-Record-ID") == len(own)
    scanned = sorted(tuple(r) for r in found.select("archive", "offset", "length", "record_type").collect())
    assert scanned == [r for r in index if r[3] != "warcinfo"]


def test_fetch_reads_single_records(spark, folder):
    index = warc.read_index(spark, folder)
    wanted = index.where("id IN ('<urn:page:7>', '<urn:page:9>', '<urn:page:2>')")
    got = {r.page_id: r for r in warc.fetch(spark, folder, wanted).collect()}
    assert {i: r.record_type for i, r in got.items()} == {7: "response", 9: "response", 2: "revisit"}
    assert bytes(got[7].payload).decode() == "é日😀" * 400 and bytes(got[9].payload).decode() == BIG
    assert got[2].payload is None and got[2].refers_to == 9


def test_payloads_come_back(spark, folder):
    got = {r.page_id: r.payload for r in warc.read(spark, folder, payloads=True).where("record_type = 'response'").collect()}
    for i, _, html in PAGES:
        if i in got and i is not None:
            assert bytes(got[i]).decode() == (html or "")


def test_streams_are_one_member_and_split_at_the_limit(spark):
    top = tempfile.mkdtemp(prefix="warc-", dir="/tmp") + "/streams"
    rng = random.Random(4)
    rows = [(i, f"http://x/{i}", "".join(rng.choices("abcdefgh", k=4000))) for i in range(60)]
    warc.write_streams(warc.plan(pages(spark, rows)), top, limit=20_000)
    paths = [os.path.join(d, f) for d, _, names in os.walk(top) for f in names if f.startswith("part-")]
    assert len(paths) > 3
    for path in paths:
        data = open(path, "rb").read()
        stream = zlib.decompressobj(31)
        text = stream.decompress(data)
        assert stream.eof and stream.unused_data in (b"", warc.member(b"")) and text.count(b"WARC/1.1\r\n") > 1


def test_normalise_foreign_damaged_and_padded_files(spark):
    """Members of any cut, padding between them, a stream that breaks off, and a file that is no WARC."""
    parts = [warc.page_record(i, "http://x", b"p" * 5000 * i, 5000 * i, hashlib.sha1(b"p" * 5000 * i).hexdigest(), None)
             for i in range(1, 6)]
    stream = b"".join(parts)
    contents = {"cut": warc.member(stream[:7777]) + b"\0" * 10 + warc.member(stream[7777:]), "whole": warc.member(stream),
                "broken": warc.member(stream, 0)[:-9000], "noise": b"no gzip at all",
                "text": warc.member(b"no record\r\n\r\n"), "empty": b""}
    top = tempfile.mkdtemp(prefix="warc-", dir="/tmp") + "/out"
    rows = spark.createDataFrame([(k, bytearray(v)) for k, v in contents.items()], "archive string, content binary")
    warc.normalise(rows, top)
    lines = defaultdict(list)
    for r in warc.read_index(spark, top).orderBy("offset").collect():
        lines[r.archive].append(r.type)
    assert lines["cut"] == lines["whole"] == ["response"] * 5
    assert lines["broken"] == ["response"] * 4 + ["damaged"]
    assert lines["noise"] == lines["text"] == ["damaged"] and "empty" not in lines
    got = warc.read(spark, top).where("archive = 'cut' AND intact").selectExpr("page_id", "payload_bytes").collect()
    assert sorted(map(tuple, got)) == [(i, 5000 * i) for i in range(1, 6)]


def test_large_member_is_followed_by_an_empty_one():
    data = warc.member(bytes(17 << 20))
    assert not data.endswith(b"\0")
    whole = warc.sealed(data) + b"\0"
    assert gzip.decompress(whole) == bytes(17 << 20) and whole.startswith(data)


def test_empty_table(spark):
    assert warc.round_trip(pages(spark, [])).count() == 0


def test_hot_page_is_dealt_by_salt(spark):
    rows = [(i, f"http://x/{i}", BIG if i % 3 else f"{i} " * 400) for i in range(3000)]
    got = warc.plan(pages(spark, rows)).where("refers_to IS NOT NULL")
    assert got.count() == 1999 and got.where("refers_to <> 2999 AND refers_to <> 2998").count() == 0


def test_query_agrees_with_brute_force(spark):
    got = queries.op12(spark, SF_SMALL)
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").select("page_id", "url", "html").collect()]
    assert sorted(map(tuple, got.collect()), key=repr) == expected(rows)


def test_index_lines_are_json(folder):
    for (path,) in files(folder, "index").values():
        lines = gzip.decompress(open(path, "rb").read()).decode().splitlines()
        assert all({"offset", "length", "type", "id", "uri", "digest"} == set(json.loads(line)) for line in lines)
