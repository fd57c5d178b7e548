"""Archives: exact round trip, revisit rules, order of the merged index, the loser tree."""

from __future__ import annotations

import gzip
import hashlib
import random
from pathlib import Path

import pytest

from tidegrid.llm import warc


def brute(rows):
    largest = {}
    for i, _, html in rows:
        data = (html or "").encode()
        if len(data) >= 1000 and i is not None:
            largest[data] = max(largest.get(data, i), i)
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        other = largest.get(data)
        other = None if other == i else other
        out.append((i is None, i or 0, len(data), hashlib.sha1(data).hexdigest(), "response" if other is None else "revisit",
                    other or 0))
    return sorted(out)


@pytest.fixture
def rows():
    rng = random.Random(4)
    bodies = ["", None, "short", "<p>é\r\n\r\nWARC/1.1\r\n\r\n</p>" * 60, "x" * 999, "y" * 1000, "\0\r\n\r\n" + "ü" * 700,
              "z" * 200_000]
    urls = [f"http://www.host{k}.example.org/p/{k}?q=1#f" for k in range(5)] + [None, "", "no url", "http://[bad/",
                                                                             "https://u@Host.example.com:443", "a\nb"]
    found = [(i, rng.choice(urls), rng.choice(bodies)) for i in range(200)]
    return found + [(7, *found[7][1:]), (None, "http://a/", "y" * 1000), (None, None, None)]


@pytest.mark.parametrize("run_rows,range_rows", [(50_000, 50_000), (9, 13)])
def test_round_trip_and_order(spark, tmp_path, monkeypatch, rows, run_rows, range_rows):
    monkeypatch.setattr(warc, "RUN_ROWS", run_rows)
    monkeypatch.setattr(warc, "RANGE_ROWS", range_rows)
    monkeypatch.setattr(warc, "FILE_BYTES", 5000)
    df = spark.createDataFrame([(*r, 1) for r in rows], "page_id bigint, url string, html string, offset int").repartition(3)
    got = warc.archive(df, str(tmp_path / "a")).collect()
    assert sorted((r.page_id is None, r.page_id or 0, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to or 0)
                  for r in got) == brute(rows)
    got.sort(key=lambda r: (r.part, r.position))
    keys = [(r.url_key, r.captured, "" if r.page_id is None else str(r.page_id)) for r in got]
    assert keys == sorted(keys) and len({(r.part, r.position) for r in got}) == len(rows)
    assert len({r.part for r in got}) > 5 or range_rows > 100


def test_files_are_plain_archives(spark, tmp_path, rows):
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    warc.write_archives(warc.plan_records(df), str(tmp_path / "a"))
    payloads = []
    for file in Path(tmp_path / "a").glob("*/part-*"):
        data = file.read_bytes()
        whole = gzip.decompress(data)
        at = 0
        for offset, fields, block in warc.parse_records(data):
            assert gzip.decompress(data[offset:]) == whole[at:] and whole[at:].startswith(b"WARC/1.1\r\n")
            at = whole.index(b"\r\n\r\n", at) + 4 + len(block) + 4
            head, _, payload = block.partition(b"\r\n\r\n")
            assert f"Content-Length: {fields['warc-payload-length']}".encode() in head
            if fields["warc-type"] == "response":
                payloads.append(payload.decode())
            else:
                assert not payload and fields["warc-refers-to"].startswith("<urn:x-page:")
        assert at == len(whole)
    assert set(payloads) == {h or "" for _, _, h in rows}


def test_a_record_is_read_by_its_offset_alone(spark, tmp_path, rows):
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(2)
    for r in warc.archive(df, str(tmp_path / "a")).collect():
        with open(tmp_path / "a" / r.file, "rb") as source:
            source.seek(r.offset)
            fields, block = warc.parse_record(warc.read_record(source.read)[0])
        assert fields["warc-record-id"] == f"<urn:x-page:{'' if r.page_id is None else r.page_id}>"
        if r.record_type == "response":
            assert hashlib.sha1(block.partition(b"\r\n\r\n")[2]).hexdigest() == r.payload_digest


def test_files_are_bounded_in_bytes(spark, tmp_path, monkeypatch):
    """Pages of 5 MB that do not compress, and one whose record needs more than three bytes for its length."""
    monkeypatch.setattr(warc, "FILE_BYTES", 4_000_000)
    rng = random.Random(8)
    rows = [(i, "http://a/", rng.randbytes(2_500_000).hex()) for i in range(6)] + [(9, "http://b/", "word " * 4_000_000)]
    df = spark.createDataFrame([*rows, (10, "http://c/", "")], "page_id bigint, url string, html string").coalesce(1)
    got = warc.archive(df, str(tmp_path / "a")).collect()
    assert sorted((r.page_id is None, r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to or 0)
                  for r in got) == brute([*rows, (10, "http://c/", "")])
    sizes = [f.stat().st_size for f in Path(tmp_path / "a").glob("*/part-*")]
    assert len(sizes) >= 6 and max(sizes) < 4_000_000


@pytest.mark.parametrize("size", [0, 1, 255, (1 << 24) - 1, 1 << 24, (1 << 24) + 5])
def test_members_end_in_a_zero(size):
    record = b"x" * size
    member = warc.packed_record(record) + b"\0"
    assert gzip.decompress(member * 2) == record * 2


def test_loser_tree():
    rng = random.Random(1)
    for k in range(9):
        runs = [sorted((rng.randrange(50), j) for _ in range(rng.randrange(12))) for j in range(k)]
        assert list(warc.LoserTree(runs)) == sorted(x for r in runs for x in r)


def test_url_keys():
    assert warc.url_key("HTTP://www.Example.org:80/a/b?x=1#top") == "org,example)/a/b?x=1"
    assert warc.url_key("https://example.org:8080") == "org,example:8080)/"
    assert warc.url_key(None) == warc.url_key("") == "-"


def test_empty_table(spark):
    assert warc.archive(spark.createDataFrame([], "page_id bigint, url string, html string")).collect() == []
