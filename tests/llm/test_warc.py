"""Operator 12: round trips, broken archives and the registered query."""

import base64
import hashlib

import pytest
import zstandard

from shoplens.llm import registry, warc_archive
from shoplens.llm.warc_frames import (DICTIONARY, ArchiveFrames, BadArchive, format_record, frames, http_response,
                                      parse_record, train)
from tests.conftest import SF_SMALL

PAGES = [(1, "http://a/x y\r\nWARC-Type: evil", "<p>one</p>"), (2, "http://b", "<p>one</p>"), (3, None, None), (4, "", ""),
         (None, "http://c", "<p>one</p>"), (None, "http://d", "only here"), (5, "http://é/中", "é中\U0001f600 " * 5000),
         (6, "http://e", "x" * 3_000_000), (2, "http://b", "<p>one</p>"), (-9, "http://f", "\r\n\r\nWARC/1.1\r\n")]
PAGES += [(100 + i, f"http://h/{i}", f"<html>{'word ' * (i % 7)}page {i}</html>") for i in range(80)]


def digest(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


@pytest.mark.parametrize("min_bytes, archive_bytes", [(0, 1 << 24), (11, 2000)])
def test_round_trip(spark, min_bytes, archive_bytes, tmp_path):
    pages = spark.createDataFrame([(*p, "x", 1) for p in PAGES], "page_id long, url string, html string, path string, row int")
    listed = warc_archive.write_archives(warc_archive.records_of(pages, min_bytes), str(tmp_path / "a"), archive_bytes)
    assert listed.count() >= (1 if archive_bytes > 10_000 else 4)
    found = warc_archive.read_archives(warc_archive.dealt(listed))
    rows = found.withColumn("page_id", warc_archive.page_of(found.record_id)).withColumn(
        "to", warc_archive.page_of(found.refers_to)).collect()
    assert all(r.problem is None for r in rows)
    want = sorted(((p[0] is None, p[0] or 0), (p[2] or "").encode()) for p in PAGES)
    full = {r.record_id: r.payload for r in warc_archive.with_payloads(found).collect()}
    assert sorted(((r.page_id is None, r.page_id or 0), full[r.record_id]) for r in rows) == want
    for r in rows:
        body = full[r.record_id]
        same = [p[0] for p in PAGES if (p[2] or "").encode() == body]
        assert (r.payload_bytes, r.payload_digest) == (len(body), digest(body))
        if r.record_type == "revisit":
            assert len(body) >= min_bytes and r.payload is None and r.to == max(x for x in same if x is not None)
        elif len(body) >= min_bytes:
            assert r.page_id == max((x for x in same if x is not None), default=None)
    responses = [full[r.record_id] for r in rows if r.record_type == "response" and len(full[r.record_id]) >= min_bytes]
    assert len(responses) == len(set(responses))
    assert {r.target_uri for r in rows if r.page_id == 1} == {"http://a/x%20y%0D%0AWARC-Type:%20evil"}
    by_spark = warc_archive.read_archives(warc_archive.archives_at(spark, str(tmp_path / "a")), strict=True)
    assert sorted(r.record_id for r in by_spark.collect()) == sorted(r.record_id for r in rows)


def test_empty_table(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc_archive.round_trip(pages).count() == 0


def archive(records, payloads=()):
    out = ArchiveFrames(train(list(payloads)))
    return out.head + b"".join(out.frame(r) for r in records), out


HEAD = [("WARC-Type", "response"), ("WARC-Record-ID", "<urn:x>"), ("WARC-Date", "2024-01-01T00:00:00Z"),
        ("Content-Type", "application/http;msgtype=response")]
GOOD = format_record(HEAD, http_response(3, b"abc"))


def test_dictionary_is_used_and_needed():
    payloads = [f"<html><body>common words of every page {i} {i * 7}</body></html>".encode() * 20 for i in range(300)]
    records = [format_record(HEAD, http_response(len(p), p)) for p in payloads]
    data, out = archive(records, payloads)
    assert int.from_bytes(data[:4], "little") == DICTIONARY
    assert [f for _, f in frames(data)] == records
    raw = train(payloads).as_bytes()                                  # a dictionary that is not compressed
    plain = DICTIONARY.to_bytes(4, "little") + len(raw).to_bytes(4, "little") + raw
    assert [f for _, f in frames(plain + data[len(out.head):])] == records
    assert all(isinstance(f, BadArchive) for _, f in frames(data[len(out.head):]))


def test_frames_are_bounded_and_faults_found():
    skip = (0x184D2A51).to_bytes(4, "little") + (2).to_bytes(4, "little") + b"zz"
    unsized = zstandard.ZstdCompressor(write_content_size=False, write_checksum=True).compress(b"q" * 300_000 + GOOD)
    rle = zstandard.ZstdCompressor().compress(b"\0" * 1_000_000)
    data = skip + unsized + rle + skip + zstandard.compress(GOOD)
    assert [f for _, f in frames(data)] == [b"q" * 300_000 + GOOD, b"\0" * 1_000_000, GOOD]
    cut = list(frames(data[:-3]))
    assert isinstance(cut[-1][1], BadArchive) and len(cut) == 3
    spoilt = bytearray(unsized)
    spoilt[-1] ^= 1                                                    # the checksum
    found = list(frames(bytes(spoilt) + zstandard.compress(GOOD)))
    assert isinstance(found[0][1], BadArchive) and found[1][1] == GOOD
    assert isinstance(next(frames(b"plain text"))[1], BadArchive) and list(frames(b"")) == []


@pytest.mark.parametrize("bad", [
    b"", b"WARC/2.0\r\n\r\n", GOOD[:-1], GOOD + b"x", GOOD.replace(b"Content-Length: 3", b"Content-Length: 4"),
    GOOD.replace(b"WARC-Date", b"WARC-Day"), GOOD.replace(b"abc", b"abd"), GOOD.replace(b"WARC-Type: ", b"WARC-Type "),
    GOOD.replace(b"<urn:x>", b""), GOOD + GOOD, GOOD.replace(b"\r\nContent-Length: ", b"\r\nContent-Length: -"),
    GOOD.replace(b"WARC-Type: response", b"WARC-Type: revisit"),
    format_record([*HEAD, ("WARC-Payload-Digest", "sha1:" + "A" * 32)], http_response(3, b"abc"))])
def test_bad_records(bad):
    with pytest.raises(BadArchive):
        parse_record(bad)


def test_problems_are_rows_or_failures(spark, tmp_path):
    data, _ = archive([GOOD, b"nonsense", GOOD])
    (tmp_path / "b.warc.zst").write_bytes(data)
    listed = warc_archive.archives_at(spark, str(tmp_path))
    rows = sorted(warc_archive.read_archives(listed).collect(), key=lambda r: r.offset)
    assert [r.problem is None for r in rows] == [True, False, True] and rows[0].payload == b"abc"
    with pytest.raises(Exception, match="nonsense"):
        warc_archive.read_archives(listed, strict=True).collect()


def test_registered_query(spark, duck):
    got = registry.op12_warc(spark, SF_SMALL)
    want = duck.execute(registry.OP12_SQL)
    names = [d[0] for d in want.description]
    assert got.columns == names
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want.fetchall(), key=str)
