from __future__ import annotations

import base64
import gzip
import hashlib
import io
import random
from collections import Counter

import pytest

from stratalake.llm.warc import WarcError, WarcParams, encode_record, plain_uri, read_records, round_trip
from stratalake.sources.filesystem import child_names
from stratalake.sources.staging import shared_folder

SCHEMA = "page_id long, url string, html string, refers_to string, revisit int"


def _pages(spark, rows):
    return spark.createDataFrame([(i, f"http://a.b/{i} x", html, "c", 1) for i, html in rows], SCHEMA)


def _brute(rows):
    payload = lambda html: (html or "").encode()
    last = {}
    for i, html in rows:
        p = payload(html)
        if i is not None and (p not in last or i > last[p]):
            last[p] = i
    out = Counter()
    for i, html in rows:
        p = payload(html)
        revisit = p in last and last[p] != i
        digest = base64.b32encode(hashlib.sha1(p).digest()).decode()
        out[i, len(p), digest, "revisit" if revisit else "response", last[p] if revisit else None] += 1
    return out


def test_round_trip(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice(["<p>a</p>", "", None, f"<b>{i}é😀</b>\r\n\r\nWARC/1.1", "x" * rng.randrange(300_000)])) for i in range(300)]
    rows += [(None, "none"), (None, "none"), (None, "<p>a</p>"), (5, rows[5][1]), (2**60, "<p>a</p>"), (400, "y" * 3_000_000)]
    got = round_trip(_pages(spark, rows), WarcParams(file_bytes=20_000)).collect()
    assert Counter(map(tuple, got)) == _brute(rows)
    assert round_trip(_pages(spark, [])).count() == 0


def test_small_payloads_may_be_left_alone(spark):
    rows = [(1, "ab"), (2, "ab"), (3, "long enough"), (4, "long enough")]
    got = {r["page_id"]: r["record_type"] for r in round_trip(_pages(spark, rows), WarcParams(min_bytes=5)).collect()}
    assert got == {1: "response", 2: "response", 3: "revisit", 4: "response"}


def test_archives_are_plain_gzip_members(spark):
    folder = shared_folder(spark)
    before = set(child_names(spark, folder))
    round_trip(_pages(spark, [(1, "a"), (2, "a")])).collect()
    import glob

    new = [f for d in set(child_names(spark, folder)) - before for f in glob.glob(f"{folder}/{d}/*/*.warc.gz")]
    text = "".join(gzip.open(f, "rt", newline="").read() for f in new)
    assert text.count("WARC/1.1\r\n") == 2 and text.count("WARC-Type: revisit") == 1
    assert "WARC-Refers-To: <urn:x-page:2>" in text


def _records(data, **options):
    return list(read_records(io.BytesIO(data), WarcParams(**options)))


def test_reader_in_small_steps():
    payloads = [b"", b"a" * 100_000, bytes(range(256)) * 50]
    data = b"".join(encode_record(i, None, p, False, None) for i, p in enumerate(payloads))
    for step in (1, 7, 1 << 16):
        assert [r.payload for r in _records(data, chunk_bytes=step)] == payloads


def test_reader_refuses_what_is_broken():
    good = encode_record(1, "http://x", b"payload", False, None)
    raw = gzip.decompress(good)
    with pytest.raises(WarcError, match="ends within"):
        _records(good[:-5])
    with pytest.raises(WarcError, match="block digest"):
        _records(gzip.compress(raw.replace(b"payload", b"pAyload")))
    with pytest.raises(WarcError, match="after the record"):
        _records(gzip.compress(raw + b"more"))
    with pytest.raises(WarcError, match="Content-Length"):
        _records(gzip.compress(raw[:-6]))
    with pytest.raises(WarcError, match="not a WARC"):
        _records(gzip.compress(b"HTTP/1.1 200\r\n\r\n"))
    block = raw.split(b"\r\n\r\n", 1)[1][:-4]
    other = block.replace(b"payload", b"another")
    forged = raw.replace(block, other)
    for old, new in ((block, other),):
        forged = forged.replace(
            base64.b32encode(hashlib.sha1(old).digest()), base64.b32encode(hashlib.sha1(new).digest()))
    with pytest.raises(WarcError, match="payload digest"):
        _records(gzip.compress(forged))


def test_reader_compares_the_stated_http_length():
    raw = gzip.decompress(encode_record(1, "http://x", b"payload", False, None))
    head, block = raw[:-4].split(b"\r\n\r\n", 1)
    other = block.replace(b"Content-Length: 7", b"Content-Length: 8")
    digests = [base64.b32encode(hashlib.sha1(b).digest()) for b in (block, other)]
    forged = head.replace(*digests) + b"\r\n\r\n" + other + b"\r\n\r\n"
    with pytest.raises(WarcError, match="HTTP length"):
        _records(gzip.compress(forged))


def test_many_small_files_share_tasks(spark):
    rows = [(i, f"page {i} " * 20) for i in range(300)]
    got = round_trip(_pages(spark, rows), WarcParams(file_bytes=200, readers_per_core=1))
    assert got.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
    assert Counter(map(tuple, got.collect())) == _brute(rows)


def test_names_of_folders():
    assert plain_uri("s3a://bucket/a/b") == plain_uri("s3n://bucket/a/b") == "s3://bucket/a/b"
    assert plain_uri("file:/a/b") == "/a/b"
    for uri in ("/a/b", "file:///a/b", "hdfs://name:8020/a"):
        assert plain_uri(uri) == uri
