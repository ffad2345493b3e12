import gzip
import hashlib
import random
import zlib

import pytest

from glosswork.llm import warc

SCHEMA = "page_id bigint, url string, html string, payload string"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x") for i, u, h in rows], SCHEMA)


def test_round_trip(spark, tmp_path):
    big, rng = "é" * 60, random.Random(1)
    noise = "".join(chr(rng.randrange(32, 0x2FF)) for _ in range(300_000))
    rows = [
        (3, "http://a/", big), (1, "http://b/\r\nWARC-Type: x", big), (7, None, big), (2, "u", "x" * 99),
        (4, "u", "x" * 99), (5, "u", None), (6, "u", ""), (8, "u", noise), (9, "u", "x" * 100), (10, "u", "x" * 100),
        (None, "u", big), (1, "http://b/", big),
    ]
    path = str(tmp_path / "a")
    warc.write_archives(pages(spark, rows), path)
    got = warc.read_archives(spark, path, with_payload=True).collect()
    assert all(r.digest_ok for r in got) and len(got) == len(rows)
    seen = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str)
    want = []
    for i, _, h in rows:
        data = (h or "").encode()
        same = [j for j, _, g in rows if (g or "") == (h or "") and j is not None]
        revisit = len(data) >= 100 and i is not None and i != min(same)
        want.append(
            (i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response",
             min(same) if revisit else None)
        )
    assert seen == sorted(want, key=str)
    assert all(hashlib.sha256(r.payload).hexdigest() == r.payload_digest for r in got if r.record_type == "response")


def test_archives_are_gzip_members(spark, tmp_path):
    path = tmp_path / "a"
    warc.write_archives(pages(spark, [(i, "u", f"page {i}") for i in range(20)]).coalesce(1), str(path))
    data = b"".join(gzip.decompress(f.read_bytes()) for f in sorted(path.glob("part-*")))
    assert data.count(b"WARC/1.1\r\n") == 20 and data.count(b"WARC-Type: response") == 20


def test_empty(spark, tmp_path):
    path = str(tmp_path / "a")
    warc.write_archives(pages(spark, []), path)
    assert warc.read_archives(spark, path).count() == 0


def record(payload=b"hello", digest=None):
    return warc.record_bytes(1, "u", payload, digest or hashlib.sha256(payload).hexdigest(), None, "1970-01-01T00:00:00Z")


def read(data):
    return [warc.read_record(p, with_payload=True) for p in warc.members(data)]


def test_digests_and_framing_are_checked():
    assert read(warc.gzip_member(record()))[0]["digest_ok"]
    assert not read(warc.gzip_member(record(digest="0" * 64)))[0]["digest_ok"]
    assert not read(warc.gzip_member(record().replace(b"hello", b"hallo")))[0]["digest_ok"]
    for broken in (record()[:-2], record()[:-8], b"HTTP" + record(), record() + b"x"):
        with pytest.raises(warc.WarcError):
            read(warc.gzip_member(broken))
    with pytest.raises((warc.WarcError, zlib.error)):
        read(warc.gzip_member(record())[:-12])


def test_padding_between_members_is_skipped():
    member = warc.gzip_member(record())
    assert len(read(member + b"\0\0" + member + b"\0")) == 2


def test_pieces_split_anywhere():
    data = record(b"ab\r\n\r\n" * 50)
    for size in (1, 2, 3, 7):
        got = warc.read_record(iter([data[i : i + size] for i in range(0, len(data), size)]), with_payload=True)
        assert got["digest_ok"] and got["payload"] == b"ab\r\n\r\n" * 50 and got["payload_bytes"] == 300
