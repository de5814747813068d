import base64
import glob
import gzip
import hashlib

import pytest

from dealspark.llm import warc as W

PAGES = [
    (5, "https://a.example/x?y=1", "<p>one</p>"), (3, "http://b.example", "<p>one</p>"), (9, "https://a.example/é\r\nInjected: 1", "<p>one</p>"),
    (1, None, None), (2, "u", ""), (4, "u", "ends early\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"),
    (7, "u", "é" * 100_000), (None, "n", "<p>one</p>"), (None, "n", "alone"), (None, "n2", "alone"),
    (11, "same", "twice"), (11, "same", "twice"), (11, "other", "twice"), (12, "v", "twice"), (13, "w", "\x00\x0b  "),
]


def pages(spark, rows=PAGES):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, html string, sha string, body string")


def brute(rows):
    out = []
    for i, _, html in rows:
        raw = (html or "").encode()
        same = [p for p, _, h in rows if (h or "") == (html or "") and p is not None]
        first = min(same, default=None)
        again = first is not None and i != first
        out.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if again else "response", first if again else None))
    return sorted(out, key=repr)


def test_round_trip(spark):
    got = W.round_trip(pages(spark))
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(PAGES)


def test_small_payloads_are_all_responses(spark):
    got = W.round_trip(pages(spark), min_bytes=6).collect()
    kinds = {(r["page_id"], r["payload_bytes"]): r["record_type"] for r in got}
    assert kinds[12, 5] == "response" and kinds[5, 10] == "revisit"


def test_nested_rows_and_file_format(spark, tmp_out):
    W.write_archives(pages(spark).repartition(2), f"{tmp_out}/w", records_per_file=9)
    rows = {r["metadata"]["fields"].get("page-id"): r for r in W.assemble(W.read_records(spark, f"{tmp_out}/w")).collect()}
    r = rows["5"]
    assert r["type"] == "revisit" and r["refers_to"] == rows["3"]["capture_id"]
    assert bytes(rows["3"]["response"]["payload"]) == b"<p>one</p>" and r["response"]["payload"] is None
    assert r["request"]["http"].startswith("GET /x?y=1 HTTP/1.1\r\nHost: a.example")
    assert rows["9"]["uri"] == "https://a.example/é%0D%0AInjected: 1"
    assert bytes(rows["4"]["response"]["payload"]).decode() == PAGES[5][2]
    files = glob.glob(f"{tmp_out}/w/part-*.gz")
    assert len(files) > 2
    raw = b"".join(gzip.open(f).read() for f in files)
    assert raw.startswith(b"WARC/1.1\r\nWARC-Type: ") and raw.endswith(b"\r\n\r\n")


def test_parsing_needs_whole_records():
    head = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <a>\r\nWARC-Date: d\r\nWARC-Payload-Digest: sha1:WRONG\r\nContent-Length: 9\r\n\r\nHTTP\r\n\r\nx\r\n\r\n"
    with pytest.raises(ValueError):
        list(W.parse_archive(head))
    plain = head.replace(b"WARC-Payload-Digest: sha1:WRONG\r\n", b"")
    assert [r["payload"] for r in W.parse_archive(gzip.compress(plain) + gzip.compress(plain))] == [b"x", b"x"]


def test_capture_without_its_other_records(spark):
    df = spark.createDataFrame([("<a>", "response", None, None, "u", "d", "D", "HTTP", bytearray(b"x"), 1, None)], W.RECORD)
    r = W.assemble(df).first()
    assert r["request"] is None and r["metadata"]["fields"] is None and r["response"]["payload_bytes"] == 1


def test_empty_table(spark):
    assert W.round_trip(pages(spark, [])).count() == 0
