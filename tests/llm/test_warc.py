"""Archives: round trips, segments over several files, damaged and foreign records."""

import base64
import gzip
import hashlib
import random

import pytest

from pulsewatch.llm import common, warc

SCHEMA = "page_id long, url string, html string, payload string, n int, sha string"


def brute(rows, least=0):
    out = []
    for page_id, _, html in rows:
        payload = (html or "").encode()
        same = [p for p, _, h in rows if (h or "").encode() == payload and p is not None]
        origin = max(same) if same and len(payload) >= least else None
        revisit = origin is not None and origin != page_id
        sha = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        out.append((page_id, len(payload), sha, "revisit" if revisit else "response", origin if revisit else None, "ok"))
    return sorted(out, key=str)


def pages_of(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)


def found(pages, **options):
    return sorted((tuple(r) for r in warc.round_trip(pages, **options).collect()), key=str)


@pytest.mark.parametrize(("segment", "least"), [(warc.SEGMENT, 0), (200, 30)])
def test_round_trip(spark, segment, least):
    draw = random.Random(4)
    texts = ["", None, "\r\n\r\n", "é" * 150, "WARC/1.1\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n", "<p>\x00﻿</p>", "x" * 60_000, "y" * 200_000]
    rows = [(i, f"http://h/{i} a\n", draw.choice(texts)) for i in range(60)]
    rows += [(None, None, "lone"), (None, "u", "x" * 60_000), (60, "u", "only"), (60, "v", "only"), (61, "u", "x" * 60_000), (61, "u", "x" * 60_000)]
    assert found(pages_of(spark, rows), segment=segment, least_bytes=least) == brute(rows, least)


def test_hot_payload_meets_by_broadcast(spark, monkeypatch):
    monkeypatch.setattr(common, "HEAVY", 4)
    rows = [(i, "u", "same" if i % 3 else f"own {i // 6}") for i in range(90)]
    assert found(pages_of(spark, rows)) == brute(rows)


def test_empty_table(spark):
    assert found(pages_of(spark, [])) == []


def archive(tmp_path, *records, name="a.warc.gz"):
    data = b"".join(gzip.compress(r + b"\r\n\r\n") for r in records)  # one member a record, as is usual
    (tmp_path / name).write_bytes(data)


def rows_of(spark, tmp_path):
    return {r["record_id"]: (r["type"], None if r["payload"] is None else bytes(r["payload"]), r["status"]) for r in warc.read(spark, str(tmp_path)).collect()}


def test_segments_in_any_order_and_file(spark, tmp_path):
    payload = "é€😀".encode() * 700
    records = list(warc.page_records(7, "http://h/", payload, None, 500, warc.DATE))
    random.Random(1).shuffle(records)
    archive(tmp_path, *records[::2], records[1])
    archive(tmp_path, *records[1::2], name="b.warc.gz")  # one record stands in both
    (tmp_path / "c.warc").write_bytes(b"\r\n\r\n".join([warc.record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", "<i>")], b"software: x"), b"junk line", b""]))
    got = rows_of(spark, tmp_path)
    assert got.pop(warc.identifier(7, payload)) == ("response", payload, "ok")
    assert got == {"i": ("warcinfo", b"software: x", "ok")}


def test_missing_contradicting_and_damaged_segments(spark, tmp_path):
    def cut(i):
        return list(warc.page_records(i, "http://h/", bytes([65 + i]) * 1500, None, 400, warc.DATE))

    lost, last, orphan, double, spoilt, whole = (cut(i) for i in range(6))
    other = list(warc.page_records(3, "http://h/", b"D" * 1500, None, 400, warc.DATE))[1].replace(b"DDDD", b"DDDd")
    other = warc.record([("WARC-Type", "continuation"), ("WARC-Segment-Origin-ID", f"<{warc.identifier(3, b'D' * 1500)}>"), ("WARC-Segment-Number", 2)], other[-400:])
    archive(tmp_path, lost[0], *lost[2:], *last[:-1], *orphan[1:], *double, other, spoilt[0], spoilt[1].replace(b"EEEE", b"EEEe"), *spoilt[2:], *whole)
    got = {k.split(":")[-2]: (p, s) for k, (_, p, s) in rows_of(spark, tmp_path).items()}
    assert got == {
        "0": (None, "length"), "1": (None, "length"), "2": (None, "orphan"), "3": (None, "length"), "4": (None, "digest"), "5": (b"F" * 1500, "ok")
    }


def test_revisit_without_its_record(spark, tmp_path):
    archive(tmp_path, *warc.page_records(1, "u", b"gone", 9, 400, warc.DATE), *warc.page_records(2, "u", b"here", 3, 400, warc.DATE), *warc.page_records(3, "u", b"here", None, 400, warc.DATE))
    got = {warc_id.split(":")[3]: (n, status) for warc_id, n, status in (
        (r["record_id"], r["payload_bytes"], r["status"]) for r in warc.resolved(warc.read(spark, str(tmp_path))).collect()
    )}
    assert got == {"1": (None, "unresolved"), "2": (4, "ok"), "3": (4, "ok")}


@pytest.mark.parametrize(
    ("body", "payload"),
    [
        (b"4;name=x\r\nWiki\r\n5\r\npedia\r\n0\r\nTrailer: y\r\n\r\n", b"Wikipedia"),
        (b"A\r\n0123456789\r\n0\r\n\r\n", b"0123456789"),
        (b"0\r\n\r\n", b""),
        (b"5\r\nped", None),
        (b"5\r\npedia\r\n", None),
        (b"zz\r\npedia\r\n0\r\n\r\n", None),
        (b"3\r\npedia\r\n0\r\n\r\n", None),
        (b"", None),
    ],
)
def test_transfer_framing(body, payload):
    assert warc.dechunked(body) == payload
    assert warc.http_payload(b"HTTP/1.1 200 OK\r\nTransfer-Encoding: Chunked\r\n\r\n" + body) == payload
    if payload is not None:
        for size in (1, 3, 100):
            assert warc.dechunked(warc.chunked(payload, size)) == payload
