"""Operator 1: round trips, salvage of damaged archives, and the query's rules."""

import gzip
import hashlib
import random

import pytest

from relcast.llm import warc
from relcast.session import scratch_path


def build(n=6, seed=0):
    rng = random.Random(seed)
    payloads = [bytes(rng.choices(b"abc <>\r\n\x1f\x8b", k=rng.randint(0, 400))) for _ in range(n)]
    return payloads, [warc.record_bytes(i, f"http://h/{i}", p, None) for i, p in enumerate(payloads)]


def check_cover(data, items):
    at = 0
    for item in items:
        assert item.offset in (at, getattr(item, "offset")) and item.offset <= at <= item.end or item.offset == at
        at = max(at, item.end)
    assert at == len(data)


@pytest.mark.parametrize("packed", [False, True])
def test_clean_archive_round_trip(packed):
    payloads, records = build()
    data = b"".join(warc.gzip_member(r) if packed else r for r in records)
    got = [*warc.salvage(data)]
    assert [r.payload for r in got] == payloads
    check_cover(data, got)
    if packed:
        assert gzip.decompress(data) == b"".join(records)


@pytest.mark.parametrize("packed", [False, True])
@pytest.mark.parametrize("seed", range(12))
def test_damage_loses_only_the_damaged_record(packed, seed):
    rng = random.Random(seed)
    payloads, records = build(8, seed)
    parts = [warc.gzip_member(r) if packed else r for r in records]
    hit = rng.randrange(8)
    part = bytearray(parts[hit])
    kind = seed % 3
    if kind == 0:  # bytes overwritten
        at = rng.randrange(len(part) // 4, len(part) - 8)
        part[at:at + 6] = bytes(x ^ 0x55 for x in part[at:at + 6])
    elif kind == 1:  # cut off
        del part[len(part) // 2:]
    else:  # noise in front
        part = bytearray(rng.randbytes(50)) + part
    data = b"".join([*parts[:hit], bytes(part), *parts[hit + 1:]])
    got = [*warc.salvage(data)]
    found = [r.payload for r in got if isinstance(r, warc.Record)]
    gaps = [g for g in got if isinstance(g, warc.Gap)]
    others = [p for i, p in enumerate(payloads) if i != hit]
    missing = list(others)
    for p in found:
        if p in missing:
            missing.remove(p)
    assert not missing
    if kind == 2:
        assert len(found) == 8
    assert gaps and all(g.reason and g.end > g.offset for g in gaps) or len(found) == 8
    check_cover(data, got)


@pytest.mark.parametrize("kind", ["cut", "broken", "checksum"])
def test_records_of_a_broken_member_of_many(kind):
    """Ten records in one member: nine stand before the break, or all have their digests."""
    payloads, records = build(10, 3)
    payloads = [p + random.Random(i).randbytes(3000) for i, p in enumerate(payloads)]
    records = [warc.record_bytes(i, f"http://h/{i}", p, None) for i, p in enumerate(payloads)]
    member = bytearray(warc.gzip_member(b"".join(records)))
    if kind == "cut":
        del member[-2000:]
    elif kind == "broken":
        member[-1500:-1490] = b"\xff" * 10
    else:
        member[-6] ^= 0x55
    after = warc.gzip_member(warc.record_bytes(99, "http://h/99", b"later", None))
    got = [*warc.salvage(bytes(member) + after)]
    found = [r.payload for r in got if isinstance(r, warc.Record)]
    assert found[:9] == payloads[:9] and found[-1] == b"later" and len(found) in (10, 11)
    assert any(isinstance(g, warc.Gap) for g in got)
    check_cover(bytes(member) + after, got)


def test_undigested_records_of_contradictory_members_do_not_count():
    block = b"WARC/1.0\r\nWARC-Type: resource\r\nContent-Length: 5000\r\n\r\n" + bytes(random.Random(1).choices(b"abcdef", k=5000)) + b"\r\n\r\n"
    member = bytearray(gzip.compress(block * 3))
    member[-7] ^= 0x55  # the checksum does not fit
    assert not [r for r in warc.salvage(bytes(member)) if isinstance(r, warc.Record)]
    cut = gzip.compress(block * 3 + random.Random(2).randbytes(5000))[:-3000]
    assert len([r for r in warc.salvage(cut) if isinstance(r, warc.Record)]) == 3


@pytest.mark.parametrize("noise", [b"WARC/1.0\r\n", b"x: WARC/1.1\r\n", b"WARC/1.1\r\na: b\r\n", b"WARC/1.0\r\nContent-Length: 9\r\nWARC-Type: x\r\n\r\n", b"\x1f\x8b\x08", b"\r\n\r\n"])
@pytest.mark.parametrize("tail", [b"", b"\r\n\r\n"])
def test_salvage_is_linear(noise, tail):
    import time

    _, records = build(1)
    data = noise * ((2 << 20) // len(noise)) + tail + b"\n" + records[0]
    start = time.time()
    got = [*warc.salvage(data)]
    assert time.time() - start < 20
    check_cover(data, got)
    assert any(isinstance(r, warc.Record) and r.headers["warc-record-id"] == "<urn:page:0>" for r in got)


def test_noise_between_records_is_searched_once():
    import time

    payloads, records = build(4)
    noise = random.Random(5).randbytes(10 << 20)
    start = time.time()
    got = [*warc.salvage(records[0] + noise + records[1] + noise[:1000] + warc.gzip_member(records[2]) + records[3])]
    assert time.time() - start < 20 and [r.payload for r in got if isinstance(r, warc.Record)] == payloads


def test_archives_are_bounded_in_bytes(spark, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 20_000)
    rng = random.Random(6)
    pages = spark.createDataFrame([(i, "u", "".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(1000 + i))) for i in range(60)], "page_id long, url string, html string").repartition(2)
    path = scratch_path(spark, "warc-bounded")
    warc.write_archives(pages, path)
    sizes = [r.length for r in spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("length").collect()]
    assert len(sizes) > 4 and max(sizes) < 24_000
    assert warc.read_archives(spark, path).where("damage is null").count() == 60


def test_foreign_members_and_empty_input():
    _, records = build(3)
    whole = gzip.compress(b"".join(records))  # several records in one member
    assert len([r for r in warc.salvage(whole) if isinstance(r, warc.Record)]) == 3
    assert [*warc.salvage(b"")] == []
    assert [type(x) for x in warc.salvage(b"no archive at all")] == [warc.Gap]
    assert [type(x) for x in warc.salvage(gzip.compress(b"no record"))] == [warc.Gap]


def test_members_end_with_a_zero_byte():
    for size in (0, 10, 1 << 16, (1 << 24) + 5):
        member = warc.gzip_member(b"x" * size)
        assert member[-1] == 0 and gzip.decompress(member) == b"x" * size


def pages_table(spark):
    big, other = "<p>é" * 400, "<b>z" * 300
    rows = [
        (1, "http://a", big), (2, "http://b\r\nWARC-Type: evil", big), (3, None, big), (4, "u", "small"), (5, "u", "small"), (6, "u", None), (7, "u", ""),
        (8, "u", other), (8, "u", other), (9, "u", "x" * 999), (10, "u", "x" * 999), (11, "u", "x" * 1000), (12, "u", "x" * 1000), (None, "u", big), (None, None, None),
        (13, "u", "WARC/1.1\r\nWARC-Type: response\r\n\r\n" * 40),
    ]
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, record_type string, payload int").repartition(3)


def test_query_rules(spark, rows_of):
    pages = pages_table(spark)
    given_rows = rows_of(pages)
    got = rows_of(warc.op1_query(pages))
    latest = {}
    for r in given_rows:
        h = (r["html"] or "").encode()
        if r["page_id"] is not None:
            latest[h] = max(latest.get(h, -1), r["page_id"])
    want = []
    for r in given_rows:
        h = (r["html"] or "").encode()
        to = latest.get(h) if len(h) >= 1000 and latest.get(h) != r["page_id"] else None
        want.append((r["page_id"], len(h), hashlib.sha1(h).hexdigest(), "revisit" if to is not None else "response", to))
    key = lambda t: tuple((x is None, str(x)) for x in t)
    assert sorted((tuple(r[c] for c in ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")) for r in got), key=key) == sorted(want, key=key)
    assert warc.op1_query(pages.where("false")).count() == 0


def test_reader_returns_payloads_and_gaps(spark):
    pages = pages_table(spark).where("page_id in (1, 4, 8)")
    path = scratch_path(spark, "warc-test")
    warc.write_archives(pages.coalesce(1), path)
    read = warc.read_archives(spark, path)
    assert {bytes(r.payload).decode() for r in read.collect()} == {r.html for r in pages.collect()}
    assert read.where("damage is not null").count() == 0
