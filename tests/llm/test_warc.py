"""Archives: written, read back, and read by a plain zstd decoder."""

import hashlib
import struct
from pathlib import Path

import pytest
import zstandard as zstd

from nocturne.llm import warc
from nocturne.llm.shared import Scratch

SHAPE = "page_id long, url string, html string, payload string, digest string, n int, size string, salt string"
LONG = "<p>" + "long page ☃ " * 20 + "</p>"


def pages_of(spark, rows, parts=3):
    return spark.createDataFrame([(i, u, h, "clash", "clash", 1, "clash", "clash") for i, u, h in rows], SHAPE).repartition(parts)


def edge_rows():
    rows = [(1, None, None), (2, "http://a/", ""), (3, "http://a/b c\r\nX: y", "short"), (4, "http://a", "short"), (5, "u", LONG), (6, "u2", LONG), (7, "u3", LONG + "!"), (6, "u2", LONG)]
    rows += [(9, "big", "x" * 3_000_000), (8, "big2", "x" * 3_000_000), (10, "sep", f"{LONG}{warc.SEPARATOR}tail{warc.SEPARATOR}"), (None, "no id", LONG), (11, "\r\n\r\n", "WARC/1.1\r\n\r\n" * 20), (12, "n", "y" * 99), (13, "n", "y" * 99), (14, "n", "z" * 100), (15, "n", "z" * 100)]
    return rows + [(100 + i, f"http://h{i % 5}/{i}", f"<html><head><title>t{i}</title></head><body><div class=main>{'common words of all pages ' * 9}{i * i}</div></body></html>") for i in range(200)]


def expected(rows):
    least = {}
    for i, _, h in rows:
        p = (h or "").encode()
        if len(p) >= 100 and i is not None:
            least[p] = min(i, least.get(p, i))
    out = []
    for i, _, h in rows:
        p = (h or "").encode()
        first = least.get(p)
        revisit = first is not None and first != i
        out.append((i, len(p), hashlib.sha256(p).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


def plain_records(folder):
    """Records of every part file as a reader sees them that knows the format alone: frames one after the other."""
    for f in sorted(Path(folder.removeprefix("file:")).glob("part-*")):
        raw, at, dictionary = f.read_bytes(), 0, None
        while at < len(raw):
            magic, length = struct.unpack("<II", raw[at : at + 8])
            if 0x184D2A50 <= magic <= 0x184D2A5F:
                if magic == 0x184D2A5D:
                    assert at == 0
                    dictionary = raw[8 : 8 + length]
                at += 8 + length
                continue
            opened = zstd.ZstdDecompressor(**({"dict_data": zstd.ZstdCompressionDict(dictionary)} if dictionary else {})).decompressobj()
            record = opened.decompress(raw[at:])
            at = len(raw) - len(opened.unused_data)
            yield record, bool(dictionary)


def test_round_trip_of_edge_rows(spark, scratch):
    rows = edge_rows()
    scratch = Scratch(spark)
    got = warc.archived(pages_of(spark, rows), scratch).collect()
    assert sorted(map(tuple, got), key=str) == expected(rows)
    read = warc.read_archive(spark, f"{scratch.root}/warc").collect()
    held = {(r.page_id, r.payload_bytes): bytes(r.payload) for r in read if r.payload is not None}
    for i, n, digest, kind, _ in expected(rows):
        assert kind == "revisit" or hashlib.sha256(held[None if i is None else str(i), n]).hexdigest() == digest
    assert {r.url for r in read} >= {"http://a/b%20c%0D%0AX:%20y", None, "%0D%0A%0D%0A"}


def test_files_are_plain_zstandard(spark):
    scratch = Scratch(spark)
    rows = edge_rows()
    warc.write_archive(pages_of(spark, rows), f"{scratch.root}/a", scratch)
    found = [(warc.parse(r), d) for r, d in plain_records(f"{scratch.root}/a")]
    assert all(d for _, d in found)
    kinds = [f["warc-type"] for (f, _), _ in found]
    assert len(kinds) - kinds.count("warcinfo") == len(rows)
    revisit = next(f for (f, _), _ in found if f["warc-type"] == "revisit" and f["warc-record-id"] == "<urn:x-page:15>")
    assert revisit["warc-refers-to"] == "<urn:x-page:14>" and revisit["warc-profile"].endswith("identical-payload-digest")


def test_splits_of_one_file(spark):
    scratch = Scratch(spark)
    rows = edge_rows()
    pages = pages_of(spark, rows).coalesce(1)
    warc.write_archive(pages, f"{scratch.root}/a", scratch)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        read = warc.read_archive(spark, f"{scratch.root}/a")
        assert read.rdd.getNumPartitions() > 3
        assert read.count() == len(rows)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


@pytest.mark.parametrize("rows", [[], [(1, "u", "x")], [(1, "u", LONG), (2, "u", LONG)]])
def test_few_rows(spark, rows):
    got = warc.archived(pages_of(spark, rows, 2), Scratch(spark)).collect()
    assert sorted(map(tuple, got), key=str) == expected(rows)


def test_frames_never_hold_the_separator():
    frames = warc.Frames(b"")
    for text in (warc.SEPARATOR * 3, "a" + warc.SEPARATOR, f"0123{warc.SEPARATOR}456"):
        record = text.encode()
        frame = frames.compress(record)
        assert warc.SEPARATOR.encode() not in frame and frames.open(frame) == record


def test_damage_is_told():
    frames = warc.Frames(b"")
    frame = bytearray(frames.compress(warc.record_of(1, "u", b"payload", 7, hashlib.sha256(b"payload").hexdigest(), None, "d")))
    frame[-1] ^= 1
    with pytest.raises(zstd.ZstdError):
        frames.open(bytes(frame))
    with pytest.raises(ValueError):
        warc.parse(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nshort\r\n\r\n")


def test_same_records_again(spark):
    rows = edge_rows()
    found = []
    for parts in (1, 4):
        scratch = Scratch(spark)
        warc.write_archive(pages_of(spark, rows, parts), f"{scratch.root}/a", scratch)
        found.append(sorted(r for r, _ in plain_records(f"{scratch.root}/a") if not r.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")))
    assert found[0] == found[1]


def test_query_over_the_table(spark, sf_dir):
    from nocturne.llm.queries import QUERIES

    rows = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()]
    assert sorted(map(tuple, QUERIES["op11_warc"](spark, sf_dir).collect()), key=str) == expected(rows)
