"""WARC archives with one Zstandard frame a record and a shared dictionary in front.

A part file of an archive is

    dictionary frame | separator | warcinfo frame | separator | record frame | separator | ...

* The dictionary frame is a skippable frame (magic 0x184D2A5D) whose content is a Zstandard dictionary
  trained on archived records. Every file starts with it, so each file can be read alone.
* Each record is a frame of its own with content size and checksum, compressed with that dictionary.
* The separator is an empty skippable frame (magic 0x184D2A50, length 0). Decoders pass over it, and its eight
  bytes are plain ASCII: it is the ``lineSep`` of Spark's text writer and reader. So Spark writes the
  files under its own commit protocol, wherever the folder is, and reads them in splits. A record
  whose frame happens to hold the separator is compressed anew with block borders inside it.

Records of equal payloads (SHA-256) become revisits of the one of least page_id. Least ids are partial
minima before the shuffle; they meet the pages by a salted join, so no payload is a hot key.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard as zstd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import Scratch

LEAST_BYTES = 100  # smaller payloads are never revisits
SALTS = 32
LEVEL = 3
DICTIONARY_BYTES = 64 * 1024
SAMPLE_RECORDS, SAMPLE_BYTES = 512, 16 * 1024  # records that the dictionary is trained on, and their first bytes; results don't depend on either
BUCKETS = 1 << 40
#: Fixed values of the formats.
SEPARATOR = "P*M\x18\0\0\0\0"
DICTIONARY_MAGIC = b"]*M\x18"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"

_BREAK = SEPARATOR.encode()
_UNSAFE = re.compile(r"[\x00-\x20\x7f<>]")
ROWS = "page_id string, url string, record_type string, payload_bytes long, payload_digest string, refers_to string, payload binary"


def header(kind: str, fields: list[tuple[str, object]], length: int) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", *(f"{k}: {v}" for k, v in fields if v is not None), f"Content-Length: {length}"]
    return "\r\n".join([*lines, "", ""]).encode()


def record_of(page: object, url: str | None, payload: bytes | None, size: int, digest: str, original: object, date: str) -> bytes:
    """A response with its payload, or with ``payload`` null a revisit of the page ``original``.

    White space, control characters and angle brackets of a url are percent-encoded. A page without
    an id is written as ``null``.
    """
    name = lambda p: f"<urn:x-page:{'null' if p is None else p}>"
    target = None if url is None else _UNSAFE.sub(lambda m: f"%{ord(m.group()):02X}", url)
    fields = [("WARC-Record-ID", name(page)), ("WARC-Date", date), ("WARC-Target-URI", target), ("WARC-Payload-Digest", f"sha256:{digest}"), ("X-Payload-Length", size)]
    if payload is None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", name(original))]
    block = HTTP.format(size).encode() + (payload or b"")
    fields.append(("Content-Type", "application/http; msgtype=response"))
    return header("revisit" if payload is None else "response", fields, len(block)) + block + b"\r\n\r\n"


def parse(record: bytes) -> tuple[dict[str, str], bytes]:
    """(fields in lower case, block) of one record; ``warc-type`` is among the fields."""
    head, gap, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not gap or not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    length = int(fields["content-length"])
    if rest[length:] != b"\r\n\r\n":
        raise ValueError(f"record {fields.get('warc-record-id')} is cut or too long")
    return fields, rest[:length]


class Frames:
    """Compresses single records to frames that don't hold the separator, and opens them."""

    def __init__(self, dictionary: bytes, level: int = LEVEL):
        self.dictionary = zstd.ZstdCompressionDict(dictionary) if dictionary else None
        self.level = level
        self.pack = self._compressor(level)
        self.unpack = zstd.ZstdDecompressor(**({"dict_data": self.dictionary} if self.dictionary else {}))
        self.id = self.dictionary.dict_id() if self.dictionary else 0

    def _compressor(self, level: int) -> zstd.ZstdCompressor:
        return zstd.ZstdCompressor(level=level, write_checksum=True, write_content_size=True, **({"dict_data": self.dictionary} if self.dictionary else {}))

    def leading(self) -> bytes:
        raw = self.dictionary.as_bytes() if self.dictionary else b""
        return DICTIONARY_MAGIC + struct.pack("<I", len(raw)) + raw

    def compress(self, record: bytes) -> bytes:
        frame = self.pack.compress(record)
        levels = iter([self.level, *(x for x in range(1, 20) if x != self.level)])
        while _BREAK in frame:  # a literal separator is cut by block borders, an accidental one moved by another level
            level = next(levels, None)
            if level is None:
                raise ValueError("no level gives a frame without the separator")
            stream, parts, at = self._compressor(level).compressobj(size=len(record)), [], 0
            while (found := record.find(_BREAK, at)) >= 0:
                cut = found + len(_BREAK) // 2
                parts += [stream.compress(record[at:cut]), stream.flush(zstd.COMPRESSOBJ_FLUSH_BLOCK)]
                at = cut
            frame = b"".join([*parts, stream.compress(record[at:]), stream.flush()])
        return frame

    def open(self, frame: bytes) -> bytes:
        if (named := zstd.get_frame_parameters(frame).dict_id) != self.id:
            raise ValueError(f"a frame asks for dictionary {named}; the archive's is {self.id}")
        return self.unpack.decompress(frame)


def dictionary_of(frame: bytes) -> bytes:
    """The dictionary in a leading frame; empty if the frame holds none."""
    if frame[:4] != DICTIONARY_MAGIC or struct.unpack("<I", frame[4:8])[0] != len(frame) - 8:
        raise ValueError("not a dictionary frame")
    return frame[8:]


def train(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary of at most ``size`` bytes; empty where the samples are too few or too small to train one."""
    size = min(size, sum(map(len, samples)) // 4)
    if len(samples) < 8 or size < 1024:
        return b""
    try:
        return zstd.train_dictionary(size, samples).as_bytes()
    except zstd.ZstdError:
        return b""


def planned(pages: DataFrame, scratch: Scratch, least: int = LEAST_BYTES) -> DataFrame:
    """page_id, url, payload (null for revisits), size, digest and original (null for responses) of every row.

    Rows that repeat the least page_id of their payload are responses too. A null id is above all others.
    """
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    keyed = pages.select("page_id", "url", payload.alias("payload")).withColumns({"size": F.octet_length("payload").cast("long"), "digest": F.sha2("payload", 256)})
    copies = keyed.where(F.col("size") >= least).groupBy(F.col("digest").alias("d_")).agg(F.min("page_id").alias("first_"), F.count("*").alias("n")).where("n > 1 and first_ is not null").drop("n")
    copies = scratch.put(copies, "copies").withColumn("s_", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salt = F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int")
    met = keyed.withColumn("salt", salt).join(copies, (F.col("digest") == F.col("d_")) & (F.col("salt") == F.col("s_")) & (F.col("size") >= least), "left")
    original = F.when(~F.col("page_id").eqNullSafe(F.col("first_")), F.col("first_"))
    return met.withColumn("original", original).select("page_id", "url", F.when(F.col("original").isNull(), F.col("payload")).alias("payload"), "size", "digest", "original")


def learn_dictionary(pages: DataFrame, date: str, records: int = SAMPLE_RECORDS) -> bytes:
    """Trains on the first bytes of the records of at most ``records`` distinct pages of least hash.

    A range of hashes that holds about twice as many is read, so that tasks send few rows.
    """
    n = pages.count()
    place = F.pmod(F.xxhash64("page_id", "url", F.lit("dictionary")), F.lit(BUCKETS))
    near = pages.withColumn("place", place).where(F.col("place") <= BUCKETS * min(1.0, 2 * records / max(1, n)))
    few = near.select("place", "page_id", "url", F.substring(F.coalesce(F.col("html").cast("binary"), F.lit(b"")), 1, SAMPLE_BYTES).alias("payload")).orderBy("place", "page_id", "payload").limit(records)
    samples = {hashlib.sha256(r["payload"]).hexdigest(): r for r in few.collect()}
    return train([record_of(r["page_id"], r["url"], bytes(r["payload"]), len(r["payload"]), digest, None, date) for digest, r in samples.items()])


def write_archive(pages: DataFrame, folder: str, scratch: Scratch, date: str = "1970-01-01T00:00:00Z", level: int = LEVEL) -> None:
    """Writes a record for every row of pages (page_id, url, html) to part files of a new folder.

    Null html is an empty payload; a null url leaves WARC-Target-URI out. An empty table gives files
    without records. The same pages give the same records, in files that Spark deals out.
    """
    rows, dictionary = planned(pages, scratch), learn_dictionary(pages, date)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frames, first = Frames(dictionary, level), True
        about = b"software: nocturne\r\nformat: WARC File Format 1.1\r\n"
        info = header("warcinfo", [("WARC-Record-ID", "<urn:x-page:info>"), ("WARC-Date", date), ("Content-Type", "application/warc-fields")], len(about)) + about + b"\r\n\r\n"
        for batch in batches:
            out = [frames.leading(), frames.compress(info)] if first and batch.num_rows else []
            first = first and not batch.num_rows
            for at in range(batch.num_rows):
                page, url, payload, size, digest, original = (batch.column(i)[at].as_py() for i in range(6))
                revisit = batch.column(5)[at].is_valid
                out.append(frames.compress(record_of(page, url, None if revisit else payload, size, digest, original, date)))
                if sum(map(len, out[-64:])) > 1 << 24 or len(out) >= 2048:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["frame"])
                    out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["frame"])

    lines = rows.mapInArrow(run, "frame binary").select(F.col("frame").cast("string").alias("value"))
    lines.write.option("lineSep", SEPARATOR).option("maxRecordsPerFile", 0).option("compression", "none").text(folder)


def read_archive(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """page_id (as text), url, record_type, payload_bytes, payload_digest, refers_to (as text) and payload of each record.

    Every frame's checksum and every response's length and digest are held against its header; a record that
    fails stops the job. Payloads of revisits are null, as are all without ``payloads``. Files are
    read in splits: the one dictionary of the archive is taken from a leading frame and sent along.
    """
    frames = spark.read.option("lineSep", SEPARATOR).text(folder).select(F.col("value").cast("binary").alias("frame"))
    is_dictionary = F.substring("frame", 1, 4) == F.lit(DICTIONARY_MAGIC)
    leading = frames.where(is_dictionary).head()
    dictionary = dictionary_of(bytes(leading["frame"])) if leading else b""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened = Frames(dictionary)
        name = lambda field: None if field is None or field == "<urn:x-page:null>" else field.removeprefix("<urn:x-page:").removesuffix(">")
        for batch in batches:
            out = []
            for frame in batch.column(0):
                fields, block = parse(opened.open(frame.as_py()))
                kind = fields["warc-type"]
                if kind not in ("response", "revisit"):
                    continue
                size, digest, payload = int(fields["x-payload-length"]), fields["warc-payload-digest"].removeprefix("sha256:"), None
                if kind == "response":
                    payload = block.partition(b"\r\n\r\n")[2]
                    if len(payload) != size or hashlib.sha256(payload).hexdigest() != digest:
                        raise ValueError(f"payload of {fields['warc-record-id']} differs from its header")
                out.append((name(fields["warc-record-id"]), fields.get("warc-target-uri"), kind, size, digest, name(fields.get("warc-refers-to")), payload if payloads else None))
            kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)], ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "payload"])

    return frames.where(~is_dictionary).mapInArrow(run, ROWS)


def archived(pages: DataFrame, scratch: Scratch) -> DataFrame:
    """Writes an archive of pages to the shared folder, reads it back, and gives the digest columns of each record."""
    folder = f"{scratch.root}/warc"
    write_archive(pages, folder, scratch)
    scratch.drop("copies")
    kind = pages.schema["page_id"].dataType
    read = read_archive(pages.sparkSession, folder, payloads=False)
    return read.select(F.col("page_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"))
