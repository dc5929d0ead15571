"""FITS frames as a Spark source and sink: headers by the block, pixels only on demand.

``spark.read.format("fits")`` after :func:`register` gives path, header and, unless the option
``pixels`` is false, ny, nx and px (little-endian float32). Header-only reads stop at the END card of
the first image, wherever that is, and skip data units. Tables are no images, but for a compressed
image (a table with ZIMAGE), which is opened tile by tile.
:func:`read_frames` offers the same rows through the binaryFile source, for stores that only Spark
reads; a file that can't be parsed becomes a row with an error, not a failure.
"""

from __future__ import annotations

import gzip
import io
import re
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions import headers, sky
from ..plans.config import Instrument
from . import tiles

SUFFIXES = (".fits", ".fit", ".fts", ".fits.gz", ".fits.fz", ".fz")
BLOCK, CARD = 2880, 80
LEFT_OUT = ("XTENSION", "PCOUNT", "GCOUNT")
TABLE_CARD = re.compile(r"T(TYPE|FORM|UNIT|NULL|SCAL|ZERO|DISP|DIM)\d+|TFIELDS|THEAP|NAXIS\d*|BITPIX|CHECKSUM|DATASUM|Z(IMAGE|CMPTYPE|BITPIX|NAXIS\d*|TILE\d+|NAME\d+|VAL\d+|QUANTIZ|DITHER0|SIMPLE|EXTEND|TENSION|PCOUNT|GCOUNT|SCALE|ZERO|BLANK|HECKSUM|DATASUM)")
TYPES = {8: ">u1", 16: ">i2", 32: ">i4", 64: ">i8", -32: ">f4", -64: ">f8"}


def parse_cards(raw: bytes) -> tuple[dict[str, str], int]:
    """(keyword -> text of its value, bytes of the header) of the unit that begins ``raw``."""
    out: dict[str, str] = {}
    for at in range(0, len(raw) - CARD + 1, CARD):
        card = raw[at : at + CARD].decode("ascii", "replace")
        key = card[:8].strip()
        if key == "END":
            return out, -(-(at + CARD) // BLOCK) * BLOCK
        if card[8:10] != "= ":
            continue
        body = card[10:]
        if body.lstrip().startswith("'"):
            text, body = "", body.lstrip()[1:]
            while True:
                part, quote, body = body.partition("'")
                text += part
                if not quote or not body.startswith("'"):
                    break
                text, body = text + "'", body[1:]
            value = text.rstrip()
        else:
            value = body.split("/")[0].strip()
            value = {"T": "True", "F": "False"}.get(value, value)
        out[key] = value
    raise ValueError("no END card")


def _header(stream) -> tuple[dict[str, str], int] | None:
    """The next unit's (header, bytes of its data), read by the block; None at the end of the file."""
    raw = b""
    while block := stream.read(BLOCK):
        raw += block
        if any(block[at : at + 8] == b"END     " for at in range(0, len(block), CARD)):
            header, _ = parse_cards(raw)
            axes = [int(header[f"NAXIS{i}"]) for i in range(1, int(header.get("NAXIS", 0)) + 1)]
            size = abs(int(header.get("BITPIX", 8))) // 8 * (int(np.prod(axes)) + int(header.get("PCOUNT", 0))) * int(header.get("GCOUNT", 1)) if axes else 0
            return header, size
    if raw.strip(b"\0 "):
        raise ValueError("no END card")
    return None


def read_stream(stream, pixels: bool = True) -> tuple[dict[str, str], np.ndarray | None]:
    """(merged header, image): the primary header overlaid by that of the first image of two axes or more."""
    primary: dict[str, str] | None = None
    while (unit := _header(stream)) is not None:
        header, size = unit
        primary = header if primary is None else primary
        kind = header.get("XTENSION", "IMAGE").strip()
        if kind == "BINTABLE" and header.get("ZIMAGE") == "True":
            own = {k: v for k, v in header.items() if k not in LEFT_OUT and not TABLE_CARD.fullmatch(k)}
            merged = primary | own | {f"NAXIS{i}": header[f"ZNAXIS{i}"] for i in (1, 2) if f"ZNAXIS{i}" in header}
            if not pixels:
                return merged, None
            image = tiles.image(header, stream.read(size))
            return merged, (image * float(header.get("BSCALE", 1)) + float(header.get("BZERO", 0))).astype(np.float32)
        if kind == "IMAGE" and int(header.get("NAXIS", 0)) >= 2:
            merged = primary | {k: v for k, v in header.items() if k not in LEFT_OUT}
            if not pixels:
                return merged, None
            nx, ny = int(header["NAXIS1"]), int(header["NAXIS2"])
            image = np.frombuffer(stream.read(size), np.dtype(TYPES[int(header["BITPIX"])]), nx * ny).reshape(ny, nx).astype(np.float64)
            return merged, (image * float(header.get("BSCALE", 1)) + float(header.get("BZERO", 0))).astype(np.float32)
        stream.seek(-(-size // BLOCK) * BLOCK, io.SEEK_CUR)
    if primary is None:
        raise ValueError("empty file")
    return primary, None


def read_fits(raw: bytes, pixels: bool = True) -> tuple[dict[str, str], np.ndarray | None]:
    """As ``read_stream``, of a file's bytes, plain or gzipped."""
    stream = io.BytesIO(raw)
    return read_stream(gzip.GzipFile(fileobj=stream) if raw[:2] == b"\x1f\x8b" else stream, pixels)


def read_path(path: str, pixels: bool = True) -> tuple[dict[str, str], np.ndarray | None]:
    """As ``read_stream``, of a file: without pixels no more is read than up to the image's header."""
    with open(path, "rb") as f:
        packed = f.read(2) == b"\x1f\x8b"
        f.seek(0)
        return read_stream(gzip.GzipFile(fileobj=f) if packed else f, pixels)


def format_card(key: str, value) -> bytes:
    if key in ("HISTORY", "COMMENT"):
        return f"{key:<8}{value}"[:CARD].ljust(CARD).encode("ascii", "replace")
    if isinstance(value, bool):
        text = f"{'T' if value else 'F':>20}"
    elif isinstance(value, (int, np.integer)):
        text = f"{int(value):>20}"
    elif isinstance(value, (float, np.floating)):
        text = f"{float(value):>20.15G}"
    else:
        text = "'" + str(value).replace("'", "''")[:66].ljust(8) + "'"
    return f"{key[:8]:<8}= {text}"[:CARD].ljust(CARD).encode("ascii", "replace")


def _unit(image: np.ndarray | None, cards: list[tuple[str, object]], extension: str | None) -> bytes:
    kind = {"float32": (-32, ">f4"), "uint8": (8, ">u1"), "float64": (-64, ">f8")}[str(image.dtype)] if image is not None else (8, None)
    own: list[tuple[str, object]] = [("XTENSION", "IMAGE") if extension else ("SIMPLE", True), ("BITPIX", kind[0]), ("NAXIS", 0 if image is None else 2)]
    if image is not None:
        own += [("NAXIS1", image.shape[1]), ("NAXIS2", image.shape[0])]
    own += [("PCOUNT", 0), ("GCOUNT", 1), ("EXTNAME", extension)] if extension else []
    taken = {k for k, _ in own} | {"EXTEND", "END"}
    body = b"".join(format_card(k, v) for k, v in own + [(k, v) for k, v in cards if k in ("HISTORY", "COMMENT") or k not in taken])
    body += b"END".ljust(CARD)
    out = body.ljust(-(-len(body) // BLOCK) * BLOCK)
    if image is not None:
        data = np.ascontiguousarray(image).astype(kind[1]).tobytes()
        out += data.ljust(-(-len(data) // BLOCK) * BLOCK, b"\0")
    return out


def write_fits(path: str | Path, image: np.ndarray, header: dict | None = None, history: list[str] | None = None, extra: dict | None = None) -> Path:
    """One float32 image with its header, provenance cards and history."""
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    cards = [*(header or {}).items(), *(extra or {}).items(), ("CREATOR", "nocturne"), *(("HISTORY", h) for h in history or [])]
    path.write_bytes(_unit(np.asarray(image, np.float32), cards, None))
    return path


def write_reduced(path: str | Path, data: np.ndarray, variance: np.ndarray, quality: np.ndarray, header: dict | None = None) -> Path:
    """SCI, ERR and DQ extensions; the primary header marks the file as reduced."""
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    cards = [*(header or {}).items(), ("NOCTRED", True)]
    error = np.sqrt(np.clip(variance, 0, None)).astype(np.float32)
    parts = [_unit(None, cards, None), _unit(np.asarray(data, np.float32), cards, "SCI"), _unit(error, [], "ERR"), _unit(np.asarray(quality, np.uint8), [], "DQ")]
    path.write_bytes(b"".join(parts))
    return path


def list_frames(folder: str) -> list[str]:
    """FITS files of one folder by name, not of its subfolders."""
    root = Path(folder)
    if not root.is_dir():
        raise NotADirectoryError(folder)
    return [str(p) for p in sorted(root.iterdir()) if p.is_file() and p.name.lower().endswith(SUFFIXES)]


class _File(InputPartition):
    def __init__(self, path: str):
        self.path = path


class _Reader(DataSourceReader):
    def __init__(self, paths: list[str], pixels: bool):
        self.paths, self.pixels = paths, pixels

    def partitions(self) -> list[InputPartition]:
        return [_File(p) for p in self.paths]

    def read(self, part: InputPartition) -> Iterator[tuple]:
        try:
            header, image = read_path(part.path, self.pixels)
            yield (part.path, header, *((image.shape[0], image.shape[1], image.astype("<f4").tobytes()) if image is not None else (None, None, None)), None)
        except Exception as e:  # noqa: BLE001  an unreadable frame is a row of its own
            yield (part.path, {}, None, None, None, f"{type(e).__name__}: {e}")


class FitsDataSource(DataSource):
    """Options: path (a folder or one file) and pixels (default true)."""

    @classmethod
    def name(cls) -> str:
        return "fits"

    def schema(self) -> str:
        return "path string, header map<string,string>, ny int, nx int, px binary, error string"

    def reader(self, schema) -> DataSourceReader:
        path = self.options["path"]
        return _Reader(list_frames(path) if Path(path).is_dir() else [path], self.options.get("pixels", "true").lower() != "false")


def register(spark: SparkSession) -> None:
    spark.dataSource.register(FitsDataSource)


def must_be_folder(spark: SparkSession, folder: str) -> None:
    """Raises NotADirectoryError unless ``folder`` is one, wherever it is."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not system.exists(path) or not system.getFileStatus(path).isDirectory():
        raise NotADirectoryError(folder)


def read_frames(spark: SparkSession, folder: str, pixels: bool = True) -> DataFrame:
    """path, header, ny, nx, px and error of a folder's frames, through Spark's own file listing."""
    files = spark.read.format("binaryFile").load(folder).where(F.lower("path").rlike(r"\.(fits|fit|fts|fits\.gz|fits\.fz|fz)$")).select("path", "content")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for path, raw in zip(pdf["path"], pdf["content"], strict=True):
                try:
                    header, image = read_fits(raw, pixels)
                    rows.append((path, header, *((image.shape[0], image.shape[1], image.astype("<f4").tobytes()) if image is not None else (None, None, None)), None))
                except Exception as e:  # noqa: BLE001
                    rows.append((path, {}, None, None, None, f"{type(e).__name__}: {e}"))
            out = pd.DataFrame(rows, columns=["path", "header", "ny", "nx", "px", "error"])
            yield out.astype({"ny": "Int32", "nx": "Int32"})

    return files.mapInPandas(run, "path string, header map<string,string>, ny int, nx int, px binary, error string")


def frame_meta(frames: DataFrame, inst: Instrument) -> DataFrame:
    """The fixed metadata of each frame with a readable header, as column expressions over the map."""
    h, m = F.col("header"), inst.header
    first = lambda keys: headers.first_present(h, keys)
    text = lambda keys, default: F.coalesce(F.nullif(F.trim(first(keys)), F.lit("")), F.lit(default))
    num = lambda keys, default: headers.as_float(first(keys), default)
    size = lambda k: F.coalesce(F.try_element_at(h, F.lit(k)).try_cast("int"), F.lit(0))
    columns: dict[str, Column] = {
        "ftype": headers.classify_frame(first(m.imagetyp), first(m.exptime)), "exptime": num(m.exptime, 0.0), "filt": text(m.filt, "NONE"), "obj": text(m.obj, ""), "dateobs": text(m.dateobs, ""),
        "ra": sky.parse_coordinate(first(m.ra), True), "dec": sky.parse_coordinate(first(m.dec)), "gain": num(m.gain, inst.gain), "read_noise": num(m.rdnoise, inst.read_noise), "airmass": num(m.airmass, None),
        "naxis1": size("NAXIS1"), "naxis2": size("NAXIS2"),
    }
    return frames.where("error is null").withColumns(columns)
