"""Files that users hand in: safe names, bounded archives and plain images as frames."""

from __future__ import annotations

import re
import shutil
import zipfile
from collections.abc import Iterator
from pathlib import Path, PurePosixPath

import numpy as np
import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .fits import SUFFIXES, write_fits

IMAGES = (".png", ".jpg", ".jpeg", ".bmp", ".gif")
MEMBER_BYTES, ARCHIVE_BYTES = 2 << 30, 8 << 30
LUMINANCE = (0.299, 0.587, 0.114)


class TooLarge(ValueError):
    """An archive that unpacks beyond its budget."""


def clean_name(name: str, fallback: str = "upload") -> str:
    """The last path part with letters, digits, dot, underscore and dash, not hidden."""
    return re.sub(r"[^A-Za-z0-9._-]+", "_", re.split(r"[\\/]", str(name))[-1]).lstrip(".") or fallback


def member_name(member: str) -> str:
    """An archive path flattened into one name, so that equal names of two folders stay apart."""
    parts = [p for p in PurePosixPath(member.replace("\\", "/")).parts if p not in ("/", ".", "..")]
    return clean_name("__".join(parts))


def free_path(folder: Path, name: str) -> Path:
    """``folder/name``, numbered if it is taken."""
    path, n = folder / name, 0
    while path.exists():
        n += 1
        path = folder / f"{Path(name).stem}_{n}{Path(name).suffix}"
    return path


def unpack(archive: Path, folder: Path, member_bytes: int = MEMBER_BYTES, archive_bytes: int = ARCHIVE_BYTES) -> list[Path]:
    """Frames of a ZIP file; sizes are checked before and while they unpack."""
    out, total = [], 0
    with zipfile.ZipFile(archive) as z:
        for info in z.infolist():
            if info.is_dir() or not info.filename.lower().endswith(SUFFIXES):
                continue
            total += info.file_size
            if info.file_size > member_bytes or total > archive_bytes:
                raise TooLarge(f"{info.filename} unpacks beyond the limits")
            target = free_path(folder, member_name(info.filename))
            with z.open(info) as src, target.open("wb") as dst:
                shutil.copyfileobj(src, dst, 1 << 20)
            out.append(target)
    return out


def images_to_frames(spark: SparkSession, folder: str, target: str) -> int:
    """Writes each plain image of a folder as a light frame: luminance, bottom row first. Returns their number."""
    rows = spark.read.format("image").option("dropInvalid", "true").load(folder).select("image.origin", "image.height", "image.width", "image.nChannels", "image.data")
    rows = rows.where(F.lower("origin").rlike("(" + "|".join(s.replace(".", r"\.") for s in IMAGES) + ")$"))

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                a = np.frombuffer(r.data, np.uint8).reshape(r.height, r.width, r.nChannels).astype(np.float32)
                grey = a[..., 2::-1] @ np.array(LUMINANCE, np.float32) if r.nChannels >= 3 else a[..., 0]
                name = Path(r.origin).stem
                cards = {"IMAGETYP": "light", "EXPTIME": 1.0, "FILTER": "NONE", "OBJECT": name, "COMMENT": "made from a plain image"}
                write_fits(free_path(Path(target), f"{clean_name(name)}.fits"), np.flipud(grey) / 255.0 * 60000.0, cards)
            yield pd.DataFrame({"n": [len(pdf)]})

    return sum(r["n"] for r in rows.mapInPandas(write, "n long").collect())  # a row a batch
