"""Tile-compressed images: a binary table whose rows are compressed tiles of the image.

Tiles by RICE_1, GZIP_1, GZIP_2 and NOCOMPRESS; whole numbers, floats quantised with or without
subtractive dither, and floats that are stored as they are. Blank pixels come out as NaN.
"""

from __future__ import annotations

import re
import zlib

import numpy as np

WIDTH = {"L": 1, "X": 1, "B": 1, "I": 2, "J": 4, "K": 8, "A": 1, "E": 4, "D": 8, "C": 8, "M": 16, "P": 8, "Q": 16}
NUMBER = {"B": ">u1", "I": ">i2", "J": ">i4", "K": ">i8", "E": ">f4", "D": ">f8"}
PIXEL = {8: ">u1", 16: ">i2", 32: ">i4", 64: ">i8", -32: ">f4", -64: ">f8"}
#: Fixed values of the format: bits that hold a block's split, and the split that stands for plain values, by bytes a pixel.
RICE = {1: (3, 6), 2: (4, 14), 4: (5, 25)}
DITHERS, ZERO_MARK = 10_000, -2147483646


def columns(header: dict[str, str]) -> dict[str, tuple[str, int]]:
    """name: (type letter, or element type of a variable-length column behind a P or Q; byte offset in the row)."""
    out, at = {}, 0
    for i in range(1, int(header["TFIELDS"]) + 1):
        repeat, kind, of = re.match(r"\s*(\d*)([A-Z])([A-Z]?)", header[f"TFORM{i}"]).groups()
        n = int(repeat or 1)
        out[header.get(f"TTYPE{i}", f"COL{i}").strip()] = (kind + of if kind in "PQ" else kind, at)
        at += -(-n // 8) if kind == "X" else n * WIDTH[kind]
    return out


def rice(raw: bytes, n: int, block: int, width: int) -> np.ndarray:
    """n whole numbers of ``width`` bytes, coded as differences in blocks of ``block``.

    The unary heads are walked pixel by pixel along a table of the next set bit; the low bits of
    all pixels are then read at once.
    """
    first = int.from_bytes(raw[:width], "big", signed=width > 1)
    bits = np.unpackbits(np.frombuffer(raw[width:], np.uint8))
    total = len(bits)
    ones = np.flatnonzero(bits)
    following = np.full(total + 1, total, np.int64)
    following[ones] = ones
    following = np.minimum.accumulate(following[::-1])[::-1].tolist()
    padded = np.concatenate([bits, np.zeros(64, np.uint8)]).astype(np.int64)
    take = lambda at, k: int("".join(map(str, padded[at : at + k].tolist())) or "0", 2)
    head, plain = RICE[width]
    high, low_at, low_bits = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
    pos = 0
    for start in range(0, n, block):
        end = min(n, start + block)
        split = take(pos, head) - 1
        pos += head
        if split < 0:  # no differences
            continue
        if split == plain:
            low_at[start:end], low_bits[start:end] = pos + 8 * width * np.arange(end - start), 8 * width
            pos += 8 * width * (end - start)
            continue
        heads, lows = [], []
        for _ in range(end - start):
            one = following[pos]
            heads.append(one - pos)
            lows.append(one + 1)
            pos = one + 1 + split
        high[start:end], low_at[start:end], low_bits[start:end] = heads, lows, split
    if pos > total:
        raise ValueError("a compressed tile ends too early")
    coded = high
    for k in range(int(low_bits.max(initial=0))):
        inside = k < low_bits
        coded = np.where(inside, (coded << 1) | padded[np.where(inside, low_at + k, 0)], coded)
    steps = np.where(coded & 1, ~(coded >> 1), coded >> 1)
    found = first + np.cumsum(steps)
    span = 1 << (8 * width)
    return found % span if width == 1 else (found + span // 2) % span - span // 2


def _opened(raw: bytes, kind: str, n: int, pixel: str, header: dict[str, str]) -> np.ndarray:
    if kind in ("RICE_1", "RICE_ONE"):
        named = {header[k].strip(): int(header["ZVAL" + k[5:]]) for k in header if re.fullmatch(r"ZNAME\d+", k)}
        return rice(raw, n, named.get("BLOCKSIZE", 32), named.get("BYTEPIX", 4))
    if kind in ("GZIP_1", "GZIP_2"):
        raw = zlib.decompress(raw, 47)
        width = np.dtype(pixel).itemsize
        if len(raw) != n * width and len(raw) % n == 0:  # whole numbers may be kept wider or narrower than the image's own
            width = len(raw) // n
            pixel = {1: ">u1", 2: ">i2", 4: ">i4", 8: ">i8"}[width]
        if kind == "GZIP_2":  # the first bytes of all pixels, then the second ones
            raw = np.frombuffer(raw, np.uint8).reshape(width, n).T.tobytes()
        return np.frombuffer(raw, pixel, n)
    if kind == "NOCOMPRESS":
        return np.frombuffer(raw, pixel, n)
    raise ValueError(f"tiles compressed by {kind} are not read")


def dithers() -> np.ndarray:
    """The sequence that dithered images share: a multiplicative generator, scaled to below one."""
    out, seed = np.zeros(DITHERS), 1
    for i in range(DITHERS):
        seed = seed * 16807 % 2147483647
        out[i] = seed / 2147483647
    return out.astype(np.float32).astype(float)


def _dither(row: int, start: int, n: int, sequence: np.ndarray) -> np.ndarray:
    """The n values that belong to the tile of this row."""
    at = (row + start - 1) % DITHERS
    to = int(sequence[at] * 500)
    out = np.zeros(0)
    while len(out) < n:
        out = np.concatenate([out, sequence[to : to + n - len(out)]])
        at = (at + 1) % DITHERS
        to = int(sequence[at] * 500)
    return out


def image(header: dict[str, str], data: bytes) -> np.ndarray:
    """The image in a table's header and data, in its stored units, as float64."""
    axes = [int(header[f"ZNAXIS{i}"]) for i in range(1, int(header["ZNAXIS"]) + 1)]
    if len(axes) < 2:
        raise ValueError("a compressed image of fewer than two axes")
    nx, ny = axes[:2]
    tile_x, tile_y = int(header.get("ZTILE1", nx)), int(header.get("ZTILE2", 1))
    bitpix, kind = int(header["ZBITPIX"]), header["ZCMPTYPE"].strip()
    known, row_bytes = columns(header), int(header["NAXIS1"])
    heap = int(header.get("THEAP", row_bytes * int(header["NAXIS2"])))
    quantised = header.get("ZQUANTIZ", "NO_DITHER" if "ZSCALE" in known else "NONE").strip()
    sequence = dithers() if quantised.startswith("SUBTRACTIVE") else None
    stored = PIXEL[bitpix] if bitpix > 0 or "ZSCALE" not in known and "ZSCALE" not in header else ">i4"

    def number(name: str, row: int, default: float | None) -> float | None:
        if name in known:
            letter, at = known[name]
            return float(np.frombuffer(data, NUMBER[letter], 1, row * row_bytes + at)[0])
        return float(header[name]) if name in header else default

    def cell(name: str, row: int) -> bytes:
        if name not in known:
            return b""
        letter, at = known[name]
        count, offset = np.frombuffer(data, ">i8" if letter[0] == "Q" else ">i4", 2, row * row_bytes + at).tolist()
        return data[heap + offset : heap + offset + count * WIDTH[letter[1]]]

    out, across = np.zeros((ny, nx)), -(-nx // tile_x)
    for row in range(across * -(-ny // tile_y)):
        x, y = row % across * tile_x, row // across * tile_y
        shape = (min(tile_y, ny - y), min(tile_x, nx - x))
        n = shape[0] * shape[1]
        if raw := cell("COMPRESSED_DATA", row):
            values = _opened(raw, kind, n, stored, header).astype(float)
            if bitpix < 0 and stored == ">i4":
                blank, zero = number("ZBLANK", row, None), number("ZZERO", row, 0.0)
                scale = number("ZSCALE", row, 1.0)
                real = (values - _dither(row, int(header.get("ZDITHER0", 1)), n, sequence) + 0.5) * scale + zero if sequence is not None else values * scale + zero
                if quantised == "SUBTRACTIVE_DITHER_2":
                    real = np.where(values == ZERO_MARK, 0.0, real)
                values = np.where(values == blank, np.nan, real) if blank is not None else real
        elif raw := cell("GZIP_COMPRESSED_DATA", row):
            values = _opened(raw, "GZIP_1", n, PIXEL[bitpix], header).astype(float)
        else:
            values = np.frombuffer(cell("UNCOMPRESSED_DATA", row), PIXEL[bitpix], n).astype(float)
        out[y : y + shape[0], x : x + shape[1]] = values.reshape(shape)
    return out
