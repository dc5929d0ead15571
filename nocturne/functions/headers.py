"""Reading of dynamic frame headers: keyword fallbacks, frame classes, numbers and times."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Substrings of an image-type tag that mark each frame class, tried in this order.
FRAME_CLASSES = (("bias", ("bias", "zero")), ("dark", ("dark",)), ("flat", ("flat", "dome flat", "sky flat", "twilight")), ("light", ("light", "object", "science", "target", "sci")))
MJD_EPOCH = 40587.0  # of 1970-01-01
MINUTES = 1440.0


def first_present(header: Column, keywords: Sequence[str]) -> Column:
    """Value of the first keyword that is there and not empty."""
    return F.coalesce(*[F.nullif(F.try_element_at(header, F.lit(k)), F.lit("")) for k in keywords])


def classify_frame(tag: Column, exptime: Column) -> Column:
    """bias, dark, flat or light by substrings of the tag in this order; else bias for a zero exposure; else unknown."""
    low = F.lower(F.trim(F.coalesce(tag, F.lit(""))))
    out = None
    for kind, words in FRAME_CLASSES:
        hit = F.lit(False)
        for w in words:
            hit = hit | low.contains(w)
        out = F.when(hit, kind) if out is None else out.when(hit, kind)
    return out.when(exptime.try_cast("double") == 0.0, "bias").otherwise("unknown")


def as_float(value: Column, default: Column | float | None) -> Column:
    fallback = default if isinstance(default, Column) else F.lit(default).cast("double")
    return F.coalesce(value.try_cast("double"), fallback)


def truthy_or(value: Column, default: Column | float) -> Column:
    """The value unless it is null or zero."""
    return F.coalesce(F.nullif(value, F.lit(0.0)), default if isinstance(default, Column) else F.lit(float(default)))


def time_minutes(dateobs: Column) -> Column:
    """Minutes (MJD x 1440) of an ISO date, an MJD or a JD; null where it is neither.

    ISO text with a T is UTC. Numbers from 20000 to 80000 are MJD, above two million JD.
    """
    s = F.trim(dateobs)
    number = s.try_cast("double")
    iso = F.try_to_timestamp(F.regexp_replace(s, "Z$", ""))
    minutes = F.unix_micros(iso) / F.lit(6e7) + MJD_EPOCH * MINUTES
    return F.when((number > 20000.0) & (number < 80000.0), number * MINUTES).when(number > 2000000.0, (number - 2400000.5) * MINUTES).when(number.isNull() & s.rlike("^[0-9]{4}-"), minutes)
