"""Reference catalogues: local CSV, tables of a survey, and the order in which they are tried."""

from __future__ import annotations

import logging
from collections.abc import Callable
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.crossmatch import cone_search
from ..plans.config import Instrument, NightConfig

log = logging.getLogger("nocturne.reference")

#: Remote services by name: callables (spark, ra, dec, radius_deg) -> DataFrame(ra, dec, mag) or None.
SERVICES: dict[str, Callable] = {}
ORDER = {"gaia": ("gaia",), "panstarrs": ("panstarrs",), "ps1": ("panstarrs",), "auto": ("gaia", "panstarrs")}


def _numbered(df: DataFrame) -> DataFrame:
    """ra, dec, mag with a ref_id that follows position; NaN becomes null and rows without position go."""
    clean = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(c) for c in ("ra", "dec", "mag")]).where("ra is not null and dec is not null")
    return clean.withColumn("ref_id", F.xxhash64("ra", "dec", "mag"))


def load_local_reference(spark: SparkSession, path: str) -> DataFrame | None:
    """A CSV with ra and dec columns, any case, and perhaps mag; None if there is no such file."""
    if not Path(path).exists():
        return None
    raw = spark.read.csv(path, header=True)
    names = {c.lower(): c for c in raw.columns}
    if not {"ra", "dec"} <= names.keys():
        raise ValueError(f"{path} has no ra and dec columns")
    mag = F.col(names["mag"]) if "mag" in names else F.lit(None)
    return _numbered(raw.select(*[F.col(names[c]).try_cast("double").alias(c) for c in ("ra", "dec")], mag.try_cast("double").alias("mag")))


def from_table(table: DataFrame, ra: float, dec: float, radius_deg: float, max_mag: float = 21.0) -> DataFrame:
    """A cone of a survey table, brighter than ``max_mag`` (null magnitudes go)."""
    return _numbered(cone_search(table, ra, dec, radius_deg).where(F.col("mag") < max_mag))


def reference_catalog(spark: SparkSession, source: str, ra: float, dec: float, radius_deg: float, local_path: str | None = None) -> DataFrame | None:
    """The first of: the local file, the named services that answer; else None."""
    if local_path and (local := load_local_reference(spark, local_path)) is not None:
        return local
    for name in ORDER.get(source, ()):
        try:
            found = SERVICES[name](spark, ra, dec, radius_deg) if name in SERVICES else None
        except Exception:  # noqa: BLE001  a service may be away
            log.warning("reference service %s failed", name, exc_info=True)
            found = None
        if found is not None and not found.isEmpty():
            return _numbered(found)
    return None


def acquire_reference(spark: SparkSession, config: NightConfig, anchors: DataFrame, inst: Instrument) -> DataFrame | None:
    """The raw folder's reference_catalog.csv, else a cone about each field's anchor (field_id, ra, dec), in one table."""
    local = load_local_reference(spark, str(Path(config.paths.raw) / "reference_catalog.csv"))
    if local is not None:
        return local
    cones = [reference_catalog(spark, config.photometry.ref_catalog, r["ra"], r["dec"], 0.9 * (inst.fov_arcmin or 15.0) / 60.0) for r in anchors.orderBy("field_id").collect()]  # a row a field
    found = [c for c in cones if c is not None]
    if not found:
        return None
    return reduce(DataFrame.unionByName, found).dropDuplicates(["ref_id"])
