"""A survey catalogue as a table partitioned by cells of the sky, and cones that open only the cells they touch.

Cells are bands of declination, each cut in right ascension into steps of about the same width. A cone
knows the cells that it can reach from its centre and radius, so the partitions are pruned before any file is
opened; what is left is filtered by the exact separation.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.crossmatch import cone_search
from .reference import from_table

WIDTH = 5.0  # degrees of a cell
STRIDE = 100_000  # cells of a band are numbered from its number times this


def _steps(band: int, width: float) -> int:
    """Steps in right ascension of a band, by its circle nearest to the equator."""
    lo, hi = band * width - 90.0, min((band + 1) * width - 90.0, 90.0)
    nearest = 0.0 if lo <= 0.0 <= hi else min(abs(lo), abs(hi))
    return max(1, math.floor(360.0 * math.cos(math.radians(nearest)) / width))


def _bands(width: float) -> int:
    return math.ceil(180.0 / width)


def cell_of(ra: Column, dec: Column, width: float = WIDTH) -> Column:
    """The number of the cell of a position in degrees; null without one."""
    band = F.least(F.floor((dec + 90.0) / width), F.lit(_bands(width) - 1)).cast("int")
    steps = F.element_at(F.array(*[F.lit(_steps(b, width)) for b in range(_bands(width))]), band + 1)
    turn = F.pmod(ra, F.lit(360.0)) / 360.0
    return F.when(ra.isNotNull() & dec.isNotNull(), band * STRIDE + F.least(F.floor(turn * steps), steps - 1).cast("int"))


def cells_of_cone(ra: float, dec: float, radius_deg: float, width: float = WIDTH) -> list[int]:
    """The cells that a cone may reach."""
    radius, out = radius_deg + 1e-9, []
    first, last = (min(_bands(width) - 1, max(0, math.floor((d + 90.0) / width))) for d in (dec - radius, dec + radius))
    over_pole = abs(dec) + radius >= 90.0
    half = 180.0 if over_pole else math.degrees(math.asin(min(1.0, math.sin(math.radians(radius)) / math.cos(math.radians(dec))))) + 1e-9
    for band in range(first, last + 1):
        steps = _steps(band, width)
        if half >= 180.0:
            out += [band * STRIDE + s for s in range(steps)]
        else:
            lo, hi = math.floor((ra - half) / 360.0 * steps), math.floor((ra + half) / 360.0 * steps)
            out += sorted({band * STRIDE + s % steps for s in range(lo, min(hi, lo + steps - 1) + 1)})
    return out


def store(rows: DataFrame, path: str, width: float = WIDTH, files_a_cell: int = 4) -> None:
    """Writes a catalogue (ra, dec, others) by cell; rows without a position go. A crowded cell has several files."""
    placed = rows.withColumn("sky_cell", cell_of(F.col("ra"), F.col("dec"), width)).where("sky_cell is not null")
    spread = F.pmod(F.xxhash64("ra", "dec"), F.lit(files_a_cell))
    placed.repartition("sky_cell", spread).sortWithinPartitions("sky_cell", "dec").write.mode("overwrite").partitionBy("sky_cell").parquet(path)


def cone(spark: SparkSession, path: str, ra: float, dec: float, radius_deg: float, width: float = WIDTH, schema: T.StructType | None = None) -> DataFrame:
    """Rows of a stored catalogue within a cone, with sep_arcsec."""
    reader = spark.read.schema(T.StructType([*schema.fields, T.StructField("sky_cell", T.IntegerType())])) if schema else spark.read
    table = reader.parquet(path).where(F.col("sky_cell").isin(cells_of_cone(ra, dec, radius_deg, width)))
    return cone_search(table, ra, dec, radius_deg).drop("sky_cell")


def service(path: str, max_mag: float = 21.0, width: float = WIDTH) -> Callable[[SparkSession, float, float, float], DataFrame]:
    """A reference service, for ``reference.SERVICES``, over a stored catalogue with mag."""
    return lambda spark, ra, dec, radius: from_table(cone(spark, path, ra, dec, radius, width).drop("sep_arcsec"), ra, dec, radius, max_mag)
