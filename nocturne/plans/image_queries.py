"""Queries over 8 x 8 images made from embeddings: stacks, flats, masks, apertures and detection."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..images import kernels
from ..operators import calibration
from . import views
from .registry import query
from .sky_queries import clip_sql
from .views import PIXELS_SQL, load

_MAD, _KEPT = clip_sql("px", "label, y, x", spread="mad")
STACK_SQL = f"px AS ({PIXELS_SQL}), {_MAD}, sk AS (SELECT label, y, x, avg(v) AS combined, count(*) AS n_kept FROM {_KEPT} GROUP BY ALL)"


@query(f"WITH {STACK_SQL} SELECT label, y, x, round(combined, 6) AS combined, n_kept FROM sk")
def stack_combine_mad(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = calibration.combine_stack(views.pixels(spark, sf_dir), ["label", "y", "x"])
    return s.select("label", "y", "x", F.round("combined", 6).alias("combined"), "n_kept")


_FLAT, _FKEPT = clip_sql("lv", "label, y, x", spread="mad")


@query(
    f"""WITH px AS ({PIXELS_SQL}), md AS (SELECT label, vec_id, median(v) AS m FROM px GROUP BY 1, 2), lv AS (SELECT label, y, x, CASE WHEN m > 0 THEN v / m ELSE v END AS v FROM px JOIN md USING (label, vec_id)),
 {_FLAT}, ms AS (SELECT label, y, x, avg(v) AS c FROM {_FKEPT} GROUP BY ALL), nm AS (SELECT label, median(c) AS n FROM ms GROUP BY 1)
 SELECT label, y, x, round(CASE WHEN c / n < 0.05 THEN 1 ELSE c / n END, 6) AS flat, c / n < 0.05 AS bad FROM ms JOIN nm USING (label) WHERE n > 0"""
)
def flat_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = calibration.normalise_flats(views.pixels(spark, sf_dir), "label", "vec_id", ["y", "x"])
    return f.select("label", "y", "x", F.round("flat", 6).alias("flat"), "bad")


@query(f"SELECT vec_id, y, x, v > (SELECT median(v) + 3 * stddev_pop(v) FROM ({PIXELS_SQL})) AS hot FROM ({PIXELS_SQL})")
def hot_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calibration.hot_pixels(views.pixels(spark, sf_dir).withColumnRenamed("v", "rate"), sigma=3.0).select("vec_id", "y", "x", "hot")


@query(f"SELECT vec_id, y, x, round((v - 90 - 0.05::DOUBLE * 60) / 0.7::DOUBLE, 6) AS data, round((16 + greatest(v - 90 - 0.05::DOUBLE * 60, 0) / 2 + 0.05::DOUBLE * 60 / 2) / (0.7::DOUBLE * 0.7::DOUBLE), 6) AS variance FROM ({PIXELS_SQL})")
def reduce_variance(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, v = calibration.reduce_pixels(F.col("v"), F.lit(90.0), F.lit(0.05), F.lit(0.7), F.lit(60.0), F.lit(2.0), F.lit(8.0))
    return views.pixels(spark, sf_dir).select("vec_id", "y", "x", F.round(d, 6).alias("data"), F.round(v, 6).alias("variance"))


@query(f"SELECT vec_id, CAST(bit_or((CASE WHEN v > 115 THEN 1 ELSE 0 END) | (CASE WHEN v < 85 THEN 2 ELSE 0 END)) AS INTEGER) AS dq, count(*) FILTER (WHERE v > 115) AS n_cr FROM ({PIXELS_SQL}) GROUP BY 1")
def dq_bits(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = F.when(F.col("v") > 115, 1).otherwise(0).bitwiseOR(F.when(F.col("v") < 85, 2).otherwise(0))
    return views.pixels(spark, sf_dir).groupBy("vec_id").agg(F.bit_or(flag).alias("dq"), F.count_if(F.col("v") > 115).alias("n_cr"))


_BCLIP, _BKEPT = clip_sql("bx", "vec_id, gy, gx")


@query(f"WITH px AS ({PIXELS_SQL}), bx AS (SELECT vec_id, y // 4 AS gy, x // 4 AS gx, v FROM px), {_BCLIP}, b AS (SELECT vec_id, gy, gx, median(v) AS med, avg(v) AS mean, stddev_pop(v) AS std FROM {_BKEPT} GROUP BY ALL) SELECT vec_id, gy, gx, round(CASE WHEN std > 0 AND abs(mean - med) / std < 0.3 THEN 2.5 * med - 1.5 * mean ELSE med END, 5) AS sky, round(std, 5) AS rms FROM b")
def image_background(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = views.pixels(spark, sf_dir).withColumns({"gy": F.expr("y div 4").cast("int"), "gx": F.expr("x div 4").cast("int")})
    s = calibration.clipped_stats(p, ["vec_id", "gy", "gx"], "v")
    near = F.when(F.col("std") > 0, F.abs(F.col("mean") - F.col("median")) / F.col("std")) < 0.3
    return s.select("vec_id", "gy", "gx", F.round(F.when(near, F.lit(2.5) * F.col("median") - F.lit(1.5) * F.col("mean")).otherwise(F.col("median")), 5).alias("sky"), F.round("std", 5).alias("rms"))


@query(f"SELECT vec_id, round(sum(v) FILTER (WHERE pow(y - 3.5, 2) + pow(x - 3.5, 2) < 6.25) - count(*) FILTER (WHERE pow(y - 3.5, 2) + pow(x - 3.5, 2) < 6.25) * median(v) FILTER (WHERE pow(y - 3.5, 2) + pow(x - 3.5, 2) >= 9), 5) AS flux FROM ({PIXELS_SQL}) GROUP BY 1")
def aperture_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    r2 = F.pow(F.col("y") - 3.5, F.lit(2.0)) + F.pow(F.col("x") - 3.5, F.lit(2.0))
    p = views.pixels(spark, sf_dir).groupBy("vec_id")
    return p.agg(F.round(F.sum(F.when(r2 < 6.25, F.col("v"))) - F.count_if(r2 < 6.25) * F.median(F.when(r2 >= 9, F.col("v"))), 5).alias("flux"))


def _images(spark: SparkSession, sf_dir: str, run, schema: str) -> DataFrame:
    rows = load(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("px"))

    def every(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            parts = [run(i, np.asarray(p, np.float64).reshape(8, 8) * 50 + 100) for i, p in zip(pdf["vec_id"], pdf["px"], strict=True)]
            yield pd.concat(parts) if parts else pd.DataFrame()

    return rows.mapInPandas(every, schema)


@query()
def detect_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    def run(i: int, image: np.ndarray) -> pd.DataFrame:
        seg = kernels.detect(image, np.full(image.shape, 105.0), 3)
        return pd.DataFrame({"vec_id": [i], "n_sources": [int(seg.max())], "n_pixels": [int((seg > 0).sum())]})

    return _images(spark, sf_dir, run, "vec_id long, n_sources long, n_pixels long")


@query()
def measure_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    def run(i: int, image: np.ndarray) -> pd.DataFrame:
        seg = kernels.detect(image, np.full(image.shape, 105.0), 3)
        m = kernels.measure(image - 100, image - 100, np.ones_like(image), seg)
        return pd.DataFrame({"vec_id": np.full(len(m["id"]), i), **{c: m[c] for c in ("id", "x", "y", "flux", "snr", "fwhm", "ellipticity", "peak", "area")}})

    return _images(spark, sf_dir, run, "vec_id long, id long, x double, y double, flux double, snr double, fwhm double, ellipticity double, peak double, area double")
