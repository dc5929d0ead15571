"""The jobs as queries: each runs twice over whole tables into a new folder, and gives what then stands there."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nocturne.operators.components import shared_folder
from nocturne.plans.text_queries import COUNTS_SQL
from nocturne.plans.views import LIGHTCURVES_SQL

from . import light_curves, note_index


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def job1_note_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, documents = _folder(spark, "note-index"), f"{sf_dir}/documents.parquet"
    for _ in range(2):
        note_index.run(spark, documents, f"{folder}/index", f"{folder}/checkpoint")
    return note_index.output(spark, f"{folder}/index", spark.read.parquet(documents).schema["doc_id"].dataType.simpleString())


def job2_light_curves(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _folder(spark, "light-curves")
    for _ in range(2):
        light_curves.run(spark, f"{sf_dir}/events.parquet", folder)
    rounded = {c: F.round(c, n) for c, n in (("mean_mag", 6), ("mag_rms", 6), ("amplitude", 6), ("var_chi2", 3), ("sys_floor", 6), ("red_chi2", 3), ("significance", 4))}
    return spark.read.parquet(folder).withColumns(rounded)


NOTE_INDEX_SQL = f"""WITH RECURSIVE {COUNTS_SQL}, fr AS (SELECT term, count(*) AS df FROM ct GROUP BY 1)
SELECT key, pos, source, term, c::BIGINT AS c, df FROM ct JOIN ch USING (key, pos) JOIN fr USING (term)"""

LIGHT_CURVES_SQL = f"""WITH lc AS (SELECT l.*, DATE '2000-01-01' + CAST(floor(date_diff('day', DATE '2000-01-01', CAST(e.ts AS DATE)) / 10) * 10 AS INTEGER) AS run FROM ({LIGHTCURVES_SQL}) l JOIN events e ON e.event_id = l.det_idx),
 w AS (SELECT run, obj, sum(mag / (err * err)) / sum(1 / (err * err)) AS wmean, median(mag) AS med FROM lc GROUP BY 1, 2),
 st AS (SELECT run, obj, count(*) AS n, sum(pow((mag - wmean) / err, 2)) / (count(*) - 1) AS chi2, max(mag) - min(mag) AS amp, avg(mag) AS mean_mag, CASE WHEN count(*) > 1 THEN stddev_samp(mag) END AS rms FROM lc JOIN w USING (run, obj) GROUP BY 1, 2),
 fl AS (SELECT run, least(greatest(median(rms), 0.005::DOUBLE), 0.03::DOUBLE) AS sys_floor FROM st WHERE n >= 3 GROUP BY 1),
 dv AS (SELECT run, obj, sys_floor, sum(CASE WHEN abs(mag - med) / sqrt(err * err + sys_floor * sys_floor) > 4 THEN 1 ELSE 0 END)::BIGINT AS n_sig, avg(pow(abs(mag - med) / sqrt(err * err + sys_floor * sys_floor), 2)) AS red_chi2 FROM lc JOIN w USING (run, obj) JOIN fl USING (run) GROUP BY 1, 2, 3),
 al AS (SELECT run, obj, n, chi2, amp, mean_mag, rms, CASE WHEN n >= 3 THEN sys_floor END AS sys_floor, CASE WHEN n >= 3 THEN n_sig END AS n_sig, CASE WHEN n >= 3 THEN red_chi2 END AS red_chi2 FROM st LEFT JOIN dv USING (run, obj))
SELECT obj AS object, n, CASE WHEN n >= 3 THEN 'calibrated' ELSE 'instrumental' END AS system, round(CASE WHEN n >= 3 THEN mean_mag END, 6) AS mean_mag, round(CASE WHEN n >= 3 THEN rms END, 6) AS mag_rms, round(CASE WHEN n >= 3 THEN amp END, 6) AS amplitude, round(CASE WHEN n >= 3 THEN chi2 END, 3) AS var_chi2,
 round(sys_floor, 6) AS sys_floor, n_sig, round(red_chi2, 3) AS red_chi2, round(sqrt(greatest(red_chi2, 0)), 4) AS significance, n_sig >= greatest(2, n // 2) AND red_chi2 > 10 AND amp > 0.1 AND rms > 2.5 * sys_floor AS is_variable, run FROM al"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (job1_note_index, job2_light_curves)}
ORACLE_SQL = {"job1_note_index": NOTE_INDEX_SQL, "job2_light_curves": LIGHT_CURVES_SQL}
