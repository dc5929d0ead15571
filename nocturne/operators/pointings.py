"""Pointing clusters: frames grouped greedily around anchor pointings in time order."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def pointing_clusters(frames: DataFrame, fov_arcmin: float | None) -> DataFrame:
    """frame_index, field_id: the first anchor within half the field of view; frames without a pointing join field 0.

    Greedy first fit is sequential; it runs per night (column ``night`` if there is one) over one row
    a frame.
    """
    link = max((fov_arcmin or 15.0) / 60.0 * 0.5, 1e-3)
    night = F.col("night") if "night" in frames.columns else F.lit("all")

    def group(pdf: pd.DataFrame) -> pd.DataFrame:
        import math

        anchors: list[tuple[float, float]] = []
        fields = []
        for r in pdf.sort_values("frame_index").itertuples():
            if r.ra is None or r.dec is None or math.isnan(r.ra) or math.isnan(r.dec):
                fields.append((r.frame_index, 0))
                continue
            for i, (ra, dec) in enumerate(anchors):
                d = (r.ra - ra + 180.0) % 360.0 - 180.0
                if math.hypot(d * math.cos(math.radians(dec)), r.dec - dec) <= link:
                    fields.append((r.frame_index, i))
                    break
            else:
                anchors.append((r.ra, r.dec))
                fields.append((r.frame_index, len(anchors) - 1))
        return pd.DataFrame(fields, columns=["frame_index", "field_id"])

    return frames.withColumn("night_", night).groupBy("night_").applyInPandas(lambda pdf: group(pdf), "frame_index long, field_id long")


def merge_fields(parts: dict[int, DataFrame]) -> DataFrame:
    """One ranked table of several fields' objects: obj_id is offset by the objects of the fields before."""
    out = None
    for field, part in parts.items():
        tagged = part.withColumn("field_id", F.lit(field))
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    sizes = out.groupBy("field_id").agg(F.count("*").alias("n"))
    before = sizes.select("field_id", (F.sum("n").over(Window.orderBy("field_id")) - F.col("n")).alias("offset"))  # a row a field
    return out.join(F.broadcast(before), "field_id").withColumn("obj_id", F.col("obj_id") + F.col("offset")).drop("offset")
