"""Replies of the services that know objects: asked from tasks, read by column expressions.

``ask`` calls a given ``fetch(service, ra, dec, epoch)`` for each object and service from tasks; a call that
fails or takes too long gives an error and ends nothing. ``read_replies`` tells each reply's state:

* ``match``: a known object lies within the radius of the position;
* ``no_match``: the service answered, and none does;
* ``unavailable``: no answer, one that can't be read, or no position in it that could be compared.

Two of the services look for small bodies at an epoch (a table with bars between its columns, and JSON with
named fields), one lists near-earth passages of a date, which is context and no identification, one knows
stars and galaxies (JSON with named columns).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.sky import separation_arcsec, sexagesimal_to_degrees
from ..operators.motion import neo_counts

#: Radii of a match in arcseconds, and the text of an answer without objects.
MOVER_ARCSEC, FIELD_ARCMIN = 30.0, 10
NOTHING_FOUND = "No solar system object was found"
MOVERS, OTHERS = ("skybot", "jpl_sbident", "neows"), ("simbad",)
REPLY = "obj_id long, service string, body string, error string"


def ask(objects: DataFrame, fetch: Callable[[str, float, float, str | None], str], timeout: float = 20.0, at_once: int = 4) -> DataFrame:
    """obj_id, service, body, error for each object (obj_id, kind, ra, dec, epoch) and service of its kind.

    Objects are dealt to tasks; in each, a few calls run at a time, and one that has not answered after
    ``timeout`` seconds is given up. Without an epoch the services that need one aren't called.
    """
    service = F.explode(F.when(F.col("kind") == "mover", F.array(*map(F.lit, MOVERS))).otherwise(F.array(*map(F.lit, OTHERS))))
    calls = objects.select(F.col("obj_id").cast("long"), service.alias("service"), "ra", "dec", "epoch").repartition("obj_id")

    def one(name: str, ra: float, dec: float, epoch: str | None) -> tuple[str | None, str | None]:
        if name in MOVERS and not epoch:
            return None, "no observation time"
        return fetch(name, ra, dec, epoch), None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pool = ThreadPoolExecutor(at_once)
        try:
            for batch in batches:
                rows = batch.to_pylist()
                waiting = [pool.submit(one, r["service"], r["ra"], r["dec"], r["epoch"]) for r in rows]
                found = []
                for w in waiting:
                    try:
                        found.append(w.result(timeout))
                    except Exception as e:  # noqa: BLE001  a service that fails is unavailable
                        w.cancel()
                        found.append((None, f"{type(e).__name__}: {e}"))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([b for b, _ in found], pa.string()), pa.array([e for _, e in found], pa.string())], ["obj_id", "service", "body", "error"])
        finally:
            pool.shutdown(wait=False, cancel_futures=True)

    return calls.mapInArrow(run, REPLY)


def _nearest(found: Column, ra: Column, dec: Column) -> Column:
    """(sep, name) of the nearest of an array of (name, ra, dec) that has a position; null without one."""
    placed = F.filter(found, lambda o: o["ra"].isNotNull() & o["dec"].isNotNull())
    return F.array_min(F.transform(placed, lambda o: F.struct(separation_arcsec(ra, dec, o["ra"], o["dec"]).alias("sep"), o["name"].alias("name"))))


def _readable(text: Column, hours: bool) -> Column:
    """Degrees of a sexagesimal text or a plain number, null if it is neither."""
    cleaned = F.trim(F.regexp_replace(text, "['\"hms\u00b0d]", " "))
    return F.when(cleaned.rlike(r"^[+-]?\d+(\.\d*)?([: ]+\d+(\.\d*)?){0,2}$"), sexagesimal_to_degrees(F.regexp_replace(cleaned, r"^\+", ""), hours))


def _mover_state(near: Column, none: Column, unread: Column) -> tuple[Column, Column]:
    status = F.when(none, "no_match").when(near.isNull(), "unavailable").when(near["sep"] <= MOVER_ARCSEC, "match").otherwise("no_match")
    away = F.format_string("nearest known object %s is %.0f arcsec away", near["name"], near["sep"])
    detail = F.when(none, F.lit(f"no known object within {FIELD_ARCMIN} arcmin")).when(near.isNull(), unread).when(near["sep"] <= MOVER_ARCSEC, F.format_string("known object %s at %.1f arcsec", near["name"], near["sep"])).otherwise(away)
    return status, detail


def read_skybot(body: Column, ra: Column, dec: Column) -> tuple[Column, Column]:
    """(status, detail) of lines "number | name | ra | dec | ..." with hours and degrees; comments and rules are passed over."""
    lines = F.filter(F.split(body, "\r?\n"), lambda x: x.contains("|") & ~x.rlike("^[#-]"))
    fields = F.filter(F.transform(lines, lambda x: F.transform(F.split(x, r"\|"), lambda p: F.trim(p))), lambda p: F.size(p) >= 4)
    found = F.transform(fields, lambda p: F.struct(F.trim(F.concat_ws(" ", p[0], p[1])).alias("name"), _readable(p[2], True).alias("ra"), _readable(p[3], False).alias("dec")))
    near = _nearest(found, ra, dec)
    none = (F.trim(body) == "") | body.contains(NOTHING_FOUND) | near.isNull()  # a table without one readable line names no object
    return _mover_state(near, none, F.lit(""))


def read_jpl(body: Column, ra: Column, dec: Column) -> tuple[Column, Column]:
    """(status, detail) of JSON with named fields and rows, of the second pass if there is one."""
    parsed = F.from_json(body, "fields_second array<string>, data_second_pass array<array<string>>, fields_first array<string>, data_first_pass array<array<string>>")
    rows = F.when(F.size(parsed["data_second_pass"]) > 0, parsed["data_second_pass"]).otherwise(parsed["data_first_pass"])
    fields = F.when(F.size(parsed["fields_second"]) > 0, parsed["fields_second"]).otherwise(parsed["fields_first"])

    def place(*names: str) -> Column:
        """The first field whose name holds one of these, in order of the names; 0 if none does."""

        def holds(name: str) -> Column:
            return F.coalesce(F.array_position(F.transform(fields, lambda f: F.lower(f).contains(name)), F.lit(True)), F.lit(0))

        tries = [holds(n) for n in names]
        return F.coalesce(*[F.when(t > 0, t) for t in tries], F.lit(0)).cast("int")

    i_ra, i_dec = place("astrometric ra", "ra"), place("astrometric dec", "dec")
    at = lambda r, i: F.when(i > 0, F.try_element_at(r, i))
    found = F.transform(rows, lambda r: F.struct(F.get(r, F.lit(0)).alias("name"), _readable(at(r, i_ra), True).alias("ra"), _readable(at(r, i_dec), False).alias("dec")))
    near = _nearest(found, ra, dec)
    answered = parsed["data_second_pass"].isNotNull() | parsed["data_first_pass"].isNotNull()
    status, detail = _mover_state(near, answered & (F.coalesce(F.size(rows), F.lit(0)) <= 0), F.lit("known bodies in the field, but no position that could be compared"))
    return F.when(answered, status).otherwise("unavailable"), F.when(answered, detail).otherwise("the answer has no fields that are known")


def read_neows(body: Column) -> tuple[Column, Column]:
    """(status, detail): passages of the date, which never identify anything."""
    every, hazardous = neo_counts(body)
    said = F.format_string("%d near-earth passages on the date (%d potentially hazardous), context only", every, hazardous)
    return F.when(every.isNotNull(), "no_match").otherwise("unavailable"), F.coalesce(said, F.lit("the answer has no fields that are known"))


def read_simbad(body: Column) -> tuple[Column, Column]:
    """(status, detail) of JSON with columns (metadata) and rows (data); any row lies in the radius asked for."""
    parsed = F.from_json(body, "metadata array<struct<name: string>>, data array<array<string>>")
    at = F.array_position(F.transform(parsed["metadata"], lambda m: F.lower(m["name"])), F.lit("main_id"))
    name = F.try_element_at(F.get(parsed["data"], F.lit(0)), F.when(at > 0, at).otherwise(1).cast("int"))
    rows = F.size(parsed["data"])
    return F.when(rows > 0, "match").when(rows == 0, "no_match").otherwise("unavailable"), F.when(rows > 0, F.concat(F.lit("known object "), F.coalesce(name, F.lit("without a name")))).when(rows == 0, "no catalogued object at the position").otherwise("the answer has no fields that are known")


def read_replies(replies: DataFrame, objects: DataFrame) -> DataFrame:
    """obj_id and services, the array of (service, status, detail) in the order in which they were asked.

    The second small-body service stands in only where the first is unavailable.
    """
    r = replies.join(objects.select("obj_id", "ra", "dec"), "obj_id")
    read = {"skybot": read_skybot(F.col("body"), F.col("ra"), F.col("dec")), "jpl_sbident": read_jpl(F.col("body"), F.col("ra"), F.col("dec")), "neows": read_neows(F.col("body")), "simbad": read_simbad(F.col("body"))}
    pick = lambda i: F.coalesce(*[F.when(F.col("service") == s, both[i]) for s, both in read.items()])
    gone = F.col("body").isNull()
    told = r.withColumns({"status": F.when(gone, "unavailable").otherwise(pick(0)), "detail": F.when(gone, F.coalesce("error", F.lit("no answer"))).otherwise(pick(1))})
    order = F.array_position(F.array(*map(F.lit, MOVERS + OTHERS)), F.col("service"))
    grouped = told.groupBy("obj_id").agg(F.array_sort(F.collect_list(F.struct(order.alias("i"), "service", "status", "detail"))).alias("c"))
    first = F.exists("c", lambda x: (x["service"] == "skybot") & (x["status"] != "unavailable"))
    kept = F.filter("c", lambda x: ~first | (x["service"] != "jpl_sbident"))
    return grouped.select("obj_id", F.transform(kept, lambda x: F.struct(x["service"].alias("service"), x["status"].alias("status"), x["detail"].alias("detail"))).alias("services"))
