"""Replies of services: every state, odd bodies, and calls that fail or hang."""

import time

import pytest
from pyspark.sql import functions as F

from nocturne.operators import motion
from nocturne.sources import services


def read(spark, which, body, ra=10.0, dec=-5.0):
    f = {"skybot": services.read_skybot, "jpl": services.read_jpl}.get(which)
    df = spark.createDataFrame([(body, ra, dec)], "body string, ra double, dec double")
    pair = f(F.col("body"), F.col("ra"), F.col("dec")) if f else {"neows": services.read_neows, "simbad": services.read_simbad}[which](F.col("body"))
    return tuple(df.select(pair[0].alias("s"), pair[1].alias("d")).first())


SKYBOT = "# Num | Name | RA(h) | DE(deg) | Class\n 433 | Eros | 00 40 00.0 | -04 59 50.0 | Amor\n - | 2020 AB | 00 41 00.0 | -05 00 00.0 | MB\n"


def test_skybot(spark):
    assert read(spark, "skybot", SKYBOT) == ("match", "known object 433 Eros at 10.0 arcsec")
    status, detail = read(spark, "skybot", SKYBOT, dec=-6.0)
    assert status == "no_match" and detail.startswith("nearest known object 433 Eros is 3610 arcsec")
    for body in ("", "  ", "No solar system object was found in the requested FOV", "a | b | c | d", "# only | a | head | line"):
        assert read(spark, "skybot", body)[0] == "no_match", body


def test_jpl(spark):
    body = '{"fields_first": ["Object name", "Astrometric RA (hh:mm:ss)", "Astrometric Dec (dd mm\'ss\\")"], "data_first_pass": [["far", "00:44:00", "-05 00\'00\\""], ["433 Eros", "00:40:00.0", "-04 59\'50\\""]]}'
    assert read(spark, "jpl", body) == ("match", "known object 433 Eros at 10.0 arcsec")
    assert read(spark, "jpl", '{"data_second_pass": [], "data_first_pass": []}')[0] == "no_match"
    assert read(spark, "jpl", '{"count": 1}')[0] == "unavailable" and read(spark, "jpl", "<html>")[0] == "unavailable"
    assert read(spark, "jpl", '{"fields_first": ["name", "x"], "data_first_pass": [["a", "b"]]}')[0] == "unavailable"
    assert read(spark, "jpl", body.replace("433", "1"), dec=3.0)[0] == "no_match"


def test_context_and_objects(spark):
    assert read(spark, "neows", '{"near_earth_objects": {"d": [{"is_potentially_hazardous_asteroid": true}, {}]}}') == ("no_match", "2 near-earth passages on the date (1 potentially hazardous), context only")
    assert read(spark, "neows", "no")[0] == "unavailable"
    assert read(spark, "simbad", '{"metadata": [{"name": "MAIN_ID"}], "data": [["M 31"]]}') == ("match", "known object M 31")
    assert read(spark, "simbad", '{"metadata": [{"name": "main_id"}], "data": []}')[0] == "no_match"
    assert read(spark, "simbad", "oops")[0] == "unavailable"


def test_asking(spark):
    def fetch(service, ra, dec, epoch):
        if ra == 3.0:
            raise OSError("refused")
        if ra == 4.0:
            time.sleep(3)
        return {"skybot": "No solar system object was found", "jpl_sbident": "{}", "neows": "{}", "simbad": '{"metadata": [{"name": "main_id"}], "data": [["V X"]]}'}[service]

    rows = [(1, "mover", 1.0, 0.0, "2024-01-01T00:00:00"), (2, "transient", 2.0, 0.0, None), (3, "mover", 3.0, 0.0, "2024-01-01"), (4, "variable", 4.0, 0.0, "2024-01-01"), (5, "mover", 5.0, 0.0, None)]
    objects = spark.createDataFrame(rows, "obj_id long, kind string, ra double, dec double, epoch string").withColumn("matched_reference", F.lit(False))
    replies = services.ask(objects, fetch, timeout=0.5).collect()
    found = {r.obj_id: r.services for r in services.read_replies(spark.createDataFrame(replies, services.REPLY), objects).collect()}
    states = {k: [(c.service, c.status) for c in v] for k, v in found.items()}
    assert states[1] == [("skybot", "no_match"), ("neows", "unavailable")]
    assert states[2] == [("simbad", "match")] and states[4] == [("simbad", "unavailable")]
    assert states[3] == states[5] == [("skybot", "unavailable"), ("jpl_sbident", "unavailable"), ("neows", "unavailable")]
    assert "refused" in found[3][0].detail and found[5][0].detail == "no observation time" and "Timeout" in found[4][0].detail
    checked = motion.identity_checks(objects, services.read_replies(spark.createDataFrame(replies, services.REPLY), objects))
    v, a = motion.verdict(F.col("kind"), F.col("checks"), F.lit(2.0))
    told = {r.obj_id: r.v for r in checked.select("obj_id", v.alias("v")).collect()}
    assert told[1].startswith("uncatalogued moving object (2.00 arcsec/min)") and told[2] == "catalogued object missing from the reference: known object V X"
    assert told[3].startswith("moving object, identity unchecked") and told[4] == "variable star candidate"


def test_coordinate_texts(spark):
    from nocturne.functions import sky

    got = spark.createDataFrame([("12 30 36", "-01:30:00"), ("0.5", "+10 00 36")], "a string, b string").select(sky.sexagesimal_to_degrees(F.col("a"), True).alias("a"), sky.sexagesimal_to_degrees(F.col("b"), False).alias("b")).collect()
    assert [tuple(r) for r in got] == [(pytest.approx(187.65), pytest.approx(-1.5)), (pytest.approx(7.5), pytest.approx(10.01))]
    text = spark.range(1).select(sky.sexagesimal_text(F.lit(187.65), True).alias("a"), sky.sexagesimal_text(F.lit(-1.5), False).alias("b"), sky.sexagesimal_text(F.lit(59.99999999), False).alias("c")).first()
    assert tuple(text) == ("12-30-36.00", "M01-30-00.0", "60-00-00.0")
