"""Queries over whole tables: nothing of the input is left out."""

import math
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from nocturne.functions import text
from nocturne.operators import retrieval
from nocturne.plans import views

from .test_discovery import brute_tracks
from .test_entry import TABLES, canonical

MOTION = ["seed_pairs", "first_match", "tracklet_extend", "motion_fit", "motion_predict", "ra_unwrap", "mover_picks", "mid_epoch"]


@pytest.fixture(scope="module")
def db(sf_dir):
    out = duckdb.connect()
    for t in TABLES:
        out.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return out


def same_as_sql(spark, sf_dir, db, name):
    df, expect = driver.queries()[name](spark, sf_dir), db.sql(driver.oracle_sql()[name])
    assert sorted(df.columns) == sorted(expect.columns)
    assert canonical([tuple(r) for r in df.collect()], df.columns) == canonical(expect.fetchall(), expect.columns)


def test_tracks_hold_every_user_and_day(spark, sf_dir, db):
    assert views.tracks(spark, sf_dir).count() == db.sql("SELECT count(*) FROM (SELECT DISTINCT user_id, CAST(ts AS DATE) FROM events)").fetchall()[0][0]


@pytest.mark.parametrize("name", MOTION)
def test_motion_over_all_days(spark, sf_dir, db, name):
    same_as_sql(spark, sf_dir, db, name)


def test_movers_are_linked_over_all_days(spark, sf_dir):
    rows = [tuple(r) for r in views.tracks(spark, sf_dir).select("det_idx", "frame_index", "time_min", "ra", "dec").collect()]
    got = {}
    for r in driver.queries()["link_movers"](spark, sf_dir).collect():
        got.setdefault(r.track, []).append(r.det_idx)
    assert sorted(map(sorted, got.values())) == brute_tracks(rows, 4.0, 2.5 * 2.5 / 3600, 3)
    late = {r[0] for r in rows if r[1] > 5}
    assert late & {d for t in got.values() for d in t}


def test_every_frame_is_matched(spark, sf_dir, db):
    same_as_sql(spark, sf_dir, db, "sky_crossmatch")
    left = {r.left_id % 8 for r in driver.queries()["sky_crossmatch"](spark, sf_dir).select("left_id").collect()}
    assert left == {1, 3, 5, 7}


def test_every_frame_is_united(spark, sf_dir, db):
    same_as_sql(spark, sf_dir, db, "night_union")
    n = driver.queries()["night_union"](spark, sf_dir).count()
    assert n == db.sql("SELECT count(*) FROM embeddings").fetchall()[0][0]


LIGHT = ["lightcurve_stats", "weighted_chi2", "system_select", "ensemble_floor", "variables", "job2_light_curves"]


@pytest.mark.parametrize("name", LIGHT)
def test_values_of_zero_and_few_detections(spark, sf_dir, tmp_path, name):
    """ln(0) is minus infinity; an object of one or two detections keeps its row."""
    db = duckdb.connect()
    db.sql(f"CREATE TABLE events AS SELECT * REPLACE (CASE WHEN event_id % 97 = 3 THEN 0 ELSE value END AS value) FROM '{sf_dir}/events.parquet' WHERE user_id % 4 <> 1 OR event_id % 30 = 0")
    db.sql(f"COPY events TO '{tmp_path}/events.parquet' (FORMAT parquet)")
    assert db.sql("SELECT count(*) FROM events WHERE value = 0").fetchall()[0][0] and db.sql("SELECT min(n) FROM (SELECT count(*) AS n FROM events GROUP BY user_id)").fetchall()[0][0] < 3
    same_as_sql(spark, str(tmp_path), db, name)


def test_terms_are_counted_within_their_rows(spark):
    chunks = spark.createDataFrame([(1, 0, "Linked links linking, a b2 the 7z b2!"), (2, 0, "the a"), (3, 0, None)], "key long, pos int, passage string")
    counts = retrieval.term_counts(chunks)
    assert sorted(map(tuple, counts.collect())) == [(1, 0, "7z", 1), (1, 0, "b2", 2), (1, 0, "link", 3)]
    assert "Exchange" not in counts._jdf.queryExecution().executedPlan().toString()


def test_words_of_a_text_are_split_once(spark):
    """The words are a lambda's variable: no window splits the text again."""
    from nocturne.functions.text import passages

    cut = spark.range(1).select(passages(F.repeat(F.lit("word "), F.lit(1000)), 220, 40).alias("p"))
    assert [len(p.split(" ")) for p in cut.head().p] == [220, 220, 220, 220, 220, 100]
    assert cut.select(F.size("p"))._jdf.queryExecution().analyzed().toString().count("split(") == 1


def test_rare_terms_are_looked_up_like_frequent_ones(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(retrieval, "OFTEN", 2)
    chunks = spark.createDataFrame([(i, "s", 0, f"the sky was clear linked word{i} _a. .b7- xK {'night ' * (i % 3)}") for i in range(12)], "key long, source string, pos int, passage string")
    index = retrieval.PassageIndex.build(chunks, asked=False)
    assert index.table("postings").isEmpty()
    with pytest.raises(ValueError, match="without postings"):
        index.search("night")
    got = {}
    for r in index.weights().collect():
        got.setdefault(r.key, {})[r.term] = r.w
    frequency = Counter(t for terms in got.values() for t in terms)
    assert set(got) == set(range(12)) and {t for t, n in frequency.items() if n == 12} == {"sky", "clear", "link", "a.", "b7-", "xk"}
    for i, weights in got.items():
        assert set(weights) == {"sky", "clear", "link", "a.", f"word{i}", "b7-", "xk"} | ({"night"} if i % 3 else set())
        raw = {t: (1 + math.log(i % 3 if t == "night" else 1)) * (math.log(13 / (1 + n)) + 1) for t, n in frequency.items() if t in weights}
        length = math.sqrt(sum(x * x for x in raw.values()))
        assert all(abs(weights[t] - x / length) < 1e-12 for t, x in raw.items())


def test_stems_in_tasks_equal_the_expression(spark):
    words = ["links", "linked", "linkings", "theses", "the", "ed", "ing", "eyes", "bodies", "yyyyy", "seeeers", "a.ing", "ies", "abies", "x1", "user_ers", "glasseses", "ney", "money", "pee", "singing"]
    rows = spark.createDataFrame([(w,) for w in words], "w string").select("w", text.stem(F.col("w")).alias("s"), F.get(text.tokens(F.col("w")), F.lit(0)).alias("t")).collect()
    stems = text.Stems()
    assert all(stems[r.w] == (r.s if r.t is not None else None) for r in rows)
