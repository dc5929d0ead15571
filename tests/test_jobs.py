"""The two jobs: growing input, reruns, runs cut off half way, and the command line."""

import datetime as dt
import json
import math
import re
import shutil
import statistics
import subprocess
import sys
from collections import Counter
from pathlib import Path

import pytest

import __spark_entry__ as driver
from jobs import common, light_curves, note_index
from jobs.note_index import Settings as NoteSettings
from nocturne.functions.text import STOP_WORDS
from nocturne.operators.retrieval import PassageIndex

ROOT = Path(__file__).resolve().parents[1]


# ---- the index of notes --------------------------------------------------------------------------


def stem(t):
    while True:
        s = re.sub(r"^(.{3,}?)(ing|ers|ies|ed|es|er|s)$", r"\1", t)
        s = s if s != t else re.sub(r"^(.{4,})[ey]$", r"\1", t)
        if s == t:
            return t
        t = s


def postings(rows, words=220, overlap=40):
    """(key, pos, source, term): c of every document, plainly."""
    out = {}
    for key, source, text in rows:
        w = (text or "").split()
        for pos, i in enumerate(range(0, len(w), words - overlap)):
            passage = " ".join(w[i : i + words])
            if len(passage) > 80:
                counted = Counter(stem(t) for t in re.findall(r"[a-z0-9][a-z0-9_.\-]+", passage.lower()) if t not in STOP_WORDS)
                out |= {(key, pos, source, t): c for t, c in counted.items()}
    return out


def told(spark, out):
    rows = note_index.output(spark, str(out), "bigint").collect()
    found = {(r.key, r.pos, r.source, r.term): r.c for r in rows}
    assert len(found) == len(rows)
    df = Counter(k[3] for k in found)
    assert all(r.df == df[r.term] for r in rows)
    return found


def notes(spark, sf_dir, folder, part, parts=4):
    """Copies one part of the documents into the folder of notes as a file."""
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").where(f"doc_id % {parts} = {part}").coalesce(1)
    rows.write.mode("append").parquet(str(folder))
    return [(r.doc_id, r.source, r.text) for r in rows.collect()]


def files(folder):
    return {p.relative_to(folder): p.stat().st_mtime_ns for p in Path(folder).rglob("*.parquet")}


def test_notes_grow(spark, sf_dir, tmp_path):
    docs, out, state = tmp_path / "docs", tmp_path / "index", tmp_path / "state"
    first = notes(spark, sf_dir, docs, 0) + notes(spark, sf_dir, docs, 1)
    got = note_index.run(spark, str(docs), str(out), str(state), NoteSettings(files_per_batch=1))
    assert got["batches"] == 2 and got["documents"] == len(first)
    assert told(spark, out) == postings(first)
    before = files(out)
    assert note_index.run(spark, str(docs), str(out), str(state)) == {"batches": 0, "documents": 0, "passages": 0}
    assert files(out) == before
    second = notes(spark, sf_dir, docs, 2)
    got = note_index.run(spark, str(docs), str(out), str(state))
    assert got["batches"] == 1 and got["documents"] == len(second)
    assert told(spark, out) == postings(first + second)
    after = files(out)
    assert {k: v for k, v in after.items() if k in before} == before  # older segments are left as they are


def test_batch_cut_off_is_taken_again(spark, sf_dir, tmp_path, monkeypatch):
    docs, out, state = tmp_path / "docs", tmp_path / "index", tmp_path / "state"
    rows = notes(spark, sf_dir, docs, 0)
    put = PassageIndex._put

    def fails(self, df, name, segment):
        if name == "postings":
            raise RuntimeError("lost")
        put(self, df, name, segment)

    monkeypatch.setattr(PassageIndex, "_put", fails)
    with pytest.raises(Exception, match="lost"):
        note_index.run(spark, str(docs), str(out), str(state))
    monkeypatch.undo()
    assert note_index.run(spark, str(docs), str(out), str(state))["documents"] == len(rows)
    assert told(spark, out) == postings(rows)


def test_index_answers_over_segments(spark, tmp_path):
    docs, out, state = tmp_path / "docs", tmp_path / "index", tmp_path / "state"
    for i, (source, text) in enumerate([("movers", "moving objects are linked across frames by their motion " * 6), ("flats", "flat fields correct the response of pixels in each filter " * 6)]):
        spark.createDataFrame([(i, source, text), (10 + i, source, None), (20 + i, None, "")], "doc_id long, source string, text string").coalesce(1).write.mode("append").parquet(str(docs))
        note_index.run(spark, str(docs), str(out), str(state))
    index = PassageIndex(spark, str(out), "bigint")
    assert [r.source for r in index.search("How do movers move?").collect()] == ["movers"]
    whole = PassageIndex.build(index.table("passages").select("key", "source", "pos", "passage"))
    for question in ("flat response", "frames of pixels"):
        assert [(r.key, round(r.score, 9)) for r in index.search(question).collect()] == [(r.key, round(r.score, 9)) for r in whole.search(question).collect()]


def test_no_notes(spark, tmp_path):
    docs = tmp_path / "docs"
    spark.createDataFrame([], "doc_id long, source string, text string").write.parquet(str(docs))
    got = note_index.run(spark, str(docs), str(tmp_path / "index"), str(tmp_path / "state"))
    assert got["passages"] == 0 and told(spark, tmp_path / "index") == {}


# ---- light curves --------------------------------------------------------------------------------

PLAIN = {"object": "obj", "time": "ts", "snr": "snr", "mag_err": "err", "mag_calib": "mag", "mag_inst": "CAST(NULL AS double)"}


def brute_curves(rows, nights=10):
    """(run, object): (n, mean, rms, is_variable) by the definitions."""
    runs = {}
    for obj, ts, mag, err in rows:
        day = (ts.date() - dt.date(2000, 1, 1)).days // nights * nights
        runs.setdefault(dt.date(2000, 1, 1) + dt.timedelta(day), {}).setdefault(obj, []).append((mag, err))
    out = {}
    for run, objects in runs.items():
        rms = {o: statistics.stdev(m for m, _ in p) for o, p in objects.items() if len(p) >= 3}
        floor = min(max(statistics.median(rms.values()), 0.005), 0.03) if rms else None
        for o, p in objects.items():
            if len(p) < 3:
                out[run, o] = (len(p), None, None, None)
                continue
            med = statistics.median(m for m, _ in p)
            dev = [abs(m - med) / math.hypot(e, floor) for m, e in p]
            chi2, amp = sum(d * d for d in dev) / len(p), max(m for m, _ in p) - min(m for m, _ in p)
            decided = sum(d > 4 for d in dev) >= max(2, len(p) // 2) and chi2 > 10 and amp > 0.1 and rms[o] > 2.5 * floor
            out[run, o] = (len(p), statistics.fmean(m for m, _ in p), rms[o], decided)
    return out


def curves(spark, out):
    rows = spark.read.parquet(str(out)).collect()
    found = {(r.run, r.object): (r.n, r.mean_mag, r.mag_rms, r.is_variable) for r in rows}
    assert len(found) == len(rows)
    return found


def same(got, want):
    assert got.keys() == want.keys()
    for k, w in want.items():
        assert got[k][0] == w[0] and got[k][3] == w[3]
        assert all((a is None and b is None) or math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-12) for a, b in zip(got[k][1:3], w[1:3], strict=True))


def night_rows(days, seed=1):
    import random

    rng = random.Random(seed)
    return [(o, dt.datetime(2024, 3, 1, 22) + dt.timedelta(days=d, minutes=8 * k), 16 + 0.01 * rng.gauss(0, 1) + (0.6 * (k % 2) if o == 7 else 0), 0.01) for d in days for o in range(12) for k in range(4 if o else 1)]


def put(spark, rows, path):
    spark.createDataFrame([(*r, 50.0) for r in rows], "obj long, ts timestamp, mag double, err double, snr double").write.mode("append").parquet(str(path))


def test_light_curves_of_runs(spark, tmp_path):
    rows, s = night_rows(range(0, 24)), light_curves.Settings(columns=PLAIN)
    rows += [(None, dt.datetime(2024, 3, 2), 16.0, 0.01), (3, None, 16.0, 0.01)]
    put(spark, rows, tmp_path / "d")
    got = light_curves.run(spark, str(tmp_path / "d"), str(tmp_path / "o"), s)
    want = brute_curves([r for r in rows if r[0] is not None and r[1] is not None])
    assert got["read"] == len(rows) and got["written"] == len(want)
    same(curves(spark, tmp_path / "o"), want)
    assert any(v[3] for (_, o), v in want.items() if o == 7) and not any(v[3] for (_, o), v in want.items() if o != 7)
    light_curves.run(spark, str(tmp_path / "d"), str(tmp_path / "o"), s)
    same(curves(spark, tmp_path / "o"), want)


def test_only_the_wanted_runs_are_replaced(spark, tmp_path):
    early, late = night_rows(range(0, 24)), night_rows(range(24, 31), 2)
    s = light_curves.Settings(columns=PLAIN)
    put(spark, early, tmp_path / "d")
    light_curves.run(spark, str(tmp_path / "d"), str(tmp_path / "o"), s)
    before = files(tmp_path / "o")
    put(spark, late, tmp_path / "d")
    night = min(r[1] for r in late).date().isoformat()
    for _ in range(2):
        got = light_curves.run(spark, str(tmp_path / "d"), str(tmp_path / "o"), light_curves.Settings(columns=PLAIN, since=night, until="2024-03-31"))
    assert got["read"] < len(early) + len(late)
    want = brute_curves(early + late)
    same(curves(spark, tmp_path / "o"), want)
    first = light_curves.Settings().first_night
    touched = {k for k in before if dt.date.fromisoformat(k.parts[0].removeprefix("run=")) < dt.date.fromisoformat(night) - dt.timedelta(10)}
    assert touched and all(files(tmp_path / "o")[k] == before[k] for k in touched) and first < night


def test_wanted_nights_reach_the_scan(spark, sf_dir):
    s = light_curves.Settings(since="2024-01-10", until="2024-01-12")
    plan = light_curves.within(spark.read.parquet(f"{sf_dir}/events.parquet"), s)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan


# ---- queries, configuration, command line --------------------------------------------------------


@pytest.mark.parametrize("name", ["job1_note_index", "job2_light_curves"])
def test_queries(spark, sf_dir, name):
    import duckdb

    from .test_entry import TABLES, canonical

    db = duckdb.connect()
    for t in TABLES:
        db.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    conf = dict(spark.conf.getAll)
    df, expect = driver.queries()[name](spark, sf_dir), db.sql(driver.oracle_sql()[name])
    assert sorted(df.columns) == sorted(expect.columns)
    assert canonical([tuple(r) for r in df.collect()], df.columns) == canonical(expect.fetchall(), expect.columns)
    assert dict(spark.conf.getAll) == conf


def test_configuration(spark):
    for job, name in ((note_index, "note_index"), (light_curves, "light_curves")):
        assert common.settings_from(job.Settings, common.read_config(spark, str(ROOT / f"jobs/{name}.json"))) == job.Settings()
    with pytest.raises(ValueError, match="nights"):
        common.settings_from(light_curves.Settings, {"nights": 3})
    assert common.read_config(spark, None) == {}


def test_command_line(tmp_path, sf_dir):
    shutil.copy(f"{sf_dir}/documents.parquet", tmp_path / "docs.parquet")
    (tmp_path / "c.json").write_text(json.dumps({"words": 100}))
    args = [sys.executable, "-m", "jobs.note_index", "--documents", tmp_path / "docs.parquet", "--out", tmp_path / "index", "--checkpoint", tmp_path / "state", "--config", tmp_path / "c.json"]
    done = subprocess.run([*map(str, args)], cwd=ROOT, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    assert re.search(r"read 200 new documents .* wrote [1-9]\d* passages in 1 segments", done.stderr)
    assert list((tmp_path / "index/postings/segment=0").glob("*.parquet"))


def test_jobs_don_t_need_the_corpus_parts():
    for f in [*(ROOT / "jobs").glob("*.py"), ROOT / "tests/test_jobs.py"]:
        assert not re.search(r"^\s*(from|import)\s+\S*(llm|corpus_pipeline)", f.read_text(), re.M)


def test_terms_are_not_shuffled_for_their_sources(spark, tmp_path):
    """Passages meet their sources before their terms are written out."""
    chunks = spark.createDataFrame([(i, f"s{i}", 0, f"clear sky{i} night night") for i in range(4)], "key long, source string, pos int, passage string")
    index = PassageIndex(spark, str(tmp_path / "index"), "bigint")
    index.add(chunks)
    rows = note_index.output(spark, str(tmp_path / "index"), "bigint")
    assert sorted((r.key, r.source, r.term, r.c, r.df) for r in rows.collect()) == sorted((i, f"s{i}", t, c, n) for i in range(4) for t, c, n in (("clear", 1, 4), (f"sky{i}", 1, 1), ("night", 2, 4)))
    plan = rows._jdf.queryExecution().optimizedPlan().toString().split("\n")
    at = next(i for i, line in enumerate(plan) if "Generate explode" in line)
    met = [i for i, line in enumerate(plan) if "Join Inner" in line and "segment#" in line]
    assert met and min(met) > at
