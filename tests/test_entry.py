"""The driver contract, with and without the removable parts."""

import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as driver

ROOT = Path(__file__).resolve().parents[1]
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SAMPLE = ["frame_classify", "time_fallback", "mpc_format", "crossmatch_nn", "isolation", "zero_point", "astrom_refine", "variables", "tracklet_extend", "motion_fit", "rb_score", "merge_fields", "stack_combine_mad", "image_background", "tfidf_weights", "stream_sessions"]


def test_names():
    assert set(driver.oracle_sql()) <= set(driver.queries())


def test_entry(spark):
    assert driver.entry(spark).count() > 0


def canonical(rows, columns):
    order = sorted(columns)
    return sorted(str(tuple(None if r[columns.index(c)] is None else r[columns.index(c)] + 0.0 if isinstance(r[columns.index(c)], float) else str(r[columns.index(c)]) for c in order)) for r in rows)


@pytest.mark.parametrize("name", SAMPLE)
def test_oracle(spark, sf_dir, name):
    db = duckdb.connect()
    for t in TABLES:
        db.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    df = driver.queries()[name](spark, sf_dir)
    expect = db.sql(driver.oracle_sql()[name])
    assert sorted(df.columns) == sorted(expect.columns)
    assert canonical([tuple(r) for r in df.collect()], df.columns) == canonical(expect.fetchall(), expect.columns)


def test_without_the_corpus_operators(tmp_path):
    for item in ("nocturne", "jobs", "__spark_entry__.py"):
        subprocess.run(["cp", "-r", str(ROOT / item), str(tmp_path)], check=True)
    subprocess.run(["rm", "-rf", str(tmp_path / "nocturne" / "llm")], check=True)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 80 and not [n for n in q if n.startswith('op') and n[2].isdigit()] and 'pipeline' not in q; assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)}, check=True)
