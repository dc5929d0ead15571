import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from nocturne.llm.linear_models import bounded_sample, fit_kernel, fit_support_vectors, fold_of, predict_language, presence, quality_scores, score_quality
from nocturne.llm.queries import op3_quality, op8_language_id


def test_fold_is_crc32_of_the_decimal_id(spark):
    got = spark.range(50).select("id", fold_of(F.col("id"), 3).alias("f")).collect()
    assert all(r.f == zlib.crc32(str(r.id).encode()) % 3 for r in got)


def test_support_vectors_separate_and_stay_in_bounds():
    good, bad = [f"the plain text number {i}" for i in range(40)], [f"the### plain$$$ text {i}!!" for i in range(40)]
    model = fit_support_vectors(pa.array(good + bad), [1] * 40 + [0] * 40)
    s = quality_scores(model, pa.array([*good, *bad, "", None]))
    assert (s[:40] > 0.5).all() and (s[40:80] < 0.5).all()
    assert ((s >= 0) & (s <= 1)).all()


def test_one_class_and_no_rows():
    assert 0.5 < quality_scores(fit_support_vectors(pa.array(["a", "b"]), [1, 1]), pa.array(["a"]))[0] < 1
    assert quality_scores(fit_support_vectors(pa.array([], pa.string()), []), pa.array(["a"]))[0] == 0.5


def test_presence_is_the_blended_kernel():
    x = presence(["abc abd", "abc abd", "xyz", "", "!!"])
    k = x @ x.T
    assert abs(k[0, 1] - 1) < 1e-5 and k[0, 2] < 0.4
    assert np.isfinite(k).all()


def test_kernel_without_rows():
    assert fit_kernel(pa.array([], pa.string()), [])["names"] == []


def test_edge_rows(spark, docs, no_docs):
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    scored = score_quality(docs, labels).collect()
    assert len(scored) == docs.count() and all(0 <= r.score <= 1 for r in scored)
    assert all(r.score == 0.5 for r in score_quality(docs, labels.limit(0)).collect())
    assert score_quality(no_docs, labels.limit(0)).count() == 0
    found = {r.doc_id: r for r in predict_language(docs, docs).collect()}
    assert {found[i].lang_pred for i in (0, 1, 2, 15)} == {"und"} and all(found[i].score == 0 for i in (0, 1, 2, 15))
    assert found[6].lang_pred in ("en", "de") and 0 < found[6].score <= 1
    assert {r.lang_pred for r in predict_language(docs, docs.limit(0)).collect()} == {"und"}
    assert predict_language(no_docs, no_docs).count() == 0


def test_the_sample_has_one_row_an_id(spark):
    rows = [(i % 2, f"text {i % 7}", "de" if i % 3 else "en") for i in range(100)] + [(None, "no id", "en"), (9, None, "en"), (10, "x", None), (11, "only", "fr")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    got = bounded_sample(docs.select("doc_id", "lang"), docs, 50, "lang").collect()
    assert sorted(r.doc_id for r in got) == [0, 1, 11]
    assert all((r.doc_id, r.text, r.lang) in rows for r in got) and {r.lang for r in got} == {"de", "fr"}
    assert sorted(got) == sorted(bounded_sample(docs.select("doc_id", "lang"), docs.repartition(5), 50, "lang").collect())
    labels = spark.createDataFrame([(i % 2, i % 2) for i in range(60)] + [(0, 1), (None, 1), (11, None)], "doc_id long, quality int")
    assert sorted((r.doc_id, r.quality) for r in bounded_sample(labels, docs.select("doc_id", "text"), 50, "quality").collect()) == [(0, 0), (1, 1)]
    assert bounded_sample(labels, docs.select("doc_id", "text"), 1, "quality").count() == 1


def test_text_and_label_come_from_one_row(spark):
    rows = [(i, "hello world and the words of it", "en") for i in range(20)] + [(i, "der hund und die katze sind es", "de") for i in range(20)] + [(i, "der hund und die katze sind es", "de") for i in range(20, 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = bounded_sample(docs.select("doc_id", "lang"), docs, 100, "lang").collect()
    assert len(got) == 40 and all(r.lang == "de" and r.text.startswith("der") for r in got)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    scored = [r for r in op3_quality(spark, sf).collect() if r.held_out and r.doc_id in truth]
    assert np.mean([r.predicted == truth[r.doc_id] for r in scored]) > 0.97
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    found = [r for r in op8_language_id(spark, sf).collect() if r.held_out]
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in found]) > 0.97
