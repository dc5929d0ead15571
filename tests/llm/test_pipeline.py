"""The corpus pipeline, stage by stage, against brute-force versions on a small fixture."""

import hashlib
import json
from collections import Counter

import pytest

import corpus_pipeline
from nocturne.llm.mixing import targets
from nocturne.llm.pieces import PieceModel
from nocturne.llm.pii import redact
from nocturne.llm.queries import tokenizer_file

from .test_mixing import words
from .test_pairs import brute_groups
from .test_pii import brute

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Input and output rows of each stage, written and read again."""
    sf, folder = "/root/testdata/sf0.001", tmp_path_factory.mktemp("stages")
    odd = [(10_000, None, "en", "src0", None), (10_001, "", "en", None, 0), (10_002, "123 !!!", "en", "src0", 7)]
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema))
    out = []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs.collect()
        stage(spark, docs, sf).write.parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
        out.append((before, docs.collect(), docs.columns))
    return out


def test_columns(stages):
    assert all(columns == COLUMNS for _, _, columns in stages[:-1])


def test_language(stages):
    before, after, _ = stages[0]
    assert {r.doc_id for r in before} - {r.doc_id for r in after} == {10_000, 10_001, 10_002}
    text = {r.doc_id: r.text for r in before}
    assert all(r.text == text[r.doc_id] for r in after)


def test_near_duplicates(stages):
    before, after, _ = stages[1]
    _, root = brute_groups({r.doc_id: r.text for r in before}, 5, 80)
    assert sorted(r.doc_id for r in after) == sorted(i for i in root if root[i] == i)


def test_personal_data(stages):
    before, after, _ = stages[2]
    text = {r.doc_id: r.text for r in before}
    assert len(before) == len(after)
    for r in after:
        assert brute(r.text) == [] or "[" in r.text
        if not any(c in text[r.doc_id] for c in "@:") and "iban" not in text[r.doc_id].lower():
            assert r.text == redact(text[r.doc_id], brute(text[r.doc_id]))
        assert r.n_chars == len(r.text)


def test_mixing(stages):
    before, after, _ = stages[3]
    copies = Counter(r.doc_id for r in after)
    assert max(copies.values()) <= 2 and copies.keys() <= {r.doc_id for r in before}
    order = sorted({r.source for r in before})
    sizes = [sum(words(r.text) for r in before if r.source == s) for s in order]
    for s, t in zip(order, targets(sizes), strict=True):
        own = [r for r in before if r.source == s]
        taken = sum(copies[r.doc_id] * words(r.text) for r in own)
        assert abs(taken - t) <= max(words(r.text) for r in own)


def test_tokens(stages):
    before, after, _ = stages[4]
    model = PieceModel(tokenizer_file())
    expect = Counter((r.doc_id, len(ids := model.library.encode(r.text)), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()) for r in before)
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256) for r in after) == expect


def test_run(spark, stages):
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) > 100
    json.dumps([r.n_tokens for r in rows])
