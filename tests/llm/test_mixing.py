import re
from collections import defaultdict

import numpy as np
import pytest

from nocturne.llm import mixing
from nocturne.llm.mixing import deal, mix, targets
from nocturne.llm.queries import op5_mixing
from nocturne.llm.shared import Scratch


def test_targets_stop_at_the_ceiling_and_use_the_whole_share():
    t = targets([100, 100, 100])
    assert t[0] == 200.0 and abs(sum(t) - 450) < 1e-9
    assert all(x <= 200 for x in t)
    assert targets([]) == [] and targets([0, 10]) == [0.0, 15.0]
    assert targets([1, 1000])[0] == 2.0


def test_tree_keeps_quotas_and_shares():
    q = np.array([100, 7, 0, 33])
    d = deal(q, 6, 1)
    assert len(d) == q.sum() and set(d) == set(range(6))
    totals = np.bincount(d)
    assert totals.max() - totals.min() <= 1
    assert (d == deal(q, 6, 1)).all() and len(deal(q * 0, 6, 1)) == 0
    assert len(set(deal(np.array([2, 1]), 1000, 1))) <= 3


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def test_edge_rows(spark, docs, no_docs, scratch):
    rows = mix(docs, scratch, shards=3).rows.collect()
    assert len(rows) == docs.count()
    assert all(r["size"] == words(r.doc.text) and len(r.shards) == r.copies <= 2 for r in rows)
    again = mix(docs, scratch, shards=3).rows.collect()
    key = lambda r: (r.doc.doc_id, r.copies, tuple(r.shards))
    assert sorted(map(key, rows)) == sorted(map(key, again))
    drawn = mix(docs, scratch, shards=3).drawn()
    assert drawn.count() == sum(r.copies for r in rows) and drawn.select("doc.*").columns == docs.columns
    assert mix(no_docs, scratch).rows.count() == 0


def test_targets_are_met(spark):
    rows = op5_mixing(spark, "/root/testdata/sf0.01").collect()
    by = defaultdict(list)
    for r in rows:
        assert 0 <= r.taken <= 2 * r["size"]
        by[r.source].append(r)
    order = sorted(by)
    sizes = [sum(r["size"] for r in by[s]) for s in order]
    for s, size, t in zip(order, sizes, targets(sizes), strict=True):
        assert by[s][0].source_size == size and abs(by[s][0].target - t) < 1e-6
        assert abs(sum(r.taken for r in by[s]) - t) <= 0.05 * t + min(r["size"] for r in by[s])


def near_targets(rows):
    """Taken words of each source against brute-force targets, beside the size of the smallest document."""
    by = defaultdict(list)
    for r in rows:
        assert r.copies <= 2 and len(r.shards) == r.copies
        by[r.doc.source].append(r)
    order = sorted(by, key=lambda s: (s is None, s))
    weights = [(3, 1, 2)[i % 3] for i in range(len(order))]
    sizes = [sum(r["size"] for r in by[s]) for s in order]
    lo, hi = 0.0, 4.0 * sum(sizes) + 1  # the level at which weights, stopped at twice the sizes, fill the share
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if sum(min(mid * w, 2 * s) for w, s in zip(weights, sizes, strict=True)) < 1.5 * sum(sizes) else (lo, mid)
    for s, w, size in zip(order, weights, sizes, strict=True):
        target = min(hi * w, 2 * size)
        assert abs(by[s][0].target - target) <= 1e-6 * target + 1e-6 and by[s][0].source_size == size
        assert abs(sum(r["size"] * r.copies for r in by[s]) - target) <= max(r["size"] for r in by[s]), s


@pytest.mark.parametrize("broadcast", [100_000, 0])
def test_rows_that_repeat_an_id_meet_the_targets(spark, monkeypatch, broadcast):
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", broadcast)
    rows = [(1, "five words in this text", "a")] * 900 + [(2, f"text {i} of one id", "b") for i in range(300)] + [(i, "many ids with one text", None) for i in range(200)] + [(None, "no id", "c")] * 50
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mix(docs.repartition(3), Scratch(spark)).rows.collect()
    assert len(got) == len(rows)
    near_targets(got)
    key = lambda r: (r.doc.doc_id or 0, r.doc.text, r.copies)
    again = mix(docs.repartition(7), Scratch(spark)).rows.collect()
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_sources_without_number(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 50)
    docs = spark.createDataFrame([(i, "w " * (1 + i % 9), f"s{i % 700:03d}") for i in range(3000)], "doc_id long, text string, source string")
    near_targets(mix(docs, Scratch(spark), shards=5).rows.collect())


def test_one_document_in_several_sources(spark):
    docs = spark.createDataFrame([(1, "word", s) for s in "abc" for _ in range(1000)], "doc_id long, text string, source string")
    got = mix(docs.repartition(4), Scratch(spark)).rows.collect()
    near_targets(got)
    taken = {s: sum(r["size"] * r.copies for r in got if r.doc.source == s) for s in "abc"}
    assert taken == {"a": 2000, "b": 833, "c": 1667 if taken["c"] == 1667 else 1666}


def test_documents_repeated_over_sources(spark):
    docs = spark.createDataFrame([(i, "w " * (1 + i % 50), s) for s in "abcde" for i in range(40) for _ in range(25)], "doc_id long, text string, source string")
    near_targets(mix(docs, Scratch(spark)).rows.collect())


def test_a_source_of_many_small_and_few_huge_documents(spark):
    rows = [(i, "w " * 3, "a") for i in range(600)] + [(1000 + i, "w " * 9000, "a") for i in range(3)] + [(2000 + i, "w " * 40, "b") for i in range(800)]
    got = mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), Scratch(spark)).rows.collect()
    by = defaultdict(list)
    for r in got:
        by[r.doc.source].append(r)
    for s, own in by.items():
        assert abs(sum(r["size"] * r.copies for r in own) - own[0].target) <= 0.005 * own[0].target + 40, s


def test_rows_alike_but_for_other_columns(spark):
    rows = [(1, "five words in this text", "a", f"l{i}") for i in range(300)] + [(2, "w " * 700, "b", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    copies = [sorted((r.doc.lang or "", r.copies) for r in mix(docs.repartition(n), Scratch(spark)).rows.collect()) for n in (2, 7)]
    assert copies[0] == copies[1] and len({c for _, c in copies[0]}) == 2
