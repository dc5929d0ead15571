"""Near duplicates, exact top-k and their brute-force versions."""

import math
from fractions import Fraction
from pathlib import Path

import numpy as np
import pytest

from nocturne.llm import embedding_dedup, topk
from nocturne.llm.embedding_dedup import near_duplicates
from nocturne.llm.jaccard_join import similar_groups
from nocturne.llm.shared import Scratch, components

FOLD = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def shingles(text, k):
    w = (text or "").encode().translate(FOLD).split()
    return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def roots(ids, links):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def brute_groups(texts, k, percent):
    sets = {i: shingles(t, k) for i, t in texts.items()}
    ids = sorted(sets)
    links = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    return {i: len(s) for i, s in sets.items()}, roots(ids, links)


@pytest.mark.parametrize(("k", "percent"), [(4, 85), (5, 80)])
def test_groups_of_edge_rows(spark, docs, scratch, k, percent):
    n, root = brute_groups({r.doc_id: r.text for r in docs.collect()}, k, percent)
    got = similar_groups(docs, Scratch(spark), k, percent).collect()
    assert len(got) == docs.count()
    assert all((r.n_shingles, r.component_id) == (n[r.doc_id], root[r.doc_id]) for r in got)


def test_groups_of_edited_copies(spark):
    rng = np.random.default_rng(1)
    texts, vocabulary = {}, [f"v{i}" for i in range(4000)]
    for family in range(6):
        base = list(rng.choice(vocabulary, 90))
        for _ in range(40):
            t = list(base)
            for j in rng.choice(90, rng.integers(0, 6), replace=False):
                t[j] = str(rng.choice(vocabulary))
            texts[len(texts)] = " ".join(t)
    passage = " ".join(rng.choice(vocabulary, 30))
    for _ in range(60):
        texts[len(texts)] = f"{passage} {' '.join(rng.choice(vocabulary, int(rng.integers(1, 20))))}"
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    n, root = brute_groups(texts, 4, 85)
    got = {r.doc_id: r for r in similar_groups(df, Scratch(spark), 4, 85).collect()}
    assert {i: r.component_id for i, r in got.items()} == root and {i: r.n_shingles for i, r in got.items()} == n


def test_groups_of_nothing(spark, no_docs):
    assert similar_groups(no_docs, Scratch(spark)).count() == 0


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, j) for j in range(101, 140)] + [(200, 200), (300, 301), (301, 300), (300, 301)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long"), Scratch(spark)).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{j: 100 for j in range(100, 140)}, 300: 300, 301: 300}
    assert components(spark.createDataFrame([], "u long, v long"), Scratch(spark)).count() == 0


def vectors(rng, n, groups, spread):
    centres = rng.normal(size=(groups, 32))
    return [list(map(float, np.float32(centres[i % groups] + spread * rng.normal(size=32)))) for i in range(n)]


def test_links_of_vectors(spark):
    rng = np.random.default_rng(2)
    rows = vectors(rng, 300, 150, 0.1) + vectors(rng, 150, 1, 0.15) + [[0.5] * 32] * 40
    odd = [None, [], [0.0] * 32, [float("nan")] * 32, [float("inf")] + [1.0] * 31, [None] + [1.0] * 31, [1.0, 2.0], [2.0, 4.0], [0.5] * 32]
    data = [(i, v, 7, "clash") for i, v in enumerate(rows + odd)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>, label int, kept string").repartition(4)
    got = {r.vec_id: r for r in near_duplicates(df, Scratch(spark)).collect()}
    assert len(got) == len(data)
    good = {i: np.array(v, np.float32).astype(float) for i, v, _, _ in data if v and None not in v and np.isfinite(v).all() and np.any(v)}
    links = [(a, b) for a in good for b in good if a < b and len(good[a]) == len(good[b]) and good[a] @ good[b] / np.linalg.norm(good[a]) / np.linalg.norm(good[b]) >= 0.9]
    found = sum(r.n_links for r in got.values()) // 2
    assert 0.9 * len(links) <= found <= len(links)
    exact = roots(range(len(data)), links)
    assert np.mean([got[i].component_id == exact[i] for i in exact]) > 0.95
    for i in range(len(rows), len(rows) + 6):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)
    assert near_duplicates(df.limit(0), Scratch(spark)).count() == 0


@pytest.mark.parametrize("share", [1.0, 0.9])
def test_links_of_vectors_with_a_common_direction(spark, share):
    """Pairs at a cosine of 0.91 to 0.93 among rows of which all, or 90%, share a direction."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(5000, 64)) / 8
    x[: int(share * len(x)), 3] += 1.5
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    u = rng.normal(size=(400, 64))
    u -= (u * x[:400]).sum(1, keepdims=True) * x[:400]
    c = rng.uniform(0.91, 0.93, (400, 1))
    x = np.concatenate([x, c * x[:400] + np.sqrt(1 - c * c) * u / np.linalg.norm(u, axis=1, keepdims=True)])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(4)
    got = {r.vec_id: r for r in near_duplicates(df, Scratch(spark)).collect()}
    a, b = np.nonzero(np.triu(x @ x.T >= 0.9, 1))
    found = sum(r.n_links for r in got.values()) // 2
    assert len(a) >= 400 and 0.99 * len(a) <= found <= len(a)
    exact = roots(range(len(x)), zip(a.tolist(), b.tolist(), strict=True))
    assert np.mean([got[i].component_id == exact[i] for i in exact]) > 0.99


@pytest.mark.parametrize("blocks", [((8, 8), (64, 64)), ((1024, 4096), (4096, 4096))])
def test_top_k_equals_brute_force(spark, blocks):
    rng = np.random.default_rng(4)
    rows = vectors(rng, 260, 40, 0.5) + [[0.25] * 32] * 30 + [None, [float("nan")] * 32, [0.0] * 32, [1.0, 2.0], [3.0, 4.0], []]
    data = [(i, v, "clash") for i, v in enumerate(rows)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>, rank string").repartition(3)
    asked = df.where("vec_id % 10 = 0 or vec_id > 285")
    got = {}
    for r in topk.exact_top_k(df, asked, Scratch(spark), 10, *blocks).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(got[r.query_id])
    good = {i: np.floor(np.array(v, np.float32).astype(float) * 1024) for i, v, _ in data if v and np.isfinite(v).all()}
    for q in [i for i in good if i % 10 == 0 or i > 285]:
        expect = sorted(((i, int(x @ good[q])) for i, x in good.items() if i != q and len(x) == len(good[q])), key=lambda p: (-p[1], p[0]))[:10]
        assert got.get(q, []) == expect, q
    assert topk.exact_top_k(df.limit(0), asked.limit(0), Scratch(spark)).count() == 0


@pytest.mark.parametrize("sf", ["sf0.1", "check_s"])
def test_links_of_a_table_against_brute_force(spark, sf):
    """Recall and precision over a whole table, links and components."""
    path = f"/root/testdata/{sf}/embeddings.parquet"
    if not Path(path).exists():
        pytest.skip("no such table here")
    rows = spark.read.parquet(path)
    data = rows.select("vec_id", "embedding").toPandas()
    x = np.stack(data["embedding"]).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    ids = data["vec_id"].to_numpy()
    parent = np.arange(len(ids))
    n = np.zeros(len(ids), int)
    for lo in range(0, len(ids), 1000):
        on = x[lo : lo + 1000] @ x.T >= 0.9
        n[lo : lo + 1000] = on.sum(1) - 1
        parent[lo : lo + 1000] = on.argmax(1)  # the first row linked with it
    got = near_duplicates(rows, Scratch(spark)).toPandas().set_index("vec_id").loc[ids]
    found = got["n_links"].to_numpy()
    assert (found <= n).all() and found.sum() >= 0.99 * n.sum()
    assert (got["component_id"].to_numpy()[parent] == got["component_id"].to_numpy()).mean() > 0.99


def test_links_of_planted_pairs_by_cosine(spark):
    """Of pairs planted at each cosine from the threshold up, 97% at least are found, none below it."""
    rng = np.random.default_rng(12)
    x = rng.normal(size=(12000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    u = rng.normal(size=(3000, 64))
    u -= (u * x[:3000]).sum(1, keepdims=True) * x[:3000]
    c = np.repeat([0.88, 0.9001, 0.905, 0.92, 0.95, 0.99], 500)[:, None]
    y = c * x[:3000] + np.sqrt(1 - c * c) * u / np.linalg.norm(u, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(np.concatenate([x, y]))], "vec_id long, embedding array<double>")
    got = {r.vec_id: r.n_links for r in near_duplicates(df, Scratch(spark)).collect()}
    share = [np.mean([got[12000 + i] for i in range(k, k + 500)]) for k in range(0, 3000, 500)]
    assert share[0] == 0 and min(share[1:]) >= 0.97 and max(share) <= 1


def test_keys_that_many_codes_share_are_dealt(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "HOT", 8)
    rng = np.random.default_rng(13)
    rows = vectors(rng, 400, 4, 0.25) + vectors(rng, 200, 100, 0.1) + [[1.0, 0.0]] * 3
    data = [*enumerate(rows), (None, rows[0]), (None, rows[1]), (None, None)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>").repartition(4)
    got = near_duplicates(df, Scratch(spark)).collect()
    assert len(got) == len(data)
    assert [(r.n_links, r.component_id, r.kept) for r in got if r.vec_id is None] == [(0, None, True)] * 3
    x = np.array(rows[:600])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    links = [(int(a), int(b)) for a, b in zip(*np.nonzero(np.triu(x @ x.T >= 0.9, 1)), strict=True)]
    by = {r.vec_id: r for r in got}
    found = sum(by[i].n_links for i in range(600)) // 2
    assert 0.98 * len(links) <= found <= len(links) and len(links) > 1000
    assert [by[i].n_links for i in range(600, 603)] == [2, 2, 2]


def test_keys_grow_with_the_rows():
    width = lambda n: next(w for _, w, count, radius in embedding_dedup.options(n) if count * (64 // w) >= 6)
    assert width(1_000) <= width(1_000_000) < width(10**9) and width(10**9) >= 26


@pytest.mark.parametrize("block", [(4, 4), (4096, 4096)])
def test_top_k_of_any_finite_vector(spark, block):
    """Small and huge components, scores beyond 2^53 and beyond 64 bits, null ids and ids beyond 2^53."""
    rng = np.random.default_rng(11)
    rows = [[float(x) for x in rng.normal(size=8)] for _ in range(30)] + [[1e10] * 8, [-1e10] * 8, [1e10] * 7 + [1.0], [1e307] * 8, [1.5e308] + [0.0] * 7, [-1.7e308] * 8, [5e-324] * 8, [2.0**40 + 0.5] * 8]
    data = [(2**60 + i, v) for i, v in enumerate(rows)] + [(None, [1.0] * 8), (2**60 + 3, rows[3])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>").repartition(3)
    whole = {i: [math.floor(Fraction(x) * 1024) for x in v] for i, v in data if i}
    got = {}
    for r in topk.exact_top_k(df, df, Scratch(spark), 5, block, block).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert got.keys() == whole.keys()
    for q, mine in whole.items():
        scores = [(i, sum(a * b for a, b in zip(mine, whole[i], strict=True))) for i, _ in data if i and i != q]
        best = sorted(scores, key=lambda p: (-p[1], p[0]))[:5]
        assert got[q] == [(i, max(-(2**63), min(2**63 - 1, s))) for i, s in best], q


def test_keys_order_like_integers():
    values = sorted([0, 1, -1, 255, 256, -255, -256, 2**63, -(2**63), 10**400, -(10**400), 7, -7])
    assert sorted(values, key=topk.sort_key) == values


def test_threshold_stops_early():
    rng = np.random.default_rng(6)
    rows = np.floor(1024 * rng.normal(size=(3000, 4)))
    order = np.argsort(rows.T, axis=1, kind="stable").astype(np.int32)
    ids = np.arange(3000)
    found, scores, depth = topk.threshold_search(order, rows, ids, rows[5], 5, 10)
    best = sorted(((int(rows[i] @ rows[5]), -i) for i in range(3000) if i != 5), reverse=True)[:10]
    assert [(s, -i) for i, s in zip(found, scores, strict=True)] == best
    assert depth < 3000
    assert topk.threshold_search(order, rows, ids, rows[5], 5, 10, floor=scores[0] + 1.0)[2] <= depth
