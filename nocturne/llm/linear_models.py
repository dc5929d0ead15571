"""Two text classifiers: naive Bayes support vectors for quality, Nyström string kernels for language.

Both are fitted in one executor task on a bounded sample of labelled rows (a documented parameter;
the rows of least hash, so that the sample does not depend on partitions), and the fitted model, a
few MB whatever the corpus, is shipped with the scoring closure. Scoring is a narrow map over Arrow
batches of whole texts.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import make_room
from .textbytes import buffers, ngram_codes, slices, word_hashes

QUALITY_BITS, QUALITY_ORDERS, QUALITY_SAMPLE = 18, (1, 2, 3, 4), 6000
LANGUAGE_SAMPLE, LANDMARKS = 3000, 128
SPECTRUM = {1: 8, 2: 11, 3: 12}  # n-gram length: hash bits


def fold_of(doc_id: Column, n: int) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % n


def bounded_sample(labels: DataFrame, docs: DataFrame, bound: int, label: str) -> DataFrame:
    """doc_id, text and ``label`` of the ``bound`` labelled ids of least hash (doc_id breaks ties), one row an id.

    Ids are chosen first, from the narrow ``labels`` (doc_id, label) and below a hash that leaves half
    as many again; at most ``bound`` of them are then broadcast to the texts, so no text is shuffled
    but those of the sample. Where ``docs`` has the label itself, text and label are those of one row.
    An id with several labels or texts takes the least label and, of the rows with it, the text of
    least hash: rows that repeat an id, however many, add nothing to the sample. Null ids are left out.
    """
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40))
    known = labels.where(f"doc_id is not null and {label} is not null")
    n = known.agg(F.approx_count_distinct("doc_id", 0.02).alias("n")).first()["n"]
    below = (1 << 40) if n <= 2 * bound else int((1 << 40) * (1.5 * bound / n))
    ids = known.where(place < below).groupBy("doc_id").agg(F.min(label).alias(label)).orderBy(place, "doc_id").limit(bound)
    on = ["doc_id", label] if label in docs.columns else ["doc_id"]
    rows = docs.select("text", *on).where("text is not null").join(F.broadcast(ids), on)
    return rows.groupBy("doc_id", label).agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")).select("doc_id", "text", label)


def _fit_on_executor(sample: DataFrame, fit, label: str) -> bytes:
    """Runs ``fit(texts, labels)`` in one task over the bounded sample and returns the pickled model."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [pa.Table.from_batches([b]) for b in batches]
        rows = pa.concat_tables(got).sort_by([("doc_id", "ascending")]) if got else None
        texts = rows.column("text").combine_chunks() if rows is not None else pa.array([], pa.string())
        labels = rows.column(label).to_pylist() if rows is not None else []
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit(texts, labels))], pa.binary())], ["model"])

    model = sample.select("doc_id", "text", label).repartition(1).mapInArrow(run, "model binary").first()
    return bytes(model["model"]) if model else pickle.dumps(fit(pa.array([], pa.string()), []))  # without rows no task may run


# ---- naive Bayes support vectors -------------------------------------------------------------


def _codes_of(names: list[str]) -> np.ndarray:
    return np.array([int(ngram_codes(np.frombuffer(f"\0{n}".encode(), np.uint8), (len(n) + 1,), QUALITY_BITS)[0]) for n in names])


RUNS = (2, 3, 4, 6, 10)  # lengths of runs of one word that have an indicator of their own
_RUN_CODES, _VARIETY_CODES = _codes_of([f"run{n}" for n in RUNS]), _codes_of([f"variety{n}" for n in range(11)])


def repetition(words: np.ndarray) -> np.ndarray:
    """Codes of the word n-grams w w ... w up to the longest run, and of the tenth of distinct words."""
    if not len(words):
        return np.zeros(0, np.int64)
    edges = np.flatnonzero(np.concatenate([[True], words[1:] != words[:-1], [True]]))
    longest = int(np.diff(edges).max())
    variety = 10 * len(np.unique(words)) // len(words)
    return np.concatenate([_RUN_CODES[: int(np.searchsorted(RUNS, longest, "right"))], _VARIETY_CODES[variety : variety + 1]])


def indicators(texts: pa.Array) -> Iterator[np.ndarray]:
    """Sorted distinct hashed byte n-grams of each whole text, with the codes of its repeated words."""
    data, offsets = buffers(texts)
    seen = np.zeros(1 << QUALITY_BITS, bool)
    for lo, hi in zip(offsets[:-1], offsets[1:], strict=True):
        for at in range(int(lo), max(int(hi), int(lo) + 1), 1 << 18):  # long texts by overlapping windows
            seen[ngram_codes(data[at : min(int(hi), at + (1 << 18) + max(QUALITY_ORDERS) - 1)], QUALITY_ORDERS, QUALITY_BITS)] = True
        seen[repetition(word_hashes(data[lo:hi])[0])] = True
        found = np.flatnonzero(seen)
        seen[found] = False
        yield found.astype(np.int32)


def fit_support_vectors(texts: pa.Array, labels: list[int], cost: float = 1.0, epochs: int = 12, smooth: float = 1.0, seed: int = 7) -> dict:
    """Log-count ratios, then hinge loss by dual coordinate descent on the scaled indicators.

    With one class or no rows the ratios are zero and the score is the smoothed share of label 1.
    """
    size = 1 << QUALITY_BITS
    rows = list(indicators(texts))
    y = np.where(np.array(labels, float) > 0, 1.0, -1.0) if labels else np.zeros(0)
    count = {c: np.full(size, smooth) for c in (1.0, -1.0)}
    for x, c in zip(rows, y, strict=True):
        count[c][x] += 1
    ratio = np.log(count[1.0] / count[1.0].sum()) - np.log(count[-1.0] / count[-1.0].sum())
    prior = float(np.log(((y > 0).sum() + 1.0) / ((y < 0).sum() + 1.0)))
    if not ((y > 0).any() and (y < 0).any()):
        return {"w": np.zeros(size, np.float32), "slope": 1.0, "shift": prior}
    values = [ratio[x] / max(np.sqrt((ratio[x] ** 2).sum()), 1e-9) for x in rows]
    w, b, alpha = np.zeros(size), 0.0, np.zeros(len(rows))
    upper = np.where(y > 0, cost * len(y) / (2 * (y > 0).sum()), cost * len(y) / (2 * (y < 0).sum()))
    random = np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in random.permutation(len(rows)):
            x, v = rows[i], values[i]
            gradient = y[i] * (v @ w[x] + b) - 1.0
            new = min(max(alpha[i] - gradient / 2.0, 0.0), upper[i])  # each row has squared length 1 and bias input 1
            if step := new - alpha[i]:
                w[x] += step * y[i] * v
                b += step * y[i]
                alpha[i] = new
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    margin = np.array([v @ w[x] + b for x, v in zip(rows, values, strict=True)])
    slope, shift = _platt(margin, y)
    return {"w": (w * ratio).astype(np.float64), "r2": ratio**2, "b": b, "slope": slope, "shift": shift}


def _platt(margin: np.ndarray, y: np.ndarray, rounds: int = 60) -> tuple[float, float]:
    """Slope and shift of a logistic curve over the margins, by Newton's method with smoothed targets."""
    n1, n0 = (y > 0).sum(), (y < 0).sum()
    target = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, c = 1.0, 0.0
    x = np.stack([margin, np.ones_like(margin)], 1)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a * margin + c, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2), x.T @ (p - target) + 1e-3 * np.array([a - 1.0, c]))
        a, c = a - step[0], c - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(max(a, 1e-3)), float(c)


def quality_scores(model: dict, texts: pa.Array) -> np.ndarray:
    out = np.empty(len(texts))
    for i, x in enumerate(indicators(texts)):
        margin = 0.0
        if "r2" in model:
            margin = model["w"][x].sum() / max(np.sqrt(model["r2"][x].sum()), 1e-9) + model["b"]
        out[i] = 1 / (1 + np.exp(-np.clip(model["slope"] * margin + model["shift"], -30, 30)))
    return out


def score_quality(docs: DataFrame, labels: DataFrame, keep: tuple[str, ...] = ("doc_id",), bound: int = QUALITY_SAMPLE) -> DataFrame:
    """``keep`` columns and score of each row of docs, by a model of the docs in ``labels`` (doc_id, quality).

    Null and empty texts have no n-gram and score by the bias alone; texts of any length are read
    whole. Labels that are null or whose document has no text are left out; with one class or none, every
    score is the smoothed share of label 1. Repeated rows stay; the sample has one row an id, whatever
    repeats. A null doc_id is scored and never learned from (the query's held_out is null there).
    """
    sample = bounded_sample(labels.select("doc_id", "quality"), docs.select("doc_id", "text"), bound, "quality")
    fitted = docs.sparkSession.sparkContext.broadcast(pickle.loads(_fit_on_executor(sample, fit_support_vectors, "quality")))
    out = ", ".join([*(docs.schema[c].simpleString().replace(":", " ", 1) for c in keep), "score double"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(len(keep))
            score = np.concatenate([np.zeros(0), *(quality_scores(fitted.value, text.slice(lo, hi - lo)) for lo, hi in slices(text))])
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(score, pa.float64())], [*keep, "score"])

    return docs.select(*keep, "text").mapInArrow(run, out)


# ---- string kernels for language -------------------------------------------------------------

_LETTERS = np.full(256, 0x20, np.uint8)
_LETTERS[97:123] = np.arange(97, 123)
_LETTERS[128:] = np.arange(128, 256)
_WIDTH = sum(1 << b for b in SPECTRUM.values())


def presence(texts: list[str]) -> np.ndarray:
    """Row per text, column per hashed n-gram: the presence vectors of the blended spectrum.

    Lower-cased whole texts; bytes that are no ASCII letter nor part of a longer character count as
    spaces. Each n-gram length has its own columns and is scaled so that a row's inner product with
    itself is 1 over the lengths present: inner products are the blended kernel.
    """
    out = np.zeros((len(texts), _WIDTH), np.float32)
    for i, t in enumerate(texts):
        base = 0
        data = _LETTERS[np.frombuffer(f" {t.lower()} ".encode("utf-8", "replace"), np.uint8)]
        data = data[np.concatenate([[True], (data[1:] != 0x20) | (data[:-1] != 0x20)])]
        for n, bits in SPECTRUM.items():
            block = out[i, base : base + (1 << bits)]
            for at in range(0, max(1, len(data) - n + 1), 1 << 18):
                block[ngram_codes(data[at : at + (1 << 18) + n - 1], (n,), bits)] = 1.0
            block *= np.float32(1 / np.sqrt(len(SPECTRUM) * max(1.0, float(block.sum()))))
            base += 1 << bits
    return out


def fit_kernel(texts: pa.Array, labels: list[str], landmarks: int = LANDMARKS, ridge: float = 1e-3, seed: int = 11) -> dict:
    """Landmarks drawn evenly over the classes; one-versus-rest ridge regression in their span."""
    names = sorted(set(labels))
    if not names:
        return {"names": [], "landmarks": np.zeros((0, _WIDTH), np.float32), "weights": np.zeros((0, 0), np.float32)}
    texts, labels = texts.to_pylist(), np.array([names.index(x) for x in labels])
    random, chosen = np.random.default_rng(seed), []
    for c in range(len(names)):
        of = np.flatnonzero(labels == c)
        chosen.extend(random.permutation(of)[: max(1, landmarks // len(names))])
    marks = presence([texts[i] for i in chosen])
    kernel = np.concatenate([presence(texts[lo : lo + 256]) @ marks.T for lo in range(0, len(texts), 256)]).astype(np.float64)
    among = (marks @ marks.T).astype(np.float64)
    wanted = np.where(labels[:, None] == np.arange(len(names)), 1.0, -1.0)
    balance = (len(labels) / (len(names) * np.bincount(labels, minlength=len(names))))[labels][:, None]
    system = kernel.T @ (kernel * balance) + ridge * len(texts) * among + 1e-6 * np.eye(len(chosen))
    weights = np.linalg.solve(system, kernel.T @ (wanted * balance))
    return {"names": names, "landmarks": marks, "weights": weights.astype(np.float32)}


def predict_language(docs: DataFrame, labels: DataFrame, keep: tuple[str, ...] = ("doc_id",), bound: int = LANGUAGE_SAMPLE) -> DataFrame:
    """``keep`` columns, lang_pred and score of each row of docs, by a model of the docs in ``labels`` (doc_id, lang).

    ``und`` with score 0 where the text is null or has no letter, and everywhere if nothing could be
    learned. The score is the softmax share of the winning class; equal outputs go to the class
    first in code-point order. Whole texts of any length; repeated rows stay, but an id is learned
    once, with text and label of one row where ``docs`` has ``lang``. A null doc_id is predicted and
    never learned from (the query's held_out is null there).
    """
    same_rows = docs.select("doc_id", "text", *["lang"] * ("lang" in docs.columns))
    sample = bounded_sample(labels.select("doc_id", "lang"), same_rows, bound, "lang")
    fitted = docs.sparkSession.sparkContext.broadcast(pickle.loads(_fit_on_executor(sample, fit_kernel, "lang")))
    out = ", ".join([*(docs.schema[c].simpleString().replace(":", " ", 1) for c in keep), "lang_pred string", "score double"])

    def label(texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        model = fitted.value
        if not model["names"]:
            return ["und"] * len(texts), np.zeros(len(texts))
        outputs = presence([t or "" for t in texts]) @ model["landmarks"].T @ model["weights"]
        share = np.exp(4.0 * (outputs - outputs.max(1, keepdims=True)).astype(np.float64))
        best, top = outputs.argmax(1), share.max(1) / share.sum(1)
        none = np.array([t is None or not _has_letter(t) for t in texts], bool)
        return ["und" if x else model["names"][b] for x, b in zip(none, best, strict=True)], np.where(none, 0.0, top)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make_room()
        for batch in batches:
            for lo in range(0, len(batch), 256):
                part = batch.slice(lo, 256)
                names, score = label(part.column(len(keep)).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], pa.array(names, pa.string()), pa.array(score, pa.float64())], [*keep, "lang_pred", "score"])

    return docs.select(*keep, "text").mapInArrow(run, out)


def _has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))
