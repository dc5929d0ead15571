import gc
import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from nocturne.llm import pieces
from nocturne.llm.pieces import PieceModel, encode_documents
from nocturne.llm.queries import op1_sentencepiece, tokenizer_file


@pytest.fixture(scope="module")
def model():
    return PieceModel(tokenizer_file())


def test_agenda_equals_the_library_on_random_texts(model):
    rng = random.Random(3)
    alphabet = "ab the ing \u2581\n\t\x00éß漢字😀<s>0A  tion-_."
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 120))) for _ in range(800)]
    texts += ["", " ", "   ", "a" * 400, " " * 200, "lalala" * 200, "\u2581" * 40, "no" + " " * 30 + "end "]
    ids = model.encode(texts)
    model.check(texts, ids)
    assert model.decode(ids) == [t.replace("\u2581", " ") for t in texts]


def test_long_chunks_take_the_heap(model):
    text = "unbroken" * 300
    assert model.encode([text]) == [model.library.encode(text)]


def test_the_store_is_bounded_and_holds_no_long_chunk(model, monkeypatch):
    monkeypatch.setattr(pieces, "CACHE", 300)
    rng = random.Random(4)
    han = [chr(0x4E00 + i) for i in range(9000)]
    for _ in range(12):
        texts = ["".join(rng.choices(han, k=400)) for _ in range(5)] + [" ".join(f"w{rng.randint(0, 400)}" for _ in range(150)), "same words here"]
        ids = model.encode(texts)
        model.check(texts, ids)
        assert len(model.kept) <= 300 and max(map(len, model.kept), default=0) <= pieces.SHORT and not model.kept.long
    monkeypatch.setattr(pieces, "CACHE", 2)
    model.check(["more than two chunks in here"] * 2, model.encode(["more than two chunks in here"] * 2))
    assert len(model.kept) == 0


def test_collections_go_on_after_a_task(docs, monkeypatch):
    class Docs:
        schema = docs.schema
        select = lambda self, *_: self
        mapInArrow = lambda self, run, _: run

    run = encode_documents(Docs(), tokenizer_file())
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array(["a text"])], ["doc_id", "text"])
    assert len(list(run(iter([batch])))) == 1 and gc.isenabled() and gc.get_freeze_count() == 0
    run(iter([batch])).close()
    assert gc.isenabled()


def test_the_library_is_asked_once_about_each_text(monkeypatch):
    asked = PieceModel(tokenizer_file())
    monkeypatch.setitem(pieces._models, tokenizer_file(), asked)
    library, seen = asked.library, []

    class Counting:
        def encode(self, texts, **options):
            seen.extend(texts)
            return library.encode(texts, **options)

        decode = staticmethod(library.decode)

    class Docs:
        schema = None
        select = lambda self, *_: self
        mapInArrow = lambda self, run, _: run

    asked.library = Counting()
    texts = ["new words in a text", "", "  spaces  at both ends ", " ", "\u2581 ", "word\u2581", "x" * 100 + " long", "words in a text"]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    out = pa.Table.from_batches(list(encode_documents(Docs(), tokenizer_file(), keep=(), with_ids=True)(iter([batch]))))
    assert seen == texts and out["ids"].to_pylist() == [library.encode(t) for t in texts]


def test_columns_merge_apart(model):
    """Chunks of all lengths in one group: each leaves when its own agenda is empty."""
    rng = random.Random(5)
    chunks = ["".join(rng.choices("eainthors é.,\n漢", k=n)).replace(" ", "s") for n in range(pieces.SHORT + 1) for _ in range(40)] + ["", " ", "   x"]
    got = {}
    for names, n, ids in model._matrix(list(dict.fromkeys(chunks))):
        ends = np.cumsum(n)
        got |= {c: ids[end - k : end].tolist() for c, k, end in zip(names, n.tolist(), ends.tolist(), strict=True)}
    assert got == {c: model._ids(" " + c, model._heap(" " + c)) for c in chunks}


def test_a_wrong_chunk_raises(monkeypatch):
    wrong = PieceModel(tokenizer_file())
    wrong.score = wrong.score.copy()
    wrong.score[: len(wrong.piece_id)] *= -1.0  # the agenda's order turned round
    with pytest.raises(AssertionError, match="differ"):
        wrong.encode(["international understanding of words"])
    wrong.kept.trim(np.zeros(0, np.int64))
    with pytest.raises(AssertionError, match="differ"):
        wrong.encode(["x" + "international" * 20])


def test_a_wrong_id_in_a_batch_raises(model, monkeypatch):
    texts = ["first text", "second text"]
    ids = model.encode(texts)
    ids[1][-1] += 1
    with pytest.raises(AssertionError, match="second"):
        model.check(texts, ids)


def test_a_difference_raises(model):
    with pytest.raises(AssertionError):
        model.check(["some text"], [[5]])


def test_edge_rows(spark, docs, no_docs, model):
    rows = encode_documents(docs, tokenizer_file(), with_ids=True, with_text=True).collect()
    assert len(rows) == docs.count()
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in rows:
        ids = model.library.encode(texts[r.doc_id] or "")
        assert r.ids == ids and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(model.library.decode(ids).encode()).hexdigest()
    assert encode_documents(no_docs, tokenizer_file()).count() == 0


def test_query_over_a_table(spark, sf_dir, model):
    rows = op1_sentencepiece(spark, sf_dir).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    assert all(r.n_tokens == len(model.library.encode(texts[r.doc_id])) for r in rows)
