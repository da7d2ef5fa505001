"""Ids and decoded texts against the library's own encoding of whole texts."""

import random

import numpy as np
import pytest

sentencepiece = pytest.importorskip("sentencepiece")
public_tokenizers = pytest.importorskip("public_tokenizers")

from almanac.llm import marked_words  # noqa: E402

MODEL = str(public_tokenizers.path("piece_bpe_32k.model"))
ODD = [
    None, "", " ", "  ", "a", " a", "a ", "a  ", "  a   b  ", "\n", "\n a\tb \n", "▁", "a▁b", "▁▁ x ▁", "<s>", "</s> <unk> <0x0A>",
    "\x00 \x01q", "日本語 テキスト", "🙂 🙂🙂", "é é Ñ", "   x", "� ￾", "﻿a", "don't  stop", "1234567 12,5",
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def expected(library, texts):
    ids = [library.encode(t or "", add_bos=True, add_eos=True) for t in texts]
    return [(i, library.decode(i)) for i in ids]


def check(spark, library, texts, **options):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4, "doc_id")
    found = marked_words.decode(marked_words.encode(docs, MODEL, **options), MODEL).collect()
    by_id = {r.doc_id: (np.frombuffer(r.ids, "<u4").tolist(), r.text) for r in found}
    assert len(found) == len(texts)
    assert [by_id[i] for i in range(len(texts))] == expected(library, texts)
    at_once = marked_words.encode(docs, MODEL, decoded=True, **options).collect()
    assert {r.doc_id: r.text for r in at_once} == {i: text for i, (_, text) in by_id.items()}


def test_odd_texts(spark, library):
    check(spark, library, ODD)


@pytest.mark.parametrize("size", [1, 7, 1000])
def test_mixed_texts(spark, library, size):
    rng = random.Random(size)
    parts = [*(t for t in ODD if t), "the", "of", "banana", "\n", " ", "x" * 30, "q7&&", "straße"]
    check(spark, library, [rng.choice(["", " ", "  "]).join(rng.choice(parts) for _ in range(rng.randrange(60))) for _ in range(300)], table_size=size)


def test_long_texts_and_small_blocks(spark, library):
    rng = random.Random(3)
    words = ["alpha", "beta", "gamma", "", "δ"]
    check(spark, library, ["y" * 5000, " ".join(rng.choice(words) for _ in range(20000)), *(" ".join(rng.choice(words) for _ in range(30)) for _ in range(50))], block_size=100)


def test_the_table_has_the_most_frequent_words_once(spark, library):
    long = "z" * (marked_words.LONGEST + 1)
    docs = spark.createDataFrame([(i, f"the same words {i % 3} {long} the  x ") for i in range(90)] + [(90, "once")], "doc_id long, text string")
    found = marked_words.word_table(docs.repartition(5), MODEL).collect()
    assert sorted(r.word for r in found) == sorted({"the", "same", "words", "0", "1", "2", " x", ""})
    assert {r.word: list(r.ids) for r in found}["same"] == library.encode("same")
    assert [r.word for r in marked_words.word_table(docs, MODEL, size=1).collect()] == ["the"]


def test_repeated_rows_null_ids_and_other_columns(spark, library):
    rows = [(1, "a b", 0, "x"), (1, "a b", 0, "x"), (None, "c", 1, None), (None, None, 1, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, word int, ids string").coalesce(1)
    found = marked_words.encode(docs, MODEL)
    assert found.columns == ["doc_id", "ids"]
    got = sorted((r.doc_id or 0, np.frombuffer(r.ids, "<u4").tolist()) for r in found.collect())
    assert got == sorted((r[0] or 0, e[0]) for r, e in zip(rows, expected(library, [r[1] for r in rows])))


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert marked_words.decode(marked_words.encode(docs, MODEL), MODEL).count() == 0


def test_null_ids_decode_to_null(spark):
    rows = spark.createDataFrame([(1, None), (2, bytearray(np.array([1, 2], "<u4").tobytes()))], "doc_id long, ids binary")
    assert [tuple(r)[2] for r in marked_words.decode(rows, MODEL).orderBy("doc_id").collect()] == [None, ""]


def test_models_whose_pieces_cross_markers_are_refused(monkeypatch):
    class Crossing:
        def get_piece_size(self):
            return 2

        def id_to_piece(self, i):
            return ["▁a", "a▁b"][i]

    monkeypatch.setattr(marked_words, "_tokenizer", lambda model: Crossing())
    with pytest.raises(ValueError, match="cross"):
        marked_words.check_model("any")
