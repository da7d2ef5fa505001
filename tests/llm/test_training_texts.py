"""What the classifiers are trained on: bounded texts, one per id."""

import pytest

from almanac.llm.common import training_texts

CHOSEN = [(i, i % 2) for i in range(10)]


def frames(spark, docs):
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(CHOSEN, "doc_id long, bad int")


def test_one_text_per_id_and_no_long_ones_beside_short_ones(spark):
    docs, chosen = frames(spark, [(1, f"copy {i}") for i in range(500)] + [(2, "two"), (3, "l" * 50), (4, None), (None, "x"), (77, "y")])
    assert training_texts(docs, chosen, "bad", 20) == [(0, 2, "two"), (1, 1, "copy 0")]


def test_stretches_of_long_texts_where_a_class_has_no_other(spark):
    long = {i: "".join(chr(97 + (i + j) % 26) for j in range(300 + i)) for i in (1, 2, 3)}
    docs, chosen = frames(spark, [*long.items(), (5, "short")])
    found = training_texts(docs, chosen, "bad", 20)
    assert [r[:2] for r in found] == [(0, 2), (1, 1), (1, 3), (1, 5)]
    assert all(len(t) == 20 and t in long[i] for _, i, t in found[:3]) and found[3][2] == "short"


def test_a_warning_if_there_is_nothing_to_learn(spark):
    docs, chosen = frames(spark, [(1, "one"), (3, "three")])
    with pytest.warns(UserWarning, match="nothing is learned"):
        training_texts(docs, chosen, "bad", 20)
