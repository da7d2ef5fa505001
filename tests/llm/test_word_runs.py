"""Runs against a search of every stretch and period, on small texts."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from almanac.llm import word_runs


def brute_runs(words, least=12):
    """(start, length, period) of all runs, each period by itself."""
    n, stretches = len(words), {}
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            if words[i] != words[i + p]:
                i += 1
                continue
            a = i
            while i + p < n and words[i] == words[i + p]:
                i += 1
            if i + p - a >= max(least, 2 * p):
                stretches.setdefault((a, i + p - a), p)  # the smallest period comes first
    return sorted((a, length, p) for (a, length), p in stretches.items())


def collapsed(words, runs):
    gone = {k for a, length, p in runs for k in range(a + p, a + length)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def expected(rows, least=12):
    out = []
    for doc_id, text in rows:
        words = split(text)
        runs = brute_runs(words, least)
        out.append((doc_id, runs, collapsed(words, runs)))
    return out


def check(spark, rows, least=12):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = [(r.doc_id, [tuple(x) for x in r.runs], r.text) for r in word_runs.collapse_runs(docs, least).collect()]
    key = lambda r: (r[0] is not None, r[0] or 0, r[2])
    want = expected(rows, least)
    assert sorted(found, key=key) == sorted(want, key=key)
    return want


def noisy(rng, n, letters):
    """Words with nested and broken repetitions."""
    words = []
    while len(words) < n:
        unit = [rng.choice(letters) for _ in range(rng.randrange(1, 9))]
        for _ in range(rng.randrange(1, 7)):
            words += unit
            if rng.random() < 0.15:
                words[-1] = rng.choice(letters)
        if rng.random() < 0.2:
            words += words[-rng.randrange(1, 1 + len(words)) :]
    return words[:n]


@pytest.mark.parametrize("letters", ["a", "ab", "abcdef"])
@pytest.mark.parametrize("least", [2, 12])
def test_small_texts(spark, letters, least):
    rng = random.Random(letters)
    found = check(spark, [(i, " ".join(noisy(rng, rng.randrange(0, 120), letters))) for i in range(250)], least)
    assert any(len(r[1]) > 1 for r in found) or letters == "a"


def test_long_periods_across_the_cover(spark):
    rng = random.Random(5)
    rows = []
    for i in range(12):
        unit = [f"w{rng.randrange(50)}" for _ in range(rng.randrange(20, 400))]
        rows.append((i, "x y " + " ".join(unit * rng.randrange(2, 5)) + " " + " ".join(unit[: rng.randrange(len(unit))])))
    assert any(p > 100 for r in check(spark, rows) for _, _, p in r[1])


def test_odd_rows(spark):
    rows = [(None, None), (1, ""), (1, " \n\t"), (2, "a " * 11), (2, "a " * 12), (2, "a " * 12), (3, "a a " * 12), (4, "é\x0b\x0cé\r" * 9), (5, "A a " * 12)]
    check(spark, rows)


def test_texts_share_no_runs_and_sequences_may_be_short(monkeypatch):
    monkeypatch.setattr(word_runs, "SEQUENCE", 50)
    monkeypatch.setattr(word_runs, "PAIRS", 7)
    rows = [(i, "a " * n) for i, n in enumerate([5, 6, 7, 11, 12, 13, 100, 3, 40, 12, 12])]
    texts = [t for _, t in rows]
    found = [x for first, part in word_runs._sequences(texts) for x in word_runs._collapsed(part, 12)]
    assert [([tuple(r.values()) for r in runs], text) for runs, text in found] == [r[1:] for r in expected(rows)]
    assert len(list(word_runs._sequences(texts))) > 3


def test_many_words(spark):
    """300,000 words in one text: a period of 7 within, and one of 100,000."""
    rng = random.Random(1)
    unit = [f"w{rng.randrange(30000)}" for _ in range(100_000)]
    unit[500:571] = (["a", "b", "c", "d", "e", "f", "g"] * 11)[:71]
    docs = spark.createDataFrame([(1, " ".join(unit * 3))], "doc_id long, text string")
    (row,) = word_runs.collapse_runs(docs).collect()
    assert (0, 300_000, 100_000) in [tuple(r) for r in row.runs]
    assert [tuple(r) for r in row.runs if r.period == 7] == [(k * 100_000 + 500, 71, 7) for k in range(3)]
    assert row.text.split(" ") == [w for k, w in enumerate(unit) if not 507 <= k < 571]


def test_extensions_against_words_one_by_one():
    rng = random.Random(2)
    for letters in (1, 2, 5):
        sequence = np.array([rng.randrange(letters) for _ in range(300)] * 2 + [9])
        ahead = word_runs.Extensions(sequence)
        i = np.array([rng.randrange(601) for _ in range(3000)])
        j = np.array([rng.randrange(601) for _ in range(3000)])
        i, j = i[i != j], j[i != j]
        plain = []
        for a, b in zip(i.tolist(), j.tolist()):
            k = 0
            while max(a, b) + k < 601 and sequence[a + k] == sequence[b + k]:
                k += 1
            plain.append(k)
        assert ahead(i, j).tolist() == plain


def test_other_columns_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "b " * 14, 1, 2)], "doc_id long, text string, runs int, start int")
    found = word_runs.collapse_runs(docs)
    assert found.columns == ["doc_id", "runs", "text"]
    assert [tuple(r.runs[0]) for r in found.collect()] == [(0, 14, 1)]
    assert word_runs.collapse_runs(docs.limit(0)).count() == 0


def contract(doc_id, text):
    """The query's row, by its contract."""
    words, h = split(text), zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words)
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    top = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *top, digest("".join(f"{a},{m},{p}\n" for a, m, p in runs)), digest(collapsed(words, runs)))


def test_query(spark, tmp_path):
    rng = random.Random(8)
    rows = [(i, " ".join(noisy(rng, rng.randrange(0, 80), "abcdefgh"))) for i in range(300)] + [(900, None), (901, ""), (902, "\ta\n"), (903, "q  r")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = word_runs.op12_word_runs(spark, str(tmp_path))
    assert found.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert [t for _, t in found.dtypes] == ["bigint"] * 6 + ["string"] * 2
    assert sorted(map(tuple, found.collect())) == sorted(contract(*r) for r in rows)
    assert sum(zlib.crc32(str(r[0]).encode()) % 10 == 0 for r in rows) > 20
