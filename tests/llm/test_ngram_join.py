import random
import re

import pytest

from almanac.llm import ngram_join
from almanac.llm.common import components
from almanac.llm.ngram_join import ngram_components
from tests.conftest import rows

SCHEMA = "doc_id long, text string"


def shingles(text, k=4):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall("[^\x20\x09-\x0d]+", lowered)
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def expected(docs):
    sets = [(d, shingles(t)) for d, t in docs]
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            a, b = sets[i][1], sets[j][1]
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (d, s) in enumerate(sets):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    out = [(d, len(s), least.get(find(i)) if s else d) for i, (d, s) in enumerate(sets)]
    return sorted(out, key=lambda r: tuple((v is not None, v) for v in r))


def check(spark, docs):
    found = rows(ngram_components(spark.createDataFrame(docs, SCHEMA)))
    assert found == expected(docs)
    return found


def varied(rng, base, edits):
    w = list(base)
    for _ in range(edits):
        w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
    return w


def corpus(seed, groups=12, size=8):
    """Near copies on both sides of the threshold, passages that many documents share, and short texts."""
    rng = random.Random(seed)
    shared = [f"s{i}" for i in range(45)]
    docs = []
    for _ in range(groups):
        base = [f"b{rng.randrange(10**6)}" for _ in range(rng.choice([6, 20, 60, 200, 230]))]
        if rng.random() < 0.5:
            base[len(base) // 2 : len(base) // 2] = shared
        for _ in range(size):
            w = varied(rng, base, rng.choice([0, 0, 1, 1, 2, 3, 5]))
            docs.append(" ".join(w[: len(w) - rng.choice([0, 0, 1, 4])]).replace("b", rng.choice("bB")))
    docs += [" ".join(f"t{rng.randrange(4)}" for _ in range(rng.randrange(6))) for _ in range(60)]
    rng.shuffle(docs)
    return list(enumerate(docs))


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    found = check(spark, corpus(seed))
    assert any(r[2] < r[0] for r in found) and any(r[2] == r[0] and r[1] > 10 for r in found)


def test_small_blocks_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 3)
    check(spark, corpus(3, groups=5, size=12))


def test_the_threshold_itself_links(spark):
    # 185 shared of 200: sets of 185 + k shingles each, built from one long run of words.
    run = [f"w{i}" for i in range(400)]
    for drop, linked in ((15, True), (16, False)):
        docs = [(1, " ".join(run[:103])), (2, " ".join(run[drop:103]))]
        assert (100 * (100 - drop) >= 85 * 100) == linked
        assert (check(spark, docs)[1][2] == 1) == linked


def test_a_chain_is_one_component(spark):
    run = [f"w{i}" for i in range(300)]
    docs = [(50 - k, " ".join(run[5 * k : 5 * k + 100])) for k in range(12)]
    found = check(spark, docs)
    assert {r[2] for r in found} == {39}


def test_many_copies_and_near_copies_make_no_pairs(spark):
    rng = random.Random(8)
    base = [f"b{i}" for i in range(120)]
    docs = [(i, " ".join(base)) for i in range(300)] + [(300 + i, " ".join(varied(rng, base, 1))) for i in range(300)]
    check(spark, docs)


def test_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, " \n\t"), (4, "a"), (5, "A"), (6, "a b c"), (7, "a b c"), (7, "a b c"), (None, "a"), (None, None), (8, "x " * 50_000), (9, "x " * 49_999)]
    check(spark, docs)
    assert rows(ngram_components(spark.createDataFrame([], SCHEMA))) == []
    clash = spark.createDataFrame([(1, "a b"), (2, "a b")], SCHEMA).selectExpr("*", "1 as fp", "2 as n", "3 as token", "4 as root", "5 as component_id")
    assert rows(ngram_components(clash)) == [(1, 1, 1), (2, 1, 1)]


def test_components_of_random_graphs(spark):
    rng = random.Random(2)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(130)] + [(i, i + 1) for i in range(300, 340)]
    found = dict(rows(components(spark.createDataFrame(links, "a long, b long"))))
    root = {}
    for a, b in links:
        root.setdefault(a, a), root.setdefault(b, b)
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(root[a], root[b])
            changed |= root[a] != low or root[b] != low
            root[a] = root[b] = low
    assert found == {k: v for k, v in root.items() if k in found}
    assert {k for a, b in links if a != b for k in (a, b)} == set(found)


def test_other_words_and_percentages(spark):
    run = [f"w{i}" for i in range(400)]
    near = [" ".join(run[:90]), " ".join([*run[:45], "other", *run[46:90]])]  # 5 words: 81 of 91; 4 words: 83 of 91
    far = [" ".join(run[100:149]), " ".join([*run[100:120], "other", *run[121:149]])]  # 5 words: 40 of 50; 4 words: 42 of 50
    docs = spark.createDataFrame(list(enumerate([*near, *far])), SCHEMA)
    for words, percent in ((4, 85), (5, 80), (5, 81)):
        found = {r[0]: r[2] for r in rows(ngram_components(docs, words, percent))}
        assert found == {0: 0, 1: 0, 2: 2, 3: 2 if percent == 80 else 3}


@pytest.mark.parametrize("words, percent", [(5, 80), (3, 60)])
def test_other_values_against_brute_force(spark, words, percent):
    docs = corpus(4, groups=6)
    found = rows(ngram_components(spark.createDataFrame(docs, SCHEMA), words, percent))
    sets = {d: shingles(t, words) for d, t in docs}
    root = {d: d for d in sets}
    for _ in range(len(docs)):
        links = [(a, b) for a in sets for b in sets if a < b and root[a] != root[b] and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
        for a, b in links:
            low, high = sorted((root[a], root[b]))
            root = {d: low if r == high else r for d, r in root.items()}
        if not links:
            break
    assert found == sorted((d, len(s), root[d]) for d, s in sets.items())
