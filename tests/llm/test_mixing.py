import math
import re
from collections import defaultdict

import numpy as np
import pandas as pd
import pytest

from almanac.llm.mixing import GROUP, LIMIT, _rounded, mix_sources, source_targets
from tests.conftest import rows

SCHEMA = "doc_id long, text string, source string"


def words(text):
    return len(re.findall("[^\x20\x09-\x0d]+", text or ""))


def filled(sizes, weights, limit=LIMIT):
    """Share, cap, and share what is over among the rest, until nothing is."""
    left, target = dict(sizes), {}
    rest = float(sum(sizes.values()))
    while left:
        unit = rest / sum(weights[s] for s in left)
        full = [s for s in left if limit * left[s] <= unit * weights[s]]
        if not full:
            return target | {s: unit * weights[s] for s in left}
        for s in full:
            target[s] = float(limit * left.pop(s))
            rest -= target[s]
    return target


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 100, "c": 100}, {"a": 1000, "b": 1, "c": 5, "d": 0}, {"a": 7}, {"a": 0}])
def test_targets(spark, sizes):
    df = spark.createDataFrame([(s, n, 1) for s, n in sizes.items()], "source string, size long, m long")
    found = {r.source: r.target for r in source_targets(df).collect()}
    expected = filled(sizes, {s: float(i % 3 + 1) for i, s in enumerate(sorted(sizes))})
    assert found.keys() == sizes.keys()
    for s in sizes:
        assert math.isclose(found[s], expected.get(s, 0.0), rel_tol=1e-9, abs_tol=1e-9)


def corpus(spark, n=3000):
    data = [(i, "w " * (i * 37 % 90 + 1), ("a", "b", "c", None)[0 if i % 3 == 0 else i % 4]) for i in range(n)]
    return spark.createDataFrame(data, SCHEMA)


def test_mix_meets_targets_and_limits(spark):
    docs = corpus(spark)
    found = mix_sources(docs).collect()
    assert len(found) == 3000
    taken, target, largest = defaultdict(int), {}, defaultdict(int)
    for r in found:
        assert r.taken == r.copies * r.size and r.taken <= LIMIT * r.size
        ratio = r.target / r.source_size
        assert math.floor(ratio + 1e-9) <= r.copies <= math.ceil(ratio - 1e-9)
        taken[r.source] += r.taken
        target[r.source] = r.target
        largest[r.source] = max(largest[r.source], r.size)
    for s in target:
        assert abs(taken[s] - target[s]) <= largest[s]
    assert math.isclose(sum(target.values()), sum(r.size for r in found))


def test_reruns_and_partitions_do_not_matter(spark):
    docs = corpus(spark, 500)
    first = rows(mix_sources(docs))
    assert rows(mix_sources(docs.repartition(7))) == first
    assert rows(mix_sources(docs, seed=18)) != first


def test_a_source_of_many_groups_goes_through_the_tree(spark, monkeypatch):
    monkeypatch.setattr("almanac.llm.mixing.GROUP", 20)
    found = mix_sources(corpus(spark)).collect()
    assert len(found) == 3000 and GROUP > 20
    for s in {r.source for r in found}:
        own = [r for r in found if r.source == s]
        assert abs(sum(r.taken for r in own) - own[0].target) <= max(r.size for r in own)


def test_probabilities_are_kept():
    units = pd.DataFrame({"unit": range(9), "doc_id": "1", "size": [5, 1, 9, 2, 2, 7, 3, 40, 1], "idx": 0, "bucket": 0, "p": [0.5, 0.2, 0.9, 0.4, 0.4, 0.1, 0.7, 0.3, 0.6]})
    runs = [_rounded(units, 0, seed, True).sort_values("unit") for seed in range(4000)]
    assert all(set(r["p"]) <= {0.0, 1.0} for r in runs)
    assert np.allclose(np.mean([r["p"] for r in runs], axis=0), units["p"], atol=0.03)
    left = _rounded(units, 0, 5, False)
    assert ((left["p"] > 0) & (left["p"] < 1)).sum() <= 1
    assert math.isclose((left["p"] * left["size"]).sum(), (units["p"] * units["size"]).sum())


def test_odd_rows(spark):
    data = [(1, None, "a"), (2, "", "a"), (None, "one two", "a"), (4, "x", None), (4, "x", None), (4, "x", None), (5, " \t\n", None)]
    docs = spark.createDataFrame(data, SCHEMA).selectExpr("*", "1 as size", "2 as taken", "3 as idx", "4 as `m`", "5 as bucket")
    found = mix_sources(docs)
    assert sorted((r.doc_id or 0, r.size) for r in found.collect()) == [(0, 2), (1, 0), (2, 0), (4, 1), (4, 1), (4, 1), (5, 0)]
    assert all(r.taken == 0 for r in found.collect() if r.size == 0)
    # One very long text, and an empty table.
    long = mix_sources(spark.createDataFrame([(1, "word " * 200_000, "a")], SCHEMA)).collect()
    assert (long[0].size, long[0].taken) == (200_000, 200_000)
    assert mix_sources(spark.createDataFrame([], SCHEMA)).collect() == []
