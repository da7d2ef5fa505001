import numpy as np
import pytest

from almanac.llm import embeddings
from almanac.llm.embeddings import LEAST_COSINE, near_duplicates
from tests.conftest import rows


def expected(vectors):
    good = {}
    for i, (_, v) in enumerate(vectors):
        if v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            good[i] = np.asarray(v, np.float64) / np.linalg.norm(np.asarray(v, np.float64))
    n = len(vectors)
    link = [[i != j and i in good and j in good and len(good[i]) == len(good[j]) and float(good[i] @ good[j]) >= LEAST_COSINE for j in range(n)] for i in range(n)]
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            a = todo.pop()
            for j in range(n):
                if link[a][j] and j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [vectors[j][0] for j in seen if vectors[j][0] is not None]
        least = min(ids) if ids else None
        out.append((vectors[i][0], sum(link[i]), least, vectors[i][0] is not None and vectors[i][0] == least))
    return sorted(out, key=lambda r: tuple((v is not None, v) for v in r))


def corpus(seed, n=150, dim=16):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dim))
    out = []
    for i in range(n):
        v = centres[i % 6] + rng.normal(size=dim) * rng.choice([0.2, 0.3, 0.5])
        out.append((i * 3, [float(np.float32(x)) for x in v]))
    return out + [(1000 + i, out[i][1]) for i in range(20)] + [(1100 + i, [4 * x for x in out[i][1]]) for i in range(10)]


@pytest.mark.parametrize("kind", ["float", "double"])
def test_against_brute_force(spark, kind):
    vectors = corpus(1)
    found = rows(near_duplicates(spark.createDataFrame(vectors, f"vec_id long, embedding array<{kind}>")))
    assert found == expected(vectors)
    assert any(r[1] > 3 for r in found) and any(r[1] == 0 for r in found)


def test_small_blocks_and_few_pivots_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "BLOCK", 16)
    monkeypatch.setattr(embeddings, "PIVOTS", 3)
    vectors = corpus(2)
    assert rows(near_duplicates(spark.createDataFrame(vectors, "vec_id long, embedding array<float>"))) == expected(vectors)


def test_error_bounds_hold():
    rng = np.random.default_rng(3)
    unit = rng.normal(size=(300, 64))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    scale = np.abs(unit).max(axis=1) / 127
    q = np.rint(unit / scale[:, None])
    error = np.linalg.norm(unit - q * scale[:, None], axis=1)
    rough = (q @ q.T) * scale[:, None] * scale[None, :]
    assert (np.abs(rough - unit @ unit.T) <= error[:, None] + (1 + error[:, None]) * error[None, :] + 1e-12).all()


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [1.0, 0.0]), (7, [1.0, 0.0]), (8, [1e30, 1e-30]), (9, [1.0]), (10, [2.0]), (None, [1.0, 0.1]), (None, None), (11, [-0.0, 1.0]), (12, [0.0, 1.0]), (13, [1e-38, 0.0])]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    assert rows(near_duplicates(df.selectExpr("*", "1 as label", "2 as node", "3 as cell", "4 as links", "5 as kept"))) == expected(vectors)
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert rows(near_duplicates(empty)) == []
