import hashlib
import random
import re

from almanac.llm.decontaminate import decontaminate
from tests.conftest import rows

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered)


def expected(docs, items, window=13):
    out = []
    grams = [(str(i), tuple(w[s : s + min(len(w), window)])) for i, t in items if (w := words(t)) for s in range(len(w) - min(len(w), window) + 1)]
    for doc_id, text in docs:
        w, hit, ids = words(text), set(), set()
        for i, g in grams:
            for s in range(len(w) - len(g) + 1):
                if tuple(w[s : s + len(g)]) == g:
                    hit |= set(range(s, s + len(g)))
                    ids.add(i)
        sha = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(ids), sha, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=lambda r: tuple((v is not None, v) for v in r))


def check(spark, docs, items):
    found = rows(decontaminate(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)))
    assert found == expected(docs, items)
    return found


def test_against_brute_force(spark):
    rng = random.Random(4)
    vocabulary = ["the", "of", "é", "x1", "straße", *[f"w{i}" for i in range(12)]]

    def text(n):
        return rng.choice([" ", ", ", "\n"]).join(rng.choice(vocabulary) for _ in range(n))

    items = [(i, text(rng.choice([1, 3, 12, 13, 14, 30]))) for i in range(25)]
    docs = []
    for d in range(60):
        part = words(items[rng.randrange(25)][1])
        a = rng.randrange(len(part))
        docs.append((d, text(rng.randrange(60)) + " " + " ".join(part[a:]) + " " + text(rng.randrange(300))))
    # Words of no item around a short passage of one, and none of it.
    other = [f"o{i}" for i in range(400)]
    docs += [(100 + d, " ".join([*other[d:], *words(items[d][1])[:13], *other[:d]])) for d in range(20)] + [(200, " ".join(other))]
    found = check(spark, docs, items)
    assert any(r[5] for r in found) and any(r[2] and not r[5] for r in found) and any(not r[2] for r in found)


def test_shares_at_the_limit(spark):
    item = " ".join(f"i{k}" for k in range(13))
    docs = [(1, item + " z" * 247), (2, item + " z" * 248), (3, " ".join(item.split()[:12])), (4, item.upper().replace(" ", "\x00"))]
    found = {r[0]: r for r in check(spark, docs, [(9, item), (10, item.title())])}
    assert (found[1][5], found[2][5], found[3][2], found[4][5]) == (True, False, 0, True)
    assert found[1][3] == 2


def test_ends_and_overlaps(spark):
    item = " ".join(f"i{k}" for k in range(20))
    part = item.split()
    docs = [(1, " ".join(part[7:])), (2, "a " + " ".join(part[:13])), (3, " ".join(part[:13] + part)), (4, " ".join(part * 3)), (5, " ".join(part[:12] + ["x"] + part[13:]))]
    check(spark, docs, [(1, item)])


def test_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, "--- !!"), (None, "a b"), (None, "a b"), (5, "a b"), (5, "a b"), (5, "c"), (6, "q " * 100_000 + "a b")]
    items = [(1, "A b"), (1, "a B"), (2, None), (3, ""), (None, "c"), (4, "."), (10, "a b")]
    found = decontaminate(spark.createDataFrame(docs, DOCS).selectExpr("*", "1 as n_words", "2 as iid", "3 as text_hash", "4 as pos"), spark.createDataFrame(items, ITEMS).selectExpr("*", "1 as m", "2 as words"))
    expect = expected(docs, [(i, t) for i, t in items if i is not None])
    assert [r for r in rows(found) if r[0] != 5 or r[1] == 2] == [r for r in expect if r[0] != 5 or r[1] == 2]
    assert len(rows(found)) == len(docs)
    empty = spark.createDataFrame([], DOCS)
    assert rows(decontaminate(empty, spark.createDataFrame(items, ITEMS))) == []
    assert rows(decontaminate(spark.createDataFrame([(1, "a")], DOCS), spark.createDataFrame([], ITEMS))) == expected([(1, "a")], [])
