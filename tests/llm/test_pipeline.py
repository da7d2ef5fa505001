"""Each stage against its operator by brute force, on documents with every kind of case."""

import random

import pytest

import corpus_pipeline
from tests.llm import test_decontaminate, test_lines, test_mixing, test_ngram_join

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Tables with toxic documents, copies and near copies, shared lines, benchmark passages and odd rows."""
    rng = random.Random(6)
    path = tmp_path_factory.mktemp("tables")

    def prose(n):
        return " ".join(f"w{chr(97 + rng.randrange(26))}{chr(97 + rng.randrange(26))}{rng.choice('xyz') * rng.randrange(3)}" for _ in range(n))

    items = [(i, prose(30)) for i in range(5)]
    docs, labels = [], []
    for i in range(400):
        text = prose(rng.randrange(30, 90))
        if i % 8 == 0:
            text += " grob " + prose(3)
        if i % 5 == 0:
            text += "\nthis line stands under many of the pages\n" + prose(20)
        if i % 11 == 0:
            text += " " + items[i % 5][1]
        if i >= 300:
            words = docs[i - 300][1].split(" ")
            words[len(words) // 2] += "q" * (i % 2)
            text = " ".join(words)
        docs.append((i, text, "en", f"src{i % 3}" if i % 7 else None, len(text)))
        labels.append((i, 1, int("grob" in text)))
    docs += [(900, None, None, None, None), (901, "", "en", "src0", 0), (902, "x", "en", "src1", 1), (902, "x", "en", "src1", 1), (903, prose(4000), "en", "src1", 9)]
    spark.createDataFrame(docs, SCHEMA).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


@pytest.fixture(scope="module")
def stages(spark, folder):
    """Rows that go into and come out of each stage."""
    docs, out = spark.read.parquet(f"{folder}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, folder)
        after.write.parquet(f"{folder}/after-{name.replace(' ', '-')}")
        after = spark.read.parquet(f"{folder}/after-{name.replace(' ', '-')}")
        out.append(([tuple(r) for r in docs.collect()], [tuple(r) for r in after.collect()], after.columns))
        docs = after
    return out


def key(row):
    return tuple((v is not None, v) for v in row)


def test_columns(stages):
    assert [s[2] for s in stages[:-1]] == [COLUMNS] * 4
    assert len(corpus_pipeline.STAGES) == 5


def test_toxic_documents_go_and_others_stay(stages):
    before, after, _ = stages[0]
    assert sorted(after, key=key) == sorted((r for r in before if "grob" not in (r[1] or "").split()), key=key)


def test_boilerplate_lines_go(stages):
    before, after, _ = stages[1]
    expected = test_lines.expected([r[:2] for r in before])
    assert sorted((r[:2] for r in after), key=key) == sorted((r[:2] for r in expected), key=key)
    assert any("many of the pages" in (r[1] or "") for r in before) and not any("many of the pages" in (r[1] or "") for r in after)


def test_one_of_each_group_stays(stages):
    before, after, _ = stages[2]
    sets = {r[0]: test_ngram_join.shingles(r[1], 5) for r in before}
    root = {d: d for d in sets}
    for _ in sets:
        links = [(a, b) for a in sets for b in sets if root[a] != root[b] and sets[a] and sets[b] and 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b])]
        if not links:
            break
        for a, b in links:
            low, high = sorted((root[a], root[b]))
            root = {d: low if r == high else r for d, r in root.items()}
    assert sorted(after, key=key) == sorted({r for r in before if root[r[0]] == r[0]}, key=key)
    assert len(after) < len(before)


def test_contaminated_documents_go(spark, folder, stages):
    before, after, _ = stages[3]
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    bad = {r[0] for r in test_decontaminate.expected([r[:2] for r in before], items) if r[5]}
    assert bad
    assert sorted(after, key=key) == sorted((r for r in before if r[0] not in bad), key=key)


def test_mix(stages):
    before, after, columns = stages[4]
    rows = [dict(zip(columns, r)) for r in after]
    assert sorted(r["doc_id"] for r in rows) == sorted(r[0] for r in before)
    sizes = {}
    for r in before:
        sizes[r[3]] = sizes.get(r[3], 0) + test_mixing.words(r[1])
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    targets = test_mixing.filled(sizes, {s: float(i % 3 + 1) for i, s in enumerate(names)})
    for s in sizes:
        own = [r for r in rows if r["source"] == s]
        assert abs(sum(r["taken"] for r in own) - targets[s]) <= max(r["size"] for r in own)


def test_run_applies_all_stages(spark, folder, stages):
    found = corpus_pipeline.run(spark, folder)
    assert sorted(map(tuple, found.collect()), key=key) == sorted(stages[-1][1], key=key)


def test_empty_tables(spark, folder):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, spark.createDataFrame([], SCHEMA), folder).count() == 0


def test_other_columns_travel_along(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(20)
    more = docs.selectExpr("*", "1 as n", "2 as score", "3 as k", "4 as size", "5 as `a.b`", "6 as gone", "7 as doc")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, more, folder).columns == more.columns


def test_near_copies_by_other_values(spark, folder):
    run = [f"w{i}" for i in range(49)]
    texts = [" ".join(run), " ".join([*run[:20], "other", *run[21:]])]  # 40 of 50 runs of 5 words, 42 of 50 of 4
    docs = spark.createDataFrame([(i, t, "en", "src0", len(t)) for i, t in enumerate(texts)], SCHEMA)
    assert [r.doc_id for r in corpus_pipeline.keep_one_of_each_group(spark, docs, folder).collect()] == [0]
    assert corpus_pipeline.keep_one_of_each_group(spark, docs, folder, 4, 85).count() == 2


def test_null_and_clashing_ids(spark, folder):
    """Texts that share an id, or have none, are judged each by itself."""
    rng = random.Random(9)
    item = spark.read.parquet(f"{folder}/benchmark.parquet").orderBy("item_id").first().text
    clean = [" ".join(f"v{rng.randrange(500)}" for _ in range(60)) for _ in range(3)]
    toxic = "wab wcd " + "grob " + clean[2]
    near = clean[0] + " more"
    texts = [(1, clean[0]), (1, item), (None, clean[1]), (None, item + " tail"), (None, clean[1]), (1, toxic), (None, toxic), (2, near), (None, near), (None, None), (None, ""), (None, "")]
    docs = spark.createDataFrame([(d, t, "en", "src0", 1) for d, t in texts], SCHEMA)

    def kept(stage, rows=docs):
        return sorted(((r.doc_id, r.text) for r in stage(spark, rows, folder).collect()), key=key)

    labelled = spark.read.parquet(f"{folder}/documents.parquet").filter("doc_id >= 3").unionByName(docs)
    ids = [(r.doc_id, r.text) for r in labelled.collect() if r.doc_id not in (1, 2, None)]
    after = [r for r in kept(corpus_pipeline.drop_toxic, labelled) if r[0] in (1, 2, None) and r not in ids]
    assert set(texts) - set(after) == {(1, toxic), (None, toxic)}
    assert kept(corpus_pipeline.drop_contaminated) == sorted((t for t in texts if item not in (t[1] or "")), key=key)
    # (1, clean) stands for (2, near) and (None, near); the copies without id and without words stay apart.
    expected = [(1, clean[0]), (1, item), (None, clean[1]), (1, toxic), (None, None), (None, ""), (None, "")]
    assert kept(corpus_pipeline.keep_one_of_each_group) == sorted(expected, key=key)
