"""Ranked lexical search: bit-sliced signatures bound every document's score, exact counts rank what is left."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from hashlib import blake2b
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from almanac.llm.common import mixed, table
from almanac.sources.shared import materialise, scratch, shared_path

#: Documents of an item's answer.
TOP = 50
#: Documents of a block of signatures; those of a block have equally many entries up to a factor of two.
BLOCK_DOCS = 512
#: Bits of a signature per entry, and bits that an entry sets.
BITS, HASHES = 12, 4
#: A term is an entry for each of these that its occurrences reach.
LEVELS = (1, 2, 3, 4, 6, 8, 12, 16, 24, 32, 48, 64, 96, 128, 256, 512, 1024, 4096, 16384)
#: Characters of texts whose terms are counted together for the lexicon.
LEXICON_PART = 1 << 23
#: Items, and bytes of their terms, that are answered in one pass over the signatures.
ITEMS, ITEM_BYTES = 1024, 1 << 23

# Bytes that are no part of a term (others are: digits, letters, all beyond ASCII), and A-Z lowered.
_NO_TERM = [*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
_TABLE = bytearray(range(256))
for _b in _NO_TERM:
    _TABLE[_b] = 0x20
for _b in range(0x41, 0x5B):
    _TABLE[_b] = _b + 0x20
_TABLE = bytes(_TABLE)


def terms(text: str | None) -> list[bytes]:
    """The terms of a text, in order, as UTF-8."""
    return text.encode("utf-8", "replace").translate(_TABLE).split() if isinstance(text, str) else []


class Index(NamedTuple):
    """Tables in the shared folder: blocks of signatures, documents by term, and totals."""

    blocks: DataFrame
    lexicon: DataFrame
    n_docs: int
    n_terms: int


class _Hashes(dict):
    """64-bit numbers of terms, the same in every process, each made once."""

    def __missing__(self, term: bytes) -> int:
        number = self[term] = int.from_bytes(blake2b(term, digest_size=8).digest(), "little")
        return number


def _hashes(found: list[bytes], known: _Hashes) -> np.ndarray:
    return np.fromiter(map(known.__getitem__, found), np.uint64, len(found))


def _bits(entries: np.ndarray, width: int) -> np.ndarray:
    """The bits (entry, hash) of entries in signatures of a width."""
    step = mixed(entries) | np.uint64(1)
    return np.stack([(entries + np.uint64(h) * step) % np.uint64(width) for h in range(HASHES)], axis=1).astype(np.int64)


def _entries(hashes: np.ndarray, level: int) -> np.ndarray:
    return mixed(hashes ^ mixed(np.array([level + 77], np.uint64)))


#: Numbers of documents, keys and sizes are int64 end to end; a block's slices are as many bytes as it has documents / 8, by bit.
_BLOCK = "keys binary, sizes binary, total bigint, width int, slices binary, term string, df bigint"


def _packed(docs: list[tuple[int, np.ndarray, np.ndarray]], width: int) -> dict:
    """A block: its documents and, for each bit of the signatures, a bitmap of the documents that have it."""
    keys, tfs, hashes = zip(*docs)
    owner, tf, hashed = np.repeat(np.arange(len(docs)), [len(t) for t in tfs]), np.concatenate(tfs), np.concatenate(hashes)
    bits = np.zeros((width, -(-len(docs) // 8) * 8), bool)
    for level in LEVELS:
        there = tf >= level
        if not there.any():
            break
        owner, tf, hashed = owner[there], tf[there], hashed[there]
        bits[_bits(_entries(hashed, level), width), owner[:, None]] = True
    sizes = np.fromiter((t.sum() for t in tfs), np.int64, len(tfs))
    packed = {"keys": np.array(keys, np.int64).tobytes(), "sizes": sizes.tobytes(), "total": int(sizes.sum())}
    return {**packed, "width": width, "slices": np.packbits(bits, axis=1).tobytes(), "term": None, "df": None}


def _signatures(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of blocks and of the lexicon (term, df), in one pass over texts."""
    open_blocks: dict[int, list] = {}
    lexicon: Counter[bytes] = Counter()
    known, held, levels = _Hashes(), 0, np.array(LEVELS)
    columns = ["keys", "sizes", "total", "width", "slices", "term", "df"]

    def block(width: int) -> pd.DataFrame:
        return pd.DataFrame([_packed(open_blocks.pop(width), width)], columns=columns, dtype=object)

    def counted() -> pd.DataFrame:
        rows = [(*[None] * 5, t.decode("utf-8", "replace"), n) for t, n in lexicon.items()]
        return pd.DataFrame(rows, columns=columns, dtype=object)

    for batch in batches:
        for k, text in zip(batch["k"], batch["text"]):
            counts = Counter(terms(text))
            if not counts:
                continue
            lexicon.update(counts.keys())
            tf = np.fromiter(counts.values(), np.int64, len(counts))
            entries = int(np.searchsorted(levels, tf, side="right").sum())
            width = BITS << max(4, (entries - 1).bit_length())
            docs = open_blocks.setdefault(width, [])
            docs.append((int(k), tf, _hashes(list(counts), known)))
            if len(docs) == BLOCK_DOCS:
                yield block(width)
            held += len(text)
            if held >= LEXICON_PART:
                yield counted()
                lexicon, known, held = Counter(), _Hashes(), 0
    for width in list(open_blocks):
        yield block(width)
    if lexicon:
        yield counted()


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.xxhash64("doc_id", "text").alias("k"), "text")


def index(docs: DataFrame) -> Index:
    """Signatures and document counts of all whole texts; documents without terms are in neither.

    Blocks are made where the texts are read; each has documents whose signatures are equally wide, at ``BITS`` bits per
    entry. Terms are counted per part of a task, then over all: a frequent term is one row per part.
    """
    made = _keyed(docs).select("k", "text").mapInPandas(_signatures, _BLOCK)
    made = materialise(made, "signatures")
    blocks = made.filter("keys is not null").select("keys", "sizes", "total", "width", "slices")
    lexicon = made.filter("term is not null").groupBy("term").agg(F.sum("df").alias("df"))
    lexicon = materialise(lexicon, "lexicon")
    total = blocks.agg(F.sum(F.length("sizes") / 8).cast("long"), F.sum("total")).first()
    return Index(blocks, lexicon, total[0] or 0, total[1] or 0)


def weight(n_docs: int, df: int) -> int:
    return int(np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df + 1))))


def shares(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a term that occurs ``tf`` times gives per unit of weight to documents of relative length ``m``."""
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


def relative_length(n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    return 50 + (50 * n * n_docs) // max(1, n_terms)


class _Queries(NamedTuple):
    """Items of one pass: different terms, their weights, and which item has which term."""

    ids: list
    terms: list[bytes]
    weights: np.ndarray
    has: np.ndarray


def _queries(found: Index, items: DataFrame) -> Iterator[_Queries]:
    """The items with terms that some document has, in parts of bounded size."""
    cut = F.split(F.translate(F.col("text"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    wanted = items.select("item_id", F.explode(F.array_distinct(cut)).alias("term")).filter("term <> ''").distinct()
    wanted = materialise(wanted.join(found.lexicon, "term").select("item_id", "term", "df"), "item-terms")
    size = F.sum(F.octet_length("term") + 40)
    sizes = wanted.groupBy("item_id").agg(size.alias("size"), F.min(F.xxhash64("item_id")).alias("h"))
    total = sizes.agg(F.count("*"), F.sum("size")).first()
    parts = max(-(-total[0] // ITEMS), -(-(total[1] or 0) // ITEM_BYTES))
    for part in range(parts):
        dealt = F.pmod(F.xxhash64("item_id"), F.lit(parts)) == part
        rows = wanted.filter(dealt).select("item_id", "term", "df").toPandas()
        if not len(rows):
            continue
        rows["item"], ids = pd.factorize(rows["item_id"], use_na_sentinel=False)
        rows["place"], names = pd.factorize(rows["term"])
        df = rows.drop_duplicates("place").sort_values("place")["df"]
        has = np.zeros((len(names), len(ids)))
        has[rows["place"], rows["item"]] = 1
        weights = np.array([weight(found.n_docs, int(x)) for x in df], np.int64)
        yield _Queries([None if pd.isna(i) else i for i in ids], [t.encode() for t in names], weights, has)


def _bounds(block, queries: _Queries, n_docs: int, n_terms: int, hashes: np.ndarray) -> np.ndarray:
    """(document, item): no score is higher. Weighted sums of slices: each term's occurrences are overestimated."""
    n = np.frombuffer(block.sizes, np.int64)
    size = len(n)
    m = relative_length(n, n_docs, n_terms)
    slices = np.frombuffer(block.slices, np.uint8).reshape(block.width, -1)
    # Bitmaps of documents that may have a term so many times, for the terms that got that far.
    reached = np.zeros((len(hashes), size), np.int16)
    alive = np.arange(len(hashes))
    for i, level in enumerate(LEVELS):
        bits = _bits(_entries(hashes[alive], level), block.width)
        both = slices[bits[:, 0]]
        for h in range(1, HASHES):
            both = both & slices[bits[:, h]]
        there = np.unpackbits(both, axis=1, count=size).astype(bool) & (reached[alive] == i)
        reached[alive] += there
        alive = alive[there.any(axis=1)]
        if not len(alive):
            break
    # The most occurrences below the next level, and never more than the document has terms.
    most = np.array([0, *(level - 1 for level in LEVELS[1:]), np.iinfo(np.int64).max // 2_000_000_000], np.int64)
    term, doc = np.nonzero(reached)
    tf = np.minimum(most[reached[term, doc]], n[doc])
    parts = np.zeros((size, len(hashes)))
    parts[doc, term] = queries.weights[term] * shares(tf, m[doc])
    return parts @ queries.has


def _bounded(found: Index, queries: _Queries, keep: Callable[[np.ndarray], Iterator], schema: T.StructType) -> DataFrame:
    """Rows (item, k, bound) that ``keep`` chooses from the bounds of a block."""
    n_docs, n_terms = found.n_docs, found.n_terms
    hashes = _hashes(queries.terms, _Hashes())

    def bound(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        choose = keep()
        for batch in batches:
            for block in batch.itertuples():
                yield from choose(block, _bounds(block, queries, n_docs, n_terms, hashes))
        yield from choose(None, None)

    return found.blocks.mapInPandas(bound, schema)


def _rows(block, doc: np.ndarray, item: np.ndarray, bounds: np.ndarray) -> pd.DataFrame:
    return pd.DataFrame({"item": item.astype(np.int32), "k": np.frombuffer(block.keys, np.int64)[doc], "bound": bounds})


def _highest(top: int) -> Callable:
    """Of a task's documents the ``top`` highest bounds of each item."""

    def keep() -> Callable:
        held: list[pd.DataFrame] = []

        def cut() -> pd.DataFrame:
            rows = pd.concat(held, ignore_index=True)
            return rows.sort_values(["item", "bound"], ascending=[True, False], kind="stable").groupby("item").head(top)

        def choose(block, bounds: np.ndarray | None) -> Iterator[pd.DataFrame]:
            if block is None:
                if held:
                    yield cut()
                return
            few = min(top, len(bounds))
            doc = np.argpartition(-bounds, few - 1, axis=0)[:few]
            item = np.broadcast_to(np.arange(bounds.shape[1]), doc.shape)
            value = np.take_along_axis(bounds, doc, axis=0)
            there = value > 0
            held.append(_rows(block, doc[there], item[there], value[there]))
            if len(held) >= 16:
                held[:] = [cut()]

        return choose

    return keep


def _at_least(lowest: np.ndarray) -> Callable:
    """All documents whose bound is not below what an item's answer has at least."""

    def keep() -> Callable:
        def choose(block, bounds: np.ndarray | None) -> Iterator[pd.DataFrame]:
            if block is not None:
                doc, item = np.nonzero(bounds >= lowest)
                if len(doc):
                    yield _rows(block, doc, item, bounds[doc, item])

        return choose

    return keep


def _scored(docs: DataFrame, pairs: DataFrame, found: Index, queries: _Queries) -> DataFrame:
    """(item, doc_id, score) of pairs (item, k): exact, from the whole texts of the documents they name."""
    kind = docs.schema["doc_id"].dataType
    n_docs, n_terms = found.n_docs, found.n_terms
    wanted = materialise(pairs.groupBy("k").agg(F.collect_set("item").alias("items")), "wanted")
    place = {t: i for i, t in enumerate(queries.terms)}
    schema = T.StructType([T.StructField("item", T.IntegerType()), T.StructField("doc_id", kind), T.StructField("score", T.LongType())])

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        has = queries.has.astype(bool)
        for batch in batches:
            out = []
            for doc_id, text, items in zip(batch["doc_id"], batch["text"], batch["items"]):
                own = terms(text)
                counts = Counter(t for t in own if t in place)
                at = np.fromiter((place[t] for t in counts), np.int64, len(counts))
                tf = np.fromiter(counts.values(), np.int64, len(counts))
                m = relative_length(np.int64(len(own)), n_docs, n_terms)
                parts = queries.weights[at] * shares(tf, m)
                items = np.asarray(items, np.int64)
                totals = parts @ has[at][:, items].astype(np.int64)
                out += [(int(i), doc_id, int(s)) for i, s in zip(items, totals) if s > 0]
            yield pd.DataFrame(out, columns=["item", "doc_id", "score"]).astype({"doc_id": object})

    return _keyed(docs).join(wanted, "k").select("doc_id", "text", "items").mapInPandas(score, schema)


def _ranked(scores: DataFrame, top: int) -> DataFrame:
    """The highest scores of each item; partial selections come before the shuffle."""
    by_score = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return scores.withColumn("rank", F.row_number().over(by_score)).filter(F.col("rank") <= top)


def search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): the documents with the highest scores above 0 for each item.

    ``docs`` has doc_id, text and any others, ``items`` has item_id (one row each) and text. Every document gets a signature in which
    each of its terms sets bits, once for each of ``LEVELS`` that its count reaches. A term of an item is taken to occur
    as often as the bits of all its slices allow, which is never too few, so the sum of weights is an upper bound of the score. First the
    documents with the highest bounds are scored exactly; the lowest of the best ``top`` of these scores is what an answer has at least.
    Then every document whose bound is not below that is scored exactly. Nothing else is left out.

    Items are answered in parts of at most ``ITEMS`` items and about ``ITEM_BYTES`` of terms (one item's terms may be more), which
    bounds what each task is sent; each part is a pass over the signatures. Scores are 64-bit integers. NULL and empty texts have no terms
    and are in no answer, nor do they count as documents. Repeated rows are documents each, with ranks each; equal scores go by
    doc_id, NULL last. An item without terms has no rows. Very long texts have wider signatures. Other
    columns are not read. Empty tables give no rows.
    """
    spark = docs.sparkSession
    kind, item_kind = docs.schema["doc_id"].dataType, items.schema["item_id"].dataType
    schema = T.StructType([T.StructField("item", T.IntegerType()), T.StructField("k", T.LongType()), T.StructField("bound", T.DoubleType())])
    done = T.StructType(
        [T.StructField("item_id", item_kind), T.StructField("rank", T.IntegerType()), T.StructField("doc_id", kind), T.StructField("score", T.LongType())]
    )
    path = shared_path(spark, "answers")
    spark.createDataFrame([], done).write.parquet(path)
    with scratch(spark):
        found = index(docs)
        for queries in _queries(found, items):
            by_bound = Window.partitionBy("item").orderBy(F.desc("bound"), "k")
            first = _bounded(found, queries, _highest(top), schema).withColumn("place", F.row_number().over(by_bound))
            best = _ranked(_scored(docs, first.filter(F.col("place") <= top), found, queries), top)
            rows = best.groupBy("item").agg(F.count("*").alias("n"), F.min("score").alias("least")).collect()
            lowest = np.ones(len(queries.ids))
            for r in rows:
                if r.n == top:
                    lowest[r.item] = r.least
            rest = _bounded(found, queries, _at_least(lowest), schema)
            names = spark.createDataFrame([(i, x) for i, x in enumerate(queries.ids)], T.StructType([schema["item"], done["item_id"]]))
            answer = _ranked(_scored(docs, rest, found, queries), top).join(F.broadcast(names), "item")
            answer.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score").write.mode("append").parquet(path)
    return spark.read.schema(done).parquet(path)


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 highest-scoring documents of each benchmark item."""
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_SQL_CUT = r"string_split(regexp_replace(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+', ' ', 'g'), ' ')"
OP13_SQL = f"""WITH
  doc AS (SELECT doc_id, unnest({_SQL_CUT}) AS term FROM documents),
  tf AS (SELECT doc_id, term, count(*) AS tf FROM doc WHERE term <> '' GROUP BY ALL),
  len AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY doc_id),
  total AS (SELECT count(*)::BIGINT AS nn, sum(n)::BIGINT AS ll FROM len),
  m AS (SELECT doc_id, 50 + (50 * n * nn) // ll AS m FROM len, total),
  w AS (SELECT term, floor(1000 * ln((2 * nn + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM tf, total GROUP BY term, nn),
  item AS (SELECT DISTINCT item_id, term FROM (SELECT item_id, unnest({_SQL_CUT}) AS term FROM benchmark) WHERE term <> ''),
  score AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
    FROM item JOIN w USING (term) JOIN tf USING (term) JOIN m USING (doc_id) GROUP BY ALL),
  ranked AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
    FROM score WHERE score > 0)
  SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= {TOP}"""
