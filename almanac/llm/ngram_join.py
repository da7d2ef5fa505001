"""Jaccard join of documents on word n-grams: size-banded tiles with hashed bitmap signatures."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.llm.common import SPACES, components, mixed, pieces, span_hashes, table, table_of, word_spans
from almanac.sources.shared import discard, finished, materialise

#: Words of a shingle, and the percentage of the union that two sets must share.
WORDS, PERCENT = 4, 85
#: Rows of a tile's side; a larger tile is cut into blocks.
BLOCK = 2_000
#: Bits of two signatures that are compared at once.
_STRIP = 8_192
_SPACE = table_of(SPACES)


def _sets(texts: pd.Series, words: int) -> Iterator[np.ndarray]:
    """Of each text, the sorted hashes of its distinct shingles."""
    for first, last, data, rows in pieces(texts.tolist()):
        starts, ends = word_spans(data, _SPACE)
        hashes = span_hashes(data, starts, ends)
        bounds = np.searchsorted(starts, rows)
        whole = hashes.copy()  # of the shingle that starts here
        for k in range(1, words):
            n = max(0, len(hashes) - k)
            whole[:n] = mixed(whole[:n]) + hashes[k : k + n]
        for i in range(last - first):
            a, b = bounds[i], bounds[i + 1]
            if b - a >= words:
                yield np.unique(mixed(whole[a : b - words + 1]))
            elif b > a:
                short = np.array([b - a], np.uint64)
                for h in hashes[a:b]:
                    short = mixed(short) + h
                yield mixed(short)
            else:
                yield np.zeros(0, np.uint64)


def _fingerprint(found: np.ndarray) -> bytes:
    with np.errstate(over="ignore"):
        parts = [mixed(found ^ np.uint64(c)).sum(dtype=np.uint64) + np.uint64(len(found)) for c in (0x1234567, 0x89ABCDEF01)]
    return b"".join(p.tobytes() for p in parts)


def _signature(found: np.ndarray) -> bytes:
    """A bit per hash value, set if an odd number of shingles has it.

    Two signatures differ in no more bits than their sets do in shingles. The width follows the size;
    a wider one folds onto a narrower one by exclusive or.
    """
    width = max(256, 1 << int(4 * len(found) - 1).bit_length())
    bits = np.bincount((found % np.uint64(width)).astype(np.int64), minlength=width) & 1
    return np.packbits(bits.astype(np.uint8)).tobytes()


def _region(percent: int) -> int:
    """One in so many hash values belongs to the region that the first filter looks at: somewhat more than a set may lack."""
    return max(1, 80 // max(1, 100 - percent))


def _profiler(words: int, region: int | None) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def profile(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc_id, found in zip(batch["doc_id"], _sets(batch["text"], words)):
                kept = found[found % np.uint64(region) == 0] if region else found
                row = (doc_id, _fingerprint(found) if len(found) else None, len(found), kept.view(np.int64))
                rows.append((*row, _signature(found) if len(found) else None) if not region else row)
            made = pd.DataFrame(rows, columns=["doc_id", "fp", "n", "shingles", "signature"][: 4 if region else 5])
            yield made.assign(text_hash=batch["text_hash"].to_numpy()) if region else made

    return profile


_PROFILE = "doc_id string, fp binary, n long, shingles array<long>"


def _spare(percent: int) -> str:
    """How many of its n shingles a set may have that a partner lacks."""
    return f"(n - cast(ceil(n * {percent} / 100d - 1e-9) as long))"


def profiles(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, fp, n, shingles, text_hash) of every row: a fingerprint of its set, the set's size, the
    shingles that fall into the region, and a hash of the text. The fingerprint has 128 bits; NULL for an empty set."""
    ids = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"))
    return ids.mapInPandas(_profiler(words, _region(percent)), _PROFILE + ", text_hash long")


def _survivors(rows: DataFrame, percent: int) -> DataFrame:
    """(fp, doc_id) of the sets that may have a partner, by their shingles in the region.

    Of any part of a set, a partner lacks no more than of the whole. Both look at the same region, so a
    set stays only if all but so many of its shingles there occur elsewhere too. Copies count as
    occurrences, which only keeps more.
    """
    sized = rows.filter("n > 0").withColumn("k", F.xxhash64("fp"))
    classes = sized.groupBy("fp", "k").agg(
        F.min(F.col("doc_id").cast("long")).alias("doc_id"), F.first("n").alias("n"), F.count("*").alias("copies"), F.first(F.size("shingles")).alias("r")
    )
    spread = sized.select("k", F.explode("shingles").alias("token"))
    common = spread.groupBy("token").agg(F.count("*").alias("df")).filter("df > 1").select("token")
    shared = spread.join(common, "token").groupBy("k").agg(F.count("*").alias("shared"))
    kept = classes.join(shared, "k", "left").filter(f"coalesce(shared, 0) >= copies * (r - {_spare(percent)})")
    return kept.select("fp", "doc_id")


def _prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """(fp, n, share, prefix): the shingles, rarest first, of which two linked sets must have one in common.

    Shingles of one set only can match nothing; they come first in the order and fill the prefix, so
    sets with too many of them are out. ``share`` is what part of the set other sets have too.
    """
    spread = sets.select("fp", "n", F.explode("shingles").alias("token"))
    common = spread.groupBy("token").agg(F.count("*").alias("df")).filter("df > 1")
    listed = spread.join(common, "token").groupBy("fp", "n").agg(F.array_sort(F.collect_list(F.struct("df", "token"))).alias("shared"))
    room = f"size(shared) - n + {_spare(percent)} + 1"
    return listed.filter(f"{room} > 0").selectExpr("fp", "n", "size(shared) / n as share", f"transform(slice(shared, 1, cast({room} as int)), x -> x.token) as prefix")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets share enough, by exact intersection of their sorted arrays."""
    one = sets.select(F.col("fp").alias("a"), F.col("n").alias("n_a"), F.col("shingles").alias("s_a"))
    two = sets.select(F.col("fp").alias("b"), F.col("n").alias("n_b"), F.col("shingles").alias("s_b"))
    common = F.size(F.array_intersect("s_a", "s_b"))
    both = pairs.join(one, "a").join(two, "b")
    return both.filter(common * 100 >= (F.col("n_a") + F.col("n_b") - common) * percent).select("a", "b")


def _folded(signature: bytes, width: int) -> np.ndarray:
    bits = np.unpackbits(np.frombuffer(signature, np.uint8))
    return np.bitwise_xor.reduce(bits.reshape(-1, width), axis=0)


def _tile_pairs(tile: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Pairs of different components whose signatures leave room for enough overlap."""
    n = tile["n"].to_numpy(np.int64)
    # Components as small integers, the block that a row comes from, and prefixes as they were cut.
    comp = pd.factorize(tile["comp"])[0]
    upper, block = tile["upper"].to_numpy(bool), tile["block"].to_numpy(np.int64)
    width = 8 * min(map(len, tile["signature"]))
    bits = np.stack([_folded(s, width) for s in tile["signature"]])
    equal = np.zeros((len(tile), len(tile)), np.float32)
    for c in range(0, width, _STRIP):
        strip = bits[:, c : c + _STRIP].astype(np.float32) * 2 - 1
        equal += strip @ strip.T  # bits that agree, less bits that differ
    apart = (width - equal) / 2
    both = n[:, None] + n[None, :]
    close = (100 + percent) * (both - apart) >= 2 * percent * both - 0.5
    close &= (comp[:, None] != comp[None, :]) & ~(upper[:, None] & upper[None, :])
    if tile["i"].iloc[0] != tile["j"].iloc[0]:
        close &= block[:, None] != block[None, :]
    a, b = np.nonzero(np.triu(close, 1))
    # A pair that meets in several tiles is told in the one of its least common shingle only.
    fps, token, seen = tile["fp"].to_numpy(), tile["token"].iloc[0], {i: set(tile["prefix"].iloc[i].tolist()) for i in {*a.tolist(), *b.tolist()}}
    pairs = [(min(fps[x], fps[y]), max(fps[x], fps[y])) for x, y in zip(a.tolist(), b.tolist()) if min(seen[x] & seen[y]) == token]
    return pd.DataFrame(pairs, columns=["a", "b"])


def _tiles(percent: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Compare the tiles of a partition, which lie one after the other."""

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for batch in batches:
            key = batch[["token", "band", "i", "j"]].to_numpy()
            cuts = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
            bounds = [0, *cuts.tolist(), len(batch)]
            for a, b in zip(bounds, bounds[1:]):
                part = batch.iloc[a:b]
                if held and (held[-1][["token", "band", "i", "j"]].iloc[-1].to_numpy() != key[a]).any():
                    yield _tile_pairs(pd.concat(held, ignore_index=True), percent)
                    held = []
                held.append(part)
        if held:
            yield _tile_pairs(pd.concat(held, ignore_index=True), percent)

    return compare


def _tile_candidates(entries: DataFrame, facts: DataFrame, percent: int) -> DataFrame:
    """(a, b) of sets in different components that meet in a tile and pass the bound.

    A tile has a prefix shingle and two neighbouring size bands; sets two bands apart differ too much
    in size. Tiles whose sets are in one component already have nothing to find. What is left is
    small as a rule; a tile that is not is cut into blocks, whose pairs are tiles of their own.
    """
    band = F.floor(F.log("n") / float(np.log(100 / percent)))
    sides = F.explode(F.array(F.struct(band.alias("band"), F.lit(False).alias("upper")), F.struct((band - 1).alias("band"), F.lit(True).alias("upper"))))
    spread = entries.select("token", "fp", "n", "comp", sides.alias("side")).select("token", "fp", "n", "comp", "side.*")
    tile = ["token", "band"]
    mixed_up = spread.groupBy(*tile).agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.min("upper").alias("u"), F.count("*").alias("rows"))
    mixed_up = mixed_up.filter("lo < hi and not u").select(*tile, F.ceil(F.col("rows") / BLOCK).cast("int").alias("blocks"))
    dealt = spread.join(mixed_up, tile).withColumn("block", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other")).join(facts, "fp")
    placed = dealt.repartition("token", "band", "i", "j").sortWithinPartitions("token", "band", "i", "j")
    columns = placed.select("token", "band", "i", "j", "fp", "n", "comp", "upper", "block", "signature", "prefix")
    return columns.mapInPandas(_tiles(percent), "a binary, b binary")


def similar_sets(docs: DataFrame, rows: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(node, root) by fingerprint: components of linked sets that differ.

    1. Sets that can have no partner go, by the region filter; texts of the others are read again.
    2. Each set is verified against one other that shares most of its prefix shingles, which links
       groups of near copies in one star each, with one pair per set.
    3. Tiles compare what still lies in different components, signatures first; pairs that pass are
       intersected exactly. No link between different components is lost, and pairs inside a component are not made.
    """
    chosen = materialise(_survivors(rows, percent), "survivors")
    texts = docs.select("doc_id", "text").alias("d").join(
        chosen.select("doc_id").distinct().alias("c"), F.col("d.doc_id").eqNullSafe(F.col("c.doc_id")), "left_semi"
    )
    full = texts.select(F.col("doc_id").cast("string").alias("doc_id"), "text").mapInPandas(_profiler(words, None), _PROFILE + ", signature binary")
    firsts = [F.first(c).alias(c) for c in ("n", "shingles", "signature")]
    sets = materialise(full.filter("n > 0").groupBy("fp").agg(*firsts), "sets")
    discard(chosen)
    prefixes = materialise(_prefixes(sets, percent), "prefixes")

    entries = prefixes.select("fp", "n", "share", F.explode("prefix").alias("token"))
    # The set with the fewest shingles of its own is the likeliest centre of those that share one.
    pivots = entries.groupBy("token").agg(F.max_by("fp", F.struct("share", "fp")).alias("pivot"))
    common = entries.join(pivots, "token").filter("fp <> pivot").groupBy("fp", "pivot").agg(F.count("*").alias("common"))
    best = common.groupBy("fp").agg(F.max_by("pivot", F.struct("common", "pivot")).alias("b"))
    stars = materialise(_verified(best.select(F.col("fp").alias("a"), "b"), sets, percent), "stars")

    roots = components(stars).withColumnRenamed("node", "fp")
    entries = entries.join(roots, "fp", "left").select("token", "fp", "n", F.coalesce("root", "fp").alias("comp"))
    facts = sets.select("fp", "signature").join(prefixes.select("fp", "prefix"), "fp")
    pairs = materialise(_tile_candidates(entries, facts, percent), "candidates")
    return components(stars.union(_verified(pairs, sets, percent)))


def ngram_members(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, text_hash, first), one row per row of ``docs`` (doc_id, text).

    A set has the distinct shingles of ``words`` words, A-Z lowered; a text of fewer words has one
    shingle, an empty or NULL one none and no links. Sets link at a Jaccard similarity of ``percent``.
    ``component_id`` is the smallest doc_id that links lead to. Equal sets are one node, so copies and
    repeated rows are never paired. NULL ids sort out of the way: a component has its smallest other id.
    ``text_hash`` is xxhash64 of the text. ``first`` tells the rows that stand for their component: those with its smallest
    id (NULL last) and, of these, the smallest hash; all rows without shingles do. Other columns of ``docs`` play no part.
    """
    rows = materialise(profiles(docs, words, percent), "profiles")
    roots = finished(docs.sparkSession, "roots", lambda: similar_sets(docs, rows, words, percent)).withColumnRenamed("node", "fp")
    members = rows.select(F.col("doc_id").cast("long").alias("doc_id"), "fp", "n", "text_hash").join(roots, "fp", "left")
    members = members.withColumn("root", F.coalesce("root", "fp"))
    # Written first, so that the join is one of its own and a component with very many members is split in it.
    own = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    least = materialise(members.filter("root is not null").groupBy("root").agg(F.min(own).alias("least")), "least")
    first = F.col("root").isNull() | (F.col("least") == own)
    component = F.coalesce("least.doc_id", "doc_id").alias("component_id")
    return members.join(least, "root", "left").select("doc_id", F.col("n").alias("n_shingles"), component, "text_hash", first.alias("first"))


def ngram_components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) of ``ngram_members``."""
    return ngram_members(docs, words, percent).select("doc_id", "n_shingles", "component_id")


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_components(table(spark, sf_dir, "documents"))


OP4_SQL = rf"""WITH RECURSIVE
  words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
  shingle AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, s, s + {WORDS - 1}), ' ') AS g
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {WORDS - 1}, 1) + 1)) AS s FROM words WHERE len(w) > 0)),
  size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
  pair AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM shingle a JOIN shingle b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
  link AS (SELECT a, b FROM pair JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b WHERE 100 * o >= {PERCENT} * (x.n + y.n - o)),
  reach AS (SELECT doc_id AS a, doc_id AS b FROM words UNION SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b)
  SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id FROM words LEFT JOIN size USING (doc_id)
  JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) USING (doc_id)"""
