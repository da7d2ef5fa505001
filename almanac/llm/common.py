"""What several operators share: exact sizes of words, hashes in numpy, connected components."""

from __future__ import annotations

import warnings
from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.sources.shared import discard, finished, materialise

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()

# Bytes between words. A word is a run of other bytes.
SPACES = bytes([0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])
SPACE_WORD = r"[^\x20\x09-\x0D]+"

#: Bytes of text that numpy works on at once; a longer text is a piece of its own.
PIECE = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all other characters as they are."""
    return F.translate(text, UPPER, LOWER)


def remainder(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; NULL ids belong to fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds, F.lit(0))


def training_texts(docs: DataFrame, chosen: DataFrame, label: str, longest: int) -> list[tuple]:
    """Sorted (label, doc_id, text) on the driver, one per row of ``chosen`` (doc_id, label) at most, however many rows share its id.

    Texts of at most ``longest`` characters. Only if these leave fewer than two classes, a stretch of that length is taken
    from each longer text as well, at a place told by its id; if that gives no two classes either, a warning says so.
    """
    size = F.char_length("text")
    place = F.pmod(F.xxhash64("doc_id"), F.greatest(size - longest, F.lit(0)) + 1).cast("int") + 1
    stretch = F.col("text").substr(place, F.lit(longest)).alias("text")
    rows: list[tuple] = []
    for texts in (docs.filter(size <= longest), docs.filter("text is not null").select("doc_id", stretch)):
        known = texts.select("doc_id", "text").join(chosen, "doc_id").groupBy("doc_id", label).agg(F.min("text").alias("text"))
        rows = sorted((r[label], r.doc_id, r.text) for r in known.collect())
        if len({r[0] for r in rows}) > 1:
            return rows
    warnings.warn(f"no texts of two classes of {label}: nothing is learned", stacklevel=3)
    return rows


def mixed(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit integers, each by itself."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_CODES = mixed(np.arange(256, dtype=np.uint64) + np.uint64(0xA5A5))
_LOWERED = np.arange(256, dtype=np.uint8)
_LOWERED[65:91] += 32


def pieces(texts: Sequence[str | None], size: int = PIECE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a batch into pieces as (first row, row after the last, bytes, start of each row and end).

    A row's bytes are followed by one line feed. NULL is as empty.
    """
    rows: list[bytes] = []
    first = held = 0
    for i, text in enumerate(texts):
        row = text.encode("utf-8", "replace") if isinstance(text, str) else b""
        if rows and held + len(row) > size:
            yield first, i, *_joined(rows)
            rows, first, held = [], i, 0
        rows.append(row)
        held += len(row) + 1
    if rows:
        yield first, first + len(rows), *_joined(rows)


def _joined(rows: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.fromiter((len(r) + 1 for r in rows), np.int64, len(rows))
    starts = np.concatenate([[0], np.cumsum(lengths)])
    return np.frombuffer(b"\n".join(rows) + b"\n", np.uint8), starts


def word_spans(data: np.ndarray, between: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes that are not ``between`` (a table of 256 booleans)."""
    inside = ~between[data]
    edges = np.flatnonzero(np.diff(inside.view(np.int8), prepend=0, append=0))
    return edges[0::2], edges[1::2]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lowered: bool = True) -> np.ndarray:
    """A 64-bit hash of each span's bytes, with A-Z lowered if asked for."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    place = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    codes = _BYTE_CODES[_LOWERED] if lowered else _BYTE_CODES
    weights = mixed(np.arange(int(lengths.max()), dtype=np.uint64)) | np.uint64(1)
    values = codes[data[place + np.repeat(starts, lengths)]] * weights[place]
    return mixed(np.add.reduceat(values, first) + lengths.astype(np.uint64))


def table_of(values: bytes) -> np.ndarray:
    """Booleans by byte, true for the given ones."""
    found = np.zeros(256, bool)
    found[list(values)] = True
    return found


def components(links: DataFrame, kind: str = "binary") -> DataFrame:
    """(node, root) of every node of the links (a, b): the smallest node reachable.

    Alternates two steps until nothing changes: each node's larger neighbours move to its smallest
    neighbour, then its smaller ones do. A step is an aggregation with map-side combine and a join on
    the node; the rows of a hub are many, but adaptive execution splits them, and its smallest
    neighbour is one row. The number of rounds grows with the logarithm of the longest path. Each
    round lies in the shared folder, so that lost executors cost one round at most.
    """
    return finished(links.sparkSession, "components", lambda: _contracted(links))


def _contracted(links: DataFrame) -> DataFrame:
    spark = links.sparkSession
    edges = materialise(
        links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "links",
    )
    done = edges.isEmpty()
    while not done:
        after = finished(spark, "links", lambda edges=edges: _round(edges))
        done = _same(edges, after)
        discard(edges)
        edges = after
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)


def _round(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    # Larger neighbours of a node point to the smallest one.
    large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    large = materialise(large.distinct(), "large")
    # A node and its smaller neighbours point to the smallest of these.
    lowest = large.groupBy("a").agg(F.min("b").alias("m"))
    small = large.join(lowest, "a")
    small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").union(lowest.select("a", "m"))
    return small.distinct()


def _same(before: DataFrame, after: DataFrame) -> bool:
    """Whether two sets of links are equal, by their number and sums of two hashes."""
    checks = [
        df.agg(
            F.count("*"),
            F.coalesce(F.sum((F.xxhash64("a", "b") % 1_000_000_007).cast("long")), F.lit(0)),
            F.coalesce(F.sum((F.xxhash64("b", "a", F.lit(1)) % 998_244_353).cast("long")), F.lit(0)),
        ).first()
        for df in (before, after)
    ]
    return checks[0] == checks[1]
