"""Mixing sources to target weights by pivotal dependent rounding."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from almanac.llm.common import SPACE_WORD, table
from almanac.sources.shared import materialise

#: Units that one group of the reduction tree rounds.
GROUP = 10_000
#: Most copies of a document.
LIMIT = 3
_COPIES = 10_000
# Ids travel as text, as pandas would turn integers beside NULL into floats.
_LEVEL = "unit long, idx int, doc_id string, size long, m long, whole long, p double, bucket long"


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(SPACE_WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), limit: int = LIMIT) -> DataFrame:
    """(source, idx, source_size, n, target) from (source, size, m): how much of each source to take.

    Sources by code point, NULL last, have the given weights in turn and share the sum of all sizes;
    no target exceeds ``limit`` times its source's size, and what is over is shared by weight again.
    Filling the sources in the order of size per weight gives the level at which the rest stays
    below its limit: it is the highest of the levels met on the way. Windows range over one row per
    source.
    """
    totals = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("m")).alias("source_size"), F.count("*").alias("n"))
    ranked = totals.withColumn("idx", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    which = F.get(F.array(*[F.lit(float(w)) for w in weights]), F.col("idx") % len(weights))
    capped = ranked.withColumn("weight", which).withColumn("cap", F.col("source_size").cast("double") * limit)
    order = Window.orderBy(F.col("cap") / F.col("weight"), "idx")
    before = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    everything = F.sum("source_size").over(Window.partitionBy()).cast("double")
    levels = capped.withColumn("level", (everything - before) / rest)
    highest = F.max("level").over(Window.partitionBy())
    target = F.least(F.col("cap"), highest * F.col("weight")).alias("target")
    return levels.select("source", "idx", "source_size", "n", target)


def _rounded(units: pd.DataFrame, level: int, seed: int, last: bool) -> pd.DataFrame:
    """Pair the fractional units of a group until one is left; in the last group, round that as well.

    A pair moves words from one to the other, in a random direction whose odds keep both expected
    numbers of copies, until one of them has a whole number. The sum of words stays. Large units come
    first, so that the one left over tends to be small.
    """
    units = units.sort_values(["size", "unit", "doc_id"], ascending=False, kind="stable", ignore_index=True)
    idx, bucket = int(units["idx"].iloc[0]), int(units["bucket"].iloc[0])
    draw = np.random.default_rng([seed, level, idx, bucket]).random(len(units) + 1)
    p, size = units["p"].to_numpy(float).tolist(), units["size"].to_numpy(float).tolist()
    left = -1
    for j in range(len(p)):
        if not 0 < p[j] < 1:
            continue
        if left < 0:
            left = j
            continue
        i = left
        up, down = min((1 - p[i]) * size[i], p[j] * size[j]), min(p[i] * size[i], (1 - p[j]) * size[j])
        if draw[j] * (up + down) < down:
            full, empty = up == (1 - p[i]) * size[i], up == p[j] * size[j]
            p[i], p[j] = 1.0 if full else p[i] + up / size[i], 0.0 if empty else p[j] - up / size[j]
        else:
            empty, full = down == p[i] * size[i], down == (1 - p[j]) * size[j]
            p[i], p[j] = 0.0 if empty else p[i] - down / size[i], 1.0 if full else p[j] + down / size[j]
        left = i if 0 < p[i] < 1 else j if 0 < p[j] < 1 else -1
    if last and left >= 0:
        p[left] = float(draw[-1] < p[left])
    return units.assign(p=p)


def _step(level: int, seed: int, last: bool) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def step(units: pd.DataFrame) -> pd.DataFrame:
        return _rounded(units, level, seed, last)[[c.split()[0] for c in _LEVEL.split(", ")]]

    return step


def mix_sources(docs: DataFrame, seed: int = 17, weights: tuple[int, ...] = (1, 2, 3), limit: int = LIMIT) -> DataFrame:
    """How many words of each document the mix takes, so that sources meet their targets.

    ``docs`` has doc_id, text and source; other columns play no part. One row per row of ``docs``:
    doc_id, source, size, source_size, target, copies, taken. A document of a source at ratio r =
    target / source_size is copied floor(r) times, and once more with probability r - floor(r).

    The probabilities are rounded by pivotal sampling, so the words taken from a source miss its target
    by less than one document's size. Units are dealt to groups of about ``GROUP`` by a hash, a hot
    source to as many as it needs; each group leaves one fractional unit at most, and those meet in the
    next level of the tree, until one group per source is left. A level lies in the shared folder.

    NULL or empty text: size 0, takes 0. NULL source: a source of its own, the last. Repeated rows are
    one unit with a multiplicity, and its copies are dealt evenly to its rows. Equal input gives equal
    results, however it is partitioned.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source"), words_in(F.col("text")).alias("size"))
    units = materialise(rows.groupBy("doc_id", "source", "size").agg(F.count("*").alias("m")), "units")
    targets = materialise(source_targets(units, weights, limit), "targets")

    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    joined = units.join(targets.select(F.col("source").alias("of"), "idx", "n", ratio.alias("ratio")), F.col("source").eqNullSafe(F.col("of")))
    mass = F.when(F.col("size") > 0, F.col("m") * F.col("ratio")).otherwise(0.0)
    unit = F.xxhash64("doc_id", "size", F.lit(seed))
    level = joined.select(
        unit.alias("unit"),
        "idx",
        F.col("doc_id").cast("string").alias("doc_id"),
        "size",
        "m",
        F.floor(mass).alias("whole"),
        (mass - F.floor(mass)).alias("p"),
        F.pmod(unit, F.ceil(F.col("n") / GROUP)).alias("bucket"),
    )
    most = targets.agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
    decided, buckets, k = [], max(1, -(-most // GROUP)), 0
    while True:
        last = buckets == 1
        fractional = level.filter("p > 0")
        tree = fractional.groupBy("idx", "bucket").applyInPandas(_step(k, seed, last), _LEVEL)
        after = materialise(tree, "rounded")
        decided += [level.filter("p = 0"), after.filter("p = 0 or p = 1")]
        if last:
            break
        level = after.filter("p > 0 and p < 1").withColumn("bucket", F.floor(F.col("bucket") / GROUP))
        buckets, k = -(-buckets // GROUP), k + 1

    chosen = decided[0]
    for part in decided[1:]:
        chosen = chosen.union(part)
    total = (F.col("whole") + F.col("p").cast("long")).alias("total")
    chosen = chosen.select("idx", "doc_id", "size", "m", total)
    once = chosen.filter("m = 1").select("idx", "doc_id", "size", F.col("total").alias("copies"))
    out = once.union(_by_row(chosen.filter("m > 1")))
    # Both sides were written before: Spark knows how large the targets are.
    facts = targets.select("idx", "source", "source_size", "target")
    return out.join(facts, "idx").select(
        F.col("doc_id").cast("long").alias("doc_id"), "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )


def _by_row(units: DataFrame) -> DataFrame:
    """One row per repeated row, made where batches of them have been dealt to."""
    batch = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("m") - 1) / _COPIES)))
    tasks = int(units.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    batches = units.withColumn("batch", batch).repartition(tasks, "doc_id", "size", "batch")
    first = F.col("batch") * _COPIES
    rows = batches.withColumn("k", F.explode(F.sequence(first, F.least(first + _COPIES, F.col("m")) - 1)))
    copies = F.floor(F.col("total") / F.col("m")) + (F.col("k") < F.col("total") % F.col("m")).cast("long")
    return rows.select("idx", "doc_id", "size", copies.alias("copies"))


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")
