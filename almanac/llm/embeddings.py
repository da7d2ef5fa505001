"""Near-duplicate embeddings by products of int8 tiles with proven error bounds."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.llm.common import components, table
from almanac.sources.shared import materialise

LEAST_COSINE = 0.9
#: Vectors that stand for the cells, taken by hash; the driver holds so many and no more.
PIVOTS = 32
#: Vectors of a tile's side.
BLOCK = 2_048
#: Pairs recomputed at once.
_PAIRS = 1 << 16
#: Room for rounding in double precision wherever a bound decides.
_SLACK = 1e-9
_ROW = "node binary, copies long, raw binary, q binary, scale double, error double, cell int, angle double"


def _normal(raw: pd.Series, kind: str) -> np.ndarray:
    x = np.stack([np.frombuffer(r, kind) for r in raw]).astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow or underflow in the squares
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _quantiser(pivots: list[bytes], kind: str) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Unit vectors as int8 steps of a scale of their own, with the exact length of what is lost; and the
    nearest pivot with the angle to it."""

    def quantise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        centres = _normal(pd.Series(pivots), kind)
        for batch in batches:
            if not len(batch):
                continue
            batch = batch.assign(raw=[np.asarray(v, kind).tobytes() for v in batch["embedding"]])
            unit = _normal(batch["raw"], kind)
            scale = np.abs(unit).max(axis=1) / 127
            q = np.rint(unit / scale[:, None]).astype(np.int8)
            error = np.sqrt(((unit - q * scale[:, None]) ** 2).sum(axis=1))
            cosine = np.clip(unit @ centres.T, -1, 1)
            cell = cosine.argmax(axis=1)
            angle = np.arccos(cosine[np.arange(len(cell)), cell])
            yield pd.DataFrame(
                {"node": batch["node"], "copies": batch["copies"], "raw": batch["raw"], "q": [r.tobytes() for r in q]}
                | {"scale": scale, "error": error, "cell": cell.astype(np.int32), "angle": angle}
            )

    return quantise


def _linked(a: pd.DataFrame, b: pd.DataFrame, least: float, kind: str) -> np.ndarray:
    """Which vectors of two sides have at least the cosine, as booleans.

    The int8 product misses the cosine by no more than |e_a| + (1 + |e_a|) |e_b|. Where it may reach the
    threshold with that, the cosine is computed again in double precision, which alone decides.
    """
    qa, qb = (np.stack([np.frombuffer(r, np.int8) for r in x["q"]]) for x in (a, b))
    exact = np.float32 if qa.shape[1] * 127 * 127 < 1 << 24 else np.float64  # sums stay whole numbers
    rough = (qa.astype(exact) @ qb.astype(exact).T) * a["scale"].to_numpy()[:, None] * b["scale"].to_numpy()[None, :]
    ea, eb = a["error"].to_numpy()[:, None], b["error"].to_numpy()[None, :]
    rows, columns = np.nonzero(rough + ea + (1 + ea) * eb + _SLACK >= least)
    found = np.zeros(rough.shape, bool)
    ua, ub = _normal(a["raw"], kind), _normal(b["raw"], kind)
    for k in range(0, len(rows), _PAIRS):
        i, j = rows[k : k + _PAIRS], columns[k : k + _PAIRS]
        found[i, j] = np.einsum("ij,ij->i", ua[i], ub[j]) >= least
    return found


def _tile_reader(least: float, kind: str) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def tile(rows: pd.DataFrame) -> pd.DataFrame:
        """Of each vector with links in the tile: how many, and the first vector of its group here."""
        rows = rows.sort_values(["side", "node"], ignore_index=True)
        a, b = rows[rows["side"] == 0], rows[rows["side"] == 1]
        if len(a) == 0 or (len(b) == 0 and rows["c1"].iloc[0] != rows["c2"].iloc[0]):
            return pd.DataFrame({"node": [], "links": [], "root": []})
        alone = bool((rows["c1"].iloc[0] == rows["c2"].iloc[0]) and (rows["s1"].iloc[0] == rows["s2"].iloc[0]))
        b = a if alone else b
        found = _linked(a, b, least, kind)
        if alone:
            np.fill_diagonal(found, False)
        ca, cb = a["copies"].to_numpy(np.int64), b["copies"].to_numpy(np.int64)
        la, lb = found.astype(np.float64) @ cb, found.T.astype(np.float64) @ ca
        # Smallest reachable label on both sides, until nothing changes.
        left = np.arange(len(a))
        right = left if alone else np.arange(len(a), len(a) + len(b))
        while True:
            none = len(a) + len(b)
            up = np.minimum(left, np.where(found, right[None, :], none).min(axis=1, initial=none))
            down = up if alone else np.minimum(right, np.where(found, up[:, None], none).min(axis=0, initial=none))
            if (up == left).all() and (down == right).all():
                break
            left, right = up, down
        nodes = np.concatenate([a["node"].to_numpy(object), b["node"].to_numpy(object)]) if not alone else a["node"].to_numpy(object)
        links = la if alone else np.concatenate([la, lb])
        label = left if alone else np.concatenate([left, right])
        some = np.flatnonzero(links > 0)
        return pd.DataFrame({"node": nodes[some], "links": links[some].astype(np.int64), "root": nodes[label[some]]})

    return tile


def _pairs_of_cells(cells: list, pivots: list[bytes], least: float, kind: str) -> list[tuple[int, int, int]]:
    """(cell, other, blocks of the other) wherever two cells can hold vectors close enough.

    By the triangle inequality of angles, vectors of two cells are at least the pivots' angle less both
    radii apart.
    """
    centres = _normal(pd.Series(pivots), kind)
    apart = np.arccos(np.clip(centres @ centres.T, -1, 1))
    reach = float(np.arccos(min(1.0, least))) + _SLACK
    return [
        (x.cell, y.cell, -(-y.n // BLOCK))
        for x in cells
        for y in cells
        if x.cell == y.cell or apart[x.cell, y.cell] - x.radius - y.radius <= reach
    ]


def near_duplicates(vectors: DataFrame, least: float = LEAST_COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per row of ``vectors`` (vec_id, embedding).

    Vectors link at a cosine of ``least`` or more, in double precision. ``n_links`` counts the others
    linked directly, ``component_id`` is the smallest vec_id that links lead to, ``kept`` marks it. Vectors that are NULL, empty, zero, or hold NULL or components
    that are not finite link with nothing, and vectors of different lengths don't link. Equal vectors are
    one node that counts as many; repeated ids are rows of their own.

    Every pair of vectors that may link meets in one tile: vectors are dealt to the cells of ``PIVOTS``
    vectors, a cell to blocks of about ``BLOCK``, and pairs of cells too far apart are left out. A tile
    returns a count and a representative per vector, never pairs.
    """
    spark = vectors.sparkSession
    kind = "<f4" if dict(vectors.dtypes)["embedding"] == "array<float>" else "<f8"
    x = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding"))
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    good = F.coalesce(finite & F.exists("embedding", lambda v: v != 0), F.lit(False))
    node = F.when(good, F.unhex(F.md5(F.col("embedding").cast("string").cast("binary"))))
    keyed = x.withColumn("node", node)
    members = materialise(keyed.select("vec_id", "node", "embedding"), "vectors")
    classes = members.filter("node is not null").groupBy("node", "embedding").agg(F.count("*").alias("copies"))
    classes = materialise(classes.withColumn("size", F.size("embedding")), "classes")

    found = []
    for size in sorted(r[0] for r in classes.select("size").distinct().collect()):
        same = classes.filter(F.col("size") == size)
        first = same.orderBy("node").limit(PIVOTS).select("embedding").collect()
        pivots = [np.asarray(r[0], kind).tobytes() for r in first]
        rows = same.select("node", "copies", "embedding").mapInPandas(_quantiser(pivots, kind), _ROW)
        rows = materialise(rows, "quantised")
        cells = rows.groupBy("cell").agg(F.count("*").alias("n"), F.max("angle").alias("radius")).collect()
        near = spark.createDataFrame(_pairs_of_cells(cells, pivots, least, kind), "cell int, other int, theirs long")
        own = spark.createDataFrame([(c.cell, -(-c.n // BLOCK)) for c in cells], "cell int, blocks long")
        dealt = rows.join(F.broadcast(own), "cell").withColumn("s", F.pmod(F.xxhash64("node"), F.col("blocks")))
        dealt = dealt.join(F.broadcast(near), "cell")  # both tables have one row per pair of cells at most
        dealt = dealt.withColumn("t", F.explode(F.sequence(F.lit(0).cast("long"), F.col("theirs") - 1)))
        mine, yours = F.struct(F.col("cell").alias("c"), F.col("s").alias("s")), F.struct(F.col("other").alias("c"), F.col("t").alias("s"))
        tiles = dealt.withColumn("one", F.least(mine, yours)).withColumn("two", F.greatest(mine, yours))
        tiles = tiles.select(
            F.col("one.c").alias("c1"), F.col("one.s").alias("s1"), F.col("two.c").alias("c2"), F.col("two.s").alias("s2"),
            (mine > yours).cast("int").alias("side"), "node", "copies", "raw", "q", "scale", "error",
        )
        found.append(tiles.groupBy("c1", "s1", "c2", "s2").applyInPandas(_tile_reader(least, kind), "node binary, links long, root binary"))
    if not found:
        found = [spark.createDataFrame([], "node binary, links long, root binary")]
    links = found[0]
    for more in found[1:]:
        links = links.union(more)
    links = materialise(links, "links")

    counts = links.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(links.select(F.col("node").alias("a"), F.col("root").alias("b")))
    sized = classes.select("node", "copies").join(counts, "node", "left").join(roots, "node", "left")
    facts = sized.select("node", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "node").alias("root"))
    rows = members.select("vec_id", "node").join(facts, "node", "left")
    # Written first, so that the join is one of its own and a component with very many members is split in it.
    least_id = materialise(rows.filter("root is not null").groupBy("root").agg(F.min("vec_id").alias("least")), "least")
    component = F.coalesce("least", "vec_id")
    return rows.join(least_id, "root", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))


OP7_SQL = f"""WITH RECURSIVE
  v AS (SELECT vec_id, embedding::DOUBLE[] AS e, coalesce(len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0, false) AS good FROM embeddings),
  link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.good AND b.good AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
      WHERE list_cosine_similarity(a.e, b.e) >= {LEAST_COSINE}),
  reach AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b)
  SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
  FROM v LEFT JOIN (SELECT a AS vec_id, count(*) AS n_links FROM link GROUP BY a) USING (vec_id)
  JOIN (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a) USING (vec_id)"""
