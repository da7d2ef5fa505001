"""WARC files, and a Merkle audit that finds where two replicas of an archive differ."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from almanac.llm.common import table
from almanac.sources.shared import materialise

# The record format.
VERSION = "WARC/1.0\r\n"
END = "\r\n\r\n"
_HEADER = VERSION + (
    "WARC-Type: resource\r\nWARC-Record-ID: <urn:uuid:{}-{}-{}-{}-{}>\r\nWARC-Date: {}\r\n"
    "WARC-Target-URI: {}\r\nContent-Type: text/html\r\nContent-Length: {}" + END
)

#: Children of a node.
FANOUT = 64
_ROW_BITS = 33  # monotonically_increasing_id: partition number above, row number below


def record_of(page_id: Column, url: Column, html: Column, date: str = "1970-01-01T00:00:00Z") -> Column:
    """A page as a WARC record without the blank lines that end it. NULL is as empty."""
    name = F.md5(F.coalesce(page_id.cast("string"), F.lit("")).cast("binary"))
    uuid = [F.substring(name, start, size) for start, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    payload = F.coalesce(html, F.lit(""))
    values = [*uuid, F.lit(date), F.coalesce(url, F.lit("")), F.octet_length(payload).cast("string"), payload]
    texts = _HEADER.split("{}")
    return F.concat(*[part for text, value in zip(texts, values) for part in (F.lit(text), value)])


def write_warc(pages: DataFrame, path: str, compression: str = "gzip") -> None:
    """Write (page_id, url, html) as WARC files, one per partition, each record in one piece."""
    records = pages.select(record_of(F.col("page_id"), F.col("url"), F.col("html")).alias("value"))
    records.write.option("lineSep", END).option("compression", compression).text(path)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """(url, record_id, html, intact) of every record; files without compression are read in pieces.

    ``intact`` tells whether the payload has its declared length. A payload that itself has a line
    ``WARC/1.0`` is cut there, and is then not intact. Empty files have no records.
    """
    raw = spark.read.option("lineSep", VERSION).text(path).filter("value <> ''")
    head = F.substring_index("value", END, 1)
    rest = F.expr(f"substring(value, length(substring_index(value, '{END}', 1)) + {len(END) + 1})")
    payload = F.regexp_replace(rest, r"\r\n\r\n\z", "")
    parts = raw.select(head.alias("head"), payload.alias("html"))

    def field(name: str) -> Column:
        return F.regexp_extract("head", rf"(?m)^{name}: ([^\r\n]*)", 1)

    return parts.select(
        field("WARC-Target-URI").alias("url"),
        F.regexp_extract("head", r"urn:uuid:([0-9a-f-]+)", 1).alias("record_id"),
        "html",
        (F.octet_length("html") == F.try_to_number(field("Content-Length"), F.lit("999999999999")).cast("long")).alias("intact"),
    )


def leaves(records: DataFrame, key: list[str], order: list[str] = (), record: str = "record") -> DataFrame:
    """(key, at, copies, length, digest, me, row) of every different record, sorted as in an archive and written.

    ``key`` is a struct of the key columns. Records follow each other by ``order``, if given, then key and digest;
    records of equal key and content are one row, at the place of the first, with the number of ``copies``.
    Only keys and digests are sorted, by range over many tasks. ``me`` is a hash of key and digest.
    """
    digest = F.sha2(F.col(record).cast("binary"), 256)
    length = (F.octet_length(record) + len(END)).cast("long")
    at = F.struct(*[F.col(f"`{c}`") for c in order]) if order else F.lit(0)
    hashed = records.select(F.struct(*[F.col(f"`{c}`") for c in key]).alias("key"), at.alias("at"), length.alias("length"), digest.alias("digest"))
    once = hashed.groupBy("key", "length", "digest").agg(F.min("at").alias("at"), F.count("*").alias("copies"))
    placed = once.orderBy("at", "key", "digest").withColumn("row", F.monotonically_increasing_id())
    return materialise(placed.withColumn("me", F.xxhash64("key", "digest")), "leaves")


def linked(placed: DataFrame, depth: int, fanout: int = FANOUT) -> DataFrame:
    """``leaves`` with pos, offset, prev and node1 … node<depth>.

    ``prev`` is the hash of the record before, 0 for the first one. A node of level j begins at every record whose hash is a
    multiple of fanout ** j, and is named by that hash (0 before the first such record). So a record that one replica lacks
    moves no limit but its own, and ``fanout`` children are the mean, with no more than a few hundred by chance. A record's place
    is its place in its sorted partition plus what lies before, of which the broadcast table has one row per partition.
    """
    mark = F.struct("row", "me")
    marks = {"prev": mark}
    for j in range(1, depth + 1):
        marks[f"node{j}"] = F.when(F.pmod("me", F.lit(fanout**j).cast("long")) == 0, mark)
    bytes_ = F.col("length") * F.col("copies")
    placed = placed.withColumn("part", F.shiftright("row", _ROW_BITS))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy("part").agg(F.count("*").alias("n"), F.sum(bytes_).alias("bytes"), *[F.max(m).alias(c) for c, m in marks.items()])
    sums = [F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in ("n", "bytes")]
    totals = totals.select("part", *sums, *[F.max(c).over(before).alias(f"{c}_before") for c in marks])
    rows = Window.partitionBy("part").orderBy("row")
    so_far, upto = rows.rowsBetween(Window.unboundedPreceding, -1), rows.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = [F.max(m).over(so_far if c == "prev" else upto).alias(f"{c}_inside") for c, m in marks.items()]
    joined = placed.select("*", F.coalesce(F.sum(bytes_).over(so_far), F.lit(0)).alias("inside"), *inside).join(F.broadcast(totals), "part")
    return joined.select(
        "key", "copies", "length", "digest", "me",
        (F.col("n_before") + F.col("row").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))).alias("pos"),
        (F.col("bytes_before") + F.col("inside")).alias("offset"),
        *[F.coalesce(F.col(f"{c}_inside")["me"], F.col(f"{c}_before")["me"], F.lit(0)).alias(c) for c in marks],
    )


def merkle_levels(leaf: DataFrame, depth: int) -> list[DataFrame]:
    """The tree above ``linked`` leaves, from the lowest nodes to the root: (node, parent, pos, start, stop, digest).

    A node's hash covers the number of bytes below it and its children's hashes in order; a leaf's covers the record's digest,
    its copies and the record before. Offsets are reported, but not hashed, as one lost record moves all that follow.
    """
    entry = F.sha2(F.concat_ws("|", "prev", "digest", "copies").cast("binary"), 256)
    above = [F.col(f"node{j}") for j in range(1, depth + 1)] + [F.lit(0).cast("long")] * 2
    stop = F.col("offset") + F.col("length") * F.col("copies")
    level = leaf.select(*[c.alias(f"above{j}") for j, c in enumerate(above)], "pos", F.col("offset").alias("start"), stop.alias("stop"), entry.alias("digest"))
    levels = []
    for j in range(depth + 1):
        children = F.transform(F.array_sort(F.collect_list(F.struct("pos", "digest"))), lambda c: c["digest"])
        upper = [F.min(f"above{i}").alias(f"above{i}") for i in range(j + 1, depth + 2)]
        level = level.groupBy(f"above{j}").agg(*upper, F.min("pos").alias("pos"), F.min("start").alias("start"), F.max("stop").alias("stop"), children.alias("children"))
        digest = F.sha2(F.concat_ws("|", F.col("stop") - F.col("start"), "children").cast("binary"), 256)
        level = materialise(level.withColumn("digest", digest).drop("children"), "level")
        levels.append(level.select(F.col(f"above{j}").alias("node"), F.col(f"above{j + 1}").alias("parent"), "pos", "start", "stop", "digest"))
    return levels


def differing(one: list[DataFrame], other: list[DataFrame]) -> DataFrame | None:
    """(node) of the lowest nodes that differ, found from the roots down, below differing nodes only; None for equal roots."""
    if [r.digest for r in one[-1].collect()] == [r.digest for r in other[-1].collect()]:
        return None
    found = None
    for a, b in zip(reversed(one[:-1]), reversed(other[:-1])):
        b = b.select(F.col("node"), F.col("parent"), F.col("digest").alias("digest_b"))
        if found is not None:
            above = found.select(F.col("node").alias("parent"))
            a, b = a.join(above, "parent", "left_semi"), b.join(above, "parent", "left_semi")
        both = a.select("node", "digest").join(b.select("node", "digest_b"), "node", "full_outer")
        found = materialise(both.filter(~F.col("digest").eqNullSafe(F.col("digest_b"))).select("node"), "differing")
    return found


def audit(primary: DataFrame, replica: DataFrame, key: list[str], fanout: int = FANOUT, order: list[str] = ()) -> DataFrame:
    """(key, side, pos, offset, copies, length, digest, status): every record of the primary, and what only the replica has.

    Both have the columns ``key`` (returned as a struct), ``order`` and ``record``; an archive's records lie in ``order``, or by
    key if there is none. ``side`` says in which archive pos and offset are. A record of the primary is ``ok``, ``missing`` (the
    replica has nothing new under its key), ``changed`` (the replica has another record there, which is a row of its own,
    ``changed`` as well), ``copies`` (there, but not as often) or ``moved`` (behind another record than in the
    primary, where both of these records are in both archives; so what follows a lost or added record has not moved). A
    record that only the replica has is ``extra``. Repeated records are one row with the number of copies. NULL is a key of its
    own and comes first, as NULL in ``order`` does. A NULL record has a NULL digest and length. Long records are hashed where
    they lie. Other columns are ignored, and key columns may have any name. Empty tables have no rows. Each replica is hashed once, and what lies below equal nodes is not compared.
    """
    placed = [leaves(x, key, order) for x in (primary, replica)]
    n, depth = max(x.count() for x in placed), 1
    while n > fanout ** (depth + 1):
        depth += 1
    a, b = (materialise(linked(x, depth, fanout), "linked") for x in placed)
    found = differing(merkle_levels(a, depth), merkle_levels(b, depth))
    columns = ["key", "side", "pos", "offset", "copies", "length", "digest", "status"]
    if found is None:
        return a.select("*", F.lit("primary").alias("side"), F.lit("ok").alias("status")).select(columns)
    nodes = found.withColumnRenamed("node", "node1")
    x, y = (t.join(nodes, "node1", "left_semi").alias(c) for t, c in ((a, "x"), (b, "y")))
    same = (F.col("x.me") == F.col("y.me")) & F.col("x.digest").eqNullSafe(F.col("y.digest"))
    sides = [F.col(f"{t}.{c}").alias(f"{c}_{t}") for t in "xy" for c in ("key", "pos", "offset", "copies", "length", "digest", "me", "prev")]
    both = materialise(x.join(y, same, "full_outer").select(*sides), "compared")

    ours, theirs = F.col("me_y").isNull(), F.col("me_x").isNull()
    lone = both.filter(ours | theirs).select(F.when(theirs, F.col("key_y")).otherwise(F.col("key_x")).alias("key"), F.coalesce("me_x", "me_y").alias("me"), ours.alias("ours"))
    lone = materialise(lone, "lone")
    replaced = lone.groupBy("key").agg(F.min("ours").alias("least"), F.max("ours").alias("most")).filter("least <> most").select("key")
    replaced = materialise(replaced.withColumn("replaced", F.lit(True)), "replaced")
    gaps = lone.select("me").distinct().withColumn("gap", F.lit(True))
    alone = both.filter(ours | theirs).withColumn("key", F.when(theirs, F.col("key_y")).otherwise(F.col("key_x"))).alias("l")
    alone = alone.join(replaced.alias("r"), F.col("l.key").eqNullSafe(F.col("r.key")), "left")
    status = F.when(F.col("replaced"), "changed").when(theirs, "extra").otherwise("missing")
    alone = alone.select("l.*", status.alias("status"))
    pairs = both.filter(~ours & ~theirs & ((F.col("prev_x") != F.col("prev_y")) | (F.col("copies_x") != F.col("copies_y"))))
    for t in "xy":
        pairs = pairs.join(gaps.select(F.col("me").alias(f"prev_{t}"), F.col("gap").alias(f"gap_{t}")), f"prev_{t}", "left")
    moved = (F.col("prev_x") != F.col("prev_y")) & F.col("gap_x").isNull() & F.col("gap_y").isNull()
    pairs = pairs.withColumn("status", F.when(F.col("copies_x") != F.col("copies_y"), "copies").when(moved, "moved").otherwise("ok"))

    told = alone.filter("me_x is not null").select("pos_x", "status").union(pairs.select("pos_x", "status"))
    told = materialise(told.select(F.col("pos_x").alias("pos"), "status"), "told")
    ok = F.coalesce("status", F.lit("ok")).alias("status")
    mine = a.join(told, "pos", "left").withColumn("side", F.lit("primary")).withColumn("status", ok)
    new = alone.filter("me_x is null").withColumn("side", F.lit("replica"))
    new = new.select("key", "side", *[F.col(f"{c}_y").alias(c) for c in columns[2:-1]], "status")
    return mine.select(columns).union(new)


def _copied(pages: DataFrame) -> DataFrame:
    """The replica of the query, told by ids: some pages have another first byte, some lack, some are new, some lie one page later."""
    page_id, html = F.col("page_id"), F.col("html")
    hit = (page_id % 97 == 5) & (F.octet_length(html) > 0)
    damaged = F.when(hit, F.concat(F.lit("~"), F.substring(html, 2, 1 << 30))).otherwise(html)
    at = F.when(page_id % 97 == 31, page_id * 2 + 3).otherwise(page_id * 2)
    there = pages.filter(F.coalesce(page_id % 97 != 11, F.lit(True))).select("page_id", "url", damaged.alias("html"), at.alias("at"))
    more = pages.filter(page_id % 97 == 23)
    return there.union(more.select("page_id", F.concat(F.coalesce("url", F.lit("")), F.lit("#new")), "html", page_id * 2 + 1))


def op9_merkle_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    record = record_of(F.col("page_id"), F.col("url"), F.col("html")).alias("record")
    primary = pages.select("page_id", "url", (F.col("page_id") * 2).alias("at"), record)
    replica = _copied(pages).select("page_id", "url", "at", record)
    found = audit(primary, replica, ["page_id", "url"], order=["at"])
    return found.select("key.page_id", "key.url", "side", "pos", F.col("offset").alias("start_byte"), "copies", "length", "digest", "status")


def _sql_text(text: str) -> str:
    return "'" + text.replace("\r\n", "' || chr(13) || chr(10) || '") + "'"


def _sql_record() -> str:
    name = "md5(coalesce(page_id::VARCHAR, ''))"
    uuid = [f"substr({name}, {start}, {size})" for start, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    html = "coalesce(html, '')"
    values = [*uuid, "'1970-01-01T00:00:00Z'", "coalesce(url, '')", f"strlen({html})::VARCHAR", html]
    return " || ".join(f"{_sql_text(t)} || {v}" for t, v in zip(_HEADER.split("{}"), values))


_SQL_SIDES = """
  {0}_once AS (SELECT page_id, url, length, digest, min(place) AS place, count(*) AS copies FROM {0}_hashed GROUP BY ALL),
  {0} AS (SELECT *, row_number() OVER w - 1 AS pos, lag(me, 1, '') OVER w AS prev,
      CAST(coalesce(sum(length * copies) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start_byte
    FROM (SELECT *, concat_ws('|', coalesce(page_id::VARCHAR, 'none'), digest, coalesce(url, 'none'), url IS NULL) AS me FROM {0}_once)
    WINDOW w AS (ORDER BY place NULLS FIRST, page_id NULLS FIRST, url NULLS FIRST, digest)),"""
_SQL_HASHED = f"CAST(strlen(record) + {len(END)} AS BIGINT) AS length, sha256(record) AS digest"
OP9_SQL = f"""WITH
  copied AS (SELECT page_id, url, CASE WHEN page_id % 97 = 31 THEN page_id * 2 + 3 ELSE page_id * 2 END AS place,
      CASE WHEN page_id % 97 = 5 AND strlen(html) > 0 THEN '~' || substr(html, 2) ELSE html END AS html
    FROM pages WHERE coalesce(page_id % 97 <> 11, true)
    UNION ALL SELECT page_id, coalesce(url, '') || '#new', page_id * 2 + 1, html FROM pages WHERE page_id % 97 = 23),
  a_hashed AS (SELECT page_id, url, place, {_SQL_HASHED} FROM (SELECT page_id, url, page_id * 2 AS place, {_sql_record()} AS record FROM pages)),
  b_hashed AS (SELECT page_id, url, place, {_SQL_HASHED} FROM (SELECT page_id, url, place, {_sql_record()} AS record FROM copied)),
  {_SQL_SIDES.format("a")}{_SQL_SIDES.format("b")}
  a_lone AS (SELECT * FROM a WHERE me NOT IN (SELECT me FROM b)),
  b_lone AS (SELECT * FROM b WHERE me NOT IN (SELECT me FROM a)),
  lone AS (SELECT me FROM a_lone UNION SELECT me FROM b_lone)
  SELECT a.page_id, a.url, 'primary' AS side, a.pos, a.start_byte, a.copies, a.length, a.digest,
    CASE WHEN b.me IS NULL THEN CASE WHEN EXISTS (SELECT 1 FROM b_lone r WHERE r.page_id IS NOT DISTINCT FROM a.page_id AND r.url IS NOT DISTINCT FROM a.url)
        THEN 'changed' ELSE 'missing' END
      WHEN a.copies <> b.copies THEN 'copies'
      WHEN a.prev <> b.prev AND a.prev NOT IN (SELECT me FROM lone) AND b.prev NOT IN (SELECT me FROM lone) THEN 'moved' ELSE 'ok' END AS status
  FROM a LEFT JOIN b USING (me)
  UNION ALL SELECT page_id, url, 'replica', pos, start_byte, copies, length, digest,
    CASE WHEN EXISTS (SELECT 1 FROM a_lone r WHERE r.page_id IS NOT DISTINCT FROM b_lone.page_id AND r.url IS NOT DISTINCT FROM b_lone.url)
      THEN 'changed' ELSE 'extra' END FROM b_lone"""
