"""Line dedup by a log-template tree: lines of one template that recurs across documents are dropped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from almanac.llm.common import table
from almanac.sources.shared import finished, materialise

#: Leading tokens by which the tree branches, below the number of tokens.
DEPTH = 3
#: Different documents in which a template recurs; the fewest tokens of a line that may be dropped.
LEAST_DOCS, LEAST_TOKENS = 5, 3
#: Share of a line's tokens, in percent, that its template must fix.
FIXED = 70
#: Near copies, by lines: percent of a document's tokens that stand in lines of another, and tokens that an edited line counts less.
ALIKE, EDIT = 70, 8
_PIECES = 16
VARIABLE = "<*>"
_DIGIT, _TOKEN_WITH_DIGIT = "[0-9]", "[^ ]*[0-9][^ ]*"


def _masked(line: Column) -> Column:
    """The line with every token that holds a digit as a variable."""
    return F.when(line.rlike(_DIGIT), F.regexp_replace(line, _TOKEN_WITH_DIGIT, VARIABLE)).otherwise(line)


def _parsed(text: Column) -> Column:
    """Per line: number of tokens, leading tokens, and a hash of the line with its variables masked."""

    def parse(line: Column) -> Column:
        tokens = F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit(""))) + 1
        varies = F.contains(line, F.lit(VARIABLE)).alias("varies")
        return F.struct(tokens.alias("n"), F.substring_index(line, " ", DEPTH).alias("head"), F.xxhash64(line).alias("line"), varies)

    return F.transform(F.transform(F.split(text, "\n"), _masked), parse)


def _leaf(parsed: Column) -> Column:
    return F.xxhash64(parsed["n"], parsed["head"])


def _places(docs: DataFrame) -> DataFrame:
    """(k, kind, leaf, line, n, varies): the different lines of each document that are long enough.

    ``kind`` tells a line's documents apart by their whole text, so that copies of a document count once.
    """
    parsed = docs.select("k", F.xxhash64("text").alias("kind"), _parsed(F.col("text")).alias("lines"))

    def place(x: Column) -> Column:
        return F.struct(_leaf(x).alias("leaf"), x["line"].alias("line"), x["n"].alias("n"), x["varies"].alias("varies"))

    # Told apart as rows: within an array, structs would be compared each with each.
    found = F.transform(F.filter("lines", lambda x: x["n"] >= LEAST_TOKENS), place)
    return parsed.select("k", "kind", F.explode(found).alias("at")).select("k", "kind", "at.*").distinct()


def _by_copies(places: DataFrame, least_docs: int) -> DataFrame:
    """The places in leaves that enough documents reach, with one document of each group of near copies as ``kind``.

    A document's group is looked for at the one of its leaves that the fewest documents reach, of those that others reach too:
    lines of its own, edited words aside, come before boilerplate there. If ``ALIKE`` percent of its tokens stand in lines that
    the group's first document has as well, that one is its kind, else itself. A line of the same leaf that is not
    the same counts without ``EDIT`` tokens. A hot group is spread over the pieces of its first document.
    """
    leaves = places.groupBy("leaf").agg(F.count_distinct("k").alias("docs")).filter("docs > 1")
    inside = materialise(places.join(leaves, "leaf"), "reached")
    of = inside.groupBy("k").agg(F.min_by("leaf", F.struct("docs", "leaf")).alias("at"), F.max("docs").alias("most")).filter(F.col("most") >= least_docs)
    first = of.groupBy("at").agg(F.min("k").alias("first"))
    of = materialise(of.join(first, "at").select("k", "first"), "firsts")
    tokens = places.groupBy("k").agg(F.sum("n").alias("tokens"))

    pieces = F.explode(F.sequence(F.lit(0), F.lit(_PIECES - 1))).alias("piece")
    theirs = places.join(of.select(F.col("first").alias("k")).distinct(), "k").groupBy(F.col("k").alias("first"), "leaf")
    theirs = theirs.agg(F.collect_set("line").alias("lines")).select("first", "leaf", "lines", pieces)
    mine = inside.join(of.filter("k <> first"), "k").withColumn("piece", F.pmod(F.col("k"), F.lit(_PIECES)).cast("int"))
    alike = F.when(F.array_contains("lines", F.col("line")) & ~F.col("varies"), F.col("n")).otherwise(F.greatest(F.lit(0), F.col("n") - EDIT))
    shared = mine.join(theirs, ["first", "leaf", "piece"]).groupBy("k", "first").agg(F.sum(alike).alias("alike")).join(tokens, "k")
    copies = materialise(shared.filter(F.col("alike") * 100 >= F.col("tokens") * ALIKE).select("k", "first"), "copies")
    reached = inside.filter(F.col("docs") >= least_docs).join(copies.hint("merge"), "k", "left")
    return reached.select("k", F.coalesce("first", "k").alias("kind"), "leaf", "line")


def recurring_lines(docs: DataFrame, least_docs: int = LEAST_DOCS, fixed: int = FIXED, by_copies: bool = False) -> tuple[DataFrame, DataFrame]:
    """The places of lines (k, kind, leaf, line), and the lines (line) whose template recurs.

    ``docs`` has k and text. A leaf of the tree has lines with equally many tokens and the same leading ones.
    In a leaf that enough documents reach, a token is fixed at its position if enough documents have it
    there, else variable. A line belongs to a template if enough of its tokens are fixed, and the template
    recurs if enough documents have lines of it. Only counts are taken, all with map-side combine: no
    task holds a leaf, and what is joined is one row per line or token of the leaves that recur.
    """
    places = materialise(_places(docs), "places")
    if by_copies:
        places = materialise(_by_copies(places, least_docs), "places-by-copies")
    hot = places.groupBy("leaf").agg(F.count_distinct("kind").alias("docs")).filter(F.col("docs") >= least_docs)
    hot = materialise(hot.select("leaf"), "leaves")
    # Of each line the first few documents will do: only whether there are enough of them is asked below.
    nth = F.dense_rank().over(Window.partitionBy("line").orderBy("kind"))
    inside = places.join(hot, "leaf").select("line", "kind").distinct().withColumn("nth", nth)
    inside = materialise(inside.filter(F.col("nth") <= least_docs).select("line", "kind"), "inside")

    # The tokens of the lines in those leaves, each line once.
    lines = docs.select(F.explode(F.transform(F.split("text", "\n"), _masked)).alias("text"))
    tokens = F.length("text") - F.length(F.replace("text", F.lit(" "), F.lit(""))) + 1
    lines = lines.select(F.xxhash64(tokens, F.substring_index("text", " ", DEPTH)).alias("leaf"), F.xxhash64("text").alias("line"), "text")
    lines = lines.join(hot, "leaf").dropDuplicates(["line"])
    spread = lines.select("leaf", "line", F.posexplode(F.split("text", " ")).alias("pos", "token"))
    spread = materialise(spread, "tokens")

    counted = spread.join(inside, "line").groupBy("leaf", "pos", "token")
    common = counted.agg(F.count_distinct("kind").alias("docs")).filter((F.col("docs") >= least_docs) & (F.col("token") != VARIABLE))
    common = common.select("leaf", "pos", "token", F.lit(True).alias("fixed"))
    marked = spread.join(common, ["leaf", "pos", "token"], "left")
    token = F.when(F.col("fixed"), F.col("token")).otherwise(VARIABLE)
    shape = marked.groupBy("line", "leaf").agg(
        F.count("fixed").alias("fixed"), F.count("*").alias("n"), F.array_sort(F.collect_list(F.struct("pos", token.alias("token")))).alias("shape")
    )
    shape = shape.filter(F.col("fixed") * 100 >= F.col("n") * fixed)
    shape = materialise(shape.select("line", F.xxhash64("leaf", "shape").alias("template")), "shapes")
    often = shape.join(inside, "line").groupBy("template").agg(F.count_distinct("kind").alias("docs"))
    often = often.filter(F.col("docs") >= least_docs).select("template")
    return places, materialise(shape.join(often, "template").select("line"), "recurring")


def drop_recurring_lines(docs: DataFrame, least_docs: int = LEAST_DOCS, fixed: int = FIXED, by_copies: bool = False) -> DataFrame:
    """(doc, text, n_lines, n_dropped), one row per row of ``docs``, which has doc_id, text and any others.

    ``doc`` is the whole row as it was. Lines whose template recurs in ``least_docs`` different documents are gone from
    ``text``; the others stay as they were, in order. NULL text stays NULL with 0 lines, empty text is one
    empty line; lines of fewer than ``LEAST_TOKENS`` tokens stay. Documents that lose all lines stay, with
    empty text. Repeated rows get equal results. Documents of equal text count as one, and with ``by_copies`` near copies
    do so as well (``_by_copies``); without it, what ``least_docs`` near copies share is dropped from them like any boilerplate.
    """
    # Two texts with one key would share a list of lines that are dropped anyway.
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col("text"), F.xxhash64("doc_id", "text").alias("k"))
    texts = keyed.filter("text is not null").select("k", "text")

    def lists() -> DataFrame:
        places, recurring = recurring_lines(texts, least_docs, fixed, by_copies)
        return places.join(recurring, "line").groupBy("k").agg(F.collect_set("line").alias("gone"))

    dropped = finished(docs.sparkSession, "dropped", lists)
    # Dealt by key at every size; lists of lines grow with the documents and are not for a broadcast.
    joined = keyed.join(dropped.hint("merge"), "k", "left").withColumn("lines", F.split("text", "\n"))
    stay = F.filter("lines", lambda x: ~F.array_contains("gone", F.xxhash64(_masked(x))))
    kept = joined.select("doc", "text", "gone", "lines", F.when(F.col("gone").isNotNull(), stay).alias("stay"))
    left = F.when(F.col("gone").isNull(), F.size("lines")).otherwise(F.size("stay"))
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(F.size("lines"))
    return kept.select(
        "doc",
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join("stay", "\n")).alias("text"),
        n_lines.cast("long").alias("n_lines"),
        F.when(F.col("text").isNull(), 0).otherwise(F.size("lines") - left).cast("long").alias("n_dropped"),
    )


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = drop_recurring_lines(table(spark, sf_dir, "documents"))
    digest = F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256")
    return found.select(F.col("doc.doc_id").alias("doc_id"), "n_lines", "n_dropped", digest)


_SQL_TOKENS = "len(string_split(l, ' '))"
OP8_SQL = f"""WITH
  doc AS (SELECT doc_id, text, string_split(text, chr(10)) AS raw FROM documents),
  line AS (SELECT doc_id, kind, i, r, l, {_SQL_TOKENS} AS n, array_to_string(string_split(l, ' ')[1:{DEPTH}], ' ') AS head
    FROM (SELECT doc_id, md5(text) AS kind, i, raw[i] AS r, regexp_replace(raw[i], '{_TOKEN_WITH_DIGIT}', '{VARIABLE}', 'g') AS l
          FROM (SELECT doc_id, text, raw, unnest(range(1, len(raw) + 1)) AS i FROM doc WHERE text IS NOT NULL))),
  place AS (SELECT DISTINCT n, head, l, kind FROM line WHERE n >= {LEAST_TOKENS}),
  hot AS (SELECT n, head FROM place GROUP BY ALL HAVING count(DISTINCT kind) >= {LEAST_DOCS}),
  token AS (SELECT n, head, l, pos, string_split(l, ' ')[pos] AS t
    FROM (SELECT DISTINCT n, head, l, unnest(range(1, n + 1)) AS pos FROM place JOIN hot USING (n, head))),
  common AS (SELECT n, head, pos, t FROM token JOIN place USING (n, head, l) WHERE t <> '{VARIABLE}'
    GROUP BY ALL HAVING count(DISTINCT kind) >= {LEAST_DOCS}),
  shape AS (SELECT n, head, l, string_agg(CASE WHEN c.t IS NULL THEN '{VARIABLE}' ELSE token.t END, ' ' ORDER BY pos) AS template
    FROM token LEFT JOIN common c USING (n, head, pos, t) GROUP BY n, head, l HAVING count(c.t) * 100 >= n * {FIXED}),
  often AS (SELECT n, head, template FROM shape JOIN place USING (n, head, l) GROUP BY ALL HAVING count(DISTINCT kind) >= {LEAST_DOCS}),
  gone AS (SELECT n, head, l FROM shape JOIN often USING (n, head, template)),
  kept AS (SELECT doc_id, count(*) AS n_lines, count(gone.l) AS n_dropped,
      coalesce(string_agg(r, chr(10) ORDER BY i) FILTER (gone.l IS NULL), '') AS text
    FROM line LEFT JOIN gone USING (n, head, l) GROUP BY doc_id)
  SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped,
    CASE WHEN doc.text IS NULL THEN NULL ELSE sha256(kept.text) END AS text_sha256
  FROM doc LEFT JOIN kept USING (doc_id)"""
