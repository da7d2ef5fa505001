"""Benchmark decontamination: a prefix-filtered join of item windows with documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.llm.common import LOWER, UPPER, table
from almanac.sources.shared import finished, materialise

# A word is a run of digits, letters a-z and characters beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_BETWEEN = "".join(chr(c) for c in range(0x80) if not chr(c).isalnum())
#: The same for Java, with A-Z, which reads this form four times as fast as the negated ranges.
_WORD_ANY_CASE = r"[\p{Alnum}[^\p{ASCII}]]+"
WINDOW = 13
#: A document is contaminated if one in so many of its words is hit.
SHARE = 20


def words_of(text: Column) -> Column:
    """A-Z in lower case and everything between words as blanks, cut at the blanks."""
    blanked = F.translate(F.coalesce(text, F.lit("")), UPPER + _BETWEEN, LOWER + " " * len(_BETWEEN))
    return F.array_remove(F.split(blanked, " "), "")


def _tokens(text: Column) -> Column:
    """Words by hash: shorter rows to join, and what they find is compared word by word anyway."""
    return F.transform(words_of(text), lambda w: F.xxhash64(w))


def _items(items: DataFrame) -> DataFrame:
    """(iid, item_id, words, m) of items that have words; items of equal words share ``iid``."""
    words = items.select(F.col("item_id").cast("string").alias("item_id"), words_of(F.col("text")).alias("words"))
    return words.filter(F.size("words") > 0).select(
        F.md5(F.array_join("words", " ").cast("binary")).alias("iid"), "item_id", "words", F.size("words").alias("m")
    )


def _anchors(docs: DataFrame, wanted: DataFrame, window: int) -> DataFrame:
    """(word, iid, q, m): in every window of every item, the word that is rarest in the documents, by its hash.

    A window occurs only where its rarest word does, so of each window this one word is the prefix that
    has to be joined. Words are counted over all documents, those of items only; the count combines on
    the map side.
    """
    wanted = wanted.withColumn("words", F.transform("words", lambda w: F.xxhash64(w)))
    vocabulary = materialise(wanted.select(F.explode("words").alias("word")).distinct(), "vocabulary")
    found = docs.select(F.explode(_tokens(F.col("text"))).alias("word")).join(vocabulary, "word")
    rarity = materialise(found.groupBy("word").agg(F.count("*").alias("n")), "rarity")
    places = wanted.select("iid", "m", F.posexplode("words").alias("q", "word"))
    ranked = places.join(rarity, "word", "left").select("iid", "m", F.struct(F.coalesce("n", F.lit(0)).alias("n"), "word", "q").alias("place"))
    # An item's words stand in one row already; here they come back together.
    by_item = ranked.groupBy("iid", "m").agg(F.array_sort(F.collect_list(F.struct(F.col("place.q"), "place"))).alias("places"))
    size = F.least(F.col("m"), F.lit(window))
    rarest = F.transform(
        F.sequence(F.lit(1), F.col("m") - size + 1),
        lambda s: F.array_min(F.transform(F.slice("places", s, size), lambda p: p["place"])),
    )
    chosen = by_item.select("iid", "m", F.explode(F.array_distinct(rarest)).alias("place"))
    return chosen.select(F.col("place.word").alias("word"), "iid", F.col("place.q").alias("q"), "m")


def _same(*columns: str) -> list[Column]:
    return [F.col(f"docs.{c}").eqNullSafe(F.col(f"found.{c}")) for c in columns]


def contaminated_words(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, text_hash, iid, hits): where windows of an item occur in a document, as word positions.

    ``docs`` has doc_id, text, text_hash. Words of documents are joined with the items' anchors, which
    gives (document, item, shift) candidates; a shift under which less than a window overlaps is out.
    Of a candidate, only the item-sized stretch of the document is compared, word by word. Spark
    broadcasts anchors and items only where it finds their written tables small.
    """
    items = items.dropDuplicates(["iid"])
    anchors = materialise(_anchors(docs, items, window), "anchors")
    spread = docs.select("doc_id", "text_hash", F.posexplode(_tokens(F.col("text"))).alias("pos", "word"))
    shift = (F.col("pos") - F.col("q")).alias("shift")
    pairs = spread.join(anchors, "word").select("doc_id", "text_hash", "iid", "m", shift)
    size = F.least(F.col("m"), F.lit(window))
    pairs = materialise(pairs.filter(F.col("shift") + F.col("m") >= size).distinct(), "pairs")

    # One row per document and candidate list, so that its words are cut once.
    listed = pairs.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("iid", "m", "shift")).alias("pairs"))
    texts = docs.filter("text is not null").select("doc_id", "text_hash", "text").dropDuplicates(["doc_id", "text_hash"])
    both = texts.alias("docs").join(listed.alias("found"), _same("doc_id", "text_hash"))
    both = both.select("docs.doc_id", "docs.text_hash", words_of(F.col("docs.text")).alias("words"), "found.pairs")

    def stretch(pair: Column) -> Column:
        first = F.greatest(F.lit(0), pair["shift"])
        last = F.greatest(first, F.least(F.size("words"), pair["shift"] + pair["m"]))
        return F.struct(pair["iid"].alias("iid"), pair["shift"].alias("shift"), first.alias("first"), F.slice("words", first + 1, last - first).alias("found"))

    stretches = both.select("doc_id", "text_hash", F.explode(F.transform("pairs", stretch)).alias("s"))
    stretches = stretches.select("doc_id", "text_hash", "s.*").filter("size(found) > 0").join(items.select("iid", "words", "m"), "iid")
    stretches = stretches.filter(F.size("found") >= size)
    theirs = F.slice("words", F.col("first") - F.col("shift") + 1, F.size("found"))
    equal = stretches.withColumn("equal", F.zip_with("found", theirs, lambda a, b: a == b))
    starts = F.filter(
        F.sequence(F.lit(0), F.size("found") - size), lambda s: F.forall(F.slice("equal", s + 1, size), lambda x: x)
    )
    hits = F.array_distinct(F.flatten(F.transform("starts", lambda s: F.sequence(F.col("first") + s, F.col("first") + s + size - 1))))
    found = equal.withColumn("starts", starts).filter(F.size("starts") > 0)
    return found.select("doc_id", "text_hash", "iid", hits.alias("hits"))


def judged_texts(docs: DataFrame, items: DataFrame, window: int = WINDOW, share: int = SHARE) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated, text_hash), one row per row of ``docs``.

    ``docs`` has doc_id and text, ``items`` item_id and text; other columns play no part. A window is
    ``window`` consecutive words of an item, or all of a shorter one. A document's word is hit if it
    lies in an occurrence of a window; the document is contaminated if words are hit, and one in
    ``share`` at least. NULL and empty texts have no words: such documents are clean, such items match
    nothing. Equal items are compared once and count by their ids; repeated ids count once, and a NULL id
    counts for no item though its words are hit. Repeated rows each get their result, and so do texts that share an id or
    have none, which ``text_hash`` (xxhash64) tells apart. DataFrame functions only.
    """
    rows = docs.select(F.col("doc_id"), F.col("text"), F.xxhash64("text").alias("text_hash"))
    wanted = materialise(_items(items.select("item_id", "text")), "items")
    found = finished(docs.sparkSession, "hits", lambda: contaminated_words(rows, wanted, window))
    words = found.select("doc_id", "text_hash", F.explode("hits").alias("word")).distinct()
    hit = words.groupBy("doc_id", "text_hash").agg(F.count("*").alias("n_hit"))
    ids = found.select("doc_id", "text_hash", "iid").distinct().join(wanted.select("iid", "item_id").distinct(), "iid")
    ids = ids.groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_set("item_id")).alias("ids"))
    per_doc = hit.alias("docs").join(ids.alias("found"), _same("doc_id", "text_hash")).select("docs.*", "found.ids")

    n_words = F.coalesce(F.regexp_count("text", F.lit(_WORD_ANY_CASE)), F.lit(0)).cast("long").alias("n_words")
    counted = rows.select("doc_id", "text_hash", n_words)
    out = counted.alias("docs").join(per_doc.alias("found"), _same("doc_id", "text_hash"), "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    ids = F.coalesce("ids", F.array().cast("array<string>"))
    return out.select(
        "docs.doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ",").cast("binary"), 256).alias("items_sha256"),
        ((n_hit > 0) & (n_hit * share >= F.col("n_words"))).alias("contaminated"),
        "docs.text_hash",
    )


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW, share: int = SHARE) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) of ``judged_texts``."""
    return judged_texts(docs, items, window, share).drop("text_hash")


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _sql_words(text: str) -> str:
    return f"regexp_extract_all(translate(coalesce({text}, ''), '{UPPER}', '{LOWER}'), '{WORD}')"


OP6_SQL = rf"""WITH
  item AS (SELECT item_id, {_sql_words('text')} AS w FROM benchmark),
  item_window AS (SELECT DISTINCT item_id, least(len(w), {WINDOW}) AS size,
      array_to_string(list_slice(w, s, s + least(len(w), {WINDOW}) - 1), ' ') AS gram
    FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), {WINDOW}) + 2)) AS s FROM item WHERE len(w) > 0)),
  doc AS (SELECT doc_id, {_sql_words('text')} AS w FROM documents),
  doc_window AS (SELECT doc_id, s, size, array_to_string(list_slice(w, s, s + size - 1), ' ') AS gram
    FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS s
          FROM doc CROSS JOIN (SELECT DISTINCT size FROM item_window))),
  hit AS (SELECT doc_id, item_id, s, size FROM doc_window JOIN item_window USING (size, gram)),
  word AS (SELECT doc_id, count(DISTINCT pos) AS n_hit
    FROM (SELECT doc_id, unnest(range(s, s + size)) AS pos FROM hit) GROUP BY doc_id),
  ids AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM hit) GROUP BY doc_id)
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit > 0 AND {SHARE} * n_hit >= len(w), false) AS contaminated
  FROM doc LEFT JOIN word USING (doc_id) LEFT JOIN ids USING (doc_id)"""
