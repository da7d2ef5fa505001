"""From raw documents to a training mix: filters, dedup, decontamination and mixing, stage by stage.

Each stage is a job of its own: what it keeps is written as Parquet and read again, so a lost executor costs
no more than the stage it works for. A stage takes (spark, docs, sf_dir) and works on all of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.llm import decontaminate, lines, mixing, ngram_join, toxicity
from almanac.llm.common import table
from almanac.sources.shared import materialise


#: Near copies share this percentage of their runs of so many words.
NEAR_WORDS, NEAR_PERCENT = 5, 80


def _by_text(docs: DataFrame, told: DataFrame, how: str) -> DataFrame:
    """The rows of ``docs`` whose id and text are in ``told`` (doc_id, text_hash), or are not; NULL equals NULL."""
    same_id = F.col("docs.doc_id").eqNullSafe(F.col("told.doc_id"))
    same_text = F.xxhash64(F.col("docs.text")).eqNullSafe(F.col("told.text_hash"))
    joined = docs.alias("docs").join(told.select("doc_id", "text_hash").alias("told"), same_id & same_text, how)
    return joined.select(*[F.col(f"docs.`{c}`") for c in docs.columns])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on labelled ones, takes for toxic go.

    Each row is judged by its own text, so a NULL, repeated or clashing id changes nothing. NULL and empty texts stay.
    """
    net = toxicity.train(docs, table(spark, sf_dir, "labels"), F.lit(True))
    return docs.filter(F.col("text").isNull() | (toxicity.toxic_score(F.col("text"), net) < 0.5))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines go from the texts, whose length is set anew; documents stay, all of them.

    NULL texts stay NULL. Repeated rows get equal texts; a NULL, repeated or clashing id changes nothing.
    """
    found = lines.drop_recurring_lines(docs, by_copies=True)
    new = {"text": F.col("text"), "n_chars": F.when(F.col("n_dropped") > 0, F.length("text")).otherwise(F.col("doc.n_chars"))}
    return found.select(*[new.get(c, F.col(f"doc.`{c}`")).alias(c) for c in docs.columns])


def keep_one_of_each_group(
    spark: SparkSession, docs: DataFrame, sf_dir: str, words: int = NEAR_WORDS, percent: int = NEAR_PERCENT
) -> DataFrame:
    """Of each group of near copies one document stays, once: the one with the smallest id, NULL last.

    Near copies share ``percent`` of their runs of ``words`` words, by links. Rows are told apart by id and text: of texts that
    share the smallest id, one stays; rows of one id with the same text are one document, without an id only if they have
    words. Other documents without words stay, as they are no copies of anything.
    """
    found = materialise(ngram_join.ngram_members(docs, words, percent).filter("n_shingles > 0 or doc_id is not null"), "near")
    gone = materialise(found.filter("not first").select("doc_id", "text_hash").distinct(), "copies")
    again = found.filter("first").groupBy("doc_id", "text_hash").agg(F.count("*").alias("n")).filter("n > 1")
    again = materialise(again.select("doc_id", "text_hash"), "repeated")
    left = _by_text(docs, gone, "left_anti")
    once = _by_text(left, again, "left_semi").dropDuplicates(["doc_id", "text"])
    return _by_text(left, again, "left_anti").union(once)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with too many words from benchmark items go.

    Each row is judged by its own text: a NULL id does not save one, and a clashing one condemns none. NULL texts stay.
    """
    found = decontaminate.judged_texts(docs, table(spark, sf_dir, "benchmark"))
    gone = materialise(found.filter("contaminated").select("doc_id", "text_hash").distinct(), "contaminated")
    return _by_text(docs, gone, "left_anti")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How often each document goes into the mix: doc_id, source, size, source_size, target, copies, taken.

    One row per row, whatever its id; a NULL source is a source, and a NULL text has size 0.
    """
    return mixing.mix_sources(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("n-gram Jaccard join", keep_one_of_each_group),
    ("benchmark decontamination", drop_contaminated),
    ("mixing sources", mix),
]

#: Trained models and random rounding have no SQL; tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from the table of documents; each reads what the one before has written."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
