"""Whitespace-aligned observation text: one file per entity, one line per month.

Two ways to clean it. ``parse_lines`` keeps every data line: missing values become NULL, quality
marks are stripped, signs are kept. ``parse_legacy`` drops and shifts values the way an older
cleaning job did, and exists to reproduce that job's results.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from almanac.functions.columns import cast_columns, quoted
from almanac.sources.shared import materialise
from almanac.spec import STATION_REPORT, ObservationSpec

# The text format.
MISSING = "---"
PROVISIONAL = "Provisional"
MARKS = "*#$"
BLANKS = " \t\r\f\v"
NUMBER = r"[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?"
START = r"^\s*\d{4}\s+\d{1,2}(?:\s|$)"
FILE_NAME = r"([^/.]*)[^/]*$"

DIGIT_FIRST = r"^\s*\d"

#: What a line is; every line is one of these.
DATA, REJECTED, OTHER, PREAMBLE = CLASSES = ("data", "rejected", "other", "preamble")

# What the older job removed from a line, and the line starts it skipped.
LEGACY_REMOVED = ("-", "provisional", "#", "*")
LEGACY_SKIPPED = (
    "Location",
    "Estimated",
    "Missing",
    "Sunshine",
    "   yyyy  ",
    "              degC    ",
    "Site closed",
)


def entity_of(path: Column, entity_in: str = FILE_NAME) -> Column:
    """The entity that a file's path names: the first group of ``entity_in``."""
    # Paths arrive percent-encoded, but with "+" as it is.
    return F.regexp_extract(F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), entity_in, 1)


def read_lines(
    spark: SparkSession,
    path: str | list[str],
    entity: str = "station",
    drop_titles: bool = False,
    entity_in: str = FILE_NAME,
) -> DataFrame:
    """Lines of all files of a directory, or of a list of files, as (entity, value).

    The entity is the first group of ``entity_in`` in a file's path: by default the file's name up to the
    first dot; ``"station=([^/]*)/"`` finds it in the name of a folder.

    Cleaning recognises data lines by their form, so titles need no treatment. ``drop_titles`` drops
    all lines that equal their file's first line anyway. It reads the files twice: a first job collects
    the titles in the shared folder, whose size then tells whether they can be broadcast.
    """
    lines = spark.read.text(path).select(
        entity_of(F.col("_metadata.file_path"), entity_in).alias(entity),
        "value",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
    )
    if drop_titles:
        # A file's first block is read by one task from top to bottom.
        titles = (
            lines.filter("_start = 0")
            .withColumn("_row", F.monotonically_increasing_id())
            .groupBy("_file")
            .agg(F.min_by("value", "_row").alias("value"))
        )
        lines = lines.join(materialise(titles, "titles"), ["_file", "value"], "left_anti")
    return lines.select(quoted(entity), "value")


def classified_lines(lines: DataFrame, spec: ObservationSpec = STATION_REPORT) -> DataFrame:
    """(entity, value, token, class) of every line; each is in exactly one class.

    Lines that start as data do, with a year and a month, are ``data`` if they have a token for every value before a
    provisional mark or a note and no number after these, else ``rejected``. Other lines that begin with a digit are ``other``,
    as they may have been meant as data. All else is ``preamble``: titles, notes, headers, footers and blank lines.
    ``token`` is NULL for lines that do not start as data.
    """
    value = F.col("value")
    word = rf"(?i){PROVISIONAL}"
    # Marks and blanks separate tokens, and so does the provisional word, in any case and wherever it is attached.
    apart = F.when(value.rlike(word), F.regexp_replace(value, word, f" {PROVISIONAL} ")).otherwise(value)
    trimmed = F.ltrim(F.rtrim(apart, F.lit(BLANKS + MARKS)), F.lit(BLANKS))
    # A generated column, which filters on it do not make Spark compute once more.
    split = F.explode(F.array(F.when(value.rlike(START), F.split(trimmed, rf"[{MARKS}\s]+")))).alias("token")
    tokens = lines.select(quoted(spec.entity), "value", split)
    n = 2 + len(spec.values)
    word_at, after = F.array_position("token", PROVISIONAL), F.get("token", F.lit(n))
    enough = (F.size("token") >= n) & ((word_at == 0) | (word_at > n))
    ok = enough & ~F.coalesce(after.rlike(f"^(?:{NUMBER}|{MISSING})$"), F.lit(False))
    kind = F.when(F.col("token").isNotNull(), F.when(ok, DATA).otherwise(REJECTED))
    return tokens.withColumn("class", kind.when(value.rlike(DIGIT_FIRST), OTHER).otherwise(PREAMBLE))


def parse_lines(lines: DataFrame, spec: ObservationSpec = STATION_REPORT) -> DataFrame:
    """Typed observations plus ``provisional``, from every line with a year, a month and all values.

    A value that is missing or no number is NULL, and so is a month that is none; the row stays. Lines
    that start as data but have too few or too many values are in ``rejected_lines``.
    """
    return parse_classified(classified_lines(lines, spec), spec)


def parse_classified(classified: DataFrame, spec: ObservationSpec = STATION_REPORT) -> DataFrame:
    """``parse_lines`` of lines that are classified already."""
    tokens = classified.filter(F.col("class") == DATA)
    names = [spec.year, spec.month, *spec.values]
    kinds = dict(spec.columns)

    def value_at(i: int, name: str) -> Column:
        token = F.get("token", F.lit(i))
        token = token if i < 2 or kinds[name] not in ("double", "int", "long") else F.when(token.rlike(f"^{NUMBER}$"), token)
        return (F.when(token.cast("int").between(1, 12), token) if i == 1 else token).alias(name)

    texts = tokens.select(
        quoted(spec.entity),
        *[value_at(i, name) for i, name in enumerate(names)],
        F.array_contains("token", PROVISIONAL).alias("provisional"),
    )
    return cast_columns(texts, [c for c in spec.columns if c[0] in names])


def rejected_lines(lines: DataFrame, spec: ObservationSpec = STATION_REPORT) -> DataFrame:
    """(entity, value) of the lines that start as data and are none."""
    return classified_lines(lines, spec).filter(F.col("class") == REJECTED).select(quoted(spec.entity), "value")


def unread_lines(lines: DataFrame, spec: ObservationSpec = STATION_REPORT) -> DataFrame:
    """(entity, value, class) of the rejected lines and of others that begin with a digit, so that nothing is lost unseen."""
    return classified_lines(lines, spec).filter(F.col("class").isin(REJECTED, OTHER)).select(quoted(spec.entity), "value", "class")


def line_counts(classified: DataFrame, name: str = "lines") -> tuple[DataFrame, Observation]:
    """The lines with an observation that counts them by class while some action reads them: read and one count per class."""
    counts = Observation(name)
    each = [F.count(F.when(F.col("class") == c, 1)).alias(c) for c in CLASSES]
    return classified.observe(counts, F.count(F.lit(1)).alias("read"), *each), counts


def parse_legacy(lines: DataFrame, spec: ObservationSpec = STATION_REPORT) -> DataFrame:
    """Observations as the older job stored them: year and month typed, measures as strings.

    It put the entity before the line, deleted hyphens (also minus signs and missing-value marks),
    split at blanks, and kept what had the right number of tokens. Rows with missing values are
    therefore dropped, and a provisional row with one missing value shifts to the left.
    """
    skipped = reduce(or_, [F.startswith("value", F.lit(start)) for start in LEGACY_SKIPPED])
    line = F.concat(F.col(quoted(spec.entity)), F.lit(" "), "value")
    for removed in LEGACY_REMOVED:
        line = F.replace(line, F.lit(removed), F.lit(""))
    # A generated column, which the filter on it does not make Spark compute once more.
    token = F.explode(F.array(F.split(F.rtrim(line, F.lit(BLANKS)), r"\s+"))).alias("token")
    names = [spec.entity, spec.year, spec.month, *spec.values]
    tokens = lines.filter(~skipped).select(token).filter(F.size("token") == len(names))
    texts = tokens.select(*[F.get("token", F.lit(i)).alias(name) for i, name in enumerate(names)])
    return cast_columns(texts, [c for c in spec.columns if c[0] in (spec.year, spec.month)])
