"""Ingest of the files that changed, by a list of files kept with the store."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from almanac.functions.columns import quoted
from almanac.sources.shared import delete_path, materialise, scratch
from almanac.sources.store import write_observations
from almanac.sources.text import FILE_NAME, entity_of, parse_legacy, parse_lines, read_lines
from almanac.spec import STATION_REPORT, ObservationSpec

#: Where a store keeps the list of the files it was made from; Spark passes over names that begin so.
FILES = "_files"
_SCHEMA = "path string, size bigint, modified timestamp, entity string"


def list_files(spark: SparkSession, source: str, entity_in: str = FILE_NAME) -> DataFrame:
    """(path, size, modified, entity) of all files of a directory; their content is not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(source)
    return files.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"), entity_of(F.col("path"), entity_in).alias("entity"))


def known_files(spark: SparkSession, root: str) -> DataFrame:
    """The list of files that the store at ``root`` was made from; empty if there is none."""
    try:
        return spark.read.schema(_SCHEMA).parquet(f"{root}/{FILES}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _SCHEMA)


def ingest_changed(
    spark: SparkSession,
    source: str,
    root: str,
    spec: ObservationSpec = STATION_REPORT,
    mode: str = "strict",
    entity_in: str = FILE_NAME,
) -> list[str]:
    """Bring a store by entity up to date and return the entities that were done anew, in order.

    A file counts as changed if its path, size or time of change is not in the list that the last run left in the store. All
    files of an entity with a changed, new or missing file are read, and its directory is replaced; no other file is
    read and no other directory touched. An entity without files, or whose files have no data, has no directory. The
    list is written last, so a run that fails is made good by the next one. What goes through the driver are the
    paths of the files to read, which Spark lists there anyway, and the entities they belong to.
    """
    if mode not in ("strict", "legacy"):
        raise ValueError(f"mode must be strict or legacy, not {mode!r}")
    with scratch(spark):
        current = materialise(list_files(spark, source, entity_in), "files")
        known = materialise(known_files(spark, root), "known-files")
        same = ["path", "size", "modified", "entity"]
        differ = current.join(known, same, "left_anti").union(known.join(current, same, "left_anti"))
        affected = materialise(differ.select("entity").distinct(), "affected")
        entities = sorted(r.entity for r in affected.collect())
        if not entities:
            return []
        paths = [r.path for r in current.join(affected, "entity", "left_semi").select("path").orderBy("path").collect()]
        for entity in entities:
            delete_path(spark, f"{root}/{_partition(spark, spec.entity, entity)}")
        if paths:
            legacy = mode == "legacy"
            lines = read_lines(spark, paths, spec.entity, drop_titles=legacy, entity_in=entity_in)
            parsed = (parse_legacy if legacy else parse_lines)(lines, spec)
            write_observations(parsed.filter(F.col(quoted(spec.entity)).isNotNull()), root, [spec.entity], gather=legacy)
        current.write.mode("overwrite").parquet(f"{root}/{FILES}")
    return entities


def _partition(spark: SparkSession, column: str, value: str) -> str:
    """The name of a value's directory, as Spark writes it."""
    return spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString(column, value)
