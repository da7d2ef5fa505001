"""Parquet store of observations and the CSV sink for answers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def write_observations(
    df: DataFrame, root: str, partition_by: Sequence[str] = ("station",), gather: bool = True
) -> None:
    """Write one directory per key value and replace only the directories that ``df`` has rows for.

    ``gather`` brings a key's rows together first, for files of a useful size: the rebalance hint
    shuffles by the key, and adaptive execution then splits the rows of a hot key over several tasks.
    Rows that come straight from one file per key lie together already and need no shuffle.

    Partition by columns whose number of values does not grow with the data; an entity with millions
    of values should be partitioned by year.
    """
    if gather:
        df = df.hint("rebalance", *partition_by)
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(root)
    )


def read_observations(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """All partitions as one table. The explicit schema keeps keys that look like numbers strings."""
    return spark.read.schema(schema).parquet(root).select(*schema.names)


def write_csv(df: DataFrame, path: str) -> None:
    """Answer as CSV without header, replacing what is there."""
    df.write.mode("overwrite").csv(path)
