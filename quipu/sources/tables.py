"""Readers. Every reader takes an explicit projection or schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_table(spark: SparkSession, folder: str, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def read_query(
    spark: SparkSession,
    url: str,
    query: str,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 1,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """Run a query in an external database; split by ``partition_column`` for parallel reads."""
    reader = spark.read.format("jdbc").option("url", url).options(**(properties or {}))
    if partition_column is None:
        return reader.option("query", query).load()
    if bounds is None:
        raise ValueError("a partitioned read needs the bounds of its partition column")
    return (
        reader.option("dbtable", f"({query}) src")
        .option("partitionColumn", partition_column)
        .option("lowerBound", bounds[0])
        .option("upperBound", bounds[1])
        .option("numPartitions", partitions)
        .load()
    )


def read_delimited(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Forum exports as CSV; messages may hold quotes and line breaks.

    Because of the line breaks a file is read by one task whatever its size; large
    exports are better written by ``sinks.export_lines`` and read by ``read_json``.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("multiLine", True)
        .option("quote", '"')
        .option("escape", '"')
        .csv(path)
    )


def read_json(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)
