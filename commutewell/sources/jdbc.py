"""Warehouse table reader over JDBC. Needs the database's driver on the class path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(url: str, table: str, **extra: str) -> dict[str, str]:
    """Connection options; pass user, password and driver in ``extra``."""
    return {"url": url, "dbtable": table, **extra}


def partitioned(column: str, lower: int, upper: int, partitions: int) -> dict[str, str]:
    """Options that read a table in parallel by ranges of a numeric column.

    Rows outside ``lower`` and ``upper`` are still read, by the first and last range.
    """
    return {
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
    }


def read_table(spark: SparkSession, url: str, table: str, **extra: str) -> DataFrame:
    """A table or ``(select ...) alias``; filters and columns are pushed into the database."""
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **extra)).load()
