"""Helpers shared by the operators: reading tables, cutting lineage, ASCII words."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from commutewell.session import work_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: its lineage ends there.

    A lost executor costs a re-read, not a recomputation, and every later reader sees the same rows.
    """
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_words(text: str | None) -> list[bytes]:
    """Runs of anything but space and \\x09-\\x0D, with A-Z in lower case; no words without text."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []
