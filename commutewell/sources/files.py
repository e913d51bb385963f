"""Parquet and CSV readers and the file inventory."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from commutewell.contract import ACTIVITY, HR_HEADERS, ContractViolation
from commutewell.sources.storage import Storage

INVENTORY = "entry string, n_files bigint, modified timestamp"


class MissingInput(FileNotFoundError):
    """A load's required input does not exist."""


def empty(spark: SparkSession, schema: T.StructType | str) -> DataFrame:
    """No rows of ``schema``, in a form Catalyst knows to be empty: joins and unions with it vanish."""
    fields = (T.DataType.fromDDL(schema) if isinstance(schema, str) else schema).fields
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields]).where(F.lit(False))


def read_parquet(
    spark: SparkSession, paths: str | list[str], schema: T.StructType | None = None, required: bool = False
) -> DataFrame:
    """Parquet under ``paths`` (directories or globs) read by the contract, never by inference.

    No such path is an empty frame, or ``MissingInput`` when the input is ``required``. Without a
    ``schema`` the layout comes from the files and a missing path always raises.
    """
    paths = [paths] if isinstance(paths, str) else paths
    reader = spark.read.schema(schema) if schema is not None else spark.read
    try:
        return reader.parquet(*paths)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        if required or schema is None:
            raise MissingInput(f"no data at {', '.join(paths)}") from error
        return empty(spark, schema)


def read_activities(spark: SparkSession, paths: str | list[str], required: bool = False) -> DataFrame:
    """Activity records of a bronze zone."""
    return read_parquet(spark, paths, ACTIVITY, required)


def read_activity_csv(spark: SparkSession, path: str) -> DataFrame:
    """Activity records from CSV files with a header in contract order.

    The word ``NULL`` and empty fields are missing values; a header that differs from the contract
    is an error.
    """
    return spark.read.csv(
        path, schema=ACTIVITY, header=True, sep=",", nullValue="NULL", quote='"', escape='"', enforceSchema=False
    )


def read_hr_csv(
    spark: SparkSession,
    path: str,
    headers: Mapping[str, str] = HR_HEADERS,
    required: Iterable[str] = ("Date de naissance",),
) -> DataFrame:
    """HR export as text columns under their technical names.

    Header names lose a byte-order mark and outer blanks. A missing ``required`` header is a
    ``ContractViolation``.
    """
    raw = spark.read.csv(path, header=True, sep=",", encoding="UTF-8", quote='"', escape='"')
    raw = raw.toDF(*[name.strip("\ufeff \t\r\n") for name in raw.columns])
    missing = [name for name in required if name not in raw.columns]
    if missing:
        raise ContractViolation(f"columns {missing} not in the CSV header {raw.columns}")
    return raw.withColumnsRenamed(dict(headers))


def inventory(spark: SparkSession, zone: str, suffix: str = ".parquet") -> DataFrame:
    """Entries directly below ``zone`` named ``*suffix``: files, or directories of such files.

    Columns ``entry``, ``n_files`` and ``modified`` (latest change of a file). Empty files do not
    count. File contents are not read; Spark lists large zones in parallel.
    """
    try:
        files = (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", "true")
            .option("pathGlobFilter", f"*{suffix}")
            .load(zone)
        )
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty(spark, INVENTORY)
    return (
        files.select(entry_of(spark, zone, "path", encoded=False).alias("entry"), "modificationTime")
        .where(F.col("entry").endswith(suffix))
        .groupBy("entry")
        .agg(F.count("*").alias("n_files"), F.max("modificationTime").alias("modified"))
    )


def entry_of(spark: SparkSession, zone: str, path: str | Column, encoded: bool = True) -> Column:
    """Column: name of the entry of ``zone`` that holds the file ``path``; NULL for a file elsewhere.

    ``encoded`` says that the path is URL-encoded, as in ``_metadata.file_path``.
    """
    path = F.col(path) if isinstance(path, str) else path
    base = Storage(spark).absolute(zone, encoded).rstrip("/") + "/"
    inside = F.element_at(F.split(F.substring_index(path, base, -1), "/"), 1)
    return F.when(path.contains(base), inside)


def count_files(spark: SparkSession, zone: str, suffix: str = ".parquet") -> int:
    """Number of files named ``*suffix`` anywhere below ``zone``."""
    found = inventory(spark, zone, suffix).agg(F.coalesce(F.sum("n_files"), F.lit(0)))
    return found.first()[0]
