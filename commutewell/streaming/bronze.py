"""Landing a stream of records in a Parquet zone."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from commutewell.sinks.files import write_observed
from commutewell.sources.storage import Storage


def stream_files(spark: SparkSession, path: str, schema: T.StructType, **options: str) -> DataFrame:
    """Unbounded frame over the Parquet files that arrive under ``path`` (a directory or a glob).

    ``maxFilesPerTrigger`` or ``maxBytesPerTrigger`` bound a micro-batch.
    """
    return spark.readStream.schema(schema).options(**options).parquet(path)


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """Id of the streaming query that ``checkpoint`` belongs to; it survives restarts."""
    return json.loads(Storage(spark).read_text(f"{checkpoint}/metadata"))["id"]


def land(
    records: DataFrame, path: str, checkpoint: str, bounded: bool = False, measures: Mapping[str, Column] | None = None
) -> StreamingQuery:
    """Append ``records`` to the Parquet zone ``path``, each exactly once.

    Every micro-batch becomes one directory ``path/<query>-<batch>.parquet`` that appears as a whole and may be
    taken away by a reader at any time. A batch that is repeated after a failure is recognised by a mark in the
    checkpoint, made between writing the directory under a hidden name and renaming it. The checkpoint remembers
    the position, so a restart goes on where the last run stopped. A ``bounded`` run takes what is there and ends.

    ``measures`` are aggregates by name; the run that writes a batch takes them, ``landed_counts`` reads them.
    """
    spark = records.sparkSession
    storage = Storage(spark)

    def append(batch: DataFrame, number: int) -> None:
        name = f"{query_id(spark, checkpoint)}-{number:012d}"
        draft, mark = f"{path}/_draft-{name}", f"{checkpoint}/landed/{name}"
        if not storage.exists(mark):
            write = lambda df: df.write.mode("overwrite").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(draft)
            if measures:
                seen = write_observed(batch, measures, write)
                storage.make_dirs(f"{checkpoint}/counts")
                storage.delete(f"{checkpoint}/counts/{name}.json")  # of a run that ended before its mark
                storage.create_text(f"{checkpoint}/counts/{name}.json", json.dumps({"batch": number} | seen))
            else:
                write(batch)
            storage.make_dirs(f"{checkpoint}/landed")
            storage.create_text(mark, "")
        if storage.exists(draft):
            storage.rename(draft, f"{path}/{name}.parquet")
        storage.delete(f"{checkpoint}/landed/{query_id(spark, checkpoint)}-{number - 1:012d}")

    writer = records.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint)
    if bounded:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def landed_counts(spark: SparkSession, checkpoint: str, measures: Iterable[str]) -> DataFrame:
    """Rows (batch, measures): what each batch of the query at ``checkpoint`` landed, counted by the run that wrote it.

    A batch that was repeated has one row. No rows before the first batch.
    """
    schema = T.StructType([T.StructField("batch", T.LongType()), *[T.StructField(m, T.LongType()) for m in measures]])
    folder = f"{checkpoint}/counts"
    if not Storage(spark).exists(folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("pathGlobFilter", "*.json").json(folder)
