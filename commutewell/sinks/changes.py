"""A table kept up to date from batches of its change feed.

Every key keeps the sequence of the last image that counted, deleted keys as a row of their own that readers do not
see. So an image or a delete that arrives late, in whatever batch, loses against what came after it at the source, and
the table is the same however the feed is cut.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from commutewell.contract import TableContract
from commutewell.operators.merge import last_images
from commutewell.sinks.snapshot import SnapshotTable


class ChangedTable:
    """Rows of ``schema`` by ``keys`` under ``root``, as a change feed ordered by the columns ``sequence`` leaves them."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, keys: Iterable[str], sequence: Iterable[str], buckets: int = 8):
        self.schema, self.sequence = schema, list(sequence)
        rank = T.StructType([schema[c] for c in self.sequence])
        rest = [f for f in schema.fields if f.name not in self.sequence]
        stored = T.StructType([*rest, T.StructField("_sequence", rank), T.StructField("_deleted", T.BooleanType())])
        self._stored = SnapshotTable(spark, root, TableContract("changes", stored, tuple(keys), buckets=buckets))

    def apply(self, feed: DataFrame, delete_flag: str = "__deleted", stream: str | None = None, batch: int | None = None) -> bool:
        """Merge a batch of the feed; rewrites only the buckets of its keys. A replayed batch of ``stream`` is skipped.

        The feed has the table's columns and ``delete_flag``; rows in which that is NULL are tombstones and say
        nothing. Of images with equal keys and sequence, the first one applied stays.
        """
        contract = self._stored.contract
        last = last_images(feed.select(*self.schema.names, delete_flag), contract.keys, self.sequence, delete_flag)
        last = last.withColumn("_sequence", F.col("_sequence").cast(contract.schema["_sequence"].dataType))

        def later(old: Column, new: Column) -> Column:
            return F.when(F.col("new__sequence") > F.col("old__sequence"), new).otherwise(old)

        rules = {c: later for c in contract.columns if c not in contract.keys}
        return self._stored.merge(last, rules, unique_source=True, stream=stream, batch=batch)

    def read(self) -> DataFrame:
        """The present rows."""
        rows = self._stored.read().where("NOT _deleted")
        return rows.select(*[F.col(f"_sequence.{c}").alias(c) if c in self.sequence else F.col(c) for c in self.schema.names])

    def purge(self, before: Column) -> None:
        """Forget deleted keys whose last change is older than ``before``, a struct like the sequence.

        An image older than that which arrives afterwards would bring its key back.
        """
        self._stored.delete(F.col("_deleted") & (F.col("_sequence") < before))
