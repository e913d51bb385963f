"""Topic reader, bounded or unbounded.

Needs Spark's Kafka connector on the class path (``--packages org.apache.spark:spark-sql-kafka-0-10_2.13:4.1.2``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

DEFAULT_TOPIC = "cdc.public.ref_salaries"

# Layout of every topic frame.
ENVELOPE = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("timestampType", T.IntegerType()),
    ]
)


def topic_options(
    servers: str, topic: str = DEFAULT_TOPIC, bounded: bool = False, extra: dict[str, str] | None = None
) -> dict[str, str]:
    """Options from the earliest message on; a ``bounded`` read ends at the latest one.

    ``extra`` may hold ``minPartitions`` (more tasks than topic partitions) or, for a stream,
    ``maxOffsetsPerTrigger`` (bounds a micro-batch).
    """
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": "earliest"}
    if bounded:
        options["endingOffsets"] = "latest"
    return options | (extra or {})


def read_topic(spark: SparkSession, servers: str, topic: str = DEFAULT_TOPIC, **extra: str) -> DataFrame:
    """All messages now in ``topic``, whatever earlier runs consumed."""
    return spark.read.format("kafka").options(**topic_options(servers, topic, True, extra)).load()


def stream_topic(spark: SparkSession, servers: str, topic: str = DEFAULT_TOPIC, **extra: str) -> DataFrame:
    """Unbounded messages of ``topic``; the query's checkpoint remembers how far it got."""
    return spark.readStream.format("kafka").options(**topic_options(servers, topic, False, extra)).load()
