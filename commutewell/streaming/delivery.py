"""Messages that are delivered more than once."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame


def once(messages: DataFrame, key: Iterable[str], arrived: str, delay: str) -> DataFrame:
    """``messages`` of a stream, each ``key`` once, however often and in whatever micro-batch it is delivered.

    ``arrived`` is the time at which the source took a message in, such as a topic's append time; every delivery of a
    message carries the same one. Keys are remembered until the newest arrival is ``delay`` past theirs. What is
    delivered later than that is behind the watermark and left out: with a time that the source sets on arrival,
    only a repeated message can be, as when a topic is read again from its start.

    The key is a topic's (partition, offset), or an event's own id where a producer may send it twice. State is kept
    by Spark's state store in the query's checkpoint, by key, so no key is hot.
    """
    return messages.withWatermark(arrived, delay).dropDuplicatesWithinWatermark(list(key))
