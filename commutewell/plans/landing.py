"""Landing topic messages and test events in the bronze zones."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from commutewell.contract import ACTIVITY, conform
from commutewell.functions.wire import decode
from commutewell.operators.dispatch import Layout, records, resolve, set_aside
from commutewell.operators.quality import landing_measures
from commutewell.plans.lake import Lake
from commutewell.sinks.files import drop_batch, overwrite, overwrite_observed
from commutewell.sources.files import read_activity_csv
from commutewell.streaming.bronze import land, landed_counts


def land_history(lake: Lake, messages: DataFrame, codec, files: int | None = None) -> int:
    """Replace the history zone by all ``messages``; returns how many there were."""
    return overwrite(conform(decode(messages, codec), ACTIVITY), lake.history, files)


def land_live(lake: Lake, messages: DataFrame, codec, bounded: bool = False) -> StreamingQuery:
    """Append a stream of ``messages`` to the live zone, from where the last run stopped."""
    activities = conform(decode(messages, codec), ACTIVITY)
    return land(activities, lake.live, f"{lake.checkpoints}/live", bounded, landing_measures(activities))


def live_counts(lake: Lake) -> DataFrame:
    """What every micro-batch of the live zone held, counted while it was written."""
    names = landing_measures(conform(lake.spark.createDataFrame([], ACTIVITY), ACTIVITY))
    return landed_counts(lake.spark, f"{lake.checkpoints}/live", names)


def land_history_observed(lake: Lake, messages: DataFrame, codec, files: int | None = None) -> dict[str, int]:
    """``land_history`` that returns the measures of ``landing_measures``, from the run that writes the zone."""
    activities = conform(decode(messages, codec), ACTIVITY)
    return overwrite_observed(activities, lake.history, landing_measures(activities), files)


def land_history_mixed(lake: Lake, messages: DataFrame, layouts: Mapping[int, Layout]) -> dict[str, int]:
    """Replace the history zone by the records of a topic of several schemas, one layout by schema id.

    Messages that give no record are set aside with their bytes below ``lake.unread``. Returns how many ``landed``
    and how many are ``unread``.
    """
    resolved = resolve(messages, layouts, ACTIVITY)
    landed = overwrite_observed(records(resolved, ACTIVITY), lake.history, {"landed": F.count("*")})
    return landed | overwrite_observed(set_aside(resolved), f"{lake.unread}/history", {"unread": F.count("*")})


def land_live_mixed(lake: Lake, messages: DataFrame, layouts: Mapping[int, Layout], bounded: bool = False) -> list[StreamingQuery]:
    """Append a stream of several schemas to the live zone; a second query sets aside what gives no record."""
    resolved = resolve(messages, layouts, ACTIVITY)
    activities = records(resolved, ACTIVITY)
    aside = land(set_aside(resolved), f"{lake.unread}/live", f"{lake.checkpoints}/unread", bounded)
    return [land(activities, lake.live, f"{lake.checkpoints}/live", bounded, landing_measures(activities)), aside]


def inject_events(lake: Lake, csv_path: str, name: str | None = None, files: int | None = None) -> str:
    """Drop the events of a CSV file beside the live stream, each read by the contract; returns the new directory.

    A large file is read in splits and every task writes its own; ``files=1`` is for a small one.
    """
    return drop_batch(read_activity_csv(lake.spark, csv_path), lake.drops, name, files)
