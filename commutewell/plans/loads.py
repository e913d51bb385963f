"""Loads of the gold tables."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commutewell.contract import ACTIVITY, CSV_FIXED, HISTORY_FIXED, REFERENCE, conform, contract_diff, require_readable
from commutewell.functions.dates import moment_of
from commutewell.operators import facts as op
from commutewell.operators.dedup import one_per_key
from commutewell.operators.quality import undated
from commutewell.plans.contributions import CONTRIBUTE, contribute, contribute_history, withdraw
from commutewell.plans.lake import Lake, Parameters
from commutewell.sources.files import read_activities, read_hr_csv
from commutewell.streaming.facts import GEO_UPDATE, LIVE, merge_facts


def load_history(lake: Lake, parameters: Parameters = Parameters()) -> None:
    """Facts and reference from the whole history zone; the zone must exist.

    Facts are refreshed in full. The reference takes every employee's latest record by upsert of all
    columns. Activities that no fact counts are set aside.
    """
    activities = read_activities(lake.spark, lake.history, required=True)
    if parameters.live_mode == CONTRIBUTE:
        contribute_history(lake, activities, parameters)
    else:
        load_history_facts(lake, activities, parameters)
    load_history_reference(lake, activities)
    undated(activities).write.mode("overwrite").parquet(f"{lake.undated}/history")


def load_history_facts(lake: Lake, activities: DataFrame, parameters: Parameters = Parameters()) -> None:
    """Both facts, from one scan of the activities."""
    summary = op.history_summary(activities).persist(StorageLevel.DISK_ONLY)
    try:
        lake.bonus.replace(op.distance_bonus_from_summary(summary, parameters.one_way_km, parameters.euro_per_km))
        lake.eligibility.replace(
            op.eligibility_from_summary(summary, parameters.history_threshold, source=op.HISTORY), unique_source=True
        )
    finally:
        summary.unpersist()


def load_history_reference(lake: Lake, activities: DataFrame) -> None:
    """One reference row per employee from their latest activity record."""
    taken = [c for c in REFERENCE.names if c in ACTIVITY.names and c not in HISTORY_FIXED]
    moment = moment_of(activities, "date_activite").alias("_moment")
    people = activities.where(F.col("id_salarie").isNotNull()).select(*taken, moment)
    latest = conform(one_per_key(people, ["id_salarie"], newest=["_moment"]), REFERENCE, HISTORY_FIXED)
    if lake.reference.version:
        latest = latest.persist(StorageLevel.DISK_ONLY)  # read for the buckets it touches, then for its rows
    lake.reference.merge(latest, unique_source=True)
    latest.unpersist()


def load_live(lake: Lake, parameters: Parameters = Parameters()) -> int:
    """Process the bronze entries that arrived since the last run; returns how many.

    Merges facts and reference, writes one congratulation per sport activity and sets undated
    activities aside. Nothing new is a normal, empty run. Every step knows the batch's number, so
    an interrupted run is simply started again.
    """
    number, folder, entries = lake.next_batch()
    if not entries:
        return 0
    # Entries nest; nothing in their names is a partition column.
    activities = lake.spark.read.schema(ACTIVITY).option("recursiveFileLookup", "true").parquet(folder)
    if parameters.live_mode == CONTRIBUTE:
        contribute(lake, activities, LIVE, number, parameters)
    else:
        merge_facts(
            activities,
            number,
            lake.eligibility,
            lake.bonus,
            mode=parameters.live_mode,
            rate=parameters.bonus_rate,
            threshold=parameters.live_threshold,
        )
    lake.reference.merge(op.geo_update(activities), GEO_UPDATE, unique_source=True, stream=LIVE, batch=number)
    op.congratulations(activities).write.mode("overwrite").parquet(f"{lake.messages}/batch={number}")
    undated(activities).write.mode("overwrite").parquet(f"{lake.undated}/{LIVE}-{number}")
    lake.finish_batch(number)
    return entries


def load_reference(lake: Lake, csv_path: str) -> int:
    """Replace the reference by an HR export; returns the number of employees.

    Stops when the stored table lacks a field of the activity contract, and when a value of the export does not
    fit its column; the old table then stays.
    """
    stored = lake.reference.stored_columns()
    if stored is not None:
        contract_diff(ACTIVITY, stored)
    export = read_hr_csv(lake.spark, csv_path)
    require_readable(export, REFERENCE, "id_salarie", CSV_FIXED)
    return lake.reference.replace(conform(export, REFERENCE, CSV_FIXED))


def reset_live(lake: Lake, parameters: Parameters = Parameters()) -> None:
    """Take what the live load added back out of the facts and put its batches back, to be processed again.

    Where facts are held as contributions, those of other origins stay. Elsewhere both facts are emptied, which is
    refused when another origin has added to them: its rows would not come again. What was set aside from other
    origins stays.
    """
    if lake.contributions.version:
        withdraw(lake, LIVE, parameters)
    else:
        others = (lake.bonus.streams() | lake.eligibility.streams()) - {LIVE}
        if others:
            raise ValueError(f"the facts also hold {sorted(others)}, which a reset would lose; load with live_mode={CONTRIBUTE!r}")
        lake.bonus.clear()
        lake.eligibility.clear()
    lake.reference.forget(LIVE)
    lake.storage.delete(lake.messages)
    for name in lake.storage.names(lake.undated):
        if name.startswith(f"{LIVE}-"):
            lake.storage.delete(f"{lake.undated}/{name}")
    lake.restore_batches()
