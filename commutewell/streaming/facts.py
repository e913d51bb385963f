"""Keeping the facts up to date from a stream of activities."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from commutewell.operators import facts as op
from commutewell.operators import quality
from commutewell.operators.merge import Update, add, take_new
from commutewell.sinks.snapshot import SnapshotTable
from commutewell.streaming.bronze import query_id

# Columns a key match updates; the others keep what the first load wrote.
BONUS_UPDATE = ("montant_prime", "date_calcul_dwh")
ELIGIBILITY_UPDATE = ("nombre_activites_total", "est_eligible", "date_calcul_dwh")
GEO_UPDATE = ("distance_km", "latitude", "longitude", "evolution_conges", "date_geocodage")

LIVE = "live"  # origin of the batches that the live load numbers

REPLACE = "replace"
ACCUMULATE = "accumulate"

# Columns the facts need: the only ones a micro-batch reads.
FACT_COLUMNS = ("id_salarie", "date_activite", "moyen_de_deplacement", "type_sport", "salaire_brut")


def eligibility_update(mode: str, threshold: int) -> dict[str, Update]:
    """Update rules of the eligibility fact.

    ``replace`` takes the new batch's count and verdict, so a year's count can shrink;
    ``accumulate`` adds the batch to the year and judges the sum.
    """
    if mode == REPLACE:
        return dict.fromkeys(ELIGIBILITY_UPDATE, take_new)
    if mode != ACCUMULATE:
        raise ValueError(f"unknown mode {mode!r}")

    def judge(old: Column, new: Column) -> Column:
        total = add(F.col("old_nombre_activites_total"), F.col("new_nombre_activites_total"))
        return total >= threshold

    return {"nombre_activites_total": add, "est_eligible": judge, "date_calcul_dwh": take_new}


def merge_facts(
    activities: DataFrame,
    batch: int,
    eligibility: SnapshotTable,
    bonus: SnapshotTable | None = None,
    stream: str = LIVE,
    mode: str = REPLACE,
    rate: float = op.BONUS_RATE,
    threshold: int = op.LIVE_THRESHOLD,
) -> None:
    """Merge one batch of activities into the fact tables; a batch merged before changes nothing.

    The activities are reduced in one pass; both facts come from that summary, which is kept on
    executor disks for the length of the merge and recomputed where an executor is lost.
    """
    summary = op.live_summary(activities).persist(StorageLevel.DISK_ONLY)
    try:
        if bonus is not None:
            fresh = op.bonus_from_summary(summary, rate)
            bonus.merge(fresh, BONUS_UPDATE, unique_source=True, stream=stream, batch=batch)
        fresh = op.eligibility_from_summary(summary, threshold)
        rules = eligibility_update(mode, threshold)
        eligibility.merge(fresh, rules, unique_source=True, stream=stream, batch=batch)
    finally:
        summary.unpersist()


def stream_facts(
    activities: DataFrame,
    checkpoint: str,
    eligibility: SnapshotTable,
    undated: str,
    bonus: SnapshotTable | None = None,
    bounded: bool = False,
    **options,
) -> StreamingQuery:
    """Merge every micro-batch of ``activities`` into the fact tables (options of ``merge_facts``).

    A micro-batch frame computes all columns of the streaming plan, so the plan is cut down to the
    facts' columns first. Batches are numbered under the query's own id, so that no other load of the same
    tables is mistaken for this one; replayed batches are recognised by the tables. Activities that no fact
    counts go to a directory per batch below ``undated``.
    """
    spark = activities.sparkSession

    def apply(batch: DataFrame, batch_id: int) -> None:
        stream = f"stream-{query_id(spark, checkpoint)}"
        merge_facts(batch, batch_id, eligibility, bonus, stream=stream, **options)
        quality.undated(batch).write.mode("overwrite").parquet(f"{undated}/{stream}-{batch_id}")

    writer = activities.select(*FACT_COLUMNS).writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    if bounded:
        writer = writer.trigger(availableNow=True)
    return writer.start()
