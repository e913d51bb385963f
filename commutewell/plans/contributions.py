"""Facts as the sum of what each origin contributed.

An origin is the history, the live load, or a streaming query. Its batches add up in a table of partial aggregates
by origin, employee, year and mode; the facts are aggregates of that table. So any cut of the activities into batches,
in any order, gives the same facts, and one origin can be withdrawn without touching the others.

Every step can be repeated: a batch adds to the contributions once, and the facts of its employees are computed anew
from them whether it was added now or by an attempt that broke off.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from commutewell.operators import facts as op
from commutewell.operators import quality
from commutewell.operators.merge import add
from commutewell.plans.lake import Lake, Parameters
from commutewell.sinks.snapshot import SnapshotTable
from commutewell.streaming.bronze import query_id
from commutewell.streaming.facts import FACT_COLUMNS

CONTRIBUTE = "contribute"  # value of Parameters.live_mode

_PERSON_YEAR = ["id_salarie", "annee_civile"]
_BONUS_VALUES = ("salaire_brut_base", "montant_prime", "date_calcul_dwh", "source_donnees")
_ELIGIBILITY_VALUES = ("nombre_activites_total", "seuil_applique", "est_eligible", "date_calcul_dwh", "source_donnees")


def _newest(old: Column, new: Column) -> Column:
    """Update rule of salary and moment: both come from the later moment, of equal ones from the higher salary."""
    rank = lambda side: F.struct(f"{side}_dernier_moment", f"{side}_salaire_brut")
    return F.when(rank("new") > rank("old"), new).otherwise(old)


_ADDING = {"nombre_activites": add, "nombre_jours": add, "salaire_brut": _newest, "dernier_moment": _newest}


def contribute(lake: Lake, activities: DataFrame, origin: str, batch: int, parameters: Parameters = Parameters()) -> None:
    """Add one batch of ``origin`` and bring the facts of its employees and years up to date."""
    rows = op.contributions(activities, origin).persist(StorageLevel.DISK_ONLY)
    try:
        years = _years(rows)
        lake.contributions.merge(rows, _ADDING, unique_source=True, stream=origin, batch=batch, parts=years)
        mine = _of_people(lake.contributions.read(years), rows)
        lake.bonus.merge(_bonus(mine, parameters), _BONUS_VALUES, unique_source=True, parts=years)
        lake.eligibility.merge(_eligibility(mine, parameters), _ELIGIBILITY_VALUES, unique_source=True, parts=years)
    finally:
        rows.unpersist()


def contribute_history(lake: Lake, activities: DataFrame, parameters: Parameters = Parameters()) -> None:
    """Replace what the history contributed, and both facts in full from all origins."""
    others = lake.contributions.read().where(F.col("origine") != op.HISTORY)
    lake.contributions.replace(others.unionByName(op.contributions(activities, op.HISTORY)), unique_source=True)
    rows = lake.contributions.read()
    lake.bonus.replace(_bonus(rows, parameters), unique_source=True)
    lake.eligibility.replace(_eligibility(rows, parameters), unique_source=True)


def withdraw(lake: Lake, origin: str, parameters: Parameters = Parameters()) -> None:
    """Take all contributions of ``origin`` out; its batches may then be added again.

    The facts lose them first: an attempt that breaks off in between finds the origin's rows still there.
    """
    mine = F.col("origine") == origin
    gone = lake.contributions.read().where(mine)
    years = _years(gone)
    left = _of_people(lake.contributions.read(years).where(~mine), gone)
    _exchange(lake.bonus, _bonus(left, parameters), gone, _BONUS_VALUES, years)
    _exchange(lake.eligibility, _eligibility(left, parameters), gone, _ELIGIBILITY_VALUES, years)
    lake.contributions.delete(mine, forget=origin)


def stream_contributions(
    activities: DataFrame, checkpoint: str, lake: Lake, parameters: Parameters = Parameters(), bounded: bool = False
) -> StreamingQuery:
    """Add every micro-batch of ``activities``, as an origin named by the query's own id.

    Activities that no fact counts go to a directory per batch in the lake's ``undated`` zone.
    """
    spark = activities.sparkSession

    def apply(batch: DataFrame, number: int) -> None:
        origin = f"stream-{query_id(spark, checkpoint)}"
        contribute(lake, batch, origin, number, parameters)
        quality.undated(batch).write.mode("overwrite").parquet(f"{lake.undated}/{origin}-{number}")

    writer = activities.select(*FACT_COLUMNS).writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    if bounded:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def _bonus(rows: DataFrame, parameters: Parameters) -> DataFrame:
    return op.bonus_from_contributions(rows, parameters.bonus_rate, parameters.one_way_km, parameters.euro_per_km)


def _eligibility(rows: DataFrame, parameters: Parameters) -> DataFrame:
    return op.eligibility_from_contributions(rows, parameters.live_threshold, parameters.history_threshold)


def _years(rows: DataFrame) -> list[int]:
    return [r[0] for r in rows.select("annee_civile").distinct().collect()]


def _of_people(rows: DataFrame, touched: DataFrame) -> DataFrame:
    """Those of ``rows`` with an employee and year of ``touched``: a batch of few employees computes few facts."""
    return rows.join(touched.select(*_PERSON_YEAR).distinct(), _PERSON_YEAR, "left_semi")


def _exchange(table: SnapshotTable, fresh: DataFrame, touched: DataFrame, values: tuple[str, ...], years: list[int]) -> None:
    """Merge ``fresh`` into ``table``; of the employees and years of ``touched``, keys that ``fresh`` lacks are deleted.

    What a matched key does not take from ``values``, such as the state of its payment, stays.
    """
    keys = list(table.contract.keys)
    known = _of_people(table.read(years).select(*keys), touched)
    gone = known.join(fresh.select(*keys), keys, "left_anti").withColumn("_gone", F.lit(True))
    source = fresh.withColumn("_gone", F.lit(False)).unionByName(gone, allowMissingColumns=True)
    table.merge(source, values, unique_source=True, control=["_gone"], delete=F.col("new__gone"), parts=years)
