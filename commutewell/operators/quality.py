"""Quality checks, quarantine and the alert about it."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commutewell.functions.dates import year_of
from commutewell.functions.text import full_name
from commutewell.operators.filters import outside


@dataclass(frozen=True)
class Check:
    """``measure`` (min, max or count) of ``column``, compared with ``bound`` by ``op`` (>=, <= or >)."""

    name: str
    measure: str
    column: str
    op: str
    bound: float


@dataclass(frozen=True)
class Bounds:
    """Rows of a table whose ``column`` leaves [``low``, ``high``] are rejected as ``name``."""

    name: str
    column: str
    low: float
    high: float


# The checks and bounds of the warehouse.
REFERENCE_CHECKS = (
    Check("Distance positive", "min", "distance_km", ">=", 0),
    Check("Latitude Min France", "min", "latitude", ">=", 40),
    Check("Latitude Max France", "max", "latitude", "<=", 52),
    Check("Longitude Min France", "min", "longitude", ">=", -5),
    Check("Longitude Max France", "max", "longitude", "<=", 10),
)
BONUS_CHECKS = (
    Check("Prime positive", "min", "montant_prime", ">=", 0),
    Check("Seuil alerte prime", "max", "montant_prime", "<=", 500),
)
RAW_CHECKS = (Check("row_count", "count", "*", ">", 0),)
DISTANCE_BOUNDS = Bounds("Distance Hors Bornes", "distance_km", 0, 500)
BONUS_BOUNDS = Bounds("Prime Hors Bornes", "montant_prime", 0, 500)
UNDATED = "Date Invalide"

_MEASURES = {"min": F.min, "max": F.max, "count": F.count}
_OPS = {
    ">=": lambda value, bound: value >= bound,
    "<=": lambda value, bound: value <= bound,
    ">": lambda value, bound: value > bound,
}


def metric_checks(df: DataFrame, checks: Iterable[Check]) -> DataFrame:
    """One row ``(check_name, value, passed)`` per check, from one aggregate over ``df``.

    A measure over no values is NULL and so is its verdict.
    """
    checks = list(checks)
    measures = [_MEASURES[c.measure](c.column).cast("double").alias(f"m{i}") for i, c in enumerate(checks)]

    def verdict(i: int, check: Check) -> Column:
        value = F.col(f"m{i}")
        passed = _OPS[check.op](value, float(check.bound))
        return F.struct(F.lit(check.name).alias("check_name"), value.alias("value"), passed.alias("passed"))

    rows = F.explode(F.array(*[verdict(i, c) for i, c in enumerate(checks)])).alias("_row")
    return df.agg(*measures).select(rows).select("_row.*")


def rejects(df: DataFrame, bounds: Bounds, id_column: str = "id_salarie") -> DataFrame:
    """Quarantine rows ``(id_salarie, check_name, value)`` for the values outside ``bounds``."""
    return df.where(outside(bounds.column, bounds.low, bounds.high)).select(
        F.col(id_column).alias("id_salarie"),
        F.lit(bounds.name).alias("check_name"),
        F.col(bounds.column).cast("double").alias("value"),
    )


def undated(activities: DataFrame) -> DataFrame:
    """Quarantine rows for activities that no fact counts: no employee or no readable date."""
    lost = activities.where(year_of(activities, "date_activite").isNull() | F.col("id_salarie").isNull())
    return lost.select(
        "id_salarie", F.lit(UNDATED).alias("check_name"), F.lit(None).cast("double").alias("value")
    )


def landing_measures(activities: DataFrame) -> dict[str, Column]:
    """Aggregates by name that a landing can observe: all rows, those that no fact will count, distances out of bounds."""
    no_employee = F.col("id_salarie").isNull()
    far = outside(DISTANCE_BOUNDS.column, DISTANCE_BOUNDS.low, DISTANCE_BOUNDS.high)
    return {
        "landed": F.count("*"),
        "undated": F.count_if(year_of(activities, "date_activite").isNull() | no_employee),
        "no_employee": F.count_if(no_employee),
        "rejected": F.count_if(far),
    }


def quarantine(*parts: DataFrame) -> DataFrame:
    """All rejects, each kept as often as it was found."""
    return reduce(DataFrame.unionByName, parts)


def failing_people(
    reference: DataFrame, rejected: DataFrame, id_column: str = "id_salarie", take: Iterable[str] = ("nom", "prenom")
) -> DataFrame:
    """Distinct names of the employees that have a quarantine row.

    Rejects shrink to distinct ids before the join, so an id rejected very often weighs as one row.
    """
    take = list(take)
    ids = rejected.select(F.col("id_salarie").alias("_id")).distinct()
    return reference.join(ids, F.col(id_column) == F.col("_id"), "left_semi").select(*take).distinct()


# Fixed value: the sentence that announces how many people failed.
ALERT = ("⚠️ *Alerte Qualité* : ", " anomalies détectées.")


def alert_rows(people: DataFrame, first: str = "prenom", last: str = "nom") -> DataFrame:
    """The alert about ``people``: one row ``(n, message)`` that counts them and one row ``(name)`` for each.

    ``n`` counts distinct people. Rows have one shape at every size: nothing is gathered, cut or paged. Nobody
    failing is a single row with the count 0.
    """
    people = people.select(first, last).distinct()
    count = people.agg(F.count("*").alias("n"))
    message = F.concat(F.lit(ALERT[0]), F.col("n").cast("string"), F.lit(ALERT[1]))
    summary = count.select("n", F.lit(None).cast("string").alias("name"), message.alias("message"))
    nothing = F.lit(None)
    return summary.unionByName(
        people.select(
            nothing.cast("bigint").alias("n"), full_name(F.col(first), F.col(last)).alias("name"), nothing.cast("string").alias("message")
        )
    )
