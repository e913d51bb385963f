"""Yearly facts: transport bonus and wellness eligibility.

All operators take activity rows in the contract's column names. ``date_activite`` may be text,
date or timestamp. Rows without employee or readable date belong to no year; they are left out of
the facts and listed by ``operators.quality.undated``.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commutewell.contract import LIVE_GEO_FIXED
from commutewell.functions.dates import moment_of, year_of
from commutewell.functions.text import congratulation
from commutewell.operators.dedup import latest
from commutewell.operators.filters import SUSTAINABLE_MODES, in_modes, with_activity

# The business rules' default parameters.
BONUS_RATE = 0.05
LIVE_THRESHOLD = 15
HISTORY_THRESHOLD = 10
ONE_WAY_KM = 5.0
EURO_PER_KM = 0.25
TO_PAY = "A PAYER"
LIVE = "LIVE"
HISTORY = "INITIAL_LOAD_BIS"


def _dated(activities: DataFrame, *columns: str | Column) -> DataFrame:
    """``columns`` plus ``annee_civile`` for the rows that have an employee and a year."""
    year = year_of(activities, "date_activite").alias("annee_civile")
    rows = activities.where(F.col("id_salarie").isNotNull()).select("id_salarie", year, *columns)
    return rows.where(F.col("annee_civile").isNotNull())


def stamp(df: DataFrame, source: str, as_of: Column | None = None) -> DataFrame:
    """``df`` with its provenance: time of computation and origin."""
    moment = F.current_timestamp() if as_of is None else as_of
    return df.withColumns({"date_calcul_dwh": moment, "source_donnees": F.lit(source)})


def bonus_by_rate(
    activities: DataFrame,
    rate: float = BONUS_RATE,
    modes: Iterable[str] = SUSTAINABLE_MODES,
    tie_break: Iterable[str] = ("salaire_brut",),
    require_activity: bool = False,
    source: str = LIVE,
    as_of: Column | None = None,
) -> DataFrame:
    """Salary × ``rate`` per employee, year and sustainable mode.

    The salary is the one of the latest activity; ``tie_break`` decides among equal moments. The
    salary stays the contract's single-precision number widened to double, so its rounding shows in
    the product. ``require_activity`` also drops rows without a sport, which reference-table images
    on the same topic are.
    """
    tie_break = list(tie_break)
    rows = in_modes(activities, modes)
    if require_activity:
        rows = with_activity(rows)
    columns = [c for c in dict.fromkeys(["salaire_brut", *tie_break])]
    rows = _dated(rows, "moyen_de_deplacement", moment_of(rows, "date_activite").alias("_moment"), *columns)
    groups = rows.groupBy("id_salarie", "annee_civile", "moyen_de_deplacement").agg(
        latest("salaire_brut", "_moment", *tie_break).cast("double").alias("salaire_brut_base")
    )
    bonus = groups.withColumn("montant_prime", F.col("salaire_brut_base") * F.lit(rate))
    return stamp(bonus, source, as_of)


def bonus_by_distance(
    activities: DataFrame,
    one_way_km: float = ONE_WAY_KM,
    euro_per_km: float = EURO_PER_KM,
    modes: Iterable[str] = SUSTAINABLE_MODES,
    source: str = HISTORY,
    as_of: Column | None = None,
) -> DataFrame:
    """Days × return trip × price per kilometre, per employee, year, mode and salary.

    The salary is part of the group: an employee with two salaries in a year has two rows, which
    the bonus table's key then refuses.
    """
    rows = _dated(in_modes(activities, modes), "moyen_de_deplacement", "salaire_brut")
    groups = rows.groupBy("id_salarie", "annee_civile", "moyen_de_deplacement", "salaire_brut").agg(
        F.count("*").alias("_days")
    )
    return _distance_bonus(groups, one_way_km, euro_per_km, source, as_of)


def _distance_bonus(
    groups: DataFrame, one_way_km: float, euro_per_km: float, source: str, as_of: Column | None
) -> DataFrame:
    euro_per_day = one_way_km * 2 * euro_per_km
    bonus = groups.select(
        "id_salarie",
        "annee_civile",
        "moyen_de_deplacement",
        F.col("salaire_brut").cast("double").alias("salaire_brut_base"),
        (F.col("_days") * F.lit(euro_per_day)).alias("montant_prime"),
        F.lit(TO_PAY).alias("statut_paiement"),
    )
    return stamp(bonus, source, as_of)


def eligibility(
    activities: DataFrame, threshold: int = LIVE_THRESHOLD, source: str = LIVE, as_of: Column | None = None
) -> DataFrame:
    """Number of sport activities per employee and year, and whether it reaches ``threshold``."""
    counts = _dated(with_activity(activities)).groupBy("id_salarie", "annee_civile")
    return _judge(counts.agg(F.count("*").alias("nombre_activites_total")), threshold, source, as_of)


def _judge(counts: DataFrame, threshold: int, source: str, as_of: Column | None) -> DataFrame:
    judged = counts.withColumns(
        {
            "seuil_applique": F.lit(threshold),
            "est_eligible": F.col("nombre_activites_total") >= threshold,
        }
    )
    return stamp(judged, source, as_of)


# --- Both facts from one pass over the activities -------------------------------------------------
#
# The facts read the same activities under different filters and keys. A load that needs both first
# reduces the activities to one row per employee, year and mode in a single scan and shuffle; the
# facts are then small aggregates of that summary.


def live_summary(activities: DataFrame, tie_break: Iterable[str] = ("salaire_brut",)) -> DataFrame:
    """Per employee, year and mode: sport activities (``_sports``) and latest salary."""
    tie_break = list(tie_break)
    columns = [c for c in dict.fromkeys(["salaire_brut", "type_sport", *tie_break])]
    moment = moment_of(activities, "date_activite").alias("_moment")
    rows = _dated(activities, "moyen_de_deplacement", moment, *columns)
    return rows.groupBy("id_salarie", "annee_civile", "moyen_de_deplacement").agg(
        F.count("type_sport").alias("_sports"),
        latest("salaire_brut", "_moment", *tie_break).cast("double").alias("salaire_brut_base"),
    )


def contributions(activities: DataFrame, origin: str) -> DataFrame:
    """What ``activities`` add to the facts, per employee, year and mode: sports, days, latest salary and its moment.

    Contributions of any parts of the activities add up to those of all, in any order: counts are summed and the
    salary of the latest moment stays, of equal moments the highest. A missing mode is kept as empty text.
    """
    moment = moment_of(activities, "date_activite").cast("timestamp_ntz").alias("_moment")
    mode = F.coalesce("moyen_de_deplacement", F.lit("")).alias("moyen_de_deplacement")
    rows = _dated(activities, mode, moment, F.col("salaire_brut").cast("double").alias("salaire_brut"), "type_sport")
    summary = rows.groupBy("id_salarie", "annee_civile", "moyen_de_deplacement").agg(
        F.count("type_sport").alias("nombre_activites"),
        F.count("*").alias("nombre_jours"),
        F.max(F.struct("_moment", "salaire_brut")).alias("_last"),
    )
    return summary.select(
        F.lit(origin).alias("origine"), "id_salarie", "annee_civile", "moyen_de_deplacement", "nombre_activites", "nombre_jours",
        F.col("_last.salaire_brut").alias("salaire_brut"), F.col("_last._moment").alias("dernier_moment"),
    )


def bonus_from_contributions(
    rows: DataFrame,
    rate: float = BONUS_RATE,
    one_way_km: float = ONE_WAY_KM,
    euro_per_km: float = EURO_PER_KM,
    modes: Iterable[str] = SUSTAINABLE_MODES,
) -> DataFrame:
    """Transport bonus of all origins together.

    A key with live contributions earns the rate on its latest salary, one that only the history knows its days'
    distance.
    """
    keys = ["id_salarie", "annee_civile", "moyen_de_deplacement"]
    sums = in_modes(rows, modes).groupBy(*keys).agg(
        F.sum("nombre_jours").alias("_days"),
        F.max(F.struct("dernier_moment", "salaire_brut")).alias("_last"),
        F.max(F.col("origine") != HISTORY).alias("_live"),
    )
    base = F.col("_last.salaire_brut")
    amount = F.when(F.col("_live"), base * F.lit(rate)).otherwise(F.col("_days") * F.lit(one_way_km * 2 * euro_per_km))
    bonus = sums.select(*keys, base.alias("salaire_brut_base"), amount.alias("montant_prime"), F.lit(TO_PAY).alias("statut_paiement"), "_live")
    return _stamp_by_origin(bonus)


def eligibility_from_contributions(
    rows: DataFrame, live_threshold: int = LIVE_THRESHOLD, history_threshold: int = HISTORY_THRESHOLD
) -> DataFrame:
    """Eligibility of all origins together; a key with live contributions is judged by the live threshold."""
    counts = rows.where("nombre_activites > 0").groupBy("id_salarie", "annee_civile").agg(
        F.sum("nombre_activites").alias("nombre_activites_total"), F.max(F.col("origine") != HISTORY).alias("_live")
    )
    threshold = F.when(F.col("_live"), F.lit(live_threshold)).otherwise(F.lit(history_threshold))
    judged = counts.withColumns({"seuil_applique": threshold, "est_eligible": F.col("nombre_activites_total") >= threshold})
    return _stamp_by_origin(judged)


def _stamp_by_origin(df: DataFrame) -> DataFrame:
    source = F.when(F.col("_live"), F.lit(LIVE)).otherwise(F.lit(HISTORY))
    return stamp(df, LIVE).withColumn("source_donnees", source).drop("_live")


def bonus_from_summary(
    summary: DataFrame,
    rate: float = BONUS_RATE,
    modes: Iterable[str] = SUSTAINABLE_MODES,
    source: str = LIVE,
    as_of: Column | None = None,
) -> DataFrame:
    """``bonus_by_rate`` from ``live_summary``; needs no further shuffle."""
    bonus = in_modes(summary, modes).select(
        "id_salarie",
        "annee_civile",
        "moyen_de_deplacement",
        "salaire_brut_base",
        (F.col("salaire_brut_base") * F.lit(rate)).alias("montant_prime"),
    )
    return stamp(bonus, source, as_of)


def history_summary(activities: DataFrame) -> DataFrame:
    """Per employee, year, mode and salary: rows (``_days``) and sport activities (``_sports``)."""
    rows = _dated(activities, "moyen_de_deplacement", "salaire_brut", "type_sport")
    return rows.groupBy("id_salarie", "annee_civile", "moyen_de_deplacement", "salaire_brut").agg(
        F.count("*").alias("_days"), F.count("type_sport").alias("_sports")
    )


def distance_bonus_from_summary(
    summary: DataFrame,
    one_way_km: float = ONE_WAY_KM,
    euro_per_km: float = EURO_PER_KM,
    modes: Iterable[str] = SUSTAINABLE_MODES,
    source: str = HISTORY,
    as_of: Column | None = None,
) -> DataFrame:
    """``bonus_by_distance`` from ``history_summary``."""
    return _distance_bonus(in_modes(summary, modes), one_way_km, euro_per_km, source, as_of)


def eligibility_from_summary(
    summary: DataFrame, threshold: int = LIVE_THRESHOLD, source: str = LIVE, as_of: Column | None = None
) -> DataFrame:
    """``eligibility`` from either summary."""
    counts = (
        summary.where("_sports > 0")
        .groupBy("id_salarie", "annee_civile")
        .agg(F.sum("_sports").alias("nombre_activites_total"))
    )
    return _judge(counts, threshold, source, as_of)


# --- Per-activity texts and reference updates -----------------------------------------------------


def congratulations(activities: DataFrame, keep: Iterable[str] = ("id_salarie",)) -> DataFrame:
    """One ``message`` per sport activity, next to the columns to ``keep``."""
    text = congratulation(F.col("prenom"), F.col("nom"), F.col("commentaire")).alias("message")
    return with_activity(activities).select(*keep, text)


def geo_update(activities: DataFrame, fixed: dict[str, object] = LIVE_GEO_FIXED, as_of: Column | None = None) -> DataFrame:
    """Reference update per active employee with the flat-rate position.

    One row per employee however many addresses they gave, so that a keyed merge accepts it.
    """
    moment = F.current_timestamp() if as_of is None else as_of
    people = activities.where(F.col("id_salarie").isNotNull()).select("id_salarie").distinct()
    fields = {name: F.lit(value) for name, value in fixed.items()}
    return people.withColumns({**fields, "date_geocodage": moment.cast("string")})
