"""Quality audit and health report."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame

from commutewell.contract import ACTIVITY, QUARANTINE
from commutewell.operators import monitor, quality
from commutewell.plans.lake import Lake
from commutewell.sources.files import read_parquet


def audit(lake: Lake) -> dict[str, DataFrame]:
    """Refill the quarantine and return the frames ``checks``, ``people`` and ``alert``."""
    reference, bonus = lake.reference.read(), lake.bonus.read()
    lake.quarantine.replace(
        quality.quarantine(
            quality.rejects(reference, quality.DISTANCE_BOUNDS),
            quality.rejects(bonus, quality.BONUS_BOUNDS),
            read_parquet(lake.spark, f"{lake.undated}/*", QUARANTINE),
        )
    )
    raw = read_parquet(lake.spark, [lake.history], ACTIVITY)
    checks = [
        quality.metric_checks(reference, quality.REFERENCE_CHECKS),
        quality.metric_checks(bonus, quality.BONUS_CHECKS),
        quality.metric_checks(raw, quality.RAW_CHECKS),
    ]
    people = quality.failing_people(reference, lake.quarantine.read())
    return {
        "checks": reduce(DataFrame.unionByName, checks),
        "people": people,
        "alert": quality.alert_rows(people),
    }


def health_report(lake: Lake, as_of: Column | None = None, alarm_when_empty: bool = False) -> DataFrame:
    """One-row health frame: volumes, reject ratio, stuck entries and the report text."""
    return monitor.health(
        lake.reference.read(),
        [lake.eligibility.read(), lake.bonus.read()],
        lake.quarantine.read(),
        monitor.stuck_files(lake.waiting_entries(), as_of),
        alarm_when_empty,
    )


def fact_counts(lake: Lake) -> DataFrame:
    """Row counts of the fact tables."""
    return monitor.table_counts({"Primes": lake.bonus.read(), "Eligibilité": lake.eligibility.read()})
