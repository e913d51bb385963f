"""Health report of the loads."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Alarm limits.
STUCK_AFTER_MINUTES = 120
REJECT_LIMIT_PERCENT = 50.0


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Distinct rows ``(table, n)`` with the row count of each frame.

    Counting reads no column: on Parquet only the footers.
    """
    counts = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table"), "n") for name, df in tables.items()]
    return reduce(DataFrame.union, counts).distinct()


def stuck_files(
    inventory: DataFrame, as_of: Column | None = None, after_minutes: int = STUCK_AFTER_MINUTES
) -> DataFrame:
    """Inventory entries last changed more than ``after_minutes`` before ``as_of`` (default: now)."""
    moment = F.current_timestamp() if as_of is None else as_of
    return inventory.where(F.col("modified") < moment - F.expr(f"INTERVAL {int(after_minutes)} MINUTES"))


def health(
    reference: DataFrame,
    facts: list[DataFrame],
    rejected: DataFrame,
    stuck: DataFrame | None = None,
    alarm_when_empty: bool = False,
    load_name: str = "live load",
) -> DataFrame:
    """One row: volumes, reject ratio in percent, alarm flags and the report text.

    ``alarm_when_empty`` adds the rule that fact tables without rows are an anomaly.
    """
    groups = [("a", reference), *[("f", df) for df in facts], ("r", rejected)]
    if stuck is not None:
        groups.append(("s", stuck))
    counted = reduce(
        DataFrame.union, [df.agg(F.count("*").alias("n")).select(F.lit(tag).alias("tag"), "n") for tag, df in groups]
    )

    def total(tag: str) -> Column:
        return F.sum(F.when(F.col("tag") == tag, F.col("n")).otherwise(0))

    f, r = F.col("total_faits"), F.col("total_rejets")
    ratio = F.when(f + r > 0, r.cast("double") / (f + r).cast("double") * 100).otherwise(0.0)
    row = counted.agg(
        total("a").alias("total_salaries"),
        total("f").alias("total_faits"),
        total("r").alias("total_rejets"),
        total("s").alias("fichiers_bloques"),
    ).withColumn("ratio_rejet", ratio)
    row = row.withColumns(
        {
            "alerte_qualite": F.col("ratio_rejet") > REJECT_LIMIT_PERCENT,
            "alerte_fichiers": F.col("fichiers_bloques") > 0,
            "alerte_vide": F.lit(alarm_when_empty) & (f < 1),
        }
    )
    return row.withColumn("rapport", _report(load_name))


def _report(load_name: str) -> Column:
    """Four short lines: verdict, volumes, quarantine, waiting files."""
    count = lambda name: F.col(name).cast("string")
    alarm = F.col("alerte_qualite") | F.col("alerte_fichiers") | F.col("alerte_vide")
    limit = f"{REJECT_LIMIT_PERCENT:g} %"
    return F.concat_ws(
        "\n",
        F.when(alarm, "État du jour : à vérifier").otherwise("État du jour : normal"),
        F.concat(F.lit("Référence : "), count("total_salaries"), F.lit(" salariés, faits : "), count("total_faits"), F.lit(" lignes")),
        F.concat(
            F.lit("Quarantaine : "), count("total_rejets"), F.lit(" lignes, soit "), F.format_string("%.1f", "ratio_rejet"),
            F.when(F.col("alerte_qualite"), f" % (au-dessus de {limit})").otherwise(f" % (limite {limit})"),
        ),
        F.concat(
            F.lit("Fichiers en attente depuis plus de "), F.lit(f"{STUCK_AFTER_MINUTES} min : "), count("fichiers_bloques"),
            F.when(F.col("alerte_fichiers"), f" (voir {load_name})").otherwise(""),
        ),
    )
