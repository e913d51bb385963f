"""Row filters on activities."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The transport modes that earn a bonus.
SUSTAINABLE_MODES = ("Vélo/Trottinette/Autres", "Marche/running")


def in_modes(df: DataFrame, modes: Iterable[str] = SUSTAINABLE_MODES, column: str = "moyen_de_deplacement") -> DataFrame:
    """Rows whose mode is one of ``modes``, spelled exactly so. Reaches the Parquet scan."""
    return df.where(F.col(column).isNotNull() & F.col(column).isin(*modes))


def matching_modes(df: DataFrame, pattern: str, column: str = "moyen_de_deplacement") -> DataFrame:
    """Rows whose mode matches the regular expression ``pattern`` anywhere, in any case."""
    return df.where(F.col(column).rlike(f"(?i){pattern}"))


def with_activity(df: DataFrame, column: str = "type_sport") -> DataFrame:
    """Rows that record a sport."""
    return df.where(F.col(column).isNotNull())


def outside(column: str, low: float, high: float) -> Column:
    """``column`` below ``low`` or above ``high``; NULL is not outside."""
    return (F.col(column) < low) | (F.col(column) > high)
