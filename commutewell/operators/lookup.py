"""Address lookup in a table of known places."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def geocode(df: DataFrame, places: DataFrame, on: str, place_key: str | None = None, take: Iterable[str] | None = None) -> DataFrame:
    """``df`` plus the columns ``take`` of the place whose key equals ``on``; NULL when unknown.

    Of places that share a key the least one by its columns counts, so no row of ``df`` is doubled; a place
    without a key matches nothing. Spark broadcasts it when its measured size is below the
    session's limit. Beyond it both sides are shuffled, and AQE splits the partition of a much-used
    or missing address over several tasks, which a left join allows.
    """
    place_key = place_key or on
    take = list(take or [c for c in places.columns if c != place_key])
    key = F.col(place_key).alias("_place")
    known = places.where(F.col(place_key).isNotNull()).groupBy(key).agg(F.min(F.struct(*take)).alias("_found"))
    known = known.select("_place", *[F.col(f"_found.{c}").alias(c) for c in take])
    return df.join(known, F.col(on) == F.col("_place"), "left").drop("_place")
