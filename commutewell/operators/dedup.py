"""One row per key, chosen deterministically."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest(value: str | Column, *order: str | Column) -> Column:
    """Aggregate: the ``value`` of the row that is greatest by ``order``.

    One ``order`` column with no NULLs keeps the aggregate hash-based; further ones break ties and
    make it sort-based. Both are combined on the map side, so a hot key costs one row per task.
    """
    return F.max_by(value, order[0] if len(order) == 1 else F.struct(*order))


def latest_per_key(
    df: DataFrame, keys: Iterable[str], order: Iterable[str | Column], columns: Iterable[str] | None = None
) -> DataFrame:
    """The greatest row by ``order`` for each key: ``keys`` plus ``columns`` (default: all others).

    The rank is always a struct, which is never NULL, so a key whose order columns are all NULL
    still keeps a row. No window: only one row per key and task is shuffled.
    """
    keys = list(keys)
    columns = [c for c in (columns or df.columns) if c not in keys]
    best = F.max_by(F.struct(*columns), F.struct(*order)).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_best.{c}").alias(c) for c in columns])


def one_per_key(df: DataFrame, keys: Iterable[str], newest: Iterable[str | Column] = ()) -> DataFrame:
    """One row per key: newest first, remaining ties broken by the other columns in schema order.

    Rank and row travel as one struct, each column once.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    ranks = [F.col(c) if isinstance(c, str) else c for c in newest]
    row = F.struct(*[c.alias(f"_rank{i}") for i, c in enumerate(ranks)], *rest)
    return df.groupBy(*keys).agg(F.max(row).alias("_best")).select(*keys, *[F.col(f"_best.{c}").alias(c) for c in rest])


def distinct_of(df: DataFrame, *columns: str) -> DataFrame:
    """Distinct combinations of ``columns``; nothing else is read or shuffled."""
    return df.select(*columns).distinct()
