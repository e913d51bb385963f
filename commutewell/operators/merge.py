"""Keyed upsert and change-feed reduction."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Update = Callable[[Column, Column], Column]


def take_new(old: Column, new: Column) -> Column:
    """Update rule: the source's value, NULL included."""
    return new


def add(old: Column, new: Column) -> Column:
    """Update rule: running total."""
    return F.coalesce(old, F.lit(0)) + F.coalesce(new, F.lit(0))


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Iterable[str],
    update: Iterable[str] | Mapping[str, Update] | None = None,
    defaults: Mapping[str, object] | None = None,
    unique_source: bool = False,
    full_keys: bool = False,
    control: Iterable[str] = (),
    delete: Column | None = None,
) -> DataFrame:
    """``target`` after inserting the rows of ``source`` or updating those with an equal key.

    ``update`` names the columns a match takes from the source, or maps them to a rule
    ``(old, new) -> value``, which may also use the columns ``old_<name>`` and ``new_<name>``; all others keep the target's value (default: every column of the source
    but the keys is taken). Inserted rows take the source's columns; columns the source lacks get
    ``defaults`` or NULL. Rows with a NULL in a key match nothing and are all kept.

    Two source rows with one key are refused: the plan raises when it runs. Say ``unique_source``
    when the source is an aggregate by the same keys; its shuffle then also serves the join.

    Keys are unique on both sides of the join, so no key is hot. Rows without a full key would all
    meet in one task and are led around the join, at the price of a filtered second read. Say
    ``full_keys`` where they cannot be many: a contract table, an aggregate by the keys.

    ``control`` names columns of the source that only rules and ``delete`` use, as ``new_<name>``. Keys for which the
    condition ``delete`` over ``old_<name>`` and ``new_<name>`` holds are left out of the result.
    """
    keys = list(keys)
    names = target.columns
    defaults = defaults or {}
    unknown = set(source.columns) - set(names) - set(control)
    if unknown:
        raise ValueError(f"the target has no column {sorted(unknown)}")
    if update is None:
        update = [c for c in names if c in source.columns and c not in {*keys, *control}]
    rules = dict(update) if isinstance(update, Mapping) else dict.fromkeys(update, take_new)
    types = {f.name: f.dataType for f in target.schema.fields}

    def inserted(name: str, prefix: str = "") -> Column:
        if name in source.columns:
            return F.col(prefix + name).cast(types[name])
        return F.lit(defaults.get(name)).cast(types[name])

    old = target if full_keys else _full_keys(target, keys)
    old = old.select(*[F.col(c).alias(f"old_{c}") for c in names], F.lit(True).alias("old_hit"))
    new = source if full_keys else _full_keys(source, keys)
    if unique_source:
        new = new.withColumn("hit", F.lit(True))
    else:
        new = _one_row_per_key(new, keys)
    new = new.select(*[F.col(c).alias(f"new_{c}") for c in new.columns])

    same_key = reduce(lambda a, b: a & b, [F.col(f"old_{k}") == F.col(f"new_{k}") for k in keys])
    joined = old.join(new, same_key, "full_outer")
    if delete is not None:
        joined = joined.where(~F.coalesce(delete, F.lit(False)))
    is_old, is_new = F.col("old_hit").isNotNull(), F.col("new_hit").isNotNull()

    def merged(name: str) -> Column:
        before = F.col(f"old_{name}")
        if name in keys:
            return F.coalesce(before, F.col(f"new_{name}").cast(types[name])).alias(name)
        kept = before
        if name in rules:
            after = rules[name](before, F.col(f"new_{name}")).cast(types[name])
            kept = F.when(is_new, after).otherwise(before)
        return F.when(is_old, kept).otherwise(inserted(name, "new_")).alias(name)

    result = joined.select(*[merged(c) for c in names])
    if full_keys:
        return result
    loose = _partial_keys(source, keys).select(*[inserted(c).alias(c) for c in names])
    return result.unionByName(_partial_keys(target, keys)).unionByName(loose)


def _full_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return reduce(lambda d, k: d.where(F.col(k).isNotNull()), keys, df)


def _partial_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.where(reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys]))


def _one_row_per_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """``df`` with a ``hit`` flag that raises for a key seen twice.

    Counted by a map-side combined aggregate: a key with very many copies fails without gathering them.
    """
    rest = [c for c in df.columns if c not in keys]
    row = F.first(F.struct(F.lit(True).alias("hit"), *rest)).alias("_row")
    counted = df.groupBy(*keys).agg(F.count("*").alias("_n"), row)
    key_text = F.concat_ws(", ", *[F.col(k).cast("string") for k in keys])
    refusal = F.raise_error(F.concat(F.lit("several source rows for key "), key_text)).cast("boolean")
    hit = F.when(F.col("_n") == 1, F.col("_row.hit")).otherwise(refusal).alias("hit")
    return counted.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest], hit)


def apply_changes(
    feed: DataFrame, keys: Iterable[str], sequence: Iterable[str], delete_flag: str = "__deleted"
) -> DataFrame:
    """Present rows of a table from its flattened change feed.

    Each feed row is a full row image; ``delete_flag`` is ``'true'`` on the last image of a deleted
    row and NULL on a tombstone, which says nothing. The image with the highest ``sequence`` counts.
    """
    keys = list(keys)
    images = feed.where(F.col(delete_flag).isNotNull())
    columns = [c for c in feed.columns if c not in keys]
    last = F.max_by(F.struct(*columns), F.struct(*sequence)).alias("_last")
    present = images.groupBy(*keys).agg(last).where(F.col(f"_last.{delete_flag}") != "true")
    return present.select(*[c if c in keys else F.col(f"_last.{c}").alias(c) for c in feed.columns if c != delete_flag])


def last_images(
    feed: DataFrame, keys: Iterable[str], sequence: Iterable[str], delete_flag: str = "__deleted"
) -> DataFrame:
    """The last image of every key in a change feed, deletes included: keys, the other columns, ``_sequence`` and ``_deleted``.

    ``_sequence`` is the struct of the ``sequence`` columns. Tombstones say nothing and are left out.
    """
    keys, sequence = list(keys), list(sequence)
    images = feed.where(F.col(delete_flag).isNotNull())
    rest = [c for c in feed.columns if c not in {*keys, *sequence, delete_flag}]
    row = F.struct(*rest, (F.col(delete_flag) == "true").alias("_deleted"))
    rank = F.struct(*sequence)
    last = images.groupBy(*keys).agg(F.max_by(row, rank).alias("_row"), F.max(rank).alias("_sequence"))
    return last.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest], "_sequence", "_row._deleted")


def unprocessed(items: DataFrame, ledger: DataFrame, key: str | Mapping[str, str]) -> DataFrame:
    """Rows of ``items`` whose ``key`` is not in ``ledger``.

    The ledger is reduced to its distinct keys first, so an entry that was logged very often does
    not weigh on one task.
    """
    item_key, ledger_key = next(iter(key.items())) if isinstance(key, Mapping) else (key, key)
    seen = ledger.select(F.col(ledger_key).alias("_seen")).distinct()
    return items.join(seen, F.col(item_key) == F.col("_seen"), "left_anti")
