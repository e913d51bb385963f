"""Parquet zones."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation

from commutewell.sources.storage import Storage


def overwrite(df: DataFrame, path: str, files: int | None = None) -> int:
    """Replace the zone at ``path`` by ``df`` and return the number of rows written.

    ``files=1`` gives the single output file of a small load but writes it in one task; by default
    every task writes its own. The count comes from the new files' footers: the input is not
    computed twice, and unlike an accumulator it is exact when tasks are retried.
    """
    out = df if files is None else df.coalesce(files)
    out.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).count()


def overwrite_observed(df: DataFrame, path: str, measures: Mapping[str, Column], files: int | None = None) -> dict[str, int]:
    """Replace the zone at ``path`` by ``df`` and return the ``measures`` of its rows, taken by the run that writes them.

    Nothing is read again. The measures are collected in the tasks that write, each partition's once, whatever was
    retried before them. Measures over no rows are 0.
    """
    out = df if files is None else df.coalesce(files)
    return write_observed(out, measures, lambda seen: seen.write.mode("overwrite").parquet(path))


def write_observed(df: DataFrame, measures: Mapping[str, Column], write) -> dict[str, int]:
    """Call ``write`` with ``df`` and return the ``measures`` of the rows that it wrote, once."""
    observation = Observation()
    write(df.observe(observation, *[measure.alias(name) for name, measure in measures.items()]))
    seen = observation.get
    return {name: seen.get(name) or 0 for name in measures}


def drop_batch(df: DataFrame, zone: str, name: str | None = None, files: int | None = None) -> str:
    """Write ``df`` as the new directory ``zone/<name>.parquet`` and return its path.

    Without a ``name`` the directory is named after the present second. The directory appears as a whole: it
    is written under a hidden name and then renamed. No success marker is left.
    """
    name = name or f"test_batch_{datetime.now():%Y%m%d_%H%M%S}"
    zone = zone.rstrip("/")
    out = df if files is None else df.coalesce(files)
    put_entry(out, zone, f"{name}.parquet", f"{zone}/_draft-{name}-{uuid.uuid4().hex}")
    return f"{zone}/{name}.parquet"


def put_entry(df: DataFrame, zone: str, entry: str, draft: str) -> None:
    """Write ``df`` to the hidden directory ``draft`` and rename it to ``zone/entry``, which must not exist."""
    storage = Storage(df.sparkSession)
    if storage.exists(f"{zone}/{entry}"):
        raise FileExistsError(f"{zone}/{entry} already exists")
    df.write.mode("overwrite").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(draft)
    if not storage.rename(draft, f"{zone}/{entry}"):
        raise FileExistsError(f"{zone}/{entry} already exists")
