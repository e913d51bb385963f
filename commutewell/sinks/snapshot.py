"""Gold tables as Parquet snapshots with an atomic switch.

A commit writes the new rows to a fresh directory and then one small JSON file that says which
directory holds which part of the table. Readers follow the newest such file, so they see the whole
commit or none of it, and a load can read the table it is about to replace. A failed load leaves
only an unreferenced directory.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from commutewell.contract import ContractViolation, TableContract
from commutewell.operators.merge import Update, upsert
from commutewell.sources.files import empty
from commutewell.sources.storage import Storage

WHOLE = ""  # part name of a table without partitions
BUCKET = "_bucket"  # partition column of a table that is cut by a hash of its keys


class ConcurrentCommit(RuntimeError):
    """Another load committed the table in the meantime."""


class ImpossibleBatch(RuntimeError):
    """A batch number below what its stream may repeat: two origins share a stream's name."""


class SnapshotTable:
    """The table ``contract`` under ``root``."""

    def __init__(self, spark: SparkSession, root: str, contract: TableContract):
        self.spark = spark
        self.root = root.rstrip("/")
        self.contract = contract
        self._storage = Storage(spark)
        self._partition = contract.partition_by or (BUCKET if contract.buckets else None)

    # --- reading ---

    def _state(self) -> dict:
        """Newest commit: its version, the version directory of each part, batch ids by stream."""
        names = [n for n in self._storage.names(f"{self.root}/commits") if n.endswith(".json")]
        if not names:
            return {"commit": -1, "version": 0, "parts": {}, "applied": {}, "buckets": self.contract.buckets}
        return json.loads(self._storage.read_text(f"{self.root}/commits/{max(names)}"))

    @property
    def version(self) -> int:
        """Version of the newest commit; 0 for a table never written."""
        return self._state()["version"]

    def applied(self, stream: str) -> int:
        """Id of the last micro-batch of ``stream`` in the table; -1 before the first."""
        return self._state()["applied"].get(stream, -1)

    def streams(self) -> set[str]:
        """Names of the streams whose batches are in the table."""
        return set(self._state()["applied"])

    def read(self, parts: Iterable[object] | None = None) -> DataFrame:
        """The table, or only the given partition values."""
        return self._read(self._state()["parts"], parts)

    def _read(self, located: Mapping[str, int], parts: Iterable[object] | None = None) -> DataFrame:
        if parts is not None:
            wanted = {str(p) for p in parts}
            located = {part: version for part, version in located.items() if part in wanted}
        if not located:
            return empty(self.spark, self.contract.schema)
        paths = [self._directory(version, part) for part, version in located.items()]
        reader = self.spark.read.schema(self.contract.schema).option("basePath", f"{self.root}/data")
        return reader.parquet(*paths).select(*self.contract.columns)

    def stored_columns(self) -> list[str] | None:
        """Columns of the stored files, whatever the contract says; None for a table without rows."""
        located = self._state()["parts"]
        if not located:
            return None
        part, version = next(iter(located.items()))
        stored = self.spark.read.parquet(self._directory(version, part)).columns
        return stored + ([self.contract.partition_by] if self.contract.partition_by else [])

    def _directory(self, version: int, part: str = WHOLE) -> str:
        path = f"{self.root}/data/v={version}"
        return path if part == WHOLE else f"{path}/{self.contract.partition_by or BUCKET}={part}"

    # --- writing ---

    def replace(
        self, df: DataFrame, stream: str | None = None, batch: int | None = None, unique_source: bool = False
    ) -> int:
        """Full refresh by ``df``; returns the number of rows.

        Refused, with the old table left in place, when ``df`` breaks the contract's keys or
        required columns. ``unique_source`` says that ``df`` is grouped by the keys, which spares the
        shuffle that looks for keys held twice.
        """
        state = self._state()
        version = self._write(self.contract.enforce(df), state)
        written = self._written(version)
        if self.contract.keys and not unique_source:
            twice = self.contract.key_violations(written).limit(5).collect()
            if twice:
                raise ContractViolation(f"{self.contract.name}: keys held by several rows, such as {twice}")
        located = {part: version for part in self._parts_of(version)}
        self._commit(state | {"buckets": self.contract.buckets}, version, located, stream, batch)
        return written.count()

    def expire(self) -> int:
        """Delete superseded commits and the data directories that the newest one does not use; returns how many.

        For times without readers of older versions and without a running load.
        """
        state = self._state()
        used = {f"v={v}" for v in state["parts"].values()}
        old = [f"{self.root}/data/{n}" for n in self._storage.names(f"{self.root}/data") if n not in used]
        newest = f"{state['commit']:012d}.json"
        old += [f"{self.root}/commits/{n}" for n in self._storage.names(f"{self.root}/commits") if n < newest]
        for path in old:
            self._storage.delete(path)
        return len(old)

    def clear(self) -> None:
        """Empty the table and forget which stream batches it holds."""
        state = self._state()
        self._commit(state | {"applied": {}}, self._next_version(state), {}, None, None)

    def forget(self, stream: str) -> None:
        """Keep the rows, but let batches of ``stream`` be applied again from the first one."""
        state = self._state()
        applied = {name: batch for name, batch in state["applied"].items() if name != stream}
        self._commit(state | {"applied": applied}, state["version"], state["parts"], None, None)

    def merge(
        self,
        source: DataFrame,
        update: Iterable[str] | Mapping[str, Update] | None = None,
        unique_source: bool = False,
        stream: str | None = None,
        batch: int | None = None,
        control: Iterable[str] = (),
        delete: Column | None = None,
        parts: Iterable[object] | None = None,
    ) -> bool:
        """Keyed upsert of ``source``; rewrites only the partitions that ``source`` touches.

        With ``stream`` and ``batch`` the last batch of that stream is skipped when it comes again (False), which
        makes replays harmless; a lower number raises ``ImpossibleBatch``. A row without a full key is refused, as in ``replace``.
        ``control`` and ``delete`` are those of ``upsert``. ``parts`` names the values of the partition column that
        occur in the source, where the caller knows them. Else the source of a partitioned table that holds rows is
        read twice: persist it when it is costly.
        """
        state = self._state()
        last = -1 if stream is None else state["applied"].get(stream, -1)
        if stream is not None and batch < last:
            raise ImpossibleBatch(f"{self.contract.name}: batch {batch} of {stream!r} after batch {last}")
        if stream is not None and batch == last:
            return False
        touched = self._touched(source, state) if parts is None else list(parts)
        target = self._read(state["parts"], touched)
        merged = upsert(
            target, source, self.contract.keys, update, self.contract.defaults, unique_source, True, control, delete
        )
        self._exchange(state, touched, merged, stream, batch)
        return True

    def delete(self, condition: Column, forget: str | None = None) -> None:
        """Remove the rows that meet ``condition``; rewrites only the partitions that hold some.

        With ``forget`` batches of that stream may be applied again from the first one.
        """
        state = self._state()
        if forget is not None:
            state = state | {"applied": {name: batch for name, batch in state["applied"].items() if name != forget}}
        touched = self._touched(self.read().where(condition), state)
        if touched == []:
            return self._commit(state, state["version"], state["parts"], None, None)
        kept = self._read(state["parts"], touched).where(~F.coalesce(condition, F.lit(False)))
        self._exchange(state, touched, kept, None, None)

    def _touched(self, rows: DataFrame, state: dict) -> list[object] | None:
        """Partition values that ``rows`` belong to; None where the whole table is to be written.

        One value per partition directory (civil years, buckets), so the list stays small. A table that was stored
        with another number of buckets is written whole once.
        """
        if self._partition is None or not state["parts"] or (self.contract.buckets and state.get("buckets", 0) != self.contract.buckets):
            return None
        value = self.contract.bucket() if self._partition == BUCKET else F.col(self._partition)
        return [r[0] for r in rows.select(value.alias("part")).distinct().collect()]

    def _exchange(self, state: dict, touched: list[object] | None, rows: DataFrame, stream: str | None, batch: int | None) -> None:
        """Commit ``rows`` in place of the partitions ``touched``, of which some may have no row any more."""
        version = self._write(rows, state)
        replaced = set(state["parts"]) if touched is None else {str(p) for p in touched}
        kept = {part: v for part, v in state["parts"].items() if part not in replaced}
        state = state | {"buckets": self.contract.buckets}
        self._commit(state, version, kept | {part: version for part in self._parts_of(version)}, stream, batch)

    def _next_version(self, state: dict) -> int:
        """Above every commit and every directory an earlier attempt may have left."""
        used = [int(n[2:]) for n in self._storage.names(f"{self.root}/data") if n.startswith("v=")]
        return max([state["version"], *used]) + 1

    def _write(self, df: DataFrame, state: dict) -> int:
        version = self._next_version(state)
        partition = self._partition
        if partition == BUCKET:
            df = df.withColumn(BUCKET, self.contract.bucket())
        if partition is None:
            df.write.mode("error").parquet(self._directory(version))
        else:
            # Files of even size per partition value: AQE splits a large year, joins small ones.
            even = df.hint("rebalance", F.col(partition))
            even.write.mode("error").partitionBy(partition).parquet(self._directory(version))
        lost = self.contract.null_violations(self._written(version)).limit(1).collect()
        if lost:
            raise ContractViolation(f"{self.contract.name}: NULL in a required column, such as {lost[0]}")
        return version

    def _written(self, version: int) -> DataFrame:
        reader = self.spark.read.schema(self.contract.schema).option("basePath", f"{self.root}/data")
        return reader.parquet(self._directory(version)).select(*self.contract.columns)

    def _parts_of(self, version: int) -> list[str]:
        partition = self._partition
        if partition is None:
            return [WHOLE]
        prefix = f"{partition}="
        names = self._storage.names(self._directory(version))
        return [name.removeprefix(prefix) for name in names if name.startswith(prefix)]

    def _commit(
        self, state: dict, version: int, located: Mapping[str, int], stream: str | None, batch: int | None
    ) -> None:
        """Publish the commit after ``state``; a second one after the same state is refused."""
        number = state["commit"] + 1
        applied = state["applied"] if stream is None else {**state["applied"], stream: batch}
        text = json.dumps(
            {"commit": number, "version": version, "parts": dict(located), "applied": applied, "buckets": state.get("buckets", 0)}
        )
        self._storage.make_dirs(f"{self.root}/commits")
        if not self._storage.create_text(f"{self.root}/commits/{number:012d}.json", text):
            raise ConcurrentCommit(self.contract.name)
