"""Where a deployment keeps its zones and tables, and the parameters of its loads."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from commutewell.contract import (
    BONUS_TABLE,
    CONTRIBUTION_TABLE,
    ELIGIBILITY_TABLE,
    QUARANTINE_TABLE,
    REFERENCE_TABLE,
)
from commutewell.operators import facts as op
from commutewell.sinks.snapshot import SnapshotTable
from commutewell.sources.files import inventory
from commutewell.sources.storage import Storage


@dataclass(frozen=True)
class Parameters:
    """Business parameters of the loads."""

    bonus_rate: float = op.BONUS_RATE
    live_threshold: int = op.LIVE_THRESHOLD
    history_threshold: int = op.HISTORY_THRESHOLD
    one_way_km: float = op.ONE_WAY_KM
    euro_per_km: float = op.EURO_PER_KM
    live_mode: str = "replace"  # or "accumulate", or "contribute" (plans.contributions)


class Lake:
    """Zones and gold tables under ``root``.

    ``history`` and ``live`` hold bronze activities (batch landing and stream landing), ``drops``
    directories dropped beside the stream. A live batch moves its entries from both to ``taken`` and, when it is
    finished, to ``archive``. Gold tables are snapshot tables.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.storage = Storage(spark)
        self.history = f"{self.root}/bronze/historique"
        self.live = f"{self.root}/bronze/live"
        self.drops = f"{self.root}/bronze/drops"
        self.taken = f"{self.root}/bronze/taken"
        self.archive = f"{self.root}/bronze/archive"
        self.checkpoints = f"{self.root}/checkpoints"
        self.messages = f"{self.root}/messages"
        self.undated = f"{self.root}/undated"
        self.unread = f"{self.root}/unread"
        self.ledger = f"{self.root}/ledger"
        self.bonus = SnapshotTable(spark, f"{self.root}/gold/fct_primes_transport", BONUS_TABLE)
        self.eligibility = SnapshotTable(spark, f"{self.root}/gold/fct_bien_etre_eligibilite", ELIGIBILITY_TABLE)
        self.reference = SnapshotTable(spark, f"{self.root}/gold/ref_salaries", REFERENCE_TABLE)
        self.contributions = SnapshotTable(spark, f"{self.root}/silver/contributions", CONTRIBUTION_TABLE)
        self.quarantine = SnapshotTable(spark, f"{self.root}/gold/soda_failed_rows", QUARANTINE_TABLE)

    # --- live batches ---

    def _finished(self) -> int:
        """Number of the last finished batch; -1 before the first."""
        names = self.storage.names(self.archive)
        return max((int(n.removeprefix("batch=")) for n in names if n.startswith("batch=")), default=-1)

    def waiting(self, zone: str) -> list[str]:
        """Names of the entries of a live zone that no batch has taken; hidden drafts aside."""
        return [n for n in self.storage.names(zone) if n.endswith(".parquet") and not n.startswith(("_", "."))]

    def next_batch(self) -> tuple[int, str, int]:
        """Number, directory and number of entries of the batch to process: an unfinished one again, else what waits.

        Entries are taken by renaming them into the batch's directory, so the live zones only hold what waits and
        no list of files is kept. Once all are taken a mark closes the batch: a repeated attempt works on the
        same entries whatever arrived since.
        """
        number = self._finished() + 1
        folder, mark = f"{self.taken}/batch={number}", f"{self.ledger}/closed-{number}"
        if not self.storage.exists(mark):
            for zone in (self.live, self.drops):
                for entry in self.waiting(zone):
                    self.storage.rename(f"{zone}/{entry}", f"{folder}/{zone.rsplit('/', 1)[1]}-{entry}")
            if self.storage.names(folder):
                self.storage.make_dirs(self.ledger)
                self.storage.create_text(mark, "")
        return number, folder, len(self.storage.names(folder))

    def finish_batch(self, number: int) -> None:
        """Archive batch ``number``, which is completely processed."""
        self.storage.rename(f"{self.taken}/batch={number}", f"{self.archive}/batch={number}")
        self.storage.delete(f"{self.ledger}/closed-{number}")

    def restore_batches(self) -> None:
        """Put every batch back as an entry of the drop zone: one rename for each."""
        for zone in (self.archive, self.taken):
            for name in self.storage.names(zone):
                self.storage.rename(f"{zone}/{name}", f"{self.drops}/again-{uuid.uuid4().hex}.parquet")
        self.storage.delete(self.ledger)

    def waiting_entries(self) -> DataFrame:
        """Inventory of what waits in the live zones."""
        return inventory(self.spark, self.live).unionByName(inventory(self.spark, self.drops))
