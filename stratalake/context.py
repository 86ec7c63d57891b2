"""Everything one run of the layers shares: identity, clock and the semantic switches."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

from stratalake.schemas import SILVER_SOURCE_NAME


@dataclass(frozen=True)
class RunContext:
    run_id: str = field(default_factory=lambda: f"manual-{uuid.uuid4().hex[:12]}")
    run_ts: datetime = field(default_factory=lambda: datetime.now(timezone.utc))
    source_file: str = "subscribers.csv"
    source_name: str = SILVER_SOURCE_NAME
    # Numeric columns left out of median imputation; keys are worth listing here.
    impute_exclude: tuple[str, ...] = ()
    # Percentile sketch instead of the exact distributed median.
    approx_median: bool = False
    hash_length: int = 16
    hash_salt: str | None = None
    # Match NULL natural keys of facts and dimensions instead of losing those fact rows.
    null_safe_lookup: bool = False
    # Which dimension row a fact gets where a customer has several: its own (the one with the
    # fact's attributes), all of them (fanout), the longest tenure's (pick), or none (error).
    on_conflict: str = "own"
    fact_partition_by: tuple[str, ...] = ()
    # Buckets in which silver and the customer dimension are laid out side by side while gold is
    # built, about one for each 128 MB of silver; 0 joins them by a shuffle of both.
    customer_buckets: int = 0

    @property
    def _utc(self) -> datetime:
        """The clock in UTC; a time without a zone is taken as UTC."""
        if self.run_ts.tzinfo is None:
            return self.run_ts.replace(tzinfo=timezone.utc)
        return self.run_ts.astimezone(timezone.utc)

    @property
    def version(self) -> str:
        """Name of the table versions of this run; versions sort by time."""
        stamp = self._utc.strftime("%Y%m%dT%H%M%S%f")
        safe_id = "".join(ch if ch.isalnum() else "-" for ch in self.run_id)
        return f"{stamp}_{safe_id}"

    def now(self) -> Column:
        """The run's clock as a timestamp literal: one instant for every table of a run."""
        micros = int(self._utc.timestamp()) * 1_000_000 + self._utc.microsecond
        return F.timestamp_micros(F.lit(micros))
