"""The run clock: one instant per run, read once on the driver."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class RunClock:
    """Load timestamp and date of a run (UTC).

    Passing one value through a run keeps reruns, retried tasks and every
    table of the run on the same stamp.
    """

    instant: datetime

    @classmethod
    def now(cls) -> "RunClock":
        return cls(datetime.now(timezone.utc))

    @classmethod
    def at(cls, text: str) -> "RunClock":
        return cls(datetime.fromisoformat(text).replace(tzinfo=timezone.utc))

    @property
    def day(self) -> date:
        return self.instant.date()

    @property
    def ts_col(self) -> Column:
        return F.timestamp_micros(F.lit(int(self.instant.timestamp()) * 1_000_000 + self.instant.microsecond))

    @property
    def day_col(self) -> Column:
        return F.lit(self.day)

    def suffix(self) -> str:
        """``yyyyMMddHHmmss`` stamp for run-named output folders."""
        return self.instant.strftime("%Y%m%d%H%M%S")
