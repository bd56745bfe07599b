"""Query results kept for a while (S19): persist on first use, drop after ``ttl`` seconds or when the data has changed.

Executor memory holds the cached blocks (spilling to disk if needed); nothing is
collected to the driver.  Losing an executor only drops cached blocks, which Spark
recomputes from the plan.
"""

from __future__ import annotations

import time
from typing import Callable, Hashable

from pyspark import StorageLevel
from pyspark.sql import DataFrame


class ResultCache:
    def __init__(self, ttl: float = 3600.0, clock: Callable[[], float] = time.monotonic):
        self.ttl, self.clock = ttl, clock
        self._entries: dict[str, tuple[float, Hashable, DataFrame]] = {}

    def get(self, name: str, build: Callable[[], DataFrame], version: Hashable = None) -> DataFrame:
        """The kept result of that name, or a new one.  ``version`` says what data it was made from (for example the
        version of a ``VersionedTable``): a kept result of another version is dropped, however young it is."""
        now = self.clock()
        hit = self._entries.get(name)
        if hit and now - hit[0] < self.ttl and hit[1] == version:
            return hit[2]
        if hit:
            hit[2].unpersist()
        df = build().persist(StorageLevel.MEMORY_AND_DISK)
        self._entries[name] = (now, version, df)
        return df

    def clear(self) -> None:
        for *_, df in self._entries.values():
            df.unpersist()
        self._entries.clear()
