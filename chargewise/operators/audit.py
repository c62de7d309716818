"""Row counts gathered while a job runs.

`Audit` attaches `DataFrame.observe` metrics to the frames that a rule passes through it: the rows read, the rows that
each exclusion drops, the rows and the amount written. They are filled by the job's own writes, so nothing is scanned
for them a second time. Without an audit (`NO_AUDIT`) the rules run as plain filters.
"""

from __future__ import annotations

import threading
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

AMOUNT = "decimal(38,6)"
WAIT_S = 10


class Audit:
    def __init__(self):
        self._seen: list[tuple[str, str, Observation, DataFrame, list[Column]]] = []

    def _observe(self, kind: str, name: str, df: DataFrame, *metrics: Column) -> DataFrame:
        watch = Observation()
        self._seen.append((kind, name, watch, df, list(metrics)))
        return df.observe(watch, *metrics)

    def read(self, df: DataFrame) -> DataFrame:
        """The rows that the job reads (of several such frames, all)."""
        return self._observe("read", "", df, F.count(F.lit(1)).alias("n"))

    def exclude(self, df: DataFrame, keep: Column, name: str) -> DataFrame:
        """The rows for which `keep` is true; the others are counted as dropped by `name`."""
        dropped = F.count_if(~F.coalesce(keep, F.lit(False))).alias("n")
        return self._observe("dropped", name, df, dropped).filter(keep)

    def without(self, before: DataFrame, join, name: str) -> DataFrame:
        """`join(before)`, a join that only takes rows away; the rows taken count as dropped by `name`."""
        counted = self._observe("before", name, before, F.count(F.lit(1)).alias("n"))
        return self._observe("after", name, join(counted), F.count(F.lit(1)).alias("n"))

    def written(self, df: DataFrame, amount: str | None) -> DataFrame:
        """The rows that the job writes, and the sum of their amounts."""
        total = F.sum(F.col(amount).cast(AMOUNT)) if amount else F.lit(None).cast(AMOUNT)
        return self._observe("written", "", df, F.count(F.lit(1)).alias("n"), F.max(total).alias("amount") if not amount else total.alias("amount"))

    def rows_read(self) -> int | None:
        found = [self._value(*s[2:])["n"] for s in self._seen if s[0] == "read"]
        return sum(found) if found else None

    def rows_written(self) -> tuple[int | None, Decimal | None]:
        found = [self._value(*s[2:]) for s in self._seen if s[0] == "written"]
        return (found[-1]["n"], found[-1]["amount"]) if found else (None, None)

    def dropped(self) -> dict[str, int]:
        out: dict[str, int] = {}
        for kind, name, *rest in self._seen:
            if kind in ("dropped", "before", "after"):
                out[name] = out.get(name, 0) + self._value(*rest)["n"] * (-1 if kind == "after" else 1)
        return out

    @staticmethod
    def _value(watch: Observation, df: DataFrame, metrics: list[Column]) -> dict:
        """The observed metrics. The planner may cut a frame out of a plan (a join whose other side turns out to be
        empty); its metrics then never come and are computed here."""
        held: list[dict] = []
        waiting = threading.Thread(target=lambda: held.append(watch.get), daemon=True)
        waiting.start()
        waiting.join(WAIT_S)
        return held[0] if held else df.agg(*metrics).first().asDict()


class _NoAudit(Audit):
    def _observe(self, kind, name, df, *metrics):
        return df


NO_AUDIT = _NoAudit()
