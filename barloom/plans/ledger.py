"""A ledger of refresh runs: what a run covers, and which of its layers are stored."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.sinks.tables import stored

ENTRY = "run long, layer string, low timestamp_ntz, high timestamp_ntz"
PLANNED, FINISHED = "planned", "finished"


@dataclass(frozen=True)
class Run:
    """Run ``number`` covers the rows loaded after ``low`` (None: from the start) up to ``high``."""

    number: int
    low: dt.datetime | None
    high: dt.datetime
    done: frozenset[str] = frozenset()

    @property
    def finished(self) -> bool:
        return FINISHED in self.done


class Ledger:
    """Entries are only ever added: one when a run is planned, one per stored layer, one when it is finished.

    A run's range is fixed before its first layer is written, so a run that stopped is taken up with the same rows,
    and the layers it has stored are left alone.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def entries(self) -> DataFrame:
        found = stored(self.spark, self.path)
        return self.spark.createDataFrame([], ENTRY) if found is None else self.spark.read.schema(ENTRY).parquet(self.path)

    def last(self) -> Run | None:
        """The newest run."""
        entries = self.entries()
        rows = entries.where(F.col("run") == entries.agg(F.max("run")).scalar()).collect()
        if not rows:
            return None
        plan = next(r for r in rows if r.layer == PLANNED)
        return Run(plan.run, plan.low, plan.high, frozenset(r.layer for r in rows))

    def begin(self, raw: DataFrame, load_time: str = "ingested_at") -> Run | None:
        """The run to work on: the last one if it is unfinished, else a new one over what was loaded since; None if
        nothing was."""
        last = self.last()
        if last is not None and not last.finished:
            return last
        fresh = raw if last is None else raw.where(F.col(load_time) > F.lit(last.high))
        high = fresh.agg(F.max(load_time)).first()[0]
        if high is None:
            return None
        run = Run(1 if last is None else last.number + 1, None if last is None else last.high, high)
        self._add(run, PLANNED)
        return run

    def _add(self, run: Run, layer: str) -> None:
        row = self.spark.createDataFrame([(run.number, layer, run.low, run.high)], ENTRY)
        row.coalesce(1).write.mode("append").parquet(self.path)

    def commit(self, run: Run, layer: str) -> None:
        self._add(run, layer)


def rows_of(raw: DataFrame, run: Run, load_time: str = "ingested_at") -> DataFrame:
    """The rows a run covers. Rows without a load time belong to the first run."""
    upto = F.col(load_time) <= F.lit(run.high)
    if run.low is None:
        return raw.where(upto | F.col(load_time).isNull())
    return raw.where(upto & (F.col(load_time) > F.lit(run.low)))
