"""Late rows told by state: the newest closed day of every item."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.streaming.state import use_rocksdb


def after_closed_days(rows: DataFrame, day: str) -> DataFrame:
    """The rows of a stream whose ``day`` is later than every day their item had in earlier batches.

    The state of an item is one date. The rows of a batch pass through one by one, so that an item with much of a batch
    needs no more memory than any other.
    """
    from pyspark.sql.streaming import StatefulProcessor

    class NewestDay(StatefulProcessor):
        def init(self, handle) -> None:
            self.newest = handle.getValueState("newest", "day date")

        def handleInputRows(self, key, rows, timerValues):
            closed = self.newest.get()[0] if self.newest.exists() else None
            last = closed
            for row in rows:
                if row[day] is not None and (closed is None or row[day] > closed):
                    last = row[day] if last is None else max(last, row[day])
                    yield row
            if last is not None:
                self.newest.update((last,))

        def close(self) -> None:
            pass

    use_rocksdb(rows.sparkSession)
    return rows.where(F.col("item_id").isNotNull()).groupBy("item_id").transformWithState(
        NewestDay(), rows.schema, "Append", "None")
