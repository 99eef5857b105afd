"""Small hand-made frames."""

from __future__ import annotations

import datetime as dt

RAW = ("timestamp timestamp_ntz, avgHighPrice long, avgLowPrice long, highPriceVolume long, lowPriceVolume long, "
       "item_id long, ingested_at timestamp_ntz")


def at(day: int, hour: int = 0, minute: int = 0) -> dt.datetime:
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=day - 1, hours=hour, minutes=minute)


def raw_rows(spark, rows):
    """rows: (ts, high, low, high volume, low volume, item, ingested)."""
    return spark.createDataFrame(rows, RAW)


def daily(spark, prices, item=1, start=dt.date(2024, 1, 1)):
    """A daily series (item_id, date, price) from a list; None is a missing price."""
    rows = [(item, start + dt.timedelta(days=i), None if p is None else float(p)) for i, p in enumerate(prices)]
    return spark.createDataFrame(rows, "item_id long, date date, price double")


def rows(df, *cols):
    return [tuple(r) for r in (df.select(*cols) if cols else df).collect()]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
