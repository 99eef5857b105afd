"""Column layouts of the stored tables and the configuration records."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


def _struct(spec: list[tuple[str, T.DataType]]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in spec])


_LONG, _DBL, _STR, _BOOL = T.LongType(), T.DoubleType(), T.StringType(), T.BooleanType()

#: One landed price observation. Prices and volumes are 64-bit throughout.
RAW_TIMESERIES = _struct([
    ("timestamp", T.TimestampNTZType()),
    ("avgHighPrice", _LONG),
    ("avgLowPrice", _LONG),
    ("highPriceVolume", _LONG),
    ("lowPriceVolume", _LONG),
    ("item_id", _LONG),
    ("ingested_at", T.TimestampNTZType()),
])

ITEM_MAPPING = _struct([
    ("id", _LONG),
    ("name", _STR),
    ("examine", _STR),
    ("members", _BOOL),
    ("lowalch", _LONG),
    ("highalch", _LONG),
    ("limit", _LONG),
])

BACKTEST_METRICS = _struct([
    ("item_id", _LONG),
    ("date", T.DateType()),
    ("method", _STR),
    ("mae", _DBL),
    ("smape", _DBL),
    ("actual", _DBL),
    ("predicted", _DBL),
    ("horizon", T.IntegerType()),
    ("window_size", T.IntegerType()),
])

SELECTION_ITEM = _struct([
    ("id", _LONG),
    ("name", _STR),
    ("median_units_per_day", _DBL),
    ("median_price", _DBL),
    ("median_turnover_gp", _DBL),
    ("coverage", _DBL),
    ("days_with_data", _LONG),
    ("avg_price", _DBL),
    ("ranking_score", _DBL),
    ("last_trade_date", T.DateType()),
    ("selection_reason", _STR),
])

# --- fixed values: category patterns, first match wins -----------------------
CATEGORY_LADDER: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("Runes", ("%rune%",)),
    ("Logs", ("%log%",)),
    ("Ores", ("%ore%",)),
    ("Bars", ("%bar%",)),
    ("Weapons", ("%dragon%", "%whip%")),
    ("Armor", ("%helm%", "%tassets%")),
)
CATEGORY_DEFAULT = "Other"

# --- fixed values: item ids used when a selection or a target list is empty --
SELECTION_FALLBACK_IDS = (4151, 561, 5616)
EMERGENCY_SEED_IDS = (561, 536, 12934)


@dataclass(frozen=True)
class SelectionConfig:
    """Gates and manual overrides for item selection."""

    top_n: int = 10
    min_days: int = 10
    min_volume: float = 1000
    min_coverage_pct: float = 0.0
    lookback_days: int = 365
    include_ids: tuple[int, ...] = ()
    exclude_ids: tuple[int, ...] = ()
    include_names: tuple[str, ...] = ()
    exclude_names: tuple[str, ...] = ()


@dataclass(frozen=True)
class DiscoverConfig:
    """Auto-discovery of liquid items by trade limit."""

    enabled: bool = False
    top_k: int = 10
    min_limit: int = 1000
    members_only: bool | None = None


@dataclass(frozen=True)
class IngestConfig:
    """Which items an ingestion run covers; all of them unless ``max_items`` is given."""

    include_ids: tuple[int, ...] = ()
    include_names: tuple[str, ...] = ()
    exclude_ids: tuple[int, ...] = ()
    exclude_names: tuple[str, ...] = ()
    discover: DiscoverConfig = field(default_factory=DiscoverConfig)
    max_items: int | None = None
    seed_ids: tuple[int, ...] = EMERGENCY_SEED_IDS
