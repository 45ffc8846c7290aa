"""Record formats, table contracts and default thresholds."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# The wire record, the target tables, the views and the alert
# rules of the system this package stands in for. They must stay as they are for
# results and stored tables to match.
TICK_FIELDS = "symbol: STRING, price: DOUBLE, volume: INT, timestamp: TIMESTAMP"
TOPIC = "stock_data"
TICK_TABLE = "stock_prices"
STATS_TABLE = "price_stats"
ALERT_TABLE = "anomalies"
LATEST_VIEW = "vw_latest_prices"
DAILY_VIEW = "vw_daily_stats"
PRICE_ALERT = "High volatility detected"
VOLUME_ALERT = "High volume detected"
VOLATILITY_LIMIT = 2.0
VOLUME_LIMIT = 50000
WINDOW_WIDTH = "5 minutes"
WATERMARK_DELAY = "10 minutes"
ALERT_ROWS = 5


@dataclass(frozen=True)
class Contract:
    """A target table: column types in order, all of them NOT NULL.

    ``lengths`` holds the maximum length of text columns. ``key`` is the natural
    key, empty where rows have none. ``time`` is the column whose day a stored row belongs to.
    """

    table: str
    columns: dict[str, str]
    lengths: dict[str, int] = field(default_factory=dict)
    key: tuple[str, ...] = ()
    time: str | None = None

    @property
    def ddl(self) -> str:
        return ", ".join(f"`{name}` {kind}" for name, kind in self.columns.items())


TICKS = Contract(
    TICK_TABLE,
    {
        "symbol": "STRING",
        "price": "DECIMAL(10,2)",
        "volume": "INT",
        "timestamp": "TIMESTAMP_NTZ",
    },
    lengths={"symbol": 10},
    time="timestamp",
)

PRICE_STATS = Contract(
    STATS_TABLE,
    {
        "symbol": "STRING",
        "window_start": "TIMESTAMP_NTZ",
        "window_end": "TIMESTAMP_NTZ",
        "price_range": "DECIMAL(10,2)",
        "volatility": "DECIMAL(10,2)",
    },
    lengths={"symbol": 10},
    key=("symbol", "window_start"),
    time="window_start",
)

ALERTS = Contract(
    ALERT_TABLE,
    {
        "symbol": "STRING",
        "window_start": "TIMESTAMP_NTZ",
        "window_end": "TIMESTAMP_NTZ",
        "alert_type": "STRING",
        "value": "DECIMAL(10,2)",
    },
    lengths={"symbol": 10, "alert_type": 50},
    key=("symbol", "window_start", "alert_type"),
    time="window_start",
)

# The other tables are not in the original layout; the shapes are ours.
LATEST = replace(TICKS, table="latest_prices", time=None)

BARS = Contract(
    "price_bars",
    {
        "symbol": "STRING",
        "window_start": "TIMESTAMP_NTZ",
        "window_end": "TIMESTAMP_NTZ",
        "ma": "DOUBLE",
        "high": "DECIMAL(10,2)",
        "low": "DECIMAL(10,2)",
        "avg_volume": "DOUBLE",
    },
    lengths={"symbol": 10},
    key=("symbol", "window_start"),
    time="window_start",
)

QUARANTINE = Contract("quarantine", {"value": "STRING", "reason": "STRING"})

# Partial aggregates of a window; a window may have several rows.
ROLLUP = Contract(
    "price_rollups",
    {
        "symbol": "STRING",
        "window_start": "TIMESTAMP_NTZ",
        "window_end": "TIMESTAMP_NTZ",
        "price_total": "DECIMAL(28,2)",
        "price_count": "BIGINT",
        "high": "DECIMAL(10,2)",
        "low": "DECIMAL(10,2)",
        "volume_total": "BIGINT",
        "volume_count": "BIGINT",
        "first_at": "TIMESTAMP_NTZ",
        "first_price": "DECIMAL(10,2)",
        "last_at": "TIMESTAMP_NTZ",
        "last_price": "DECIMAL(10,2)",
    },
    lengths={"symbol": 10},
    time="window_start",
)

# Ticks whose window was closed when they came, with the watermark that closed it.
LATE = Contract(
    "late_ticks",
    {
        **TICKS.columns,
        "window_end": "TIMESTAMP_NTZ",
        "watermark": "TIMESTAMP_NTZ",
        "reason": "STRING",
    },
    time="timestamp",
)

# Indicators of a closed window, null where the history is too short, and the closes that the next ones need.
INDICATORS = Contract(
    "indicators",
    {
        "symbol": "STRING",
        "window_start": "TIMESTAMP_NTZ",
        "window_end": "TIMESTAMP_NTZ",
        "close": "DECIMAL(10,2)",
        "rsi": "DOUBLE",
        "trend": "STRING",
    },
    key=("symbol", "window_start"),
    time="window_start",
)
LAST_CLOSES = Contract(
    "last_closes", {name: INDICATORS.columns[name] for name in ("symbol", "window_start", "window_end", "close")}
)

# Ticks of a relational table with a ledger: what tells equal ticks of a batch apart, and the batches
# that are there as a whole.
KEYED_TICKS = replace(
    TICKS,
    columns={**TICKS.columns, "source": "STRING", "batch_id": "BIGINT", "row_key": "BIGINT", "row_no": "INT"},
    key=("row_key", "row_no"),
)
LEDGER = Contract("tick_batches", {"source": "STRING", "batch_id": "BIGINT"}, key=("source", "batch_id"))

# States of one row: the newest tick so far, and the newest before the last batch.
HIGH_WATER = Contract("high_water", {"newest": "TIMESTAMP_NTZ"})
EVENT_TIMES = Contract("event_times", {"newest": "TIMESTAMP_NTZ", "before": "TIMESTAMP_NTZ"})
