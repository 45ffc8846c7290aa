"""SQL counterparts of the registered queries, in DuckDB's dialect."""

from __future__ import annotations

from tickloom.schema import (
    ALERT_ROWS,
    PRICE_ALERT,
    VOLATILITY_LIMIT,
    VOLUME_ALERT,
    VOLUME_LIMIT,
)

TICKS = """ticks AS (
  SELECT event_type AS symbol, CAST(value AS DECIMAL(18,2)) AS price,
         CAST(regexp_extract(props, '"k": (\\d+)', 1) AS INTEGER) * 1000 AS volume,
         ts AS timestamp
  FROM events)"""


def _stats(width: str) -> str:
    return f"""{TICKS}, windows AS (
  SELECT symbol, time_bucket(INTERVAL '{width}', timestamp) AS window_start,
         CAST(sum(price) AS DOUBLE) / nullif(count(price), 0) AS ma,
         max(price) AS high, min(price) AS low,
         CAST(sum(volume) AS DOUBLE) / nullif(count(volume), 0) AS avg_volume
  FROM ticks GROUP BY ALL),
stats AS (
  SELECT symbol, window_start, window_start + INTERVAL '{width}' AS window_end,
         ma, high, low, avg_volume, CAST(high - low AS DECIMAL(19,2)) AS price_range,
         CAST(high - low AS DOUBLE) / nullif(ma, 0) * 100 AS volatility
  FROM windows)"""


def _alerts(width: str = "5 minutes") -> str:
    return f"""{_stats(width)}, alerts AS (
  SELECT symbol, window_start, window_end, '{PRICE_ALERT}' AS alert_type, volatility AS value
  FROM stats WHERE volatility > {VOLATILITY_LIMIT}
  UNION ALL
  SELECT symbol, window_start, window_end, '{VOLUME_ALERT}', avg_volume
  FROM stats WHERE avg_volume > {VOLUME_LIMIT})"""


BARS = "symbol, window_start, window_end, ma, high, low, avg_volume"
STATS = "symbol, window_start, window_end, price_range, volatility"
ALERTS = "symbol, window_start, window_end, alert_type, value"
CLOSED = "window_end <= (SELECT max(timestamp) FROM ticks) - INTERVAL '10 minutes'"


def _history(span: str) -> str:
    return f"""WITH {TICKS} SELECT timestamp, price, volume FROM ticks
WHERE symbol = 'view' AND timestamp BETWEEN
  (SELECT max(timestamp) FROM ticks) - INTERVAL '{span}' AND (SELECT max(timestamp) FROM ticks)
ORDER BY timestamp"""


def _recent(span: str, value: str = "value", more: str = "") -> str:
    return f"""SELECT window_end AS timestamp, alert_type, {value} AS value FROM alerts
WHERE symbol = 'view' AND window_end >= (SELECT max(timestamp) FROM ticks) - INTERVAL '{span}' {more}
ORDER BY timestamp DESC, alert_type LIMIT {ALERT_ROWS}"""


def _feed(span: str) -> str:
    return f"""WITH {_alerts()}, recent AS ({_recent(span, "CAST(value AS DECIMAL(10,2))")})
SELECT strftime(timestamp, '%H:%M:%S') AS time, alert_type,
       printf('%.2f', CAST(value AS DOUBLE)) AS value
FROM recent"""


LATEST = f"""WITH {TICKS}
SELECT DISTINCT ON (symbol) symbol, price, volume, timestamp FROM ticks
ORDER BY symbol, timestamp DESC, volume DESC, price DESC"""

DAILY = f"""WITH {TICKS}
SELECT symbol, CAST(date_trunc('day', timestamp) AS TIMESTAMP) AS date, max(price) AS high,
       min(price) AS low, CAST(sum(price) AS DOUBLE) / nullif(count(price), 0) AS avg_price,
       CAST(sum(volume) AS BIGINT) AS total_volume
FROM ticks GROUP BY ALL"""

MESSAGE = """'{"symbol":"' || symbol || '","price":' || price || ',"volume":' || volume
      || ',"timestamp":"' || strftime(timestamp, '%Y-%m-%dT%H:%M:%S.%f') || '"}'"""

NUMBERED = TICKS.replace("ticks AS (", "numbered AS (").replace("SELECT event_type", "SELECT event_id, event_type")
# Ticks as the tick table has them.
SOUND = f"""{NUMBERED}, ticks AS (
  SELECT symbol, TRY_CAST(CAST(price AS VARCHAR) AS DECIMAL(10,2)) AS price, volume, timestamp
  FROM numbered)"""

QUARANTINE = f"""WITH {NUMBERED}, messages AS (
  SELECT *, event_id // 10 % 6 AS turn, {MESSAGE} AS message FROM numbered WHERE event_id % 10 = 0)
SELECT CASE turn WHEN 0 THEN rtrim(message, '}}')
            WHEN 1 THEN symbol
            WHEN 2 THEN regexp_replace(message, '"price":[\\d.]+', '"price":"high"')
            WHEN 3 THEN '{{}}' WHEN 4 THEN message || ' and more' ELSE message || message END AS value,
       CASE turn WHEN 3 THEN 'missing symbol, price, volume, timestamp'
            ELSE 'malformed message' END AS reason
FROM messages"""

CLOSES = f"""{TICKS}, closes AS (
  SELECT DISTINCT ON (symbol, window_start) symbol,
         time_bucket(INTERVAL '1 hour', timestamp) AS window_start,
         time_bucket(INTERVAL '1 hour', timestamp) + INTERVAL '1 hour' AS window_end,
         price AS close
  FROM ticks ORDER BY symbol, window_start, timestamp DESC, price DESC)"""

RSI = f"""WITH {CLOSES}, steps AS (
  SELECT *, close - lag(close) OVER (PARTITION BY symbol ORDER BY window_start) AS step,
         row_number() OVER (PARTITION BY symbol ORDER BY window_start) AS n
  FROM closes),
sums AS (
  SELECT *, sum(greatest(step, 0)) OVER last AS gain, sum(greatest(-step, 0)) OVER last AS loss
  FROM steps
  WINDOW last AS (PARTITION BY symbol ORDER BY window_start ROWS 13 PRECEDING))
SELECT symbol, window_start, window_end, close,
       CASE WHEN n > 14 THEN 100 * CAST(gain AS DOUBLE)
            / nullif(CAST(gain + loss AS DOUBLE), 0) END AS rsi
FROM sums"""

TREND = f"""WITH {CLOSES}, sums AS (
  SELECT *, row_number() OVER w AS n,
         sum(close) OVER (w ROWS 2 PRECEDING) * 4 AS near,
         sum(close) OVER (w ROWS 11 PRECEDING) AS far
  FROM closes WINDOW w AS (PARTITION BY symbol ORDER BY window_start))
SELECT symbol, window_start, window_end, close,
       CASE WHEN n < 12 THEN NULL WHEN near > far THEN 'up'
            WHEN near < far THEN 'down' ELSE 'flat' END AS trend
FROM sums"""


def _conformed(source: str, table: str, columns: dict[str, str], more: str = "") -> str:
    """Rows cast to a contract; two decimals by the number's text, half up, as binary ties differ."""
    cast = ", ".join(
        f"TRY_CAST({f'CAST({name} AS VARCHAR)' if kind == TWO_PLACES else name} AS {kind}) AS {name}"
        for name, kind in columns.items()
    )
    whole = " AND ".join(f"{name} IS NOT NULL" for name in columns)
    return f"WITH {source} SELECT * FROM (SELECT {cast} FROM {table} {more}) WHERE {whole}"


TWO_PLACES = "DECIMAL(10,2)"
FITTING_TICKS = {
    "symbol": "VARCHAR", "price": TWO_PLACES, "volume": "INTEGER", "timestamp": "TIMESTAMP",
}
WINDOW = {"symbol": "VARCHAR", "window_start": "TIMESTAMP", "window_end": "TIMESTAMP"}

FITTING_BARS = {**WINDOW, "ma": "DOUBLE", "high": TWO_PLACES, "low": TWO_PLACES, "avg_volume": "DOUBLE"}
FITTING_STATS = {**WINDOW, "price_range": TWO_PLACES, "volatility": TWO_PLACES}
FITTING_ALERTS = {**WINDOW, "alert_type": "VARCHAR", "value": TWO_PLACES}
# What the streams store: aggregates of sound messages, of windows that the watermark closed.
SOUND_ALERTS = _alerts().replace(TICKS, SOUND)
STORED_BARS = _conformed(SOUND_ALERTS, "stats", FITTING_BARS, f"WHERE {CLOSED}")
STORED_STATS = _conformed(SOUND_ALERTS, "stats", FITTING_STATS, f"WHERE {CLOSED}")
STORED_ALERTS = _conformed(SOUND_ALERTS, "alerts", FITTING_ALERTS, f"WHERE {CLOSED}")
STORED_TICKS = f"WITH {SOUND} SELECT * FROM ticks"


def _stored_alerts(span: str) -> str:
    return f"""WITH s AS ({STORED_ALERTS}), n AS (SELECT max(ts) AS now FROM events)
SELECT window_end AS timestamp, alert_type, value FROM s, n
WHERE symbol = 'view' AND window_end >= now - INTERVAL '{span}'
ORDER BY timestamp DESC, alert_type LIMIT {ALERT_ROWS}"""


JOB = f"""WITH t AS ({STORED_TICKS}), b AS ({STORED_BARS}), s AS ({STORED_STATS}), a AS ({STORED_ALERTS}),
l AS (SELECT DISTINCT ON (symbol) * FROM t ORDER BY symbol, timestamp DESC, volume DESC, price DESC),
q AS ({QUARANTINE})
SELECT 'ticks' AS stored_in, symbol, timestamp AS at, CAST(volume AS VARCHAR) AS note, CAST(price AS DOUBLE) AS value FROM t
UNION ALL SELECT 'bars', symbol, window_start, CAST(high AS VARCHAR), CAST(low AS DOUBLE) FROM b
UNION ALL SELECT 'stats', symbol, window_start, CAST(price_range AS VARCHAR), CAST(volatility AS DOUBLE) FROM s
UNION ALL SELECT 'alerts', symbol, window_start, alert_type, CAST(value AS DOUBLE) FROM a
UNION ALL SELECT 'latest', symbol, timestamp, CAST(volume AS VARCHAR), CAST(price AS DOUBLE) FROM l
UNION ALL SELECT 'quarantine', NULL, NULL, reason || ': ' || value, NULL FROM q"""

# The stream takes the table range by range; every seventh event comes a range late. A batch is held
# against the newest time of the batches before the one before it.
LATE = f"""WITH {NUMBERED}, span AS (
  SELECT epoch_us(min(timestamp)) AS first,
         (epoch_us(max(timestamp)) - epoch_us(min(timestamp))) // greatest(4, (count(*) + 4999999) // 5000000) + 1 AS width
  FROM numbered),
sent AS (
  SELECT *, (epoch_us(timestamp) - first) // width + CASE WHEN event_id % 7 = 0 THEN 1 ELSE 0 END AS turn
  FROM numbered, span),
batches AS (SELECT *, dense_rank() OVER (ORDER BY turn) AS batch FROM sent),
newest AS (SELECT batch, max(date_trunc('millisecond', timestamp)) AS newest FROM batches GROUP BY batch),
marks AS (
  SELECT batch, max(newest) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 2 PRECEDING)
         - INTERVAL '10 minutes' AS watermark FROM newest),
late AS (
  SELECT symbol, CAST(CAST(price AS VARCHAR) AS DECIMAL(10,2)) AS price, volume, timestamp,
         time_bucket(INTERVAL '5 minutes', timestamp) + INTERVAL '5 minutes' AS window_end, watermark,
         'its window was closed' AS reason
  FROM batches JOIN marks USING (batch))
SELECT * FROM late WHERE window_end <= watermark"""

SQL: dict[str, str] = {
    "price_bars_5m": f"WITH {_stats('5 minutes')} SELECT {BARS} FROM stats",
    "price_bars_1h": f"WITH {_stats('1 hour')} SELECT {BARS} FROM stats",
    "price_stats_5m": f"WITH {_stats('5 minutes')} SELECT {STATS} FROM stats",
    "price_stats_1h": f"WITH {_stats('1 hour')} SELECT {STATS} FROM stats",
    "price_alerts": f"WITH {_alerts()} SELECT {ALERTS} FROM alerts "
    f"WHERE alert_type = '{PRICE_ALERT}'",
    "volume_alerts": f"WITH {_alerts()} SELECT {ALERTS} FROM alerts "
    f"WHERE alert_type = '{VOLUME_ALERT}'",
    "alerts_5m": f"WITH {_alerts()} SELECT {ALERTS} FROM alerts",
    "alerts_1h": f"WITH {_alerts('1 hour')} SELECT {ALERTS} FROM alerts",
    "latest_prices": LATEST,
    "daily_stats": DAILY,
    "view_latest_prices": LATEST,
    "view_daily_stats": DAILY,
    "price_history_5min": _history("5 minutes"),
    "price_history_15min": _history("15 minutes"),
    "price_history_1hour": _history("1 hour"),
    "price_history_1day": _history("1 day"),
    "recent_alerts": f"WITH {_alerts()} {_recent('1 hour')}",
    "recent_alerts_1day": f"WITH {_alerts()} {_recent('1 day')}",
    "alert_feed": _feed("1 hour"),
    "alert_feed_1day": _feed("1 day"),
    "decode_ticks": f"""WITH {SOUND}
SELECT symbol, CAST(price AS DOUBLE) AS price, volume, timestamp FROM ticks""",
    "quarantine_ticks": QUARANTINE,
    "encode_decode_roundtrip": f"WITH {TICKS} SELECT symbol, price, volume, timestamp FROM ticks",
    "conform_ticks": _conformed(TICKS, "ticks", FITTING_TICKS),
    "conform_price_stats": _conformed(_stats("5 minutes"), "stats", FITTING_STATS),
    "conform_alerts": _conformed(_alerts(), "alerts", FITTING_ALERTS),
    "conform_price_bars": _conformed(_stats("5 minutes"), "stats", FITTING_BARS),
    "rsi_1h": RSI,
    "trend_1h": TREND,
    "stream_price_bars": STORED_BARS,
    "stream_price_stats": STORED_STATS,
    "stream_alerts": STORED_ALERTS,
    "job_tables": JOB,
    "stream_raw_ticks": STORED_TICKS,
    "stream_quarantine": QUARANTINE,
    "stream_rsi_1h": f"{RSI.replace(TICKS, SOUND)} WHERE {CLOSED}",
    "stream_trend_1h": f"{TREND.replace(TICKS, SOUND)} WHERE {CLOSED}",
    "handover_price_stats": STORED_STATS,
    "late_ticks": LATE,
    "rollup_price_bars_5m": f"WITH {_stats('5 minutes')} SELECT {BARS} FROM stats".replace(TICKS, SOUND),
    "rollup_price_bars_1h": f"WITH {_stats('1 hour')} SELECT {BARS} FROM stats".replace(TICKS, SOUND),
    "rollup_alerts_1h": f"WITH {_alerts('1 hour')} SELECT {ALERTS} FROM alerts".replace(TICKS, SOUND),
    "rollup_daily_stats": DAILY.replace(TICKS, SOUND),
    "rollup_trend_1h": TREND.replace(TICKS, SOUND),
    "compacted_ticks": STORED_TICKS,
    "compacted_price_stats": STORED_STATS,
    "compacted_alerts": STORED_ALERTS,
    "compacted_daily_stats": DAILY.replace(TICKS, SOUND),
    "stored_price_history_15min": _history("15 minutes").replace(TICKS, SOUND),
    "stored_price_history_1day": _history("1 day").replace(TICKS, SOUND),
    "stored_view_latest_prices": LATEST.replace(TICKS, SOUND),
    "stored_view_daily_stats": DAILY.replace(TICKS, SOUND),
    "stored_recent_alerts": _stored_alerts("1 hour"),
    "stored_recent_alerts_1day": _stored_alerts("1 day"),
    "stored_alert_feed_1day": f"""WITH recent AS ({_stored_alerts("1 day")})
SELECT strftime(timestamp, '%H:%M:%S') AS time, alert_type, printf('%.2f', CAST(value AS DOUBLE)) AS value FROM recent""",
    "stream_latest_prices": LATEST.replace(TICKS, SOUND),
}
