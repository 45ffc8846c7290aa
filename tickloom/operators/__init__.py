"""DataFrame in, DataFrame out; the same function serves tables and streams."""

from tickloom.operators.alerts import detect_alerts, price_alerts, volume_alerts
from tickloom.operators.contracts import conform
from tickloom.operators.indicators import closes, last_closes, rsi, trend
from tickloom.operators.rollups import coarser, merged, rollup, rollup_closes, rollup_days, rollup_stats
from tickloom.operators.serving import alert_feed, price_history, recent_alerts
from tickloom.operators.views import create_views, daily_stats, latest_prices
from tickloom.operators.windows import price_bars, price_stats, windowed_stats

__all__ = [
    "alert_feed",
    "closes",
    "coarser",
    "conform",
    "create_views",
    "daily_stats",
    "detect_alerts",
    "last_closes",
    "latest_prices",
    "merged",
    "price_alerts",
    "price_bars",
    "price_history",
    "price_stats",
    "recent_alerts",
    "rollup",
    "rollup_closes",
    "rollup_days",
    "rollup_stats",
    "rsi",
    "trend",
    "volume_alerts",
    "windowed_stats",
]
