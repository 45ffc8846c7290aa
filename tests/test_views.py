import random
from collections import defaultdict

import pytest
from conftest import moment, rows

from tickloom.operators import create_views, daily_stats, latest_prices, views
from tickloom.schema import DAILY_VIEW, LATEST_VIEW


def test_latest_breaks_ties_by_volume_then_price(make_ticks):
    at = "00:01:00"
    ticks = make_ticks(
        [("A", 9, 9, "00:00:59"), ("A", 8, 1, at), ("A", 2, 5, at), ("A", 3, 5, at), ("B", 1, 1, at)]
    )
    assert rows(latest_prices(ticks)) == [("A", 3, 5, moment(at)), ("B", 1, 1, moment(at))]


@pytest.mark.parametrize("buckets", [1, 3, 65536])
def test_latest_matches_brute_force(make_ticks, monkeypatch, buckets):
    """With fewer buckets than symbols, long idle symbols share one with busy ones."""
    monkeypatch.setattr(views, "FLOOR_BUCKETS", buckets)
    draw = random.Random(3)
    data = [("OLD", "1.00", 1, "00:00:00"), (None, "2.00", 1, "00:00:01")]
    for _ in range(1500):
        symbol = "HOT" if draw.random() < 0.4 else f"S{draw.randrange(20)}"
        price, volume = f"{draw.randrange(300) / 100:.2f}", draw.randrange(3)
        data.append((symbol, price, volume, f"00:{draw.randrange(20):02}:00"))
    expected = {}
    for symbol, price, volume, at in data:
        rank = (moment(at), volume, float(price))
        expected[symbol] = max(expected.get(symbol, rank), rank)
    found = latest_prices(make_ticks(data).repartition(5)).collect()
    assert {r.symbol: (r.timestamp, r.volume, float(r.price)) for r in found} == expected


def test_latest_sorts_only_what_is_left(make_ticks):
    plan = latest_prices(make_ticks([("A", 1, 1, "00:01:00")]))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.index("BroadcastHashJoin") > text.index("partial_max_by")


def test_daily_totals(make_ticks):
    draw = random.Random(4)
    data = [
        (draw.choice("AB"), f"{draw.randrange(10**4) / 100:.2f}", draw.randrange(2**31), 
         f"2024-01-0{draw.randrange(1, 4)}T{draw.randrange(24):02}:00:00")
        for _ in range(500)
    ]
    groups = defaultdict(list)
    for symbol, price, volume, at in data:
        groups[symbol, moment(at[:10] + "T00:00:00")].append((float(price), volume))
    found = {(r.symbol, r.date): r for r in daily_stats(make_ticks(data)).collect()}
    assert found.keys() == groups.keys()
    for key, members in groups.items():
        prices = [p for p, _ in members]
        row = found[key]
        assert (float(row.high), float(row.low)) == (max(prices), min(prices))
        assert row.avg_price == pytest.approx(sum(prices) / len(prices), rel=1e-12)
        assert row.total_volume == sum(v for _, v in members)


def test_views_answer_sql(spark, make_ticks):
    create_views(make_ticks([("A", 1, 1, "00:01:00"), ("A", 2, 3, "00:02:00")]))
    assert spark.sql(f"SELECT price, volume FROM {LATEST_VIEW}").first()[:] == (2, 3)
    daily = spark.sql(f"SELECT date, high, low, avg_price, total_volume FROM {DAILY_VIEW}")
    assert daily.first()[:] == (moment("00:00:00"), 2, 1, 1.5, 4)
