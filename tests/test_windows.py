import random
from collections import defaultdict
from datetime import datetime, timedelta
from fractions import Fraction

import pytest
from conftest import moment, rows

from tickloom.operators import price_bars, price_stats, windowed_stats


def stats_of(ticks, **options):
    return {(r.symbol, r.window_start): r for r in windowed_stats(ticks, **options).collect()}


def test_boundary_ticks_fall_into_different_windows(make_ticks):
    found = stats_of(make_ticks([("A", 1, 1, "00:04:59.999999"), ("A", 2, 1, "00:05:00")]))
    assert sorted(found) == [("A", moment("00:00:00")), ("A", moment("00:05:00"))]
    assert found["A", moment("00:05:00")].window_end == moment("00:10:00")


def test_single_tick(make_ticks):
    row = stats_of(make_ticks([("A", "7.25", 9, "00:01:00")]))["A", moment("00:00:00")]
    assert (row.price_range, row.volatility, row.ma, row.avg_volume) == (0, 0.0, 7.25, 9.0)


def test_zero_mean_has_no_volatility(make_ticks):
    row = stats_of(make_ticks([("A", 0, 1, "00:01:00")]))["A", moment("00:00:00")]
    assert (row.ma, row.volatility) == (0.0, None)


def test_null_prices_are_skipped(make_ticks):
    found = stats_of(
        make_ticks([("A", None, 4, "00:01:00"), ("B", None, 4, "00:01:00"), ("B", 3, 6, "00:02:00")])
    )
    alone = found["A", moment("00:00:00")]
    assert (alone.ma, alone.high, alone.volatility, alone.avg_volume) == (None, None, None, 4.0)
    assert (found["B", moment("00:00:00")].ma, found["B", moment("00:00:00")].avg_volume) == (3.0, 5.0)


def test_null_symbol_is_a_group_and_null_time_is_none(make_ticks):
    found = stats_of(make_ticks([(None, 1, 1, "00:01:00"), ("A", 1, 1, None)]))
    assert list(found) == [(None, moment("00:00:00"))]


def random_ticks(count, seed=5):
    """Ticks of which a third belong to one symbol."""
    draw = random.Random(seed)
    start = datetime(2024, 1, 1)
    for _ in range(count):
        symbol = "HOT" if draw.random() < 1 / 3 else f"S{draw.randrange(6)}"
        at = start + timedelta(microseconds=draw.randrange(3 * 3600 * 10**6))
        yield symbol, Fraction(draw.randrange(1, 10**6), 100), draw.randrange(10**5), at


@pytest.mark.parametrize("width,minutes", [("5 minutes", 5), ("1 hour", 60)])
def test_stats_match_brute_force(make_ticks, width, minutes):
    data = list(random_ticks(2000))
    groups = defaultdict(list)
    for symbol, price, volume, at in data:
        start = at.replace(minute=at.minute // minutes * minutes, second=0, microsecond=0)
        groups[symbol, start].append((price, volume))
    ticks = make_ticks([(s, f"{float(p):.2f}", v, t) for s, p, v, t in data])
    found = stats_of(ticks.repartition(7), width=width)
    assert found.keys() == groups.keys()
    for key, members in groups.items():
        prices = [p for p, _ in members]
        row, mean = found[key], float(sum(prices)) / len(prices)
        assert row.ma == mean
        assert (row.high, row.low) == (max(prices), min(prices))
        assert row.price_range == max(prices) - min(prices)
        assert row.avg_volume == sum(v for _, v in members) / len(members)
        assert row.volatility == float(max(prices) - min(prices)) / mean * 100
        assert float(row.low) <= row.ma <= float(row.high) and row.volatility >= 0


def test_double_prices_work_too(make_ticks):
    row = stats_of(make_ticks([("A", 1, 2, "00:01:00"), ("A", 2, 4, "00:02:00")], price="double"))
    assert row["A", moment("00:00:00")].volatility == pytest.approx(100 / 1.5)


def test_since_keeps_whole_windows(make_ticks):
    ticks = make_ticks([(s, p, 1, f"00:{m:02}:00") for s in "AB" for m in range(30) for p in (1, 2)])
    everything = windowed_stats(ticks)
    for since in ("00:10:00", "00:12:30", "00:30:00", "01:00:00"):
        expected = [r for r in rows(everything) if r[2] >= moment(since)]
        assert rows(windowed_stats(ticks, since=moment(since))) == expected


def test_bars_and_stats_are_cuts_of_the_same_windows(make_ticks):
    stats = windowed_stats(make_ticks([("A", 1, 2, "00:01:00")]))
    assert price_bars(stats).columns[3:] == ["ma", "high", "low", "avg_volume"]
    assert price_stats(stats).columns[3:] == ["price_range", "volatility"]


def test_tasks_aggregate_before_one_shuffle(make_ticks):
    plan = windowed_stats(make_ticks([("A", 1, 2, "00:01:00")]))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1 and "partial_sum" in text and "SortAggregate" not in text
