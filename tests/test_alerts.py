from conftest import moment, rows

from tickloom.operators import detect_alerts, price_alerts, volume_alerts, windowed_stats

PRICE, VOLUME = "High volatility detected", "High volume detected"


def test_limits_are_strict(make_ticks):
    # Mean 100, range 2: volatility exactly 2. Mean volume exactly 50,000.
    at_limit = make_ticks([("A", 99, 50000, "00:01:00"), ("A", 101, 50000, "00:02:00")])
    assert rows(detect_alerts(windowed_stats(at_limit))) == []
    above = make_ticks([("A", "98.99", 50000, "00:01:00"), ("A", 101, 50001, "00:02:00")])
    assert [r[3] for r in rows(detect_alerts(windowed_stats(above)))] == [PRICE, VOLUME]


def test_both_alerts_of_one_window(make_ticks):
    stats = windowed_stats(make_ticks([("A", 1, 60000, "00:01:00"), ("A", 3, 60000, "00:02:00")]))
    key = ("A", moment("00:00:00"), moment("00:05:00"))
    assert rows(detect_alerts(stats)) == [(*key, PRICE, 100.0), (*key, VOLUME, 60000.0)]
    assert rows(price_alerts(stats)) == [(*key, PRICE, 100.0)]
    assert rows(volume_alerts(stats)) == [(*key, VOLUME, 60000.0)]


def test_limits_are_parameters(make_ticks):
    stats = windowed_stats(make_ticks([("A", 1, 10, "00:01:00"), ("A", 3, 10, "00:02:00")]))
    assert rows(detect_alerts(stats, volatility_limit=100.0, volume_limit=10)) == []
    assert len(rows(detect_alerts(stats, volatility_limit=99.0, volume_limit=9))) == 2


def test_nulls_raise_nothing(make_ticks):
    ticks = make_ticks([("A", 0, None, "00:01:00"), ("B", None, None, "00:01:00")])
    assert rows(detect_alerts(windowed_stats(ticks))) == []


def test_ticks_are_read_once(make_ticks):
    alerts = detect_alerts(windowed_stats(make_ticks([("A", 1, 1, "00:01:00")])))
    assert alerts._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
