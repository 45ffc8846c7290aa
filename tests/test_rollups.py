"""Partial aggregates: any split of the ticks gives what the ticks themselves give."""

import random

import pytest
from conftest import moment, rows
from pyspark.sql import functions as F
from test_streaming import ONCE, Topic, tick

from tickloom.operators import (
    closes,
    coarser,
    daily_stats,
    detect_alerts,
    merged,
    rollup,
    rollup_closes,
    rollup_days,
    rollup_stats,
    windowed_stats,
)
from tickloom.schema import LATE, ROLLUP
from tickloom.streaming import Batch, ParquetTables, start_late, start_rollups
from tickloom.streaming.job import sound_ticks, start_windows


def drawn(seed, count=800):
    draw = random.Random(seed)
    return [
        (draw.choice(["HOT", "HOT", "A", "B", None]), draw.choice([None, f"{draw.randrange(9000) / 100:.2f}"]),
         draw.choice([None, draw.randrange(10**6)]), f"2024-01-0{draw.randrange(1, 3)}T{draw.randrange(24):02}:{draw.randrange(60):02}:{draw.randrange(2)}0")
        for _ in range(count)
    ]


@pytest.fixture
def parts(make_ticks):
    """Ticks, and rollups of them made in seven pieces."""
    ticks = make_ticks(drawn(1))
    pieces = [ticks.where(F.pmod(F.xxhash64("timestamp", "price", "volume"), F.lit(7)) == n) for n in range(7)]
    rollups = rollup(pieces[0])
    for piece in pieces[1:]:
        rollups = rollups.unionByName(rollup(piece))
    return ticks, rollups


@pytest.mark.parametrize("width", ["5 minutes", "1 hour", "1 day"])
def test_stats_of_any_width(parts, width):
    ticks, rollups = parts
    whole = merged(rollups) if width == "5 minutes" else coarser(rollups, width)
    expected = windowed_stats(ticks, width)
    kinds = [f"CAST({n} AS {t}) AS {n}" for n, t in rollup_stats(whole).dtypes]
    assert rows(rollup_stats(whole)) == rows(expected.selectExpr(*kinds))
    assert rows(detect_alerts(rollup_stats(whole))) == rows(detect_alerts(expected))


def test_days_and_closes(parts):
    ticks, rollups = parts
    kinds = [f"CAST({n} AS {t}) AS {n}" for n, t in rollup_days(rollups).dtypes]
    assert rows(rollup_days(rollups)) == rows(daily_stats(ticks).selectExpr(*kinds))
    assert rows(rollup_closes(rollups)) == rows(closes(ticks))


def test_first_and_last_price_win_ties_apart(make_ticks):
    ticks = make_ticks([("A", 2, 1, "00:01:00"), ("A", 1, 1, "00:01:00"), ("A", None, 1, "00:00:30"), ("A", None, 1, "00:04:00")])
    row = merged(rollup(ticks).unionByName(rollup(ticks))).first()
    assert (row.first_at, row.first_price, row.last_at, row.last_price) == (moment("00:01:00"), 1, moment("00:01:00"), 2)
    assert (row.price_count, row.volume_count) == (4, 8)


def test_nothing_gives_nothing(make_ticks):
    empty = rollup(make_ticks([]))
    assert merged(empty).count() == coarser(empty, "1 hour").count() == rollup_days(empty).count() == 0
    assert rollup_closes(rollup(make_ticks([("A", None, 1, "00:01:00")]))).count() == 0


def test_aggregates_use_hashing(make_ticks):
    """Neither making nor adding up rollups sorts the rows."""
    for frame in (rollup(make_ticks(drawn(2))), merged(rollup(make_ticks(drawn(2))))):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "SortAggregate" not in plan and "HashAggregate" in plan


@pytest.fixture
def topic(spark, tmp_path):
    return Topic(spark, tmp_path / "topic")


@pytest.fixture
def tables(tmp_path):
    return ParquetTables(str(tmp_path / "tables"))


def test_batches_and_repeats_add_up(spark, topic, tables, tmp_path, make_ticks):
    """Late ticks count too, and a batch that is written again counts once."""
    for clocks in (["00:01:00", "00:02:00"], ["05:00:00"], ["00:03:00"]):
        topic.send(*[tick("A", clock, price=2.0, volume=4) for clock in clocks])
    start_rollups(topic.ticks(), tables, str(tmp_path / "c"), trigger=ONCE).awaitTermination()
    found = rollup_stats(merged(tables.read(spark, ROLLUP))).orderBy("window_start").collect()
    assert [(r.window_start, r.ma, r.avg_volume) for r in found] == [
        (moment("00:00:00"), 2.0, 4.0), (moment("05:00:00"), 2.0, 4.0),
    ]
    for _ in range(2):
        tables.append(rollup(make_ticks([("B", 1, 1, "00:01:00")], "decimal(10,2)")), ROLLUP, Batch("other", 0))
    assert {r.price_count for r in merged(tables.read(spark, ROLLUP)).where("symbol = 'B'").collect()} == {1}


def send_unordered(topic, seed):
    draw = random.Random(seed)
    at = 0
    for _ in range(9):
        texts = []
        for _ in range(60):
            minutes = max(0, at + draw.randrange(40) - (90 if draw.random() < 0.2 else 0))
            texts.append(tick(draw.choice("ABC"), f"{minutes // 60:02}:{minutes % 60:02}:{draw.randrange(60):02}"))
        topic.send(*texts)
        at += draw.randrange(10, 50)


def dropped(progress):
    return sum(op["numRowsDroppedByWatermark"] for p in progress for op in p["stateOperators"])


@pytest.mark.parametrize("seed", [5, 6])
def test_late_ticks_are_those_the_windows_drop(spark, topic, tables, tmp_path, seed):
    """Spark counts a dropped row per symbol, window and batch; so many groups do the late ticks make."""
    send_unordered(topic, seed)
    ticks = sound_ticks(topic.messages())
    windows = start_windows(ticks, tables, str(tmp_path / "w"), trigger=ONCE)
    windows.awaitTermination()
    start_late(ticks, tables, str(tmp_path / "l"), trigger=ONCE).awaitTermination()
    late = tables.scan(spark, LATE).where("symbol IS NOT NULL")
    groups = late.select("batch_id", "symbol", "window_end").distinct().count()
    assert groups == dropped(windows.recentProgress) > 5
    assert late.where("window_end > watermark").count() == 0
    assert {r.reason for r in late.collect()} == {"its window was closed"}


def test_repeated_batch_finds_the_same_late_ticks(spark, topic, tables, tmp_path, monkeypatch):
    """The job is lost after the state of the last batch is stored; the batch comes again."""
    for clock in ("01:00:00", "02:00:00", "00:30:00", "00:31:00"):
        topic.send(tick("A", clock))
    ticks = sound_ticks(topic.messages())
    write, failed = ParquetTables.put_state, []

    def lost(self, frame, contract, batch):
        write(self, frame, contract, batch)
        if batch.id == 3 and not failed:
            failed.append(1)
            raise RuntimeError("lost")

    monkeypatch.setattr(ParquetTables, "put_state", lost)
    with pytest.raises(Exception, match="lost"):
        start_late(ticks, tables, str(tmp_path / "l"), trigger=ONCE).awaitTermination()
    start_late(ticks, tables, str(tmp_path / "l"), trigger=ONCE).awaitTermination()
    found = sorted((r.timestamp, r.watermark) for r in tables.read(spark, LATE).collect())
    assert found == [(moment("00:30:00"), moment("00:50:00")), (moment("00:31:00"), moment("01:50:00"))]
