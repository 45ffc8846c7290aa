"""Open windows that go from one checkpoint to another, with other state partitions."""

import random

import pytest
from conftest import moment, rows
from test_streaming import ONCE, Topic, tick

from tickloom.schema import ALERTS, BARS, PRICE_STATS
from tickloom.sources import read_topic_stream
from tickloom.session import streaming_session
from tickloom.streaming import ParquetTables, hand_over
from tickloom.streaming.job import sound_ticks, start_windows


def drawn(seed):
    """Messages of a few hours, some of them late, in six batches."""
    draw, at, batches = random.Random(seed), 0, []
    for _ in range(6):
        texts = []
        for _ in range(80):
            minutes = max(0, at + draw.randrange(30) - (40 if draw.random() < 0.1 else 0))
            clock = f"{minutes // 60:02}:{minutes % 60:02}:{draw.randrange(60):02}"
            texts.append(tick(draw.choice("ABCDEFGH"), clock, draw.randrange(100, 999) / 100, draw.randrange(10**5)))
        batches.append(texts)
        at += 12
    return batches


def window_run(spark, path, batches, tables, checkpoint, partitions):
    topic = Topic(spark, path)
    for batch in batches:
        topic.send(*batch)
    topic.session = streaming_session(spark, partitions)
    query = start_windows(sound_ticks(topic.messages()), tables, checkpoint, trigger=ONCE)
    query.awaitTermination()
    return [state for p in query.recentProgress for state in p["stateOperators"]]


@pytest.mark.parametrize("cut", [1, 3])
def test_no_open_window_is_lost_or_doubled(spark, tmp_path, cut):
    batches = drawn(cut)
    halves = ParquetTables(str(tmp_path / "halves"))
    window_run(spark, tmp_path / "a", batches[:cut], halves, str(tmp_path / "c4"), 4)
    held = spark.read.format("statestore").load(str(tmp_path / "c4")).count()
    assert held > 5
    hand_over(spark, str(tmp_path / "c4"), str(tmp_path / "c8"))
    states = window_run(spark, tmp_path / "b", batches[cut:], halves, str(tmp_path / "c8"), 8)
    assert {s["numShufflePartitions"] for s in states} == {8}
    found = rows(halves.read(spark, PRICE_STATS))
    assert len({r[:2] for r in found}) == len(found)

    # what one query gives that is stopped and started again at the same place
    whole = ParquetTables(str(tmp_path / "whole"))
    topic = Topic(spark, tmp_path / "w")
    topic.session = streaming_session(spark, 4)
    for half in (batches[:cut], batches[cut:]):
        for batch in half:
            topic.send(*batch)
        start_windows(sound_ticks(topic.messages()), whole, str(tmp_path / "w4"), trigger=ONCE).awaitTermination()
    for contract in (PRICE_STATS, BARS, ALERTS):
        assert rows(halves.read(spark, contract)) == rows(whole.read(spark, contract))


def test_sums_go_on(spark, tmp_path):
    """A window with ticks on both sides, one that the first query closed, a restart, and alerts."""
    tables = ParquetTables(str(tmp_path / "t"))
    first = [[tick("A", "00:01:00", 1.0, 90000)], [tick("A", "00:20:00", 2.0), tick("B", "00:21:00", 5.0, 7)], [tick("A", "00:22:00", 4.0)]]
    window_run(spark, tmp_path / "a", first, tables, str(tmp_path / "c1"), 1)
    position = hand_over(spark, str(tmp_path / "c1"), str(tmp_path / "c2"))
    assert position == '{"logOffset":2}'
    second = [[tick("A", "00:23:00", 3.0, 1000), tick("A", "00:02:00", 99.0)], [tick("A", "01:00:00")]]
    topic = Topic(spark, tmp_path / "b")
    for n, batch in enumerate(second):  # the second query is stopped and started once
        topic.send(*batch)
        topic.session = streaming_session(spark, 3)
        stream = read_topic_stream(topic.session, {"maxFilesPerTrigger": "1"}, format="text", path=topic.path)
        start_windows(sound_ticks(stream), tables, str(tmp_path / "c2"), trigger=ONCE).awaitTermination()
    bars = {(r.symbol, r.window_start): (r.ma, float(r.high), float(r.low), r.avg_volume) for r in tables.read(spark, BARS).collect()}
    assert bars == {
        ("A", moment("00:00:00")): (1.0, 1.0, 1.0, 90000.0),
        ("A", moment("00:20:00")): (3.0, 4.0, 2.0, 1020 / 3),
        ("B", moment("00:20:00")): (5.0, 5.0, 5.0, 7.0),
    }
    assert tables.read(spark, BARS).count() == 3
    assert sorted(r.symbol for r in tables.read(spark, ALERTS).collect()) == ["A", "A"]


def test_unused_and_used_checkpoints(spark, tmp_path):
    assert hand_over(spark, str(tmp_path / "none"), str(tmp_path / "new")) is None
    (tmp_path / "used").mkdir()
    with pytest.raises(ValueError, match="in use"):
        hand_over(spark, str(tmp_path / "none"), str(tmp_path / "used"))
