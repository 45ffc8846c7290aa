import os
from datetime import timedelta
from threading import Event
from time import sleep

import pytest
from conftest import moment, rows
from pyspark.sql import functions as F

from tickloom.functions import as_instant
from tickloom.operators import conform, detect_alerts, latest_prices, price_stats, windowed_stats
from tickloom.schema import ALERTS, BARS, LATEST, PRICE_STATS, QUARANTINE, TICKS
from tickloom.session import run_folder, streaming_session
from tickloom.sources import (
    decode_ticks,
    kafka_options,
    kafka_sink_options,
    publish_ticks,
    read_topic_stream,
)
from tickloom.streaming.job import start_raw
from tickloom.streaming import (
    Batch,
    ParquetTables,
    start_latest,
    start_pipeline,
    start_sink,
    store,
    wait,
)

ONCE = {"availableNow": True}


def tick(symbol, clock, price=1.0, volume=10):
    return (
        f'{{"symbol":"{symbol}","price":{price},"volume":{volume},'
        f'"timestamp":"2024-01-01T{clock}"}}'
    )


class Topic:
    """A folder of message files, read one file per batch in the order of sending."""

    def __init__(self, spark, path):
        self.session = streaming_session(spark, partitions=2)
        self.path = str(path)
        self.sent = 0
        os.makedirs(self.path)

    def send(self, *texts):
        self.sent += 1
        path = f"{self.path}/{self.sent:04}.txt"
        with open(path, "w") as file:
            file.write("\n".join(texts) + "\n")
        os.utime(path, (1_700_000_000 + self.sent * 60,) * 2)

    def messages(self):
        return read_topic_stream(
            self.session, {"maxFilesPerTrigger": "1"}, format="text", path=self.path
        )

    def ticks(self):
        return decode_ticks(self.messages())[0]


@pytest.fixture
def topic(spark, tmp_path):
    return Topic(spark, tmp_path / "topic")


@pytest.fixture
def tables(tmp_path):
    return ParquetTables(str(tmp_path / "tables"))


def run(stream, tables, checkpoint, name="stats"):
    """Drain stats into a table; the progress of each batch comes back."""

    def write(frame, batch):
        store([(price_stats(frame), PRICE_STATS)], tables, batch)

    tables.create(stream.sparkSession, PRICE_STATS)
    query = start_sink(stream, name, str(checkpoint), write, trigger=ONCE)
    query.awaitTermination()
    return query.recentProgress


def dropped(progress):
    return sum(op["numRowsDroppedByWatermark"] for p in progress for op in p["stateOperators"])


def starts(spark, tables):
    return [r.window_start for r in tables.read(spark, PRICE_STATS).orderBy("window_start").collect()]


def send_late_rows(topic, settle):
    for batch in [["00:01:00"], ["00:30:00"], ["00:31:00"], ["00:02:00", "00:21:00"], ["01:30:00"]]:
        if settle or batch != ["00:31:00"]:
            topic.send(*[tick("A", clock, price=2.0) for clock in batch])


def test_late_row_is_dropped_and_counted(spark, topic, tables, tmp_path):
    send_late_rows(topic, settle=True)
    progress = run(windowed_stats(topic.ticks()), tables, tmp_path / "c")
    assert dropped(progress) == 1
    assert starts(spark, tables) == [moment("00:00:00"), moment("00:20:00"), moment("00:30:00")]


def test_late_filter_lags_one_batch(spark, topic, tables, tmp_path):
    send_late_rows(topic, settle=False)
    assert dropped(run(windowed_stats(topic.ticks()), tables, tmp_path / "c")) == 0


def test_last_window_waits_for_a_later_tick(spark, topic, tables, tmp_path):
    topic.send(tick("A", "00:01:00"))
    topic.send(tick("A", "00:14:59"))
    run(windowed_stats(topic.ticks()), tables, tmp_path / "c")
    assert starts(spark, tables) == []
    topic.send(tick("A", "00:15:00"))
    run(windowed_stats(topic.ticks()), tables, tmp_path / "c")
    assert starts(spark, tables) == [moment("00:00:00")]


def test_restart_goes_on_and_emits_nothing_twice(spark, topic, tables, tmp_path):
    for hour in range(6):
        topic.send(tick("A", f"0{hour}:01:00"), tick("A", f"0{hour}:02:00", price=3.0))
        progress = run(windowed_stats(topic.ticks()), tables, tmp_path / "c")
        assert sum(p["numInputRows"] for p in progress) == 2
    found = rows(tables.read(spark, PRICE_STATS))
    assert [r[1] for r in found] == [moment(f"0{hour}:00:00") for hour in range(5)]
    assert {float(r[4]) for r in found} == {100.0}


def test_stream_equals_table_up_to_the_watermark(spark, topic, tables, tmp_path):
    clocks = [f"{m // 60:02}:{m % 60:02}:{s:02}" for m in range(0, 150, 2) for s in (0, 31)]
    texts = [
        tick(symbol, clock, price=1 + i % 7, volume=1000 * i)
        for i, clock in enumerate(clocks)
        for symbol in ("HOT", "HOT", f"S{i % 3}")
    ]
    for at in range(0, len(texts), 90):
        topic.send(*texts[at : at + 90])
    stats = windowed_stats(topic.ticks())

    def write(frame, batch):
        store([(detect_alerts(frame), ALERTS)], tables, batch)

    start_sink(stats, "alerts", str(tmp_path / "c"), write, trigger=ONCE).awaitTermination()
    table = decode_ticks(spark.createDataFrame([(t,) for t in texts], "value string"))[0]
    last = moment(max(clocks))
    expected = detect_alerts(windowed_stats(table)).where(
        F.col("window_end") <= as_instant(last - timedelta(minutes=10), table.schema["timestamp"].dataType)
    )
    expected = conform(expected, ALERTS)[0]
    assert rows(tables.read(spark, ALERTS)) == rows(expected)
    assert expected.count() > 20


def test_one_state_and_one_read_for_all_alerts(topic, tables, tmp_path):
    topic.send(tick("A", "00:01:00"), tick("A", "00:02:00"))
    progress = run(windowed_stats(topic.ticks()), tables, tmp_path / "c")
    assert [len(p["stateOperators"]) for p in progress] == [1] * len(progress)
    assert sum(p["numInputRows"] for p in progress) == 2


def test_replayed_batch_changes_nothing(spark, make_ticks, tables):
    batch = make_ticks([("A", 1, 1, "00:01:00"), ("A", 1, 1, "00:01:00"), ("B", 1e9, 1, "00:02:00")])
    for batch_id in (0, 1, 1, 0):
        store([(batch, TICKS)], tables, Batch("raw", batch_id))
    assert tables.read(spark, TICKS).count() == 4
    assert tables.read(spark, QUARANTINE).count() == 2


def test_failed_batch_is_repeated_without_duplicates(spark, topic, tables, tmp_path):
    """The write fails after the rows are out, as when the driver is lost."""
    topic.send(tick("A", "00:01:00"))
    topic.send(tick("B", "00:02:00"))
    attempts = []

    def write(frame, batch):
        store([(frame, TICKS)], tables, batch)
        attempts.append(batch.id)
        if attempts == [0, 1]:
            raise RuntimeError("lost")

    def drain():
        query = start_sink(topic.ticks(), "raw", str(tmp_path / "c"), write, trigger=ONCE)
        query.awaitTermination()

    with pytest.raises(Exception, match="lost"):
        drain()
    drain()
    assert attempts == [0, 1, 1]
    assert [r[0] for r in rows(tables.read(spark, TICKS))] == ["A", "B"]


def test_ticks_are_laid_out_by_day_and_sorted(spark, make_ticks, tables):
    data = [(s, 1, 1, f"2024-01-0{d}T00:0{m}:00") for d in (2, 1) for m in (3, 1) for s in "BA"]
    store([(make_ticks(data).coalesce(1), TICKS)], tables, Batch("raw", 0, "x"))
    for day in (1, 2):
        path = f"{tables.path(TICKS)}/day=2024-01-0{day}/source=raw-x/batch_id=0"
        found = [(r.symbol, r.timestamp.minute) for r in spark.read.parquet(path).collect()]
        assert found == [("A", 1), ("A", 3), ("B", 1), ("B", 3)]


def test_new_checkpoint_keeps_what_an_older_one_stored(spark, topic, tables, tmp_path):
    """Batch ids start again at 0 with a new checkpoint."""
    topic.send(*[tick("A", f"00:0{i}:00") for i in range(5)])
    for checkpoint in ("first", "second"):
        for _ in range(2):  # and a restart repeats nothing
            start_raw(topic.messages(), tables, str(tmp_path / checkpoint), ONCE).awaitTermination()
    assert tables.read(spark, TICKS).count() == 10


def test_window_state_falls_between_batches(spark, topic, tables, tmp_path):
    """Closed windows leave the state, and a split of the input changes no result."""
    clocks = [f"{m // 60:02}:{m % 60:02}:00" for m in range(0, 360)]
    for at in range(0, 360, 60):
        topic.send(*[tick("A", clock, price=1 + m % 3) for m, clock in enumerate(clocks[at : at + 60])])
    progress = run(windowed_stats(topic.ticks()), tables, tmp_path / "c")
    held = [p["stateOperators"][0]["numRowsTotal"] for p in progress if p["stateOperators"]]
    assert len(progress) >= 6 and max(held) <= 15 and held[-1] <= 3
    whole = ParquetTables(f"{tables.root}-whole")
    one = Topic(spark, tmp_path / "one")
    one.send(*[tick("A", clock, price=1 + m % 60 % 3) for m, clock in enumerate(clocks)])
    run(windowed_stats(one.ticks()), whole, tmp_path / "d")
    assert rows(tables.read(spark, PRICE_STATS)) == rows(whole.read(spark, PRICE_STATS))


def test_pipeline_fills_every_table(spark, topic, tables, tmp_path):
    topic.send(tick("A", "00:01:00", 1.0, 90000), tick("A", "00:02:00", 2.0, 90000), "junk")
    topic.send(tick("ELEVENCHARS", "00:03:00"), tick("B", "01:00:00"), "{}")
    started = start_pipeline(topic.messages(), tables, str(tmp_path / "c"), ONCE)
    for query in started:
        query.awaitTermination()
    window = ("A", moment("00:00:00"), moment("00:05:00"))
    assert sorted(r.symbol for r in tables.read(spark, TICKS).collect()) == ["A", "A", "B"]
    assert [r[0] for r in rows(tables.read(spark, BARS))] == ["A"]
    assert [(*r[:3], float(r[3]), float(r[4])) for r in rows(tables.read(spark, PRICE_STATS))] == [
        (*window, 1.0, 66.67)
    ]
    assert [(r[3], float(r[4])) for r in rows(tables.read(spark, ALERTS))] == [
        ("High volatility detected", 66.67),
        ("High volume detected", 90000.0),
    ]
    assert sorted(r.reason for r in tables.read(spark, QUARANTINE).collect()) == [
        "does not fit stock_prices",
        "malformed message",
        "missing symbol, price, volume, timestamp",
    ]


def test_write_tasks_bound_the_files(spark, topic, tmp_path):
    tables = ParquetTables(str(tmp_path / "tables"), tasks=1)
    topic.send(*[tick(f"S{i}", "00:01:00", volume=90000) for i in range(40)], tick("Z", "01:00:00"))
    topic.session.conf.set("spark.sql.shuffle.partitions", "6")
    for query in start_pipeline(topic.messages(), tables, str(tmp_path / "c"), ONCE):
        query.awaitTermination()
    for contract in (TICKS, BARS, PRICE_STATS, ALERTS):
        files = tables.read(spark, contract).select(F.input_file_name()).distinct().count()
        assert files == 1
    assert tables.read(spark, ALERTS).count() == 40


def test_tables_exist_before_their_first_row(spark, topic, tables, tmp_path):
    topic.send("junk")
    for query in start_pipeline(topic.messages(), tables, str(tmp_path / "c"), ONCE):
        query.awaitTermination()
    assert [tables.read(spark, c).count() for c in (TICKS, BARS, PRICE_STATS, ALERTS, QUARANTINE)] == [0, 0, 0, 0, 1]
    assert tables.read_state(spark, LATEST).count() == 0


def test_aggregates_see_what_the_table_takes(spark, topic, tables, tmp_path):
    """A price beyond the contract is quarantined and moves no window; totals are decimal."""
    topic.send(tick("A", "00:01:00", 100.0), tick("A", "00:02:00", 1e9), tick("B", "00:01:00", 0.1))
    topic.send(tick("B", "00:02:00", 0.2), tick("B", "00:03:00", 0.3), tick("Z", "01:00:00"))
    for query in start_pipeline(topic.messages(), tables, str(tmp_path / "c"), ONCE):
        query.awaitTermination()
    assert [(r.symbol, r.ma, float(r.high)) for r in tables.read(spark, BARS).orderBy("symbol").collect()] == [
        ("A", 100.0, 100.0), ("B", 0.6 / 3, 0.3),
    ]
    assert [r.symbol for r in tables.read(spark, ALERTS).collect()] == ["B"]
    rejected = tables.read(spark, QUARANTINE).collect()
    assert [(r.value, r.reason) for r in rejected] == [(tick("A", "00:02:00", 1e9), "does not fit stock_prices")]


def test_queries_do_not_replace_each_others_batches(spark, make_ticks, tables):
    for query in ("raw", "other"):
        rows_ = make_ticks([(query, 1, 1, "00:01:00")])
        store([(rows_, TICKS)], tables, Batch(query, 0))
    assert [r[0] for r in rows(tables.read(spark, TICKS))] == ["other", "raw"]


def source_of(tables, contract):
    return next(n for n in os.listdir(tables.path(contract)) if n.startswith("source="))


def test_latest_over_checkpoints(spark, topic, tables, tmp_path):
    for n, clock in enumerate(("00:02:00", "00:01:00")):
        topic.send(tick("A", clock, 1.0 + n))
        one = Topic(spark, tmp_path / f"t{n}")
        one.send(tick("A", clock, 1.0 + n))
        start_latest(one.ticks(), tables, str(tmp_path / f"c{n}"), ONCE).awaitTermination()
    assert tables.read_state(spark, LATEST).count() == 2
    assert [float(r.price) for r in latest_prices(tables.read_state(spark, LATEST)).collect()] == [1.0]


def test_latest_on_a_stream(spark, topic, tables, tmp_path):
    topic.send(tick("A", "00:01:00", 1.0), tick("B", "00:01:00", 5.0))
    topic.send(tick("A", "00:03:00", 2.0), tick("A", "00:02:00", 9.0))
    topic.send(tick("A", "00:00:30", 7.0))
    start_latest(topic.ticks(), tables, str(tmp_path / "c"), ONCE).awaitTermination()
    state = tables.read_state(spark, LATEST)
    assert state.count() == 2
    assert len([n for n in os.listdir(f"{tables.path(LATEST)}/" + source_of(tables, LATEST)) if n.startswith("batch_id")]) <= 2
    current = latest_prices(state)
    assert not os.path.exists(tables.path(TICKS))
    assert [(r[0], float(r[1]), r[3]) for r in rows(current)] == [
        ("A", 2.0, moment("00:03:00")),
        ("B", 5.0, moment("00:01:00")),
    ]


def test_wait_stops_the_other_queries(topic, tables, tmp_path):
    def lost(frame, batch):
        raise RuntimeError("lost")

    def quiet(frame, batch):
        pass

    start_sink(topic.ticks(), "quiet", str(tmp_path / "q"), quiet)
    topic.send(tick("A", "00:01:00"))
    start_sink(topic.ticks(), "lost", str(tmp_path / "l"), lost)
    with pytest.raises(Exception, match="lost"):
        wait(topic.session)
    assert topic.session.streams.active == []


def test_stop_lets_the_running_batch_end(topic, tmp_path):
    begun, ended, stop = [], [], Event()

    def slow(frame, batch):
        begun.append(batch.id)
        stop.set()
        sleep(2)
        ended.append(batch.id)

    topic.send(tick("A", "00:01:00"))
    start_sink(topic.ticks(), "slow", str(tmp_path / "s"), slow)
    wait(topic.session, stop)
    assert begun == ended == [0] and topic.session.streams.active == []


def test_published_ticks_come_back(spark, make_ticks, tmp_path):
    sent = make_ticks([("A", "1.50", 1, "00:01:00.000001"), ("B", "2.25", 2, "00:02:00")])
    path = str(tmp_path / "out")
    assert publish_ticks(sent, {"path": path}, format="parquet") is None
    ticks, _ = decode_ticks(spark.read.parquet(path))
    assert [r[:3] for r in rows(ticks)] == [("A", 1.5, 1), ("B", 2.25, 2)]


def test_stream_can_be_published(spark, topic, tmp_path):
    topic.send(tick("A", "00:01:00", 2.0))
    options = {"path": str(tmp_path / "out")}
    with pytest.raises(ValueError, match="checkpoint"):
        publish_ticks(topic.ticks(), options, format="parquet")
    query = publish_ticks(topic.ticks(), options, "parquet", str(tmp_path / "c"), ONCE)
    query.awaitTermination()
    assert decode_ticks(spark.read.parquet(options["path"]))[0].count() == 1


def test_kafka_options():
    assert kafka_options("host:1", groupIdPrefix="x") == {
        "kafka.bootstrap.servers": "host:1",
        "subscribe": "stock_data",
        "startingOffsets": "latest",
        "groupIdPrefix": "x",
    }
    assert kafka_options("host:1", "other", "earliest")["startingOffsets"] == "earliest"
    assert kafka_sink_options("host:1", acks="all") == {
        "kafka.bootstrap.servers": "host:1", "topic": "stock_data", "acks": "all",
    }


def test_run_folder_lies_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = run_folder(spark), run_folder(spark)
    assert first.startswith(shared) and second.startswith(shared) and first != second


def test_streaming_session_leaves_the_caller_alone(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    sibling = streaming_session(spark, partitions=3)
    assert sibling.conf.get("spark.sql.shuffle.partitions") == "3"
    assert sibling.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
