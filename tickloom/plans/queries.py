"""Every operator as a query over the ``events`` table, taken as ticks."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom import operators as op
from tickloom.functions import as_instant
from tickloom.schema import (
    ALERTS,
    BARS,
    DAILY_VIEW,
    INDICATORS,
    LAST_CLOSES,
    LATE,
    LATEST,
    LATEST_VIEW,
    PRICE_STATS,
    QUARANTINE,
    ROLLUP,
    TICKS,
)
from tickloom.session import children, run_folder, streaming_session, use_utc
from tickloom.sources import (
    decode_ticks,
    encode_ticks,
    messages_from_events,
    read_alerts,
    read_ticks,
    read_topic_stream,
    ticks_from_events,
)
from tickloom.streaming import (
    ParquetTables,
    compact,
    hand_over,
    start_indicators,
    start_late,
    start_latest,
    start_pipeline,
    start_rollups,
)
from tickloom.streaming.job import sound_ticks, start_raw, start_windows

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SYMBOL = "view"
HOUR = timedelta(hours=1)
DAY = timedelta(days=1)
ONCE = {"availableNow": True}

#: Bytes of files in a batch of the streams that take the table in any order.
BOUNDED = {"maxBytesPerTrigger": str(2**40)}
#: Rows of a range of a topic, and so of a batch, about; a topic has some ranges at any size.
RANGE_ROWS, LEAST_RANGES = 5_000_000, 4
#: Files of a range, so that several tasks take it.
FILES = 4
#: Of how many events one is sent too late.
DELAYED = 7


def query(name: str, **settings) -> Callable:
    """Register a query under a name, with fixed settings of the function."""

    def register(function: Callable) -> Callable:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return function(use_utc(spark), folder, **settings)

        QUERIES[name] = run
        return function

    return register


def events(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/events.parquet")


def event_stream(spark: SparkSession, folder: str, **options: str) -> DataFrame:
    """The same files as a stream, in no order of time. Streams want a folder or a pattern, not a file."""
    reader = spark.readStream.schema(events(spark, folder).schema).options(**options)
    return reader.parquet(f"{folder}/event[s].parquet")


def ticks(spark: SparkSession, folder: str) -> DataFrame:
    return ticks_from_events(events(spark, folder))


def stats(spark: SparkSession, folder: str, width: str = "5 minutes") -> DataFrame:
    return op.windowed_stats(ticks(spark, folder), width)


def newest(spark: SparkSession, folder: str) -> datetime:
    """The time of the newest tick, standing in for now.

    One value read ahead: as a literal, both ends of a time range reach the scan.
    """
    return ticks(spark, folder).agg(F.max("timestamp")).first()[0]


def stored(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Rows written to the shared folder and read back, for use more than once."""
    path = f"{run_folder(spark)}/rows"
    rows.write.parquet(path)
    return spark.read.parquet(path)


def alerts_since(spark: SparkSession, folder: str, since: datetime) -> DataFrame:
    return op.detect_alerts(op.windowed_stats(ticks(spark, folder), since=since))


def naive(rows: DataFrame) -> DataFrame:
    """Zoned timestamps as plain UTC ones."""
    zoned = [name for name, kind in rows.dtypes if kind == "timestamp"]
    return rows.withColumns({name: F.col(name).cast("timestamp_ntz") for name in zoned})


@query("price_bars_5m", width="5 minutes")
@query("price_bars_1h", width="1 hour")
def price_bars(spark, folder, width):
    return op.price_bars(stats(spark, folder, width))


@query("price_stats_5m", width="5 minutes")
@query("price_stats_1h", width="1 hour")
def price_stats(spark, folder, width):
    return op.price_stats(stats(spark, folder, width))


@query("price_alerts")
def price_alerts(spark, folder):
    return op.price_alerts(stats(spark, folder))


@query("volume_alerts")
def volume_alerts(spark, folder):
    return op.volume_alerts(stats(spark, folder))


@query("alerts_5m", width="5 minutes")
@query("alerts_1h", width="1 hour")
def alerts(spark, folder, width):
    return op.detect_alerts(stats(spark, folder, width))


@query("latest_prices")
def latest_prices(spark, folder):
    return op.latest_prices(ticks(spark, folder))


@query("daily_stats")
def daily_stats(spark, folder):
    return op.daily_stats(ticks(spark, folder))


@query("view_latest_prices", view=LATEST_VIEW)
@query("view_daily_stats", view=DAILY_VIEW)
def view(spark, folder, view):
    op.create_views(ticks(spark, folder))
    return spark.sql(f"SELECT * FROM {view}")


@query("price_history_5min", choice="5min")
@query("price_history_15min", choice="15min")
@query("price_history_1hour", choice="1hour")
@query("price_history_1day", choice="1day")
def price_history(spark, folder, choice):
    return op.price_history(ticks(spark, folder), SYMBOL, choice, newest(spark, folder))


@query("recent_alerts", within=HOUR)
@query("recent_alerts_1day", within=DAY)
def recent_alerts(spark, folder, within):
    as_of = newest(spark, folder)
    found = alerts_since(spark, folder, as_of - within)
    return op.recent_alerts(found, SYMBOL, as_of, within)


@query("alert_feed", within=HOUR)
@query("alert_feed_1day", within=DAY)
def alert_feed(spark, folder, within):
    as_of = newest(spark, folder)
    fitting, _ = op.conform(alerts_since(spark, folder, as_of - within), ALERTS)
    return op.alert_feed(fitting, SYMBOL, as_of, within)


@query("decode_ticks")
def decode(spark, folder):
    sound, _ = decode_ticks(messages_from_events(events(spark, folder)))
    return naive(sound)


@query("quarantine_ticks")
def quarantine(spark, folder):
    _, rejected = decode_ticks(messages_from_events(events(spark, folder)))
    return rejected


@query("encode_decode_roundtrip")
def roundtrip(spark, folder):
    back, _ = decode_ticks(encode_ticks(ticks(spark, folder)))
    return naive(back).withColumn("price", F.col("price").cast("decimal(18,2)"))


@query("conform_ticks")
def conform_ticks(spark, folder):
    return op.conform(ticks(spark, folder), TICKS)[0]


@query("conform_price_stats")
def conform_price_stats(spark, folder):
    return op.conform(op.price_stats(stats(spark, folder)), PRICE_STATS)[0]


@query("conform_alerts")
def conform_alerts(spark, folder):
    return op.conform(op.detect_alerts(stats(spark, folder)), ALERTS)[0]


@query("conform_price_bars")
def conform_price_bars(spark, folder):
    return op.conform(op.price_bars(stats(spark, folder)), BARS)[0]


@query("rsi_1h")
def rsi(spark, folder):
    return op.rsi(stored(spark, op.closes(ticks(spark, folder), "1 hour")))


@query("trend_1h")
def trend(spark, folder):
    return op.trend(stored(spark, op.closes(ticks(spark, folder), "1 hour")))


def turns_of(table: DataFrame, delayed: Column | None = None) -> Column | None:
    """The number of the range of time that a row comes in; rows with ``delayed`` come a range later.

    Rows without a time come first. Null for a table without any time.
    """
    first, last, rows = table.agg(F.min("ts"), F.max("ts"), F.count("*")).first()
    if first is None:
        return None
    micros = timedelta(microseconds=1)
    width = (last - first) // micros // max(LEAST_RANGES, -(-rows // RANGE_ROWS)) + 1
    start = F.unix_micros(as_instant(first, table.schema["ts"].dataType).cast("timestamp"))
    own = F.floor((F.unix_micros(F.col("ts").cast("timestamp")) - start) / F.lit(width))
    later = F.when(delayed, 1).otherwise(0) if delayed is not None else F.lit(0)
    return F.coalesce(own + later, F.lit(0))


def topic_in_order(spark, folder: str, delayed: Column | None = None) -> str:
    """The table's messages as a topic: a folder that gets ``FILES`` files at a time, range by range."""
    return topics_in_order(spark, folder, 1, delayed)[0]


def topics_in_order(spark, folder: str, parts: int, delayed: Column | None = None) -> list[str]:
    """The same, cut into several topics, one after the other."""
    root, table = run_folder(spark), events(spark, folder)
    topics, sorted_by_turn = [f"{root}/topic{n}" for n in range(parts)], f"{root}/sorted"
    turn = turns_of(table, delayed)
    if turn is None:
        for topic in topics:
            messages_from_events(table).repartition(FILES).write.parquet(topic)
        return topics
    numbered = table.withColumn("turn", turn).repartitionByRange("turn", "event_id")
    messages_from_events(numbered, "turn").write.partitionBy("turn").parquet(sorted_by_turn)
    names = [name for name in children(spark, sorted_by_turn) if name.startswith("turn=")]
    for n, name in enumerate(sorted(names, key=lambda name: int(name.partition("=")[2]))):
        part = spark.read.schema("value binary").parquet(f"{sorted_by_turn}/{name}")
        part.repartition(FILES).write.mode("append").parquet(topics[n * parts // len(names)])
    return topics


def mixed_topic(spark, folder: str) -> str:
    """The table's messages in files that each have ticks of all days."""
    root, table = run_folder(spark), events(spark, folder)
    files = FILES * max(LEAST_RANGES, -(-table.count() // RANGE_ROWS))
    messages_from_events(table.repartition(files, "event_id")).write.parquet(f"{root}/topic")
    return f"{root}/topic"


def sent(spark, topic: str, partitions: int | None = None) -> DataFrame:
    """A topic as a stream, range by range. State has a partition per million rows of a range, about."""
    size = len(children(spark, topic)) // FILES or 1
    rows = spark.read.schema("value binary").parquet(topic).count() // size
    partitions = partitions or min(spark.sparkContext.defaultParallelism, 2 + rows // 1_000_000)
    options = {"maxFilesPerTrigger": str(FILES)}
    return read_topic_stream(streaming_session(spark, partitions), options, "parquet", "value binary", topic)


def drained(spark, started: list) -> None:
    for running in started:
        running.awaitTermination()


def job_over(spark, topic: str, start: Callable[[DataFrame, ParquetTables, str], list]) -> ParquetTables:
    """Tables that ``start``'s queries have filled from a topic."""
    root = run_folder(spark)
    tables = ParquetTables(f"{root}/tables")
    drained(spark, start(sent(spark, topic), tables, f"{root}/checkpoint"))
    return tables


def window_tables(spark, folder) -> ParquetTables:
    """Bars, stats and alerts as the job's windowed query stores them."""

    def start(stream, tables, checkpoint):
        return [start_windows(sound_ticks(stream), tables, checkpoint, trigger=ONCE)]

    return job_over(spark, topic_in_order(spark, folder), start)


@query("stream_price_bars", contract=BARS)
@query("stream_price_stats", contract=PRICE_STATS)
@query("stream_alerts", contract=ALERTS)
def stream_windows(spark, folder, contract):
    return window_tables(spark, folder).read(spark, contract)


@query("handover_price_stats")
def handover(spark, folder):
    """Stats of two queries: the second begins with the windows that the first left open, in twice the partitions."""
    root = run_folder(spark)
    tables = ParquetTables(f"{root}/tables")
    for n, topic in enumerate(topics_in_order(spark, folder, 2)):
        checkpoint = f"{root}/checkpoint{n}"
        if n:
            hand_over(spark, f"{root}/checkpoint{n - 1}", checkpoint)
        stream = sent(spark, topic, partitions=4 * (n + 1))
        drained(spark, [start_windows(sound_ticks(stream), tables, checkpoint, trigger=ONCE)])
    return tables.read(spark, PRICE_STATS)


@query("job_tables")
def job_tables(spark, folder):
    """Every row of every table that the whole job stores."""
    tables = job_over(
        spark,
        topic_in_order(spark, folder),
        lambda stream, tables, checkpoint: start_pipeline(stream, tables, checkpoint, ONCE),
    )

    def shown(rows: DataFrame, name: str, at: str, note: str, value: str) -> DataFrame:
        return rows.select(
            F.lit(name).alias("stored_in"),
            F.col("symbol"),
            F.col(at).alias("at"),
            F.expr(note).alias("note"),
            F.col(value).cast("double").alias("value"),
        )

    rejected = tables.read(spark, QUARANTINE).withColumns(
        {"symbol": F.lit(None).cast("string"), "at": F.lit(None).cast("timestamp_ntz"), "none": F.lit(None)}
    )
    parts = [
        shown(tables.read(spark, TICKS), "ticks", "timestamp", "string(volume)", "price"),
        shown(tables.read(spark, BARS), "bars", "window_start", "string(high)", "low"),
        shown(tables.read(spark, PRICE_STATS), "stats", "window_start", "string(price_range)", "volatility"),
        shown(tables.read(spark, ALERTS), "alerts", "window_start", "alert_type", "value"),
        shown(op.latest_prices(tables.read_state(spark, LATEST)), "latest", "timestamp", "string(volume)", "price"),
        shown(rejected, "quarantine", "at", "concat(reason, ': ', value)", "none"),
    ]
    return reduce(DataFrame.unionByName, parts)


@query("stream_rsi_1h", figure="rsi")
@query("stream_trend_1h", figure="trend")
def stream_indicators(spark, folder, figure):
    """Indicators of closed windows, each stored by the batch that closed it."""

    def start(stream, tables, checkpoint):
        return [start_indicators(sound_ticks(stream), tables, checkpoint, trigger=ONCE)]

    rows = job_over(spark, topic_in_order(spark, folder), start).read(spark, INDICATORS)
    return rows.select(*LAST_CLOSES.columns, figure)


@query("late_ticks")
def late_ticks(spark, folder):
    """Ticks that come after their window was closed: every seventh is sent a range too late."""

    def start(stream, tables, checkpoint):
        return [start_late(sound_ticks(stream), tables, checkpoint, trigger=ONCE)]

    topic = topic_in_order(spark, folder, F.col("event_id") % DELAYED == 0)
    return job_over(spark, topic, start).read(spark, LATE)


def rollup_table(spark, folder) -> DataFrame:
    """Rollups as the job's query stores them, batch by batch from ticks in no order."""

    def start(stream, tables, checkpoint):
        return [start_rollups(sound_ticks(stream), tables, checkpoint, trigger=ONCE)]

    return job_over(spark, mixed_topic(spark, folder), start).read(spark, ROLLUP)


@query("rollup_price_bars_5m")
def rollup_bars(spark, folder):
    return op.price_bars(op.rollup_stats(op.merged(rollup_table(spark, folder))))


@query("rollup_price_bars_1h")
def rollup_bars_1h(spark, folder):
    return op.price_bars(op.rollup_stats(op.coarser(rollup_table(spark, folder), "1 hour")))


@query("rollup_alerts_1h")
def rollup_alerts(spark, folder):
    return op.detect_alerts(op.rollup_stats(op.coarser(rollup_table(spark, folder), "1 hour")))


@query("rollup_daily_stats")
def rollup_daily(spark, folder):
    return op.rollup_days(rollup_table(spark, folder))


@query("rollup_trend_1h")
def rollup_trend(spark, folder):
    return op.trend(stored(spark, op.rollup_closes(rollup_table(spark, folder))))


def closed(tables: ParquetTables, spark, contract, combine=None) -> ParquetTables:
    """The tables after all days but the newest one are rewritten."""
    newest = tables.read(spark, contract).agg(F.max(F.to_date(contract.time))).first()[0]
    if newest is not None:
        compact(spark, tables, contract, newest, combine)
    return tables


@query("compacted_ticks")
def compacted_ticks(spark, folder):
    """The tick table after a rewrite; every batch had ticks of all days."""

    def start(stream, tables, checkpoint):
        return [start_raw(stream, tables, checkpoint, ONCE)]

    tables = closed(job_over(spark, mixed_topic(spark, folder), start), spark, TICKS)
    return tables.read(spark, TICKS).select(*TICKS.columns)


@query("compacted_price_stats", contract=PRICE_STATS)
@query("compacted_alerts", contract=ALERTS)
def compacted_windows(spark, folder, contract):
    return closed(window_tables(spark, folder), spark, contract).read(spark, contract)


@query("compacted_daily_stats")
def compacted_daily(spark, folder):
    """The daily view from rollups that a rewrite has put together."""

    def start(stream, tables, checkpoint):
        return [start_rollups(sound_ticks(stream), tables, checkpoint, trigger=ONCE)]

    tables = closed(job_over(spark, mixed_topic(spark, folder), start), spark, ROLLUP, op.merged)
    return op.rollup_days(tables.read(spark, ROLLUP))


def raw_tables(spark, folder) -> ParquetTables:
    root = run_folder(spark)
    tables = ParquetTables(f"{root}/tables")
    messages = messages_from_events(event_stream(streaming_session(spark), folder, **BOUNDED))
    start_raw(messages, tables, f"{root}/checkpoint", ONCE).awaitTermination()
    return tables


@query("stream_raw_ticks")
def stream_raw_ticks(spark, folder):
    return raw_tables(spark, folder).read(spark, TICKS).select(*TICKS.columns)


@query("stream_quarantine")
def stream_quarantine(spark, folder):
    return raw_tables(spark, folder).read(spark, QUARANTINE)


@query("stored_price_history_15min", choice="15min")
@query("stored_price_history_1day", choice="1day")
def stored_price_history(spark, folder, choice):
    """History from the table the stream wrote: by day, sorted by symbol and time, up to its high-water mark."""
    tables = raw_tables(spark, folder)
    return op.price_history(read_ticks(spark, tables.path(TICKS)), SYMBOL, choice, tables.newest(spark))


@query("stored_view_latest_prices", view=LATEST_VIEW)
@query("stored_view_daily_stats", view=DAILY_VIEW)
def stored_view(spark, folder, view):
    """The views over the table the stream wrote."""
    op.create_views(read_ticks(spark, raw_tables(spark, folder).path(TICKS)))
    return spark.sql(f"SELECT * FROM {view}")


def served_alerts(spark, folder) -> tuple[DataFrame, datetime | None]:
    """The alert table of a job, and the high-water mark of its ticks."""

    def start(stream, tables, checkpoint):
        return [
            start_raw(stream, tables, f"{checkpoint}/raw", ONCE),
            start_windows(sound_ticks(stream), tables, f"{checkpoint}/windows", trigger=ONCE),
        ]

    tables = job_over(spark, topic_in_order(spark, folder), start)
    return read_alerts(spark, tables.path(ALERTS)), tables.newest(spark)


@query("stored_recent_alerts", within=HOUR)
@query("stored_recent_alerts_1day", within=DAY)
def stored_recent_alerts(spark, folder, within):
    """Recent alerts from the table the stream wrote."""
    found, as_of = served_alerts(spark, folder)
    return op.recent_alerts(found, SYMBOL, as_of, within)


@query("stored_alert_feed_1day", within=DAY)
def stored_alert_feed(spark, folder, within):
    found, as_of = served_alerts(spark, folder)
    return op.alert_feed(found, SYMBOL, as_of, within)


@query("stream_latest_prices")
def stream_latest_prices(spark, folder):
    root = run_folder(spark)
    tables = ParquetTables(f"{root}/tables")
    messages = messages_from_events(event_stream(streaming_session(spark), folder, **BOUNDED))
    start_latest(sound_ticks(messages), tables, f"{root}/checkpoint", ONCE).awaitTermination()
    return op.latest_prices(tables.read_state(spark, LATEST))
