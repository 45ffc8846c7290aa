"""The streaming job: messages in, ticks, bars, stats, alerts and rejects out."""

from __future__ import annotations

import logging
import time
from collections import Counter, defaultdict
from collections.abc import Callable, Iterable
from functools import partial
from threading import Event

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.types import TimestampNTZType

from tickloom.functions import as_instant, utc_naive
from tickloom.operators import (
    closes,
    detect_alerts,
    last_closes,
    latest_prices,
    price_bars,
    price_stats,
    rollup,
    rsi,
    trend,
    windowed_stats,
)
from tickloom.operators.contracts import cast_to, conform, fits, misfit
from tickloom.schema import (
    ALERTS,
    BARS,
    EVENT_TIMES,
    HIGH_WATER,
    INDICATORS,
    LAST_CLOSES,
    LATE,
    LATEST,
    PRICE_STATS,
    QUARANTINE,
    ROLLUP,
    TICKS,
    VOLATILITY_LIMIT,
    VOLUME_LIMIT,
    WATERMARK_DELAY,
    WINDOW_WIDTH,
)
from tickloom.session import exists
from tickloom.sources import parse_messages
from tickloom.streaming.handover import seeded_stats, seeds_of
from tickloom.streaming.sinks import Batch, ParquetTables, Tables, start_sink, store


log = logging.getLogger(__name__)


def judged(messages: DataFrame) -> DataFrame:
    """Parsed messages; ``reason`` also says which break the contract of ticks."""
    parsed = parse_messages(messages)
    broken = F.when(~fits(parsed, TICKS), F.lit(misfit(TICKS)))
    return parsed.withColumn("reason", F.coalesce("reason", broken))


def sound_ticks(messages: DataFrame) -> DataFrame:
    """Ticks that the raw table takes, in its types but for the zone that watermarks need.

    Aggregates see the same rows and the same decimals as the table, so their totals are exact.
    """
    good = judged(messages).where(F.col("reason").isNull())
    kinds = {**TICKS.columns, "timestamp": "TIMESTAMP"}
    return good.select(*[F.col(name).cast(kind).alias(name) for name, kind in kinds.items()])


def start_raw(
    messages: DataFrame, tables: Tables, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Store ticks, and quarantine the other messages whole.

    Both tables read and parse the batch: twice the work on a plain scan, but a batch of
    any size needs no room on the executors. A high-water mark says how new the stored ticks are, so
    that readers need not look for the newest one.
    """
    tables.create(messages.sparkSession, TICKS, QUARANTINE, HIGH_WATER)

    def write(rows: DataFrame, batch: Batch) -> None:
        good = F.col("reason").isNull()
        tables.append(cast_to(rows.where(good), TICKS), TICKS, batch)
        tables.append(rows.where(~good).select("value", "reason"), QUARANTINE, batch)
        tables.advance(rows.sparkSession, batch)

    return start_sink(judged(messages), "raw", checkpoint, write, trigger=trigger, keep=False)


def start_windows(
    ticks: DataFrame,
    tables: Tables,
    checkpoint: str,
    width: str = WINDOW_WIDTH,
    delay: str = WATERMARK_DELAY,
    volatility_limit: float = VOLATILITY_LIMIT,
    volume_limit: float = VOLUME_LIMIT,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Store bars, stats and alerts of closed windows, from one state.

    A checkpoint that windows were handed over to begins with those.
    """
    tables.create(ticks.sparkSession, BARS, PRICE_STATS, ALERTS, QUARANTINE)

    def write(stats: DataFrame, batch: Batch) -> None:
        parts = [
            (price_bars(stats), BARS),
            (price_stats(stats), PRICE_STATS),
            (detect_alerts(stats, volatility_limit, volume_limit), ALERTS),
        ]
        store(parts, tables, batch)

    seeds = seeds_of(checkpoint)
    if exists(ticks.sparkSession, seeds):
        stats = seeded_stats(ticks, seeds, width, delay)
    else:
        stats = windowed_stats(ticks, width, delay)
    return start_sink(stats, "windows", checkpoint, write, trigger=trigger)


def start_latest(
    ticks: DataFrame, tables: Tables, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Keep the newest tick of each symbol.

    A batch brings the symbols that changed; the stored state takes them in, so the table has a
    row per symbol and checkpoint. ``latest_prices`` over it combines checkpoints. Ticks that the
    table cannot take do not count; :func:`start_raw` quarantines them.
    """
    tables.create(ticks.sparkSession, LATEST)

    def write(changes: DataFrame, batch: Batch) -> None:
        tables.merge(conform(changes, LATEST)[0], LATEST, batch, latest_prices)

    return start_sink(latest_prices(ticks), "latest", checkpoint, write, "update", trigger, keep=False)


def start_rollups(
    ticks: DataFrame,
    tables: Tables,
    checkpoint: str,
    width: str = WINDOW_WIDTH,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Store partial aggregates of every micro-batch, without state and without a watermark.

    A window has a row per batch that had ticks of it, late ones included; readers add them up
    with ``merged`` or ``coarser``. A repeated batch replaces its own rows, so nothing counts twice.
    """
    tables.create(ticks.sparkSession, ROLLUP)

    def write(rows: DataFrame, batch: Batch) -> None:
        tables.append(rollup(rows, width), ROLLUP, batch)

    return start_sink(ticks, "rollups", checkpoint, write, trigger=trigger, keep=False)


def start_late(
    ticks: DataFrame,
    tables: ParquetTables,
    checkpoint: str,
    width: str = WINDOW_WIDTH,
    delay: str = WATERMARK_DELAY,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Store the ticks that come after their window was closed.

    They are those that a windowed query of the same width, delay and batches drops. As there, a batch is
    held against the watermark of the batch before: the newest time of all batches earlier than that one, in
    milliseconds, less the delay. A state of one row keeps both times, so a repeated batch
    finds what it found at first.
    """
    tables.create(ticks.sparkSession, LATE, EVENT_TIMES)
    moment = F.date_trunc("MILLISECOND", "timestamp")

    def write(rows: DataFrame, batch: Batch) -> None:
        spark = rows.sparkSession
        state = tables.state_before(spark, EVENT_TIMES, batch)
        seen = state.first() if state is not None else None
        ends = F.window("timestamp", width)["end"]
        newest = rows.agg(F.max(utc_naive(moment, rows.schema["timestamp"].dataType))).first()[0]
        if seen and seen["before"]:
            closed = as_instant(seen["before"], TimestampNTZType()) - F.expr(f"INTERVAL {delay}")
            late = rows.select(
                "*", ends.alias("window_end"), closed.alias("watermark"), F.lit("its window was closed").alias("reason")
            )
            late = cast_to(late, LATE)
            tables.append(late.where(F.col("window_end") <= F.col("watermark")), LATE, batch)
        before = seen["newest"] if seen else None
        times = [t for t in (before, newest) if t is not None]
        after = spark.createDataFrame([(max(times, default=None), before)], EVENT_TIMES.ddl)
        tables.put_state(after, EVENT_TIMES, batch)

    return start_sink(ticks, "late", checkpoint, write, trigger=trigger, keep=False)


def start_indicators(
    ticks: DataFrame,
    tables: ParquetTables,
    checkpoint: str,
    width: str = "1 hour",
    delay: str = WATERMARK_DELAY,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Store the relative strength and the trend of each window as it closes.

    Windows of a symbol close in order of time. A batch is put behind the last closes before it, which are kept
    as a state of some rows per symbol, so a bar looks back over the same bars as in a whole table.
    """
    tables.create(ticks.sparkSession, INDICATORS, LAST_CLOSES)
    bar = ["symbol", "window_start"]

    def write(rows: DataFrame, batch: Batch) -> None:
        new = cast_to(rows, LAST_CLOSES)
        state = tables.state_before(rows.sparkSession, LAST_CLOSES, batch)
        known = new if state is None else state.unionByName(new)
        both = rsi(known).join(trend(known).select(*bar, "trend"), bar).join(new.select(*bar), bar, "left_semi")
        tables.append(both.select(*INDICATORS.columns), INDICATORS, batch)
        tables.put_state(last_closes(known), LAST_CLOSES, batch)

    return start_sink(closes(ticks, width, delay), "indicators", checkpoint, write, trigger=trigger)


#: Queries that a job may have besides its own, all of them over the same ticks.
MORE = {"rollups": start_rollups, "late": start_late, "indicators": start_indicators}


def pipeline(
    messages: DataFrame,
    tables: Tables,
    checkpoint_root: str,
    trigger: dict | None = None,
    more: Iterable[str] = (),
    windows_in: str = "windows",
    **windows,
) -> dict[str, Callable[[], StreamingQuery]]:
    """What starts the raw, the windowed and the latest-price query over one message stream, by name.

    Each has a checkpoint of its own and goes on from there whenever it is started. ``windows`` sets widths,
    delay and limits of :func:`start_windows`; ``more`` names queries of ``MORE``. ``windows_in`` names the
    checkpoint of the windowed query.
    """
    ticks = sound_ticks(messages)
    starts = {
        "raw": lambda: start_raw(messages, tables, f"{checkpoint_root}/raw", trigger),
        "windows": lambda: start_windows(ticks, tables, f"{checkpoint_root}/{windows_in}", trigger=trigger, **windows),
        "latest": lambda: start_latest(ticks, tables, f"{checkpoint_root}/latest", trigger),
    }
    for name in more:
        starts[name] = partial(MORE[name], ticks, tables, f"{checkpoint_root}/{name}", trigger=trigger)
    return starts


def start_pipeline(messages: DataFrame, tables: Tables, checkpoint_root: str, *args, **kwargs) -> list[StreamingQuery]:
    """Start all queries of :func:`pipeline`. What happens when one ends is for :func:`wait` to decide."""
    return [start() for start in pipeline(messages, tables, checkpoint_root, *args, **kwargs).values()]


class Progress(StreamingQueryListener):
    """Counts of each query by name: batches, rows that came in, rows dropped as late, failures.

    Late rows are counted as Spark drops them, per symbol, window and batch. A batch that drops some is logged.
    """

    def __init__(self) -> None:
        self.counts: dict[str, Counter] = defaultdict(Counter)
        self.names: dict[str, str] = {}

    def onQueryStarted(self, event) -> None:
        self.names[str(event.runId)] = event.name or str(event.id)

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        late = sum(state.numRowsDroppedByWatermark for state in progress.stateOperators)
        of_query = self.counts[progress.name or str(progress.id)]
        of_query.update(batches=1, rows=progress.numInputRows, late=late)
        if late:
            log.warning("%s dropped %d late rows in batch %d", progress.name, late, progress.batchId)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.exception:
            self.counts[self.names.get(str(event.runId), str(event.id))].update(failures=1)


def supervise(
    spark: SparkSession,
    starts: dict[str, Callable[[], StreamingQuery]],
    stop: Event | None = None,
    patience: float = 60.0,
    restarts: int = 3,
    within: float = 3600.0,
    pause: float = 1.0,
) -> None:
    """Start queries and keep them running until all have ended or ``stop`` is set.

    A query that fails is started again from its checkpoint, after a pause that doubles, up to ``restarts`` times
    within ``within`` seconds. One failure more ends the job: the others stop and the failure is
    raised. After ``stop`` each query may finish its running batch, for ``patience`` seconds.
    """
    running = {name: start() for name, start in starts.items()}
    failed: dict[str, list[float]] = defaultdict(list)
    try:
        while running and not (stop is not None and stop.is_set()):
            for name, query in list(running.items()):
                if query.isActive:
                    continue
                problem = query.exception()
                if problem is None:
                    del running[name]
                    continue
                now = time.monotonic()
                failed[name] = [at for at in failed[name] if now - at < within] + [now]
                if len(failed[name]) > restarts:
                    raise problem
                log.warning("%s failed and starts again: %s", name, problem)
                time.sleep(pause * 2 ** (len(failed[name]) - 1))
                running[name] = starts[name]()
            time.sleep(0.1)
        if running:
            drain(spark, patience)
    finally:
        for query in running.values():
            query.stop()


def wait(spark: SparkSession, stop: Event | None = None, patience: float = 60.0) -> None:
    """Block until any query ends or ``stop`` is set, then stop the others.

    One query's failure ends the job and is raised here; checkpoints keep every query's place. After
    ``stop`` each query may finish its running batch, for ``patience`` seconds.
    """
    try:
        while not spark.streams.awaitAnyTermination(1):
            if stop is not None and stop.is_set():
                drain(spark, patience)
                break
    finally:
        for query in spark.streams.active:
            query.stop()


def drain(spark: SparkSession, patience: float) -> None:
    """Wait until each query is between two batches, and stop it there."""
    until = time.monotonic() + patience
    for query in spark.streams.active:
        while query.isActive and query.status["isTriggerActive"] and time.monotonic() < until:
            time.sleep(0.05)
        query.stop()
