"""Run the streaming job: ``spark-submit ... -m tickloom`` or ``python -m tickloom``."""

from __future__ import annotations

import argparse
import logging
import signal
from threading import Event

from tickloom.schema import TOPIC, VOLATILITY_LIMIT, VOLUME_LIMIT, WATERMARK_DELAY, WINDOW_WIDTH
from tickloom.session import build_session, exists, streaming_session
from tickloom.sources import kafka_options, read_topic_stream
from tickloom.streaming import JdbcTables, ParquetTables, Progress, hand_over, pipeline, supervise
from tickloom.streaming.job import MORE


def parser() -> argparse.ArgumentParser:
    options = argparse.ArgumentParser(prog="tickloom", description=__doc__)
    options.add_argument("--servers", required=True, help="bootstrap servers of the topic")
    options.add_argument("--topic", default=TOPIC)
    options.add_argument("--starting", default="latest", help="offsets of the very first start")
    options.add_argument(
        "--source-option", action="append", default=[], metavar="KEY=VALUE",
        help="more options of the topic, such as maxOffsetsPerTrigger=1000000",
    )
    options.add_argument("--checkpoint", required=True, help="folder that all executors share")
    target = options.add_mutually_exclusive_group(required=True)
    target.add_argument("--tables", help="folder for parquet tables")
    target.add_argument("--jdbc-url", help="relational database instead")
    options.add_argument("--jdbc-option", action="append", default=[], metavar="KEY=VALUE")
    options.add_argument(
        "--jdbc-ledger", action="store_true", help="the database has the ledger and its columns: ticks exactly once"
    )
    options.add_argument("--width", default=WINDOW_WIDTH)
    options.add_argument("--delay", default=WATERMARK_DELAY)
    options.add_argument("--volatility-limit", type=float, default=VOLATILITY_LIMIT)
    options.add_argument("--volume-limit", type=float, default=VOLUME_LIMIT)
    options.add_argument("--state-partitions", type=int, help="fixed by the first start")
    options.add_argument(
        "--windows-in", default="windows", metavar="NAME", help="checkpoint of the windowed query, below --checkpoint"
    )
    options.add_argument(
        "--hand-over", metavar="NAME", help="checkpoint whose open windows --windows-in begins with, if it is new"
    )
    options.add_argument("--write-tasks", type=int, help="tasks, and so files, per table and batch")
    options.add_argument("--every", help="trigger interval such as '30 seconds'")
    options.add_argument(
        "--more", action="append", default=[], choices=sorted(MORE), help="further queries; with --tables only"
    )
    options.add_argument(
        "--restarts", type=int, default=0, help="how often a failed query may start again within an hour"
    )
    return options


def pairs(options: list[str]) -> dict[str, str]:
    return dict(option.split("=", 1) for option in options)


def stop_on_signals() -> Event:
    """An event that SIGTERM and SIGINT set."""
    stop = Event()
    for number in (signal.SIGTERM, signal.SIGINT):
        signal.signal(number, lambda *_: stop.set())
    return stop


def main(arguments: list[str] | None = None) -> None:
    logging.basicConfig(level=logging.INFO)
    options = parser()
    chosen = options.parse_args(arguments)
    if chosen.more and not chosen.tables:
        options.error("--more needs --tables")
    spark = streaming_session(build_session(), chosen.state_partitions)
    source, starting = pairs(chosen.source_option), chosen.starting
    new = f"{chosen.checkpoint}/{chosen.windows_in}"
    if chosen.hand_over and not exists(spark, new):
        # the other queries have checkpoints, so this is for the windowed one only
        starting = hand_over(spark, f"{chosen.checkpoint}/{chosen.hand_over}", new) or starting
    messages = read_topic_stream(spark, kafka_options(chosen.servers, chosen.topic, starting, **source))
    if chosen.tables:
        tables = ParquetTables(chosen.tables, chosen.write_tasks)
    else:
        options = {"url": chosen.jdbc_url, **pairs(chosen.jdbc_option)}
        tables = JdbcTables(options, chosen.write_tasks, chosen.jdbc_ledger)
    spark.streams.addListener(Progress())
    starts = pipeline(
        messages,
        tables,
        chosen.checkpoint,
        more=chosen.more,
        windows_in=chosen.windows_in,
        trigger={"processingTime": chosen.every} if chosen.every else None,
        width=chosen.width,
        delay=chosen.delay,
        volatility_limit=chosen.volatility_limit,
        volume_limit=chosen.volume_limit,
    )
    supervise(spark, starts, stop_on_signals(), restarts=chosen.restarts)


if __name__ == "__main__":
    main()
