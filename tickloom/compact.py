"""Rewrite closed days of a job's tables: ``spark-submit ... -m tickloom.compact`` or ``python -m tickloom.compact``."""

from __future__ import annotations

import argparse
import logging
from datetime import UTC, date, datetime, timedelta

from tickloom.operators import merged
from tickloom.schema import ALERTS, BARS, INDICATORS, LATE, PRICE_STATS, ROLLUP, TICKS
from tickloom.session import build_session, exists, use_utc
from tickloom.streaming import ParquetTables, clean, compact

log = logging.getLogger(__name__)

#: Tables with closed days, and what puts their rows together.
KINDS = [*((contract, None) for contract in (TICKS, BARS, PRICE_STATS, ALERTS, LATE, INDICATORS)), (ROLLUP, merged)]


def parser() -> argparse.ArgumentParser:
    options = argparse.ArgumentParser(prog="tickloom.compact", description=__doc__)
    options.add_argument("--tables", required=True, help="folder of the job's tables")
    options.add_argument("--before", type=date.fromisoformat, help="days before this one; default: today, UTC")
    options.add_argument("--keep-hours", type=float, default=24.0, help="how long folders stay that no longer count")
    return options


def main(arguments: list[str] | None = None) -> dict[str, tuple[int, int]]:
    """Days rewritten and folders deleted, by table."""
    logging.basicConfig(level=logging.INFO)
    chosen = parser().parse_args(arguments)
    spark = use_utc(build_session())
    tables = ParquetTables(chosen.tables)
    before = chosen.before or datetime.now(UTC).date()
    limit = datetime.now(UTC) - timedelta(hours=chosen.keep_hours)
    done = {}
    for contract, combine in KINDS:
        if exists(spark, tables.path(contract)):
            days = compact(spark, tables, contract, before, combine)
            done[contract.table] = days, clean(spark, tables, contract, limit)
            log.info("%s: %d days rewritten, %d folders deleted", contract.table, *done[contract.table])
    return done


if __name__ == "__main__":
    main()
