"""Sinks that can be replayed, and the streaming job."""

from tickloom.streaming.compaction import clean, compact
from tickloom.streaming.handover import hand_over
from tickloom.streaming.job import (
    Progress,
    pipeline,
    start_indicators,
    start_late,
    start_latest,
    start_pipeline,
    start_rollups,
    supervise,
    wait,
)
from tickloom.streaming.sinks import (
    Batch,
    JdbcTables,
    ParquetTables,
    start_sink,
    store,
    unseen,
    write_jdbc,
)

__all__ = [
    "Batch",
    "JdbcTables",
    "ParquetTables",
    "Progress",
    "clean",
    "compact",
    "hand_over",
    "pipeline",
    "start_indicators",
    "start_late",
    "start_latest",
    "start_pipeline",
    "start_rollups",
    "start_sink",
    "store",
    "supervise",
    "unseen",
    "wait",
    "write_jdbc",
]
