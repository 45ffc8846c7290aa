"""Rewriting closed days: few files, readers that see all rows at any time, repeats that change nothing."""

import os
from datetime import date, datetime, timedelta

import pytest
from conftest import moment, rows
from pyspark.sql import functions as F

from tickloom.operators import merged, rollup
from tickloom.operators.contracts import cast_to
from tickloom.schema import ALERTS, PRICE_STATS, QUARANTINE, ROLLUP, TICKS
from tickloom.sources import read_ticks
from tickloom.sources.rewrites import rewrites
from tickloom.streaming import Batch, ParquetTables, clean, compact

LATER = datetime.now() + timedelta(days=1)
TODAY = date(2024, 1, 3)


@pytest.fixture
def tables(tmp_path):
    return ParquetTables(str(tmp_path / "tables"), tasks=1)


@pytest.fixture
def batch_of(make_ticks):
    """The ticks of a batch: some of each of three days."""

    def build(n):
        data = [(symbol, 1 + n, n, f"2024-01-0{day}T{n // 60:02}:{n % 60:02}:00") for day in (1, 2, 3) for symbol in "BA"]
        return cast_to(make_ticks(data), TICKS)

    return build


def files(spark, tables, contract, day):
    folder = tables.scan(spark, contract).where(F.col("day") == F.lit(day))
    return folder.select(F.input_file_name()).distinct().count()


def counted_files(spark, tables, contract, day):
    rows_ = read_ticks(spark, tables.path(contract)).where(F.col("day") == F.lit(day))
    return rows_.select(F.input_file_name()).distinct().count()


def fill(tables, batch_of, numbers, query="raw"):
    for n in numbers:
        tables.append(batch_of(n), TICKS, Batch(query, n, "x"))


def test_two_hundred_batches_become_few_files(spark, tables, batch_of):
    """As after weeks of a stream: the folders of 200 batches, written at once to save time."""
    whole = batch_of(0).select("symbol", "price", "volume", "timestamp")
    every = whole.crossJoin(spark.range(200).select(F.col("id").alias("batch_id")))
    every = every.withColumns({"source": F.lit("raw-x"), "day": F.to_date("timestamp")})
    tables.overwrite(every.repartition(1), TICKS)
    before = rows(tables.read(spark, TICKS))
    assert len(before) == 1200 and counted_files(spark, tables, TICKS, date(2024, 1, 1)) == 200
    assert compact(spark, tables, TICKS, TODAY) == 2
    assert rows(tables.read(spark, TICKS)) == before
    assert counted_files(spark, tables, TICKS, date(2024, 1, 1)) <= 2
    assert counted_files(spark, tables, TICKS, TODAY) == 200
    assert compact(spark, tables, TICKS, TODAY) == 0
    assert clean(spark, tables, TICKS, LATER) == 400
    assert rows(tables.read(spark, TICKS)) == before
    assert files(spark, tables, TICKS, date(2024, 1, 1)) <= 2


def test_readers_see_equal_rows_at_any_time(spark, tables, batch_of, monkeypatch):
    """Before, after the rows are written but not published, after that, and by a scan that began earlier."""
    fill(tables, batch_of, range(4))
    before = rows(tables.read(spark, TICKS))
    began = read_ticks(spark, tables.path(TICKS)).drop("source", "batch_id")
    seen = []
    write = ParquetTables.overwrite

    def looked(self, marked, contract):
        write(self, marked, contract)
        seen.append((rows(tables.read(spark, contract)), read_ticks(spark, tables.path(TICKS)).count()))

    monkeypatch.setattr(ParquetTables, "overwrite", looked)
    assert compact(spark, tables, TICKS, TODAY) == 2
    assert seen == [(before, len(before))]
    assert rows(tables.read(spark, TICKS)) == before
    assert read_ticks(spark, tables.path(TICKS)).count() == len(before)
    assert clean(spark, tables, TICKS, datetime.now() - timedelta(hours=1)) == 0
    assert rows(began.select(*TICKS.columns, "day")) == before


def test_repeated_batches_change_nothing(spark, tables, batch_of):
    """Also if one is repeated while its day is rewritten, and after its folder is gone."""
    fill(tables, batch_of, range(3))
    before = rows(tables.read(spark, TICKS))
    compact(spark, tables, TICKS, TODAY)
    for again in (2, 0):
        tables.append(batch_of(again), TICKS, Batch("raw", again, "x"))
        assert rows(tables.read(spark, TICKS)) == before
    clean(spark, tables, TICKS, LATER)
    tables.append(batch_of(2), TICKS, Batch("raw", 2, "x"))
    assert rows(tables.read(spark, TICKS)) == before
    assert not os.path.exists(f"{tables.path(TICKS)}/day=2024-01-01/source=raw-x/batch_id=2")


def test_late_batches_are_read_and_taken_in_next_time(spark, tables, batch_of):
    fill(tables, batch_of, range(3))
    compact(spark, tables, TICKS, TODAY)
    tables.append(batch_of(9), TICKS, Batch("raw", 3, "x", again=False))
    fill(tables, batch_of, [0], query="other")
    before = rows(tables.read(spark, TICKS))
    assert len(before) == 30
    assert compact(spark, tables, TICKS, TODAY) == 2
    assert rows(tables.read(spark, TICKS)) == before
    assert counted_files(spark, tables, TICKS, date(2024, 1, 2)) <= 2
    clean(spark, tables, TICKS, LATER)
    assert rows(tables.read(spark, TICKS)) == before
    assert {r["version"] for r in rewrites(spark, tables.path(TICKS))} == {1, 2}


def test_lost_rewrite_is_done_again(spark, tables, batch_of, monkeypatch):
    """The rows are written, the record is not: nobody reads them, and the next rewrite replaces them."""
    fill(tables, batch_of, range(3))
    before = rows(tables.read(spark, TICKS))
    write = ParquetTables.overwrite

    def lost(self, marked, contract):
        write(self, marked, contract)
        raise RuntimeError("lost")

    monkeypatch.setattr(ParquetTables, "overwrite", lost)
    with pytest.raises(RuntimeError, match="lost"):
        compact(spark, tables, TICKS, TODAY)
    monkeypatch.undo()
    assert rows(tables.read(spark, TICKS)) == before
    fill(tables, batch_of, [3])
    before = rows(tables.read(spark, TICKS))
    assert compact(spark, tables, TICKS, TODAY) == 2
    assert rows(tables.read(spark, TICKS)) == before


def test_batch_that_comes_while_a_day_is_rewritten(spark, tables, batch_of, monkeypatch):
    fill(tables, batch_of, range(2))
    write = ParquetTables.overwrite
    came = []

    def slow(self, marked, contract):
        if not came:
            came.append(1)
            fill(tables, batch_of, [2])
        write(self, marked, contract)

    monkeypatch.setattr(ParquetTables, "overwrite", slow)
    compact(spark, tables, TICKS, TODAY)
    assert tables.read(spark, TICKS).count() == 18


def test_rewritten_rows_are_sorted_and_skipped_by_symbol(spark, tables, batch_of):
    fill(tables, batch_of, range(3))
    compact(spark, tables, TICKS, TODAY)
    path = f"{tables.path(TICKS)}/day=2024-01-01/source=rewritten"
    found = [(r.symbol, r.timestamp) for r in spark.read.parquet(path).collect()]
    assert found == sorted(found) and len(found) == 6
    plan = read_ticks(spark, tables.path(TICKS)).where("symbol = 'A' AND day = DATE'2024-01-01'")
    scan = next(x for x in plan._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in x)
    assert "EqualTo(symbol,A)" in scan and "batch_id" in scan.split("PartitionFilters")[1]


def test_rollups_are_put_together(spark, tables, batch_of):
    for n in range(4):
        tables.append(rollup(batch_of(n), "1 hour"), ROLLUP, Batch("rollups", n, "x"))
    before = rows(merged(tables.read(spark, ROLLUP)))
    assert compact(spark, tables, ROLLUP, TODAY, merged) == 2
    kept = tables.read(spark, ROLLUP)
    assert rows(merged(kept)) == before
    assert kept.where("window_start < '2024-01-03'").count() == 4 and kept.count() == 12


def test_other_tables_and_empty_ones(spark, tables, make_ticks):
    tables.create(spark, PRICE_STATS, ALERTS, TICKS, QUARANTINE)
    assert compact(spark, tables, TICKS, TODAY) == 0 and clean(spark, tables, TICKS, LATER) == 0
    at = moment("00:00:00")
    alert = [("A", at, at + timedelta(minutes=5), "x", 1)]
    for n in range(3):
        frame = spark.createDataFrame(alert, "symbol string, window_start timestamp_ntz, window_end timestamp_ntz, alert_type string, value int")
        tables.append(frame.selectExpr("* except (value)", "CAST(value AS DECIMAL(10,2)) AS value"), ALERTS, Batch("windows", n))
    assert compact(spark, tables, ALERTS, TODAY) == 1
    assert tables.read(spark, ALERTS).count() == 3
    with pytest.raises(ValueError, match="no time"):
        compact(spark, tables, QUARANTINE, TODAY)


def test_rare_symbol_reads_few_rows(spark, tables):
    """Of a rewritten day of many symbols, the scan gives the pages of one; of unsorted files, nearly all."""
    ticks = spark.range(400_000).selectExpr(
        "IF(id % 1000 = 7, 'RARE', concat('S', hash(id) % 150)) AS symbol", "CAST(1 AS DECIMAL(10,2)) AS price",
        "CAST(id AS INT) AS volume", "TIMESTAMP_NTZ'2024-01-01' + make_interval(0, 0, 0, 0, 0, 0, id * 0.2) AS timestamp",
    )
    plain = f"{tables.root}/plain"
    ticks.orderBy("timestamp").coalesce(1).write.parquet(plain)
    for n in range(2):
        tables.append(ticks.where(F.col("volume") % 2 == n), TICKS, Batch("raw", n))
    compact(spark, tables, TICKS, TODAY)

    def read(frame):
        found = frame.where("symbol = 'RARE'").select("volume")
        assert len(found.collect()) == 400
        leaves = found._jdf.queryExecution().executedPlan().collectLeaves()
        return leaves.apply(0).metrics().get("numOutputRows").get().value()

    assert read(spark.read.parquet(plain)) == 400_000
    assert read(read_ticks(spark, tables.path(TICKS))) <= 60_000
