"""Substring deduplication by content-defined chunks.

A gear hash rolls over the bytes of a text: every byte shifts it by one and adds a random number of the
byte, so the hash depends on the last 32 bytes only. A chunk may end where its top bits are zero, at least
``LEAST`` and at most ``MOST`` bytes after its start. Cuts depend on nearby content, so an insertion
changes the chunks around it and the following ones fall into step again. Chunks are
compared by a 128-bit digest; the first occurrence, by document and position, is the keeper.

The rolling hash needs no loop over bytes: with G(m) the hash over m bytes, G(2m) at a place is G(m) there
plus G(m) of m bytes earlier, shifted by m. Digests are counted in the tasks before the
shuffle, and only repeated ones are joined back, so a passage found everywhere is a skewed join.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.tables import stored, text_key, texts

#: Bytes of a chunk at least, about, and at most; bytes that the hash looks back.
LEAST, ABOUT, MOST, WINDOW = 24, 64, 256, 32
#: An unbroken stretch of repeated chunks is reported from this many bytes on, a whole text always.
SPAN = 64
#: Bytes hashed at a time.
PORTION = 1 << 20


def gears(seed: int = 9) -> np.ndarray:
    """One random 32-bit number per byte value."""
    return np.random.default_rng(seed).integers(0, 1 << 32, 256, np.uint32)


def candidates(data: np.ndarray, numbers: np.ndarray, about: int = ABOUT, least: int = LEAST) -> np.ndarray:
    """Ends (exclusive) at which the content allows a cut."""
    mask = np.uint32(((1 << max(1, (about - least).bit_length() - 1)) - 1) << 24)
    found = []
    for at in range(0, len(data), PORTION):
        start = max(0, at - WINDOW)
        rolled = numbers[data[start : at + PORTION]]
        step = 1
        while step < WINDOW:
            rolled[step:] = rolled[step:] + (rolled[:-step] << np.uint32(step))
            step *= 2
        found.append(np.flatnonzero((rolled[at - start :] & mask) == 0) + at + 1)
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def cuts(data: bytes, numbers: np.ndarray, least: int = LEAST, about: int = ABOUT, most: int = MOST) -> list[int]:
    """Ends of the chunks of a text; the last one may be shorter than ``least``."""
    ends, start, size = [], 0, len(data)
    for end in candidates(np.frombuffer(data, np.uint8), numbers, about, least).tolist():
        while end - start > most:
            start += most
            ends.append(start)
        if end - start >= least:
            ends.append(end)
            start = end
    while size - start > most:
        start += most
        ends.append(start)
    if size > start:
        ends.append(size)
    return ends


def chunked(docs: DataFrame) -> DataFrame:
    """``doc_id, doc_key, start, length, last, high, low``: byte ranges and digests of the chunks of every whole text.

    Null and empty texts have none. Ranges are bytes of UTF-8; ``last`` marks the end of the text, and
    ``doc_key`` tells texts of one id, or of none, apart.
    """
    numbers = gears()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[list] = [[] for _ in range(6)]
            for doc, text, key in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                data = (text.as_py() or "").encode()
                ends = cuts(data, numbers)
                starts = [0, *ends[:-1]]
                rows[0] += [doc] * len(ends)
                rows[1] += starts[: len(ends)]
                rows[2] += ends
                rows[3] += [end == len(data) for end in ends]
                rows[5] += [key] * len(ends)
                rows[4] += [xxhash.xxh3_128_digest(data[a:b]) for a, b in zip(starts, ends)]
                if len(rows[0]) >= 50_000:
                    yield _chunk_batch(rows)
                    rows = [[] for _ in range(6)]
            yield _chunk_batch(rows)

    keyed = texts(docs).withColumn("doc_key", text_key(F.col("text")))
    return keyed.mapInArrow(
        run, "doc_id long, doc_key long, start long, length int, last boolean, high long, low long"
    )


def _chunk_batch(rows: list[list]) -> pa.RecordBatch:
    digests = np.frombuffer(b"".join(rows[4]), np.int64).reshape(-1, 2)
    starts = np.array(rows[1], np.int64)
    lengths = (np.array(rows[2], np.int64) - starts).astype(np.int32)
    columns = [pa.array(rows[0], pa.int64()), pa.array(rows[5], pa.int64()), pa.array(starts), pa.array(lengths)]
    columns += [pa.array(rows[3], pa.bool_())]
    columns += [pa.array(np.ascontiguousarray(digests[:, i])) for i in (0, 1)]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "doc_key", "start", "length", "last", "high", "low"])


def repeated_chunks(docs: DataFrame) -> DataFrame:
    """Every occurrence of a chunk found twice or more, with ``copies, keeper_doc_id, keeper_start, keeper_key``.

    The keeper is the occurrence of the smallest document id, then position, then text digest. Occurrences without
    an id come after all others. Repeated rows of a document are further copies of its places.
    """
    chunks = stored(chunked(docs), "chunks")
    digest = ["high", "low"]
    found = chunks.groupBy(*digest).agg(F.count("*").alias("copies"), F.min("doc_id").alias("keeper_doc_id"))
    again = stored(chunks.join(found.where("copies > 1"), digest), "repeated")
    places = again.where("doc_id <=> keeper_doc_id").groupBy(*digest, "start").agg(F.min("doc_key").alias("key"))
    firsts = places.groupBy(*digest).agg(F.min(F.struct("start", "key")).alias("_first"))
    firsts = firsts.select(
        *digest, F.col("_first.start").alias("keeper_start"), F.col("_first.key").alias("keeper_key")
    )
    return again.join(firsts, digest)


def repeated_spans(docs: DataFrame, least: int = SPAN) -> DataFrame:
    """``doc_id, start, stop, chunks, copies, keeper_doc_id, kept``: stretches found elsewhere as well.

    Repeated chunks that follow each other make a stretch. One shorter than ``least`` bytes is left
    out, as single chunks can agree by chance, unless it is a whole text. Every other stretch is reported
    whole, in a span for each run with the same keeping document, however short. ``kept`` is true where the
    span is the keeper itself; ``copies`` counts the occurrences of its rarest chunk. Documents that
    repeat nothing have no row.
    """
    own = (
        F.col("doc_id").eqNullSafe(F.col("keeper_doc_id"))
        & (F.col("doc_key") == F.col("keeper_key"))
        & (F.col("start") == F.col("keeper_start"))
    )
    chunks = repeated_chunks(docs).withColumn("kept", own).dropDuplicates(["doc_id", "doc_key", "start", "length"])
    order = Window.partitionBy("doc_id", "doc_key").orderBy("start")
    follows = F.lag("stop").over(order) == F.col("start")
    joins = (
        follows
        & F.lag("keeper_doc_id").over(order).eqNullSafe(F.col("keeper_doc_id"))
        & (F.lag("keeper_key").over(order) == F.col("keeper_key"))
        & (F.lag("kept").over(order) == F.col("kept"))
    )
    runs = (
        chunks.withColumn("stop", F.col("start") + F.col("length"))
        .withColumn("_apart", F.when(follows, 0).otherwise(1))
        .withColumn("_new", F.when(joins, 0).otherwise(1))
        .withColumn("_stretch", F.sum("_apart").over(order))
        .withColumn("_run", F.sum("_new").over(order))
    )
    spans = runs.groupBy("doc_id", "doc_key", "_stretch", "_run").agg(
        F.min("start").alias("start"),
        F.max("stop").alias("stop"),
        F.count("*").alias("chunks"),
        F.min("copies").alias("copies"),
        F.first("keeper_doc_id").alias("keeper_doc_id"),
        F.first("kept").alias("kept"),
        F.max("last").alias("_last"),
    )
    stretch = Window.partitionBy("doc_id", "doc_key", "_stretch")
    first, stop = F.min("start").over(stretch), F.max("stop").over(stretch)
    whole = (first == 0) & F.max("_last").over(stretch)
    spans = spans.withColumn("_reported", (stop - first >= least) | whole)
    return spans.where("_reported").drop("doc_key", "_stretch", "_run", "_last", "_reported")


def chunks_query(docs: DataFrame) -> DataFrame:
    return repeated_spans(docs).select("doc_id", "start", "stop", "chunks", "copies", "keeper_doc_id", "kept")
