"""SimHash near-duplicates by anchor points of a covering code.

Anchors are the words of a covering code: nine blocks of the perfect (7, 4) Hamming code and one
free bit, so that every fingerprint has one nearest anchor, at most nine bits away (the covering
radius). A fingerprint is sent to the anchors within covering radius plus threshold that can see a
partner of it: two fingerprints at most ``2 * reach`` bits apart have a point within ``reach`` bits
of both, and the nearest anchor of that point gets both of them. So each is replicated to the nearest
anchors of the points around it, some 26 for a threshold of 2 bits, and no pair is missed.
At an anchor, fingerprints are compared by these points: two that share one are linked. A point has
at most 65 fingerprints around it, however many an anchor has, and no group is paired out.

Only distinct fingerprints are compared. Copies, a third of all rows or more, are reduced to one
row in the tasks before any shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.components import components
from tickloom.llm.tables import plain_names, stored, text_key, texts

SHINGLE, SEED, DISTANCE = 3, 42, 2
#: Bytes of text that are split into words at a time.
PORTION = 1 << 20


def word_lists(data: bytes) -> Iterator[list[bytes]]:
    """Words between ASCII white space, portion by portion, so that a huge text stays bounded."""
    at = 0
    while len(data) - at > PORTION:
        cut = at + PORTION
        while cut < len(data) and data[cut] not in b" \t\n\v\f\r":
            cut += 1
        yield data[at:cut].split()
        at = cut
    yield (data[at:] if at else data).split()


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Bit i is 1 if it is 1 in over half of the shingles' hashes; no words give 0."""
    ones, count, before = np.zeros(64, np.int64), 0, []
    for words in word_lists((text or "").encode().lower()):
        words = before + words
        hashes = _hashes(words, shingle)
        before = words[max(0, len(words) - shingle + 1) :]
        if len(hashes):
            bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones += bits.sum(axis=0, dtype=np.int64)
            count += len(hashes)
    if not count:
        if not before:
            return 0
        return xxhash.xxh64_intdigest(b" ".join(before), SEED)
    return int(np.packbits(2 * ones > count, bitorder="little").view("<u8")[0])


def _hashes(words: list[bytes], shingle: int) -> np.ndarray:
    count = len(words) - shingle + 1
    if count < 1:
        return np.zeros(0, "<u8")
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = [0, *(ends[: count - 1] + 1).tolist()]
    stops = ends[shingle - 1 :].tolist()
    return np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, stops)), "<u8", count)


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, *kept: str) -> DataFrame:
    """``doc_id, fp``: the fingerprint of every whole text as a signed long; null text is empty.

    Long columns named ``kept`` stay beside them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter(
                (fingerprint(t.as_py(), shingle) for t in batch.column(1)), np.uint64, batch.num_rows
            )
            columns = [batch.column(0), pa.array(fps.view(np.int64)), *batch.columns[2:]]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "fp", *kept])

    schema = "".join(f", {name} long" for name in kept)
    whole = texts(docs, *kept)
    return whole.mapInArrow(run, "doc_id long, fp long" + schema)


def _nearest_words() -> np.ndarray:
    """Nearest word of the (7, 4) Hamming code for each of the 128 values of a block."""
    values = np.arange(128)
    syndrome = np.zeros(128, np.int64)
    for place in range(7):
        syndrome ^= np.where(values >> place & 1, place + 1, 0)
    return (values ^ np.where(syndrome, 1 << np.maximum(syndrome - 1, 0), 0)).astype(np.uint64)


NEAREST = _nearest_words()


def nearest_anchor(points: np.ndarray) -> np.ndarray:
    """The code word that covers each 64-bit point: block by block, the free top bit as it is."""
    anchors = points & np.uint64(1 << 63)
    for block in range(9):
        shift = np.uint64(7 * block)
        anchors = anchors | (NEAREST[(points >> shift) & np.uint64(127)] << shift)
    return anchors


def around(fps: np.ndarray, reach: int) -> np.ndarray:
    """All points within ``reach`` bits of each fingerprint, itself first, as a matrix."""
    flips, last = [np.zeros(1, np.uint64)], [(0, -1)]
    for _ in range(reach):
        last = [(m | 1 << b, b) for m, top in last for b in range(top + 1, 64)]
        flips.append(np.array([m for m, _ in last], np.uint64))
    return fps[:, None] ^ np.concatenate(flips)[None, :]


def replicated(fps: DataFrame, reach: int) -> DataFrame:
    """``fp`` to ``anchor, fp, points``: one row per anchor, with the points it covers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            for some in np.array_split(fps, max(1, len(fps) * reach // 2000)):
                if len(some):
                    yield _replicas(some, reach)

    return fps.mapInArrow(run, "anchor long, fp long, points array<long>")


def _replicas(fps: np.ndarray, reach: int) -> pa.RecordBatch:
    points = around(fps, reach)
    anchors = nearest_anchor(points)
    owners = np.repeat(np.arange(len(fps)), points.shape[1])
    points, anchors = points.ravel(), anchors.ravel()
    order = np.lexsort((anchors, owners))
    points, anchors, owners = points[order], anchors[order], owners[order]
    new = np.r_[True, (anchors[1:] != anchors[:-1]) | (owners[1:] != owners[:-1])]
    offsets = np.r_[np.flatnonzero(new), len(points)].astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(points.view(np.int64)))
    return pa.RecordBatch.from_arrays(
        [pa.array(anchors[new].view(np.int64)), pa.array(fps[owners[new]].view(np.int64)), lists],
        ["anchor", "fp", "points"],
    )


def links(fps: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Links (a, b) that join all of the distinct ``fp`` at most ``distance`` bits apart.

    Fingerprints around one point are chained in order; points are made for an even distance.
    """
    if distance % 2:
        raise ValueError("the distance must be even")
    near = replicated(fps.select("fp"), distance // 2).repartition("anchor")
    points = near.select("anchor", "fp", F.explode("points").alias("point"))
    by_point = Window.partitionBy("anchor", "point").orderBy("fp")
    pairs = points.select(F.lag("fp").over(by_point).alias("a"), F.col("fp").alias("b"))
    return pairs.where("a is not null and a != b").distinct()


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """``doc_id, fp, component_id``: the smallest ``doc_id`` that links reach from each document.

    Repeated ids stay, each with its row; a null id never becomes the id of a component that has
    another one. Documents without words share the fingerprint 0 and link like any others.
    """
    marked = stored(fingerprints(docs, shingle), "fingerprints")
    firsts = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "firsts")
    reached = stored(components(links(firsts, distance)), "components")
    groups = (
        firsts.join(reached.withColumnRenamed("node", "fp"), "fp", "left")
        .select("fp", "first", F.coalesce("root", "fp").alias("root"))
    )
    least = groups.groupBy("root").agg(F.min("first").alias("component_id"))
    ids = groups.join(least, "root").select("fp", "component_id")
    return marked.join(ids, "fp").select("doc_id", "fp", "component_id")


def hexadecimal(fp: str) -> F.Column:
    """16 lowercase hex digits of a signed long."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def simhash_query(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs).select(
        "doc_id", hexadecimal("fp").alias("fingerprint"), "component_id"
    )


@plain_names
def keep_one(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One document of each group with all its columns: the smallest ``doc_id``, then digest, of the group.

    Documents are told apart by id and text, so other texts of a repeated id stay, if they are of
    another group, and so do texts without an id, which come after all others. Equal rows are one document.
    """
    whole = ["doc_id", "doc_key"]
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", text_key(F.col("text")).alias("doc_key"))
    marked = stored(fingerprints(ids, shingle, "doc_key"), "fingerprints")
    firsts = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "firsts")
    reached = stored(components(links(firsts, distance)), "components")
    groups = firsts.join(reached.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root")
    )
    members = marked.join(groups, "fp")
    ids = members.groupBy("root").agg(F.min("doc_id").alias("first"))
    members = members.join(ids, "root").where("doc_id <=> first")
    chosen = members.groupBy("root").agg(F.first("doc_id").alias("_doc"), F.min("doc_key").alias("_digest"))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_doc")) & (text_key(F.col("text")) == F.col("_digest"))
    kept = docs.join(chosen.select("_doc", "_digest"), same, "left_semi").withColumn("_digest", text_key(F.col("text")))
    return kept.dropDuplicates(["doc_id", "_digest"]).select(docs.columns)
