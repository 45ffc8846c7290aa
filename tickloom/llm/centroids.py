"""Centroid clustering of integer vectors by popcounts over bit planes.

A vector of 64 components x becomes integers ``floor(SCALE * x)``, and these become bit planes: plane p
is a 64-bit word whose bit i is bit p of component i in two's complement. Plane p weighs 2^p, the
last one -2^p. A dot product is then exact integer work on words: the sum, over pairs of planes of a
vector and a centroid, of both weights times the set bits of the words' AND; a squared distance is
``|x|^2 - 2 x.c + |c|^2``.

Vectors are packed once, into a table of a few words each. A round reads that table, finds every vector's
nearest centroid in its task, and adds up bits per centroid and plane there, so what leaves a task is a row
per centroid, however many vectors one centroid has. Spark adds these rows up; the driver sees one
row per centroid and divides. Nothing is collected but centroids: ``clusters`` times 64 numbers.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.tables import stored

PARTS, SCALE = 64, 256
CLUSTERS, ROUNDS, SEED = 40, 5, 2
#: Most planes: squared distances of vectors within them fit a long.
MOST_PLANES = 27
#: Vectors compared with all centroids at once; bounds memory, changes nothing.
TOGETHER = 2048

PLANES = "vec_id long, planes binary, norm long"
ASSIGNED = "vec_id long, cluster int, distance long"
SUMS = "cluster int, members long, parts array<long>"


def usable(vector: Column) -> Column:
    """Whether a vector has exactly 64 components, all of them finite numbers."""
    whole = (F.size(vector) == PARTS) & (F.size(F.array_compact(vector)) == PARTS)
    # NaN is larger than any number here
    finite = (F.array_max(vector) < float("inf")) & (F.array_min(vector) > float("-inf"))
    return F.coalesce(whole & finite, F.lit(False))


def usable_vectors(vectors: DataFrame) -> DataFrame:
    """``vec_id, vector`` (doubles) of usable rows. A null id is kept; repeated rows are rows of their own."""
    vector = F.col("embedding").cast("array<double>")
    kept = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("vector"))
    return kept.where(usable(F.col("vector")))


def planes_needed(vectors: DataFrame) -> int:
    """Planes for every component, sign included; raises if there are more than ``MOST_PLANES``."""
    least, most = vectors.agg(F.min(F.array_min("vector")), F.max(F.array_max("vector"))).first()
    if least is None:
        return 1
    low, high = math.floor(SCALE * least), math.floor(SCALE * most)
    needed = 1 + max(max(high, 0).bit_length(), (-low - 1 if low < 0 else 0).bit_length())
    if needed > MOST_PLANES:
        raise ValueError(f"components from {least} to {most}: distances would not fit a long")
    return needed


def pack(integers: np.ndarray, planes: int) -> np.ndarray:
    """Rows of 64 integers to rows of ``planes`` words."""
    bits = (integers[:, None, :] >> np.arange(planes)[:, None]) & 1
    packed = np.packbits(bits.astype(np.uint8), axis=-1, bitorder="little")
    return packed.view("<u8").reshape(len(integers), planes)


def weights(planes: int) -> np.ndarray:
    """What a set bit of each plane counts, in two's complement."""
    found = np.left_shift(np.int64(1), np.arange(planes, dtype=np.int64))
    found[-1] = -found[-1]
    return found


def dot_products(words: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact dot products of all rows of ``words`` with all rows of ``centroids``, both packed."""
    weight = weights(words.shape[1])
    total = np.zeros((len(words), len(centroids)), np.int64)
    for p, of_row in enumerate(weight):
        for q, of_centroid in enumerate(weight):
            common = np.bitwise_count(words[:, p, None] & centroids[None, :, q])
            total += common.astype(np.int64) * (of_row * of_centroid)
    return total


def nearest(words: np.ndarray, norms: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of each row's nearest centroid; the smaller number wins a tie."""
    packed = pack(centroids, words.shape[1])
    lengths = (centroids * centroids).sum(axis=1)
    cluster, distance = np.zeros(len(words), np.int32), np.zeros(len(words), np.int64)
    for start in range(0, len(words), TOGETHER):
        part = slice(start, start + TOGETHER)
        far = norms[part, None] - 2 * dot_products(words[part], packed) + lengths
        cluster[part] = far.argmin(axis=1)
        distance[part] = far.min(axis=1)
    return cluster, distance


def bit_sums(words: np.ndarray, cluster: np.ndarray, clusters: int) -> tuple[np.ndarray, np.ndarray]:
    """Members and component sums of each cluster, from set bits per cluster, plane and component."""
    planes = words.shape[1]
    members, sums = np.zeros(clusters, np.int64), np.zeros((clusters, PARTS), np.int64)
    for start in range(0, len(words), TOGETHER):
        part = np.ascontiguousarray(words[start : start + TOGETHER])
        own = cluster[start : start + TOGETHER]
        bits = np.unpackbits(part.view(np.uint8).reshape(len(part), -1), axis=1, bitorder="little")
        chosen = (own == np.arange(clusters)[:, None]).astype(np.float64)
        # at most TOGETHER per number, which doubles hold exactly
        counts = (chosen @ bits).astype(np.int64).reshape(clusters, planes, PARTS)
        sums += (counts * weights(planes)[:, None]).sum(axis=1)
        members += np.bincount(own, minlength=clusters)
    return members, sums


def _words(batch: pa.RecordBatch, planes: int) -> tuple[np.ndarray, np.ndarray]:
    rows = batch.column("planes").to_pylist()
    words = np.frombuffer(b"".join(rows), "<u8").reshape(len(rows), planes)
    return words, batch.column("norm").to_numpy(zero_copy_only=False)


def packed(vectors: DataFrame, planes: int) -> DataFrame:
    """``vec_id, planes, norm`` of usable vectors: their packed integers and squared length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column("vector").flatten().to_numpy(zero_copy_only=False)
            integers = np.floor(SCALE * flat).astype(np.int64).reshape(-1, PARTS)
            words = pack(integers, planes)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id"),
                    pa.array([row.tobytes() for row in words], pa.binary()),
                    pa.array((integers * integers).sum(axis=1), pa.int64()),
                ],
                ["vec_id", "planes", "norm"],
            )

    return vectors.mapInArrow(run, PLANES)


def first_centroids(vectors: DataFrame, clusters: int, seed: int) -> np.ndarray:
    """Integers of the ``clusters`` vectors whose ids have the smallest hashes, in order of these.

    Equal ids go by their components, null ids last. Each task gives at most ``clusters`` rows.
    """
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    integers = F.transform("vector", lambda x: F.floor(SCALE * x))
    chosen = vectors.select(hashed.alias("hash"), integers.alias("integers"))
    rows = chosen.orderBy(F.col("hash").asc_nulls_last(), "integers").limit(clusters).collect()
    return np.array([r["integers"] for r in rows], np.int64).reshape(-1, PARTS)


def sums_per_cluster(table: DataFrame, centroids: np.ndarray, planes: int) -> DataFrame:
    """``cluster, members, parts``: one row per task and non-empty cluster, for Spark to add up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = len(centroids)
        members, sums = np.zeros(count, np.int64), np.zeros((count, PARTS), np.int64)
        for batch in batches:
            words, norms = _words(batch, planes)
            more, parts = bit_sums(words, nearest(words, norms, centroids)[0], count)
            members += more
            sums += parts
        there = np.flatnonzero(members)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(there, pa.int32()),
                pa.array(members[there], pa.int64()),
                pa.array(sums[there].tolist(), pa.list_(pa.int64())),
            ],
            ["cluster", "members", "parts"],
        )

    return table.mapInArrow(run, SUMS)


def improved(table: DataFrame, centroids: np.ndarray, planes: int) -> np.ndarray:
    """The centroids after a round: exact floors of means; those without members stay."""
    partial = sums_per_cluster(table, centroids, planes)
    totals = partial.groupBy("cluster").agg(
        F.sum("members").alias("members"),
        *[F.sum(F.get("parts", F.lit(i))).alias(f"p{i}") for i in range(PARTS)],
    )
    new = centroids.copy()
    for cluster, members, *sums in totals.collect():  # a row per centroid
        new[cluster] = [part // members for part in sums]
    return new


def assigned(table: DataFrame, centroids: np.ndarray, planes: int) -> DataFrame:
    """``vec_id, cluster, distance`` of every packed vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, norms = _words(batch, planes)
            cluster, distance = nearest(words, norms, centroids)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(cluster), pa.array(distance)],
                ["vec_id", "cluster", "distance"],
            )

    return table.mapInArrow(run, ASSIGNED)


def clustered(
    vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED
) -> tuple[DataFrame, np.ndarray]:
    """``vec_id, cluster, distance`` of every usable vector, and the final centroids.

    Vectors of another size, or with a null, infinite or undefined component, are left out. Fewer vectors than
    ``clusters`` give as many centroids; none gives no rows. Equal vectors may start several
    centroids: the smallest number gets all of them, the others stay empty and as they are.
    """
    kept = usable_vectors(vectors)
    planes = planes_needed(kept)
    table = stored(packed(kept, planes), "planes")
    centroids = first_centroids(kept, clusters, seed)
    if not len(centroids):
        return table.selectExpr("vec_id", "0 AS cluster", "norm AS distance"), centroids
    for _ in range(rounds):
        centroids = improved(table, centroids, planes)
    return stored(assigned(table, centroids, planes), "assigned"), centroids


def clusters_query(vectors: DataFrame) -> DataFrame:
    """Contract of the query: clusters, distances, their sums and a digest of the final centroid."""
    rows, centroids = clustered(vectors)
    inertia = {r[0]: r[1] for r in rows.groupBy("cluster").agg(F.sum("distance")).collect()}  # a row per centroid
    figures = [
        (number, inertia.get(number, 0), hashlib.sha256(",".join(map(str, parts)).encode()).hexdigest())
        for number, parts in enumerate(centroids.tolist())
    ]
    of_cluster = rows.sparkSession.createDataFrame(
        figures, "cluster int, cluster_inertia long, centroid_sha256 string"
    )
    return rows.join(F.broadcast(of_cluster), "cluster").select(
        "vec_id",
        "cluster",
        "distance",
        "cluster_inertia",
        F.lit(sum(inertia.values())).cast("long").alias("inertia"),
        "centroid_sha256",
    )
