"""Exact top-k search in binary codes by incremental multi-index hashing.

A code is cut into segments, and an index maps (segment, value) to the distinct codes that have it. A search
looks up every segment's values within a radius that grows round by round: after radius r in
all m segments, every code at a distance below m * (r + 1) has been seen, since one of its segments must
differ by r bits or fewer. Candidates are verified by their whole distance, and a query ends
when its k-th verified distance lies below that bound, so the result equals that of a full scan.

Codes are compared once each, however many rows share one; of these rows only the k smallest ids can
ever be in a result, and they are picked in blocks of ids before they meet. Queries are a stated set
of rows; equal codes among them are searched once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.llm.tables import stored

BITS, SEGMENTS, TOP, EVERY = 64, 4, 10, 50
#: Ids per block when the smallest ids of a code are picked.
BLOCK = 10_000


def sign_code(vector: Column) -> Column:
    """A long whose bit i is 1 if element i is positive; null for a vector of any other size.

    A null element counts as not positive.
    """
    bits = F.aggregate(
        F.transform(
            vector,
            lambda x, i: F.when(
                F.coalesce(x > 0, F.lit(False)), F.call_function("shiftleft", F.lit(1).cast("long"), i)
            ).otherwise(F.lit(0).cast("long")),
        ),
        F.lit(0).cast("long"),
        lambda code, bit: code.bitwiseOR(bit),
    )
    return F.when(F.size(vector) == BITS, bits)


def codes(vectors: DataFrame) -> DataFrame:
    """``vec_id, code``; rows without an id or a vector of ``BITS`` elements cannot be found and go."""
    coded = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), sign_code(F.col("embedding")).alias("code"))
    return coded.where("vec_id is not null and code is not null")


def _segments(frame: DataFrame, segments: int) -> DataFrame:
    """``code`` to one row per segment: ``segment, value``."""
    width = BITS // segments
    mask = F.lit((1 << width) - 1).cast("long")
    values = [
        F.struct(F.lit(s).alias("segment"), F.shiftrightunsigned("code", s * width).bitwiseAND(mask).alias("value"))
        for s in range(segments)
    ]
    return frame.select("*", F.inline(F.array(*values)))


def _flips(spark: SparkSession, segments: int, width: int, radius: int) -> DataFrame:
    """``segment, mask``: all masks of ``radius`` bits, a fixed number of rows (51,480 at most for 16 bits)."""
    masks = spark.range(1 << width).where(F.bit_count("id") == radius).select(F.col("id").alias("mask"))
    return masks.select(F.explode(F.array(*[F.lit(s) for s in range(segments)])).alias("segment"), "mask")


def smallest_ids(coded: DataFrame, top: int = TOP) -> DataFrame:
    """The ``top`` smallest ids of every code, first within blocks of ids, then over all."""
    inner = Window.partitionBy("code", F.expr(f"vec_id div {BLOCK}")).orderBy("vec_id")
    outer = Window.partitionBy("code").orderBy("vec_id")
    few = coded.withColumn("_n", F.row_number().over(inner)).where(F.col("_n") <= top)
    return few.withColumn("_n", F.row_number().over(outer)).where(F.col("_n") <= top).drop("_n")


def nearest(coded: DataFrame, queries: DataFrame, top: int = TOP, segments: int = SEGMENTS) -> DataFrame:
    """``code`` of queries and rows to ``code, other, distance``: codes that hold each query's top rows.

    ``coded`` has ``vec_id, code``; ``queries`` has distinct ``code``. The rows of the codes returned
    contain the ``top`` smallest by (distance, vec_id); there may be more rows than that.
    """
    spark = coded.sparkSession
    sizes = stored(
        coded.groupBy("code").agg(F.least(F.count("*"), F.lit(top)).alias("rows")), "codes"
    )
    index = stored(_segments(sizes, segments).select("segment", "value", F.col("code").alias("other"), "rows"), "index")
    total = sizes.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    need = min(top, total)
    width = BITS // segments
    active = queries.select("code").distinct()
    best, finished = None, []
    for radius in range(width + 1):
        if not need or not active.take(1):
            break
        masks = F.broadcast(_flips(spark, segments, width, radius))
        probes = _segments(active, segments).join(masks, "segment")
        probes = probes.select("code", "segment", F.col("value").bitwiseXOR(F.col("mask")).alias("value"))
        seen = probes.join(index, ["segment", "value"]).select(
            "code", "other", "rows", F.bit_count(F.col("code").bitwiseXOR(F.col("other"))).alias("distance")
        )
        if best is not None:
            seen = seen.unionByName(best.where("not done").drop("done"))
        by_code = Window.partitionBy("code")
        nearer = by_code.orderBy("distance").rangeBetween(Window.unboundedPreceding, -1)
        reach = segments * (radius + 1) - 1
        closest = (
            seen.distinct()
            # codes as near as the one that completes the top stay: ids decide among them
            .withColumn("_before", F.sum("rows").over(nearer))
            .where(F.coalesce("_before", F.lit(0)) < need)
            .drop("_before")
        )
        best = stored(
            closest.withColumn(
                "done", (F.sum("rows").over(by_code) >= need) & (F.max("distance").over(by_code) <= reach)
            ),
            "best",
        )
        finished.append(best.where("done").select("code", "other", "distance"))
        active = active.join(finished[-1].select("code").distinct(), "code", "left_anti")
    if not finished:
        return index.select(F.col("other").alias("code"), "other", F.lit(0).alias("distance")).limit(0)
    return reduce(DataFrame.unionByName, finished)


def top_k(vectors: DataFrame, top: int = TOP, every: int = EVERY, segments: int = SEGMENTS) -> DataFrame:
    """``query_id, rank, vec_id, distance``: the nearest rows of every row whose id ``every`` divides.

    A query is among its own results, at distance 0. Ties go by ``vec_id``. Ids are expected to be
    unique; rows that repeat one are rows of their own. Fewer than ``top`` rows are all returned.
    """
    coded = stored(codes(vectors), "coded")
    asked = coded.where(F.col("vec_id") % every == 0).withColumnRenamed("vec_id", "query_id")
    found = stored(nearest(coded, asked.select("code").distinct(), top, segments), "found")
    rows = smallest_ids(coded, top).withColumnRenamed("code", "other")
    order = Window.partitionBy("code").orderBy("distance", "vec_id")
    ranked = found.join(rows, "other").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return asked.join(ranked, "code").select("query_id", "rank", "vec_id", F.col("distance").cast("long").alias("distance"))
