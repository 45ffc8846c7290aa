"""Preference formatting of conversations, in DataFrame functions only.

A pair is a chosen and a rejected conversation. Their longest common prefix of turns is rendered once as
the prompt; what follows in each is its completion, with the character ranges that a loss may
look at: the text and end mark of assistant turns. The last common turn is left out of the prompt when it
would leave a completion empty, so that a conversation that is the start of the other still has one.

A table of conversations without preferences is given rejections: each conversation up to its last
assistant turn, which is replaced by that of the next conversation of the same block of ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.tables import stored

#: Marks of the rendered text.
START, END = "<|im_start|>", "<|im_end|>"
TRAINED = "assistant"
#: Conversation ids per block when pairs are made.
BLOCK = 1_000


def ordered(turns: DataFrame) -> DataFrame:
    """``conv_id, place, role, text``: turns in order, numbered from 0.

    Order is by ``turn`` (null first), then role and text; a null role or text is empty. Rows without
    ``conv_id`` belong to no conversation and go; rows that repeat a turn are turns of their own.
    """
    plain = turns.select(
        "conv_id",
        "turn",
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).where("conv_id is not null")
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return plain.withColumn("place", F.row_number().over(order) - 1).drop("turn")


def with_rejections(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """``pair_id, is_chosen, turn, role, text``: every conversation with an assistant turn, and its rejection.

    The pair has the conversation's id. The last conversation of a block takes the answer of the
    first one; one that is alone in its block is rejected for its own answer.
    """
    placed = stored(ordered(turns), "turns")
    last = placed.where(F.col("role") == TRAINED).groupBy("conv_id").agg(F.max("place").alias("last"))
    answers = placed.join(last, "conv_id").where("place = last").select("conv_id", "last", "text")
    in_block = Window.partitionBy(F.expr(f"conv_id div {block}")).orderBy("conv_id")
    whole = in_block.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    swapped = answers.select(
        "conv_id", "last", F.coalesce(F.lead("text").over(in_block), F.first("text").over(whole)).alias("other")
    )
    both = placed.join(swapped, "conv_id")
    sides = F.array(
        F.struct(F.lit(True).alias("is_chosen"), F.col("text").alias("said")),
        F.struct(
            F.lit(False).alias("is_chosen"),
            F.when(F.col("place") == F.col("last"), F.col("other")).otherwise(F.col("text")).alias("said"),
        ),
    )
    return both.select("conv_id", "place", "last", "role", F.inline(sides)).where("is_chosen or place <= last").select(
        F.col("conv_id").alias("pair_id"), "is_chosen", F.col("place").alias("turn"), "role", F.col("said").alias("text")
    )


def rendered(role: Column, text: Column) -> Column:
    return F.concat(F.lit(START), role, F.lit("\n"), text, F.lit(END + "\n"))


def formatted(rows: DataFrame) -> DataFrame:
    """``pair_id, is_chosen, turn, role, text`` to one row per pair that has both sides.

    Gives ``pair_id, n_common, prompt, chosen, rejected, chosen_mask, rejected_mask``. Masks are arrays
    of ``start, end`` in characters of the completion that count for a loss. Turns are ordered by
    ``turn`` (null first), then role and text; null role or text is empty; rows without a pair or side
    go. Equal conversations share all turns but the last.
    """
    turn = F.struct(
        F.col("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    sides = rows.where("pair_id is not null and is_chosen is not null").groupBy("pair_id").agg(
        F.array_sort(F.collect_list(F.when(F.col("is_chosen"), turn))).alias("_a"),
        F.array_sort(F.collect_list(F.when(~F.col("is_chosen"), turn))).alias("_b"),
    )
    whole = sides.where("size(_a) > 0 and size(_b) > 0").select(
        "pair_id", _unnumbered("_a").alias("_a"), _unnumbered("_b").alias("_b")
    )
    differs = F.filter(
        F.sequence(F.lit(0), F.least(F.size("_a"), F.size("_b")) - 1),
        lambda i: F.get("_a", i) != F.get("_b", i),
    )
    shorter = F.least(F.size("_a"), F.size("_b")) - 1
    cut = whole.withColumn("n_common", F.least(F.coalesce(F.get(differs, F.lit(0)), shorter), shorter))
    n = F.col("n_common")
    return cut.select(
        "pair_id",
        n.cast("long").alias("n_common"),
        _joined(F.slice("_a", F.lit(1), n)).alias("prompt"),
        _joined(_rest("_a")).alias("chosen"),
        _joined(_rest("_b")).alias("rejected"),
        _mask(_rest("_a")).alias("chosen_mask"),
        _mask(_rest("_b")).alias("rejected_mask"),
    )


def _unnumbered(name: str) -> Column:
    return F.transform(name, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))


def _rest(name: str) -> Column:
    return F.slice(name, F.col("n_common") + 1, F.size(name))


def _joined(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: rendered(t["role"], t["text"])), "")


def _mask(turns: Column) -> Column:
    """Ranges of assistant texts with their end mark, by running lengths."""
    def add(done: Column, t: Column) -> Column:
        before = F.coalesce(F.get(done, F.size(done) - 1)["next"], F.lit(0).cast("long"))
        start = before + F.length(t["role"]) + len(START) + 1
        end = start + F.length(t["text"]) + len(END)
        entry = F.struct(
            start.cast("long").alias("start"), end.cast("long").alias("end"),
            (t["role"] == TRAINED).alias("trained"), (end + 1).cast("long").alias("next"),
        )
        return F.concat(done, F.array(entry))

    empty = F.array().cast("array<struct<start:bigint,end:bigint,trained:boolean,next:bigint>>")
    ranges = F.aggregate(turns, empty, add)
    return F.transform(F.filter(ranges, lambda r: r["trained"]), lambda r: F.struct(r["start"], r["end"]))


def chat_query(turns: DataFrame) -> DataFrame:
    """Every conversation with an answer against its rejection, masks as ``start-end`` joined by commas."""

    def text(mask: str) -> Column:
        return F.array_join(F.transform(mask, lambda r: F.concat_ws("-", r["start"], r["end"])), ",")

    return formatted(with_rejections(turns)).select(
        "pair_id", "n_common", "prompt", "chosen", "rejected",
        text("chosen_mask").alias("chosen_mask"), text("rejected_mask").alias("rejected_mask"),
    )
