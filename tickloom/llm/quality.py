"""Quality rules whose cutoffs are chosen under a proven bound on false rejections.

Every document gets integer signals. A rule rejects a document whose signal reaches a cutoff. For
each stratum (language) and rule, cutoffs of a fixed grid are tried from the loosest on: on the labelled
holdout of good documents, k of n would be rejected, and a cutoff is certified if the exact binomial
probability of k or fewer out of n, at a true rejection rate of ``risk``, is at most
``error / (strata * rules)``: the exact (Clopper-Pearson) upper bound of the rate is then below
``risk``. The first cutoff that is not certified ends the row (fixed-sequence testing), so only strata and
rules need the correction, and all guarantees hold together with probability ``1 - error``.
A stratum with too few labels to prove anything keeps its documents.

All of it is DataFrame functions. Words are handled as arrays inside a row, whatever the length of
the text, so nothing but a few numbers per document is shuffled.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.tables import plain_names, stored, texts

SPACE = r"[\x20\x09-\x0D]+"
RISK, ERROR = 0.02, 0.05
#: Rules: a signal and its cutoffs, in thousandths, from loose to strict.
RULES = {
    "symbols": (2000, 1000, 500, 200, 100),
    "long_words": (12000, 10000, 9000, 8000, 7500),
    "dup_lines": (900, 700, 500, 400),
    "repeats": (450, 400, 350, 300),
}
#: Most strata a run may have; their cutoffs travel inside the query.
MOST_STRATA = 10_000


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _repeated(windows: Column) -> Column:
    """Words in windows that occur twice or more, given the windows' hashes in order."""
    placed = F.array_sort(
        F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    )

    def covered(pairs: Column) -> Column:
        again = F.filter(
            pairs,
            lambda p, i: (p["h"] == F.get(pairs, i - 1)["h"]) | (p["h"] == F.get(pairs, i + 1)["h"]),
        )
        return let(F.array_sort(F.transform(again, lambda p: p["i"])), spread)

    def spread(at: Column) -> Column:
        steps = F.transform(at, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(at, i + 1) - x, F.lit(3))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda total, x: total + x)

    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("long")).otherwise(
        let(placed, covered)
    )


def _windows(hashes: Column) -> Column:
    """Hashes of the windows of three words; none if there are fewer words."""
    return F.when(
        F.size(hashes) > 2,
        F.transform(
            F.sequence(F.lit(2), F.size(hashes) - 1),
            lambda i: F.xxhash64(F.get(hashes, i - 2), F.get(hashes, i - 1), F.get(hashes, i)),
        ),
    ).otherwise(F.array().cast("array<bigint>"))


def counts(docs: DataFrame, *carried: str) -> DataFrame:
    """``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines`` and carried columns.

    Null text has no words. Windows are compared by 64-bit hashes of their words' hashes.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.regexp_replace(x, SPACE, "")) > 0)
    split = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        *carried,
        F.array_remove(F.split(text, SPACE), "").alias("_words"),
        F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        lines.alias("_lines"),
    )
    return split.select(
        "doc_id",
        *carried,
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        "n_symbols",
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        let(
            F.transform("_words", lambda w: F.xxhash64(w)),
            lambda hashes: let(_windows(hashes), _repeated),
        ).alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"),
    )


def _thousandths(part: str, whole: str) -> Column:
    return F.when(F.col(whole) > 0, F.expr(f"1000 * {part} div {whole}")).otherwise(F.lit(0).cast("long"))


def signals() -> dict[str, Column]:
    """Integer signals over the columns of ``counts``, by rule."""
    return {
        "symbols": _thousandths("n_symbols", "n_words"),
        "long_words": _thousandths("word_chars", "n_words"),
        "dup_lines": _thousandths("n_dup_lines", "n_lines"),
        "repeats": _thousandths("n_repeat_words", "n_words"),
    }


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def stratum() -> Column:
    return F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("stratum")


def _tail(k: Column, n: Column, rate: float) -> Column:
    """Binomial probability of ``k`` or fewer of ``n``, summed in logarithms; 1 if k is above the mean."""
    odds = math.log(rate / (1 - rate))
    first = n * F.lit(math.log1p(-rate))

    def add(state: Column, i: Column) -> Column:
        term = state["term"] + F.log((n - i + 1) / i.cast("double")) + F.lit(odds)
        total = state["total"] + F.log1p(F.exp(term - state["total"]))
        return F.struct(term.alias("term"), total.alias("total"))

    steps = F.when(k > 0, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>"))
    start = F.struct(first.alias("term"), first.alias("total"))
    return F.when(k > n * F.lit(rate), F.lit(1.0)).otherwise(
        F.aggregate(steps, start, add, lambda state: F.exp(state["total"]))
    )


def certified(counted: DataFrame, labels: DataFrame, rules=None, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """``stratum, rule, n, level, cutoff``: the strictest certified cutoff of each, null if none.

    The holdout are documents that the base rules pass and that ``labels`` (doc_id, quality) call
    good; with several labels a document is good if all are. No labels give no rows.
    """
    rules = rules or RULES
    good = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.min("quality").alias("quality")
    ).where("quality = 1")
    holdout = counted.where(~base_failed()).join(good, "doc_id")
    reached = F.array(*[
        F.struct(
            F.lit(name).alias("rule"),
            F.array(*[(signals()[name] >= c).cast("long") for c in grid]).alias("hits"),
            F.array(*[F.lit(c).cast("long") for c in grid]).alias("grid"),
        )
        for name, grid in rules.items()
    ])
    tried = (
        holdout.select(stratum(), F.inline(reached))
        .select("stratum", "rule", F.posexplode(F.arrays_zip("hits", "grid")).alias("level", "x"))
        .groupBy("stratum", "rule", "level", F.col("x.grid").alias("cutoff"))
        .agg(F.count("*").alias("n"), F.sum("x.hits").alias("k"))
    )
    tried = stored(tried, "holdout")
    families = max(1, tried.select("stratum", "rule").distinct().count())
    passed = _tail(F.col("k"), F.col("n"), risk) <= error / families
    ladder = Window.partitionBy("stratum", "rule").orderBy("level")
    return (
        tried.withColumn("_sure", F.min(passed).over(ladder))
        .groupBy("stratum", "rule")
        .agg(
            F.max("n").alias("n"),
            F.sum(F.col("_sure").cast("long")).alias("level"),
            F.min(F.when(F.col("_sure"), F.col("cutoff"))).alias("cutoff"),
        )
    )


def cutoffs_of(chosen: DataFrame) -> dict[str, dict[str, int]]:
    """Cutoffs by rule and stratum. One number per stratum and rule: bounded, and checked."""
    rows = chosen.where("cutoff is not null").limit(MOST_STRATA * len(RULES) + 1).collect()
    if len(rows) > MOST_STRATA * len(RULES):
        raise ValueError(f"more than {MOST_STRATA} strata")
    found: dict[str, dict[str, int]] = {}
    for row in rows:
        found.setdefault(row["rule"], {})[row["stratum"]] = row["cutoff"]
    return found


def rejected(cutoffs: dict[str, dict[str, int]]) -> Column:
    """True if a rule's signal reaches the cutoff of the row's stratum."""
    verdict = F.lit(False)
    for rule, of in sorted(cutoffs.items()):
        pairs = [F.lit(x) for pair in sorted(of.items()) for x in pair]
        cutoff = F.try_element_at(F.create_map(*pairs), stratum())
        verdict = verdict | F.coalesce(signals()[rule] >= cutoff, F.lit(False))
    return verdict


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Counts of every document with ``base_failed`` and ``kept``; cutoffs from the labelled ones.

    Repeated rows stay and count as often in the holdout. Null language is the stratum ''.
    """
    counted = stored(counts(docs, "lang"), "counts")
    cutoffs = cutoffs_of(certified(counted, labels))
    base = base_failed()
    return counted.withColumn("base_failed", base).withColumn("kept", ~base & ~rejected(cutoffs))


def quality_query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return quality(docs, labels).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@plain_names
def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, as they are.

    Cutoffs come from the rows' counts, then every row is judged where it is read: a second scan
    instead of a shuffle of all texts.
    """
    counted = stored(counts(docs, "lang"), "counts")
    cutoffs = cutoffs_of(certified(counted, labels))
    names = [f"_c{i}" for i in range(len(docs.columns))]
    own = docs.select(
        F.struct(*[F.col(c).alias(n) for c, n in zip(docs.columns, names)]).alias("_row"),
        "doc_id", "text", "lang",
    )
    counted = counts(own, "_row", "lang")
    # filters stay above a generator; below it they would count every document again for each signal
    once = counted.select(F.inline(F.array(F.struct(*counted.columns))))
    judged = once.where(~base_failed() & ~rejected(cutoffs))
    return judged.select(*[F.col(f"_row.{n}").alias(c) for c, n in zip(docs.columns, names)])
