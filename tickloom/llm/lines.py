"""Fuzzy line deduplication by MinHash over character shingles, in DataFrame functions only.

A line is the set of its runs of ``SHINGLE`` UTF-16 units (a shorter line is one run). Its signature comes
from one hash per shingle: the hash range is cut into ``BANDS`` equal parts, and a band is the
``ROWS`` smallest hashes from the start of its part on, running into the next part if there are too
few. Two lines of many shingles share a band with about the probability of their similarity to the power of
``ROWS``; at a similarity of 0.8, five rows and thirteen bands find 99.4 % of all pairs. Pairs that share
a band by chance grow with the square of the corpus: a larger one wants more rows and more bands.

Bands of a short line overlap and miss more, so lines of fewer than ``SHORT`` shingles, and those that
can resemble one, have exact bands: of two sets as similar as ``ALIKE`` in ``OF``, each leaves
out at most the rest of its own size, so their ``SUBSET`` smallest common hashes are among that many more
of the smallest of each. A band per subset of these loses no pair. Sets of up to three must be equal.

Lines that share a band are checked by exact Jaccard similarity, in two rounds: first every line against
one of its bucket, the one that meets most lines, then what the first round left in different
components. Pairs within a component need no check, so a bucket of thousands of near copies
costs a star and what falls out of it. What falls out of large buckets is paired by the shingles that are rarest among
these lines: a line with too many of its own resembles none and meets none, and a pair that meets is checked only if
what stands before the shingle they share can be enough. No link between components is lost. Components keep
the line that comes first by document and line number. Equal lines are one line from the start,
combined in the tasks, so a line that fills a third of the corpus weighs one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.components import components
from tickloom.llm.tables import plain_names, stored, text_key

SHINGLE, BANDS, ROWS = 8, 13, 5
#: Similarity of 8 in 10.
ALIKE, OF = 8, 10
#: Lines of fewer shingles are found by subsets of so many of their smallest hashes.
SHORT, SUBSET = 40, 3
#: Lines of a bucket that may all be paired.
FEW = 16
#: Steps of a line's size, as many for each factor of e.
LEVELS = 16
#: Shingles of a line that are hashed in compiled code, in blocks; longer lines give the same hashes more slowly.
COMPILED, BLOCK = 1024, 64


def lines_of(docs: DataFrame) -> DataFrame:
    """``doc_id, doc_key, line_no, line, key, key2``: lines with something other than ASCII white space.

    Keys are two independent 64-bit hashes of the line; ``doc_key`` is the text's. Null text has no lines.
    """
    text = F.split(F.col("text").cast("string"), "\n")
    ids = [F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text")).alias("doc_key")]
    lines = docs.select(*ids, F.posexplode(text).alias("line_no", "line"))
    return lines.where(F.col("line").rlike(r"[^\x20\x09-\x0D]")).select(
        "doc_id",
        "doc_key",
        F.col("line_no").cast("long").alias("line_no"),
        "line",
        F.xxhash64("line").alias("key"),
        F.xxhash64(F.lit(1), "line").alias("key2"),
    )


def shingles(line: Column) -> Column:
    """Hashes of all shingles in order."""
    width = 2 * SHINGLE

    def hashed(units: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.length(units) - (width - 1), F.lit(1)), F.lit(2))
        return F.transform(starts, lambda i: F.xxhash64(F.substring(units, i, width)))

    return F.get(F.transform(F.array(F.encode(line, "UTF-16BE")), hashed), F.lit(0))


def compiled_shingles(line: str) -> Column:
    """``shingles`` of the column ``line``, spelled out place by place up to ``COMPILED`` of them.

    Spark interprets functions over arrays, for each element; what is spelled out, it compiles. The
    line's encoding stands in two places that are always needed (``length`` and ``octet_length``), so Spark computes
    it once per line. No array here may contain nulls by its type: Spark sorts those as objects.
    """
    units, width = f"encode({line}, 'UTF-16BE')", 2 * SHINGLE

    def block(first: int) -> Column:
        places = ", ".join(f"xxhash64(substring({units}, {2 * i + 1}, {width}))" for i in range(first, first + BLOCK))
        begins = f"length({units}) > {2 * (first + SHINGLE - 1)}" if first else "true"
        return F.expr(f"case when {begins} then array({places}) else array_repeat(0L, 0) end")

    count = F.expr(f"greatest(length({units}) div 2 - {SHINGLE - 1}, 1)").cast("int")
    short = F.expr(f"greatest(length({units}), octet_length({units})) <= {2 * (COMPILED + SHINGLE - 1)}")
    blocks = F.concat(*[block(first) for first in range(0, COMPILED, BLOCK)])
    return F.when(short, F.slice(blocks, F.lit(1), count)).otherwise(shingles(F.col(line)))


def subsets(smallest: Column) -> Column:
    """A hash for each subset of ``SUBSET`` of these sorted hashes, or one of them all if there are no more."""

    def hashed(v: Column) -> Column:
        def rest(at: Column) -> Column:
            return F.slice(v, at + 1, F.size(v))

        def pairs(x: Column, i: Column) -> Column:
            return F.flatten(F.transform(rest(i + 1), lambda y, j: F.transform(
                rest(i + j + 2), lambda z: F.xxhash64(F.lit(-1), x, y, z)
            )))

        return F.when(F.size(v) <= SUBSET, F.array(F.xxhash64(F.lit(-2), v))).otherwise(F.flatten(F.transform(v, pairs)))

    return F.get(F.transform(F.array(smallest), hashed), F.lit(0))


def banded(lines: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``key, bands``: the signature of each distinct line, from the set of its shingles."""
    marks = F.array(*[F.lit(-(1 << 63) + t * ((1 << 64) // bands)) for t in range(bands)])
    # the longest line that can resemble a short one, and how many of its smallest hashes subsets come from
    longest = (SHORT - 1) * OF // ALIKE
    most = SUBSET + longest * (OF - ALIKE) // OF

    # Spark computes an expensive column once if later ones use it several times. With a function over an
    # array, short as it is, a step stays out of the one method of a whole stage, which the JVM leaves uncompiled if it is long.
    once = lines.select("key", F.sort_array(F.array_distinct(compiled_shingles("line"))).alias("v"))
    # marks are sorted in among the hashes, so their places say where parts begin
    long = F.size("v") >= SHORT
    taken = F.least(F.size("v"), F.floor(F.size("v") * (OF - ALIKE) / OF).cast("int") + SUBSET)
    once = once.select(
        "key",
        F.when(long, F.concat("v", F.slice("v", 1, rows))).alias("_v"),
        F.when(long, F.sort_array(F.concat(F.col("v"), marks))).alias("_w"),
        F.when(F.size("v") <= longest, F.filter("v", lambda _, i: i < taken)).alias("_small"),
    )

    def cut(t: int) -> Column:
        start = (F.array_position("_w", F.get(marks, F.lit(t))) - t).cast("int")
        return F.when(F.col("_w").isNotNull(), F.xxhash64(F.lit(t), F.slice("_v", start, F.lit(rows))))

    parts = [cut(t).alias(f"_b{t}") for t in range(bands)]
    least = F.filter("_small", lambda _, i: i < 1)
    parts += [F.get("_small" if i else least, F.lit(i)).alias(f"_s{i}") for i in range(most)]
    names = [f"_b{t}" for t in range(bands)] + [f"_s{i}" for i in range(most)]
    once = once.select("key", *parts).groupBy("key").agg(*[F.min(n).alias(n) for n in names])
    smallest = F.array_compact(F.array(*names[bands:]))
    exact = F.when(F.col("_s0").isNotNull(), subsets(smallest)).otherwise(F.array().cast("array<bigint>"))
    return once.select("key", F.concat(F.array_compact(F.array(*names[:bands])), exact).alias("bands"))


def buckets(lines: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``band, key, n, leader``: lines that share a band with another, and how many share it.

    The leader is the line that meets most others, counted over all its bands: of a group of near copies one
    that was changed least, which most of the group resemble.
    """
    spread = banded(lines, bands, rows).select("key", F.explode("bands").alias("band"))
    order = Window.partitionBy("band").orderBy("key")
    near = spread.select(
        "band", "key", F.lag("key").over(order).alias("_before"), F.lead("key").over(order).alias("_next")
    )
    near = near.where("_before is not null or _next is not null").select(
        "band", "key", F.count("*").over(Window.partitionBy("band")).alias("n")
    )
    near = stored(near, "near")
    met = near.groupBy("key").agg(F.sum("n").alias("_met"))
    leaders = near.join(met, "key").groupBy("band").agg(F.max(F.struct("_met", "key"))["key"].alias("leader"))
    return near.join(leaders, "band").select("band", "key", "n", "leader")


def alike(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs ``a, b`` of keys to verified links ``a, b`` of line ids.

    The sizes of the two sets bound their similarity, so most unlike pairs are never opened.
    """
    def side(key: str, id: str, line: str, size: str) -> DataFrame:
        names = {"key": key, "id": id, "line": line, "size": size}
        return texts.select(*[F.col(old).alias(new) for old, new in names.items()])

    near = pairs.join(side("a", "_a", "_s", "_n"), "a").join(side("b", "_b", "_t", "_m"), "b")
    near = near.where(OF * F.least("_n", "_m") >= ALIKE * F.greatest("_n", "_m"))
    both = F.size(F.array_intersect(shingles(F.col("_s")), shingles(F.col("_t"))))
    # OF * both >= ALIKE * (n + m - both), with ``both`` computed once
    enough = (OF + ALIKE) * both >= ALIKE * (F.col("_n") + F.col("_m"))
    return near.where(enough).select(F.col("_a").alias("a"), F.col("_b").alias("b"))


def line_components(docs: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``key, key2, root``: lines that have a near copy, with their component."""
    lines = lines_of(docs)
    found = stored(buckets(lines, bands, rows), "buckets")
    wanted = found.select("key").distinct()
    texts = (
        lines.join(wanted, "key", "left_semi")
        .groupBy("key", "key2")
        .agg(F.first("line").alias("line"))
        .withColumn("id", F.monotonically_increasing_id())
        .withColumn("size", F.size(F.array_distinct(shingles(F.col("line")))))
    )
    texts = stored(texts, "texts")
    stars = found.where("key != leader").select(F.col("leader").alias("a"), F.col("key").alias("b"))
    links = stored(alike(stars.distinct(), texts), "links")
    first = stored(components(links), "components")
    rest = stored(alike(_apart(found, texts, first), texts), "links")
    both = first.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(rest)
    whole = stored(components(both), "components") if rest.take(1) else first
    return texts.join(whole, texts.id == whole.node).select("key", "key2", "root")


def _apart(found: DataFrame, texts: DataFrame, first: DataFrame) -> DataFrame:
    """Pairs ``a, b`` of lines in different components that may be alike, from all buckets with more than one.

    Lines of a small bucket are paired as they are, a few pairs for each; those of larger ones by rare shingles.
    """
    lines = texts.join(first, texts.id == first.node, "left").select(
        "key", "id", "line", "size", F.coalesce("root", "id").alias("root")
    )
    members = found.join(lines.select("key", "root"), "key")
    mixed = members.groupBy("band").agg(F.min("root").alias("_x"), F.max("root").alias("_y")).where("_x != _y")
    members = stored(members.join(mixed.select("band"), "band", "left_semi"), "apart")
    few = members.where((F.col("n") <= FEW) & (F.col("key") != F.col("leader")))
    left = few.select("band", F.col("key").alias("a"), F.col("root").alias("_r"))
    right = few.select("band", F.col("key").alias("b"), F.col("root").alias("_s"))
    near = left.join(right, "band").where("a < b and _r != _s").select("a", "b")
    many = members.where(F.col("n") > FEW).select("key").distinct()
    return near.unionByName(_by_rare_shingles(lines.join(many, "key", "left_semi"))).distinct()


def _by_rare_shingles(lines: DataFrame) -> DataFrame:
    """Pairs ``a, b`` of keys, among them all alike lines of different ``root``.

    The shingles of a line are ranked from the most frequent on, in one order for all lines. What two lines have in
    common stands, in both, no later than the rarest shingle they share, so its smaller rank bounds their
    overlap, and only ranks that can make up ``ALIKE`` in ``OF`` are kept. Of the lines that share a
    shingle, those of its most frequent component are not paired with each other, and the others meet only lines
    of a size that their rank allows.
    """
    lines = stored(lines, "lines")
    spread = lines.select("id", "size", F.explode(F.array_distinct(shingles(F.col("line")))).alias("shingle"))
    often = spread.groupBy("shingle").agg(F.count("*").alias("_n")).where("_n > 1")
    order = Window.partitionBy("id").orderBy(F.desc("_n"), "shingle")
    ranked = (
        spread.join(often, "shingle")
        .withColumn("rank", F.row_number().over(order))
        .where(OF * F.col("rank") >= ALIKE * F.col("size"))
        .select("shingle", "id", "rank")
    )
    ranked = stored(ranked.join(lines.select("id", "key", "size", "root"), "id"), "ranked")
    by_root = ranked.groupBy("shingle", "root").agg(F.count("*").alias("_n"))
    most = by_root.groupBy("shingle").agg(F.max(F.struct("_n", "root"))["root"].alias("most"), F.count("*").alias("_r"))
    ranked = ranked.join(most.where("_r > 1").drop("_r"), "shingle")

    def side(key: str, size: str, rank: str, root: str) -> DataFrame:
        names = {"key": key, "size": size, "rank": rank, "root": root}
        return ranked.select("shingle", "most", *[F.col(old).alias(new) for old, new in names.items()])

    def level(size: Column) -> Column:
        return F.floor(F.log(size) * LEVELS)

    # the sizes that a line can be alike to if it shares no rarer shingle: they are part of the key
    least = F.ceil(F.col("_n") * ALIKE / OF)
    greatest = F.floor(F.col("_i") * (OF + ALIKE) / ALIKE - F.col("_n"))
    left = side("a", "_n", "_i", "_r").where("_r != most").drop("most")
    left = left.select("*", F.explode(F.sequence(level(least), level(F.greatest(least, greatest)))).alias("level"))
    right = side("b", "_m", "_j", "_s").withColumn("level", level(F.col("_m")))
    once = (F.col("_s") == F.col("most")) | (F.col("a") < F.col("b"))
    enough = (OF + ALIKE) * F.least("_i", "_j") >= ALIKE * (F.col("_n") + F.col("_m"))
    return (
        left.join(right, ["shingle", "level"])
        .where((F.col("_r") != F.col("_s")) & once & enough)
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .where("a != b")
    )


def keyed_duplicates(docs: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``duplicate_lines`` with ``doc_key``, which tells documents of one id, or of none, apart."""
    near = stored(line_components(docs, bands, rows), "classes")
    places = stored(
        lines_of(docs).select("key", "key2", F.struct("doc_id", "line_no", "doc_key").alias("place")), "places"
    )
    firsts = places.groupBy("key", "key2").agg(F.min("place").alias("place"), F.count("*").alias("n"))
    classed = firsts.join(near, ["key", "key2"], "left").where("n > 1 or root is not null")
    classed = stored(classed, "classes")
    keepers = classed.where("root is not null").groupBy("root").agg(F.min("place").alias("keeper"))
    keepers = classed.join(keepers, "root", "left").select(
        "key", "key2", F.coalesce("keeper", "place").alias("keeper")
    )
    return places.join(keepers, ["key", "key2"], "left").select(
        "place.doc_id",
        "place.doc_key",
        "place.line_no",
        F.coalesce("keeper", "place")["doc_id"].alias("keeper_doc_id"),
        F.coalesce("keeper", "place")["line_no"].alias("keeper_line_no"),
        F.coalesce(F.col("keeper").eqNullSafe(F.col("place")) | F.col("keeper").isNull(), F.lit(True)).alias("kept"),
    )


def duplicate_lines(docs: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``doc_id, line_no, keeper_doc_id, keeper_line_no, kept`` for every line that is not blank.

    The keeper is the first line of the component by document and line number (null ids first).
    Blank lines are never removed and have no row. Repeated rows of a document, of the same id and the
    same text, share its places; other rows of an id have places of their own.
    """
    return keyed_duplicates(docs, bands, rows).drop("doc_key")


@plain_names
def without_duplicates(docs: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``docs`` with the texts' removed lines taken out; ``n_chars``, if there, counts the new text.

    A document that loses all its lines stays, with an empty text.
    """
    gone = (
        keyed_duplicates(docs, bands, rows)
        .where("not kept")
        .groupBy(F.col("doc_id").alias("_doc"), F.col("doc_key").alias("_digest"))
        .agg(F.collect_set("line_no").alias("_gone"))
    )
    at = F.array_except(F.sequence(F.lit(0).cast("long"), F.size("_lines") - F.lit(1).cast("long")), F.col("_gone"))
    kept = F.array_join(F.transform(at, lambda i: F.get("_lines", i.cast("int"))), "\n")
    whole = docs.select(
        F.struct(*docs.columns).alias("_row"),
        F.col("doc_id").cast("long").alias("_id"),
        text_key(F.col("text")).alias("_key"),
    )
    same = F.col("_id").eqNullSafe(F.col("_doc")) & (F.col("_key") == F.col("_digest"))
    cut = whole.join(gone, same, "left").select(
        "_row", "_gone", F.split("_row.text", "\n").alias("_lines")
    )
    cut = cut.select("_row", F.when(F.col("_gone").isNotNull(), kept).alias("_new"))
    new = {"text": F.col("_new"), "n_chars": F.length("_new")}
    return cut.select(*[
        F.when(F.col("_new").isNull() | F.lit(c not in new), F.col(f"_row.{c}"))
        .otherwise(new.get(c, F.lit(None)).cast(docs.schema[c].dataType)).alias(c)
        for c in docs.columns
    ])
