"""Language identification by rank-order profiles of character n-grams.

A profile is the list of a language's most frequent n-grams (one to three letters, with word borders) by
rank. A text's own list is held against every profile: each n-gram adds the distance between its
two ranks, or the length of a profile if the profile lacks it, and the smallest sum wins. N-grams are
counted per distinct word, so a frequent word costs one lookup.

Profiles are learned from all documents with a language, bar those held out. Counts are made in the
tasks and added up by Spark; only the profiles, a fixed number of n-grams per language, come
to the driver.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.tables import stored, texts
from tickloom.llm.wordcache import Encoded, WordCache, flat, worker_kept

LONGEST, PROFILE = 3, 400
#: N-grams a task remembers, words it counts before it hands them on, texts ranked together, most languages.
REMEMBERED, COUNTED, TOGETHER, MOST_LANGUAGES = 500_000, 400_000, 200, 10_000
UNKNOWN = "und"
WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    """Runs of letters in lower case. Fractions, Roman numerals and the like match ``WORD`` but are none."""
    words = WORD.findall(text.lower())
    if not words or "".join(words).isalpha():
        return words
    return "".join(c if c.isalpha() else " " for c in " ".join(words)).split()


def held_out(doc_id: Column) -> Column:
    """Documents that nothing is learned from; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def grams(word: str) -> list[str]:
    """N-grams of a word between borders; a border alone is none."""
    framed = f"_{word}_"
    return [
        framed[i : i + n] for n in range(1, LONGEST + 1) for i in range(len(framed) - n + 1) if n > 1 or framed[i] != "_"
    ]


def gram_counts(docs: DataFrame) -> DataFrame:
    """``lang, gram, n`` over all documents of a language, held-out ones left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = counts.setdefault(lang, Counter())
                own.update(words_of(text.as_py() or ""))
            if sum(map(len, counts.values())) > COUNTED:
                yield _counted(counts)
                counts = {}
        yield _counted(counts)

    known = docs.where(F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    partial = known.mapInArrow(run, "lang string, gram string, n long")
    return partial.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _counted(counts: dict[str, Counter]) -> pa.RecordBatch:
    rows = []
    for lang, words in counts.items():
        total: Counter = Counter()
        for word, n in words.items():
            for gram in grams(word):
                total[gram] += n
        rows += [(lang, gram, n) for gram, n in total.items()]
    columns = list(zip(*rows)) or [()] * 3
    kinds = [pa.string(), pa.string(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["lang", "gram", "n"])


def profiles(docs: DataFrame, size: int = PROFILE) -> dict[str, list[str]]:
    """The ``size`` most frequent n-grams of each language, ties by text; at most ``MOST_LANGUAGES``."""
    counts = stored(gram_counts(docs), "grams")
    if counts.select("lang").distinct().limit(MOST_LANGUAGES + 1).count() > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    best = counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size)
    found: dict[str, list[str]] = {}
    for row in best.orderBy("lang", "rank").collect():
        found.setdefault(row["lang"], []).append(row["gram"])
    return found


class Grams(dict):
    """N-grams to ids, given as they come, with what is known about each of them."""

    def __init__(self, learned: list[dict[str, int]], size: int):
        self.learned, self.size = learned, size
        self.ties = np.zeros(1024, np.uint64)
        self.ranks = np.full((1024, len(learned)), size, np.int64)

    def __missing__(self, gram: str) -> int:
        at = self[gram] = len(self)
        if at == len(self.ties):
            self.ties = np.concatenate([self.ties, np.zeros_like(self.ties)])
            self.ranks = np.concatenate([self.ranks, np.full_like(self.ranks, self.size)])
        self.ties[at] = xxhash.xxh64_intdigest(gram.encode("utf-8", "surrogatepass"))
        self.ranks[at] = [ranks.get(gram, self.size) for ranks in self.learned]
        return at


class Ranker:
    """Compares texts with profiles, remembering the n-grams of words."""

    def __init__(self, learned: dict[str, list[str]], size: int):
        self.size, self.langs = size, sorted(learned)
        self.learned = [{g: r for r, g in enumerate(learned[lang])} for lang in self.langs]
        self.clear()

    def clear(self) -> None:
        self.cache = WordCache(self._encode)
        self.grams = Grams(self.learned, self.size)

    def _encode(self, words: list[str]) -> Encoded:
        number = self.grams.__getitem__
        return words, *flat([list(map(number, grams(word))) for word in words])

    def top(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text's most frequent n-grams by rank; ties by a hash of the n-gram."""
        if len(self.grams) > REMEMBERED:
            self.clear()
        found = []
        for ids, _ in self.cache([words_of(text) for text in texts]):
            counts = np.bincount(ids)
            seen = np.flatnonzero(counts)
            found.append(seen[np.lexsort((self.grams.ties[seen], -counts[seen]))][: self.size])
        return found

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """The language of the smallest distance, the first by name of equal ones, and 1 - its share."""
        return [self._nearest(top) for top in self.top([t or "" for t in texts])]

    def _nearest(self, top: np.ndarray) -> tuple[str, float]:
        if not len(top) or not self.langs:
            return UNKNOWN, 0.0
        ranks = self.grams.ranks[top]
        steps = np.abs(ranks - np.arange(len(top))[:, None])
        distance = np.where(ranks == self.size, self.size, steps).sum(axis=0)
        best = int(distance.argmin())
        return self.langs[best], float(1 - distance[best] / (self.size * len(top)))


def identify(docs: DataFrame, learned: dict[str, list[str]], size: int = PROFILE) -> DataFrame:
    """``doc_id, lang_pred, score`` of every whole text; null text or no letter gives ``und`` and 0."""
    key = f"languages {size} {xxhash.xxh3_128_hexdigest(repr(sorted(learned.items())))}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranker = worker_kept(key, lambda: Ranker(learned, size))
        for batch in batches:
            for part in (batch.slice(i, TOGETHER) for i in range(0, batch.num_rows, TOGETHER)):
                langs, scores = zip(*ranker.predict(part.column(1).to_pylist()))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                    ["doc_id", "lang_pred", "score"],
                )

    return texts(docs).mapInArrow(run, "doc_id long, lang_pred string, score double")


def language_query(docs: DataFrame) -> DataFrame:
    found = identify(docs, profiles(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
