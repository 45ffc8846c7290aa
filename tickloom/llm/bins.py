"""Best-fit packing of tokenized documents under several capacities at once.

A piece of n tokens needs a vector of room in a sequence: n tokens, one document, and n squared for
attention within the document. Pieces are placed longest first, each into an open sequence that has room in every
dimension; a new sequence is opened only if none has. Rules choose among the open ones:

* ``norm``: the one whose weighted residual, after the piece, is shortest (best fit);
* ``dot``: the one whose residual has the largest weighted dot product with the piece.

Both measure a dimension in parts of its capacity, and weigh it by the capacities that all pieces together need.

Pieces of one length are alike, so only the histogram of lengths, at most ``tokens`` numbers, reaches the
driver. Sequences with the same residual are one class with a count there, and a step of the
plan places as many equal pieces as the rule would place one after the other: a run of ranks within the
length goes to a run of sequences. Pieces find their run by their rank, which is the number of equal pieces in
earlier blocks plus their place in their own block. A block is what one task wrote.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, product

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.tables import stored, texts
from tickloom.llm.wordcache import of_file

TOKENS = 1024
END_ID = 2
TOKENIZER = "byte_bpe_50k.json"
#: Characters of texts, and words, that are encoded together; no result depends on it.
CHARACTERS, TOGETHER = 6_000_000, 1000
#: White space other than space and line feed; special tokens and runs of these two are looked for besides.
OTHER_SPACE = re.compile("[\t\x0b-\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
RUNS = ["".join(run) for run in product(" \n", repeat=3)]
#: Latin letters and the marks that end a word of them; the sign that a mark had no space before it.
LETTER, MARKS, MARK = "[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]", ".,!?;:", "\x02"

PIECES = "doc_id long, piece int, start long, length long, ids binary"


def unusual(text: str) -> bool:
    """Whether the splitter may take a text differently if it is cut at white space.

    That is so with three white characters in a row, two at the end, others than space and line
    feed, with special tokens and with the sign used here.
    """
    return (
        "<|" in text
        or MARK in text
        or text[-2:].isspace() and len(text) > 1
        or any(run in text for run in RUNS)
        or OTHER_SPACE.search(text) is not None
    )


def gathered(ids: np.ndarray, first: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Slices of ``ids`` in a row."""
    ends = np.cumsum(lengths)
    return ids[np.repeat(first - ends + lengths, lengths) + np.arange(lengths.sum())]


class Shown(dict):
    """Characters to what the vocabulary writes for their bytes, asked of the splitter when they first occur.

    Words have a space between them; that of a line feed is a piece of its own.
    """

    def __init__(self, tokenizer):
        self.splitter = tokenizer.pre_tokenizer
        self[ord(" ")] = " "
        self[ord("\n")] = self.written("\n") + " "

    def written(self, character: str) -> str:
        return "".join(part for part, _ in self.splitter.pre_tokenize_str(character))

    def __missing__(self, code: int) -> str:
        self[code] = self.written(chr(code))
        return self[code]


class ByteIds:
    """Ids of texts by the tokenizers library, each distinct word of some texts encoded once.

    The splitter takes a space together with what follows it and a line feed alone, so in a text
    without unusual white space the ids are those of its words, each with the space or line feed before it; and
    a mark between a letter and white space is a piece of its own. A text is put behind a line feed, whose id is
    taken off again, so that its first word is no exception.
    """

    def __init__(self, path: str):
        # a task has one core; the other ones have tasks of their own
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # words of letters are not split any further, so they can go straight to the merges
        self.merger = Tokenizer(self.tokenizer.model)
        self.merger.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
        self.shown = Shown(self.tokenizer)
        space, (self.feed,) = self.shown.written(" "), self._ids("\n")
        self.space = space
        vocabulary = self.tokenizer.get_vocab()
        self.spaced = np.zeros(max(vocabulary.values()) + 1, bool)
        self.spaced[[i for token, i in vocabulary.items() if token.startswith(space)]] = True

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _merged(self, words: pa.Array, fed: bool) -> tuple[np.ndarray, np.ndarray]:
        """Ids in a row, and their numbers, of words of letters, all of them behind a line feed or a space."""
        ends = pa.array([*range(0, len(words), TOGETHER), len(words)], pa.int32())
        some = pc.binary_join(pa.ListArray.from_arrays(ends, words), " ").to_pylist()
        some = [text if text.isascii() and not fed else text.translate(self.shown) for text in some]
        if not fed:
            some = [self.space + text.replace(" ", " " + self.space) for text in some]
        found = self.merger.encode_batch_fast(some, add_special_tokens=False)
        ids = np.concatenate([np.zeros(0, np.uint32), *(np.array(x.ids, np.uint32) for x in found)])
        at = np.flatnonzero(ids == self.feed if fed else self.spaced[ids])
        return ids, np.diff(at, append=len(ids))

    def _others(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same of words with their line feed, marks, and words that had a space before them."""
        texts = [word[1:] if word[:1] == MARK else word if word[:1] == "\n" else " " + word for word in words]
        found = [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return np.fromiter(chain.from_iterable(found), np.uint32), np.array([*map(len, found)], np.int64)

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids in a row, and where the slice of each word begins and how long it is."""
        plain = pc.match_substring_regex(words, f"^{LETTER}+$").to_numpy(zero_copy_only=False)
        fed = pc.match_substring_regex(words, f"^\n{LETTER}+$").to_numpy(zero_copy_only=False)
        rest = words.filter(pa.array(~(plain | fed))).to_pylist()
        parts = [self._merged(words.filter(pa.array(mask)), mask is fed) for mask in (plain, fed)]
        parts.append(self._others(rest))
        ids, counts = (np.concatenate(column) for column in zip(*parts))
        lengths, first = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        order = np.concatenate([np.flatnonzero(mask) for mask in (plain, fed, ~(plain | fed))])
        lengths[order], first[order] = counts, np.cumsum(counts) - counts
        return ids, first, lengths

    def __call__(self, rows: list[str]) -> list[np.ndarray]:
        """Ids of texts. Words are told apart by Arrow, and most are joined again without becoming objects."""
        usual = [not unusual("\n" + text) for text in rows]
        fed = pa.array(
            ["\n" + text.replace("\n", " \n") for text, good in zip(rows, usual) if good], pa.string()
        )
        marked = pc.replace_substring_regex(fed, f"({LETTER})([{MARKS}])( |$)", f"\\1 {MARK}\\2\\3")
        words = pc.split_pattern(marked, " ")
        coded = words.flatten().dictionary_encode()
        ids, first, lengths = self._words(coded.dictionary)
        of_word = coded.indices.to_numpy()
        ids, lengths = gathered(ids, first[of_word], lengths[of_word]), lengths[of_word]
        ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(lengths)])[words.offsets.to_numpy()]
        ready = iter([ids[a + 1 : b] for a, b in zip(ends, ends[1:])])
        return [next(ready) if good else np.array(self._ids(text), np.uint32) for text, good in zip(rows, usual)]


def cuts(length: int, tokens: int) -> list[int]:
    """Starts of the pieces of a document: full ones, but for the first."""
    first = (length - 1) % tokens + 1
    return [0, *range(first, length, tokens)]


def tokenized(docs: DataFrame, tokens: int = TOKENS, tokenizer: str | None = None) -> DataFrame:
    """Pieces of all documents: ``doc_id, piece, start, length, ids`` (little-endian uint32).

    A null text is empty; every document ends with the id 2, so each has a piece. Only documents of more than
    ``tokens`` ids are cut. Repeated rows are kept.
    """
    path = tokenizer or public_tokenizers.path(TOKENIZER)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = of_file(ByteIds, path)
        for batch in batches:
            for docs, some in _groups(batch):
                rows = []
                for doc, ids in zip(docs, encode(some)):
                    ids = np.append(ids, np.uint32(END_ID)).astype("<u4")
                    starts = cuts(len(ids), tokens)
                    for piece, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)])):
                        rows.append((doc, piece, a, b - a, ids[a:b].tobytes()))
                yield _batch(rows)

    return texts(docs).mapInArrow(run, PIECES)


def _groups(batch: pa.RecordBatch) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts of some rows at a time, one at least."""
    docs, some, size = [], [], 0
    for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
        docs.append(doc)
        some.append(text.as_py() or "")
        size += len(some[-1])
        if size > CHARACTERS:
            yield docs, some
            docs, some, size = [], [], 0
    if docs:
        yield docs, some


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"doc_id": pa.int64(), "piece": pa.int32(), "start": pa.int64(), "length": pa.int64(), "ids": pa.binary()}
    columns = list(zip(*rows)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds.values())], list(kinds))


@dataclass(frozen=True)
class Limits:
    """Capacities of a sequence. By default only tokens bind: documents and attention could not be used up sooner."""

    tokens: int = TOKENS
    documents: int = TOKENS
    attention: int = TOKENS * TOKENS

    @property
    def vector(self) -> np.ndarray:
        return np.array([self.tokens, self.documents, self.attention], np.int64)


def need(length: int) -> np.ndarray:
    """Room that a piece takes: tokens, documents, attention within it."""
    return np.array([length, 1, length * length], np.int64)


def demand(histogram: dict[int, int], limits: Limits) -> np.ndarray:
    """Weight of each dimension: how many sequences all pieces would fill in it alone, against the sum."""
    total = sum((need(n).astype(float) * count for n, count in histogram.items()), np.zeros(3)) / limits.vector
    return total / max(total.sum(), 1e-300)


class Open:
    """Open sequences by residual: a row of numbers per class, and the runs (first, count) of its sequences."""

    def __init__(self, limits: Limits, weights: np.ndarray, rule: str):
        self.limits, self.weights, self.rule = limits.vector, weights / limits.vector.astype(float) ** 2, rule
        self.residual = np.zeros((64, 3), np.int64)
        self.runs: list[list[tuple[int, int]]] = []
        self.at: dict[tuple, int] = {}

    def add(self, residual: np.ndarray, first: int, count: int) -> None:
        slot = self.at.setdefault(tuple(residual.tolist()), len(self.runs))
        if slot == len(self.runs):
            if slot == len(self.residual):
                self.residual = np.concatenate([self.residual, np.zeros_like(self.residual)])
            self.residual[slot] = residual
            self.runs.append([])
        self.runs[slot].append((first, count))

    def best(self, wanted: np.ndarray) -> int | None:
        """The class that the rule prefers among those with room; the smallest residual wins a tie."""
        room = self.residual[: len(self.runs)]
        fitting = np.flatnonzero((room >= wanted).all(axis=1))
        if not len(fitting):
            return None
        room = room[fitting].astype(float)
        if self.rule == "norm":
            score = ((room - wanted) ** 2 * self.weights).sum(axis=1)
        else:
            score = -(room * wanted * self.weights).sum(axis=1)
        ties = fitting[score == score.min()]
        return min(ties.tolist(), key=lambda slot: tuple(self.residual[slot]))

    def take(self, slot: int) -> tuple[np.ndarray, int, int]:
        """Residual, first sequence and number of a run of a class, which leaves it."""
        residual = self.residual[slot].copy()
        first, count = self.runs[slot].pop()
        if not self.runs[slot]:
            self._drop(slot)
        return residual, first, count

    def _drop(self, slot: int) -> None:
        """Take an empty class out; the last one moves to its place."""
        last = len(self.runs) - 1
        del self.at[tuple(self.residual[slot].tolist())]
        if slot != last:
            self.residual[slot], self.runs[slot] = self.residual[last], self.runs[last]
            self.at[tuple(self.residual[slot].tolist())] = slot
        self.runs.pop()


def plan(
    histogram: dict[int, int], limits: Limits = Limits(), rule: str = "norm", weights: np.ndarray | None = None
) -> list[tuple[int, int, int, int, int]]:
    """Runs ``(length, first rank, first sequence, pieces per sequence, offset)``.

    From its first rank to the next run's, pieces of a length go, so many to each, to sequences
    from the first on. Raises if a piece does not even fit a sequence of its own.
    """
    if rule not in ("norm", "dot"):
        raise ValueError(f"no such rule: {rule}")
    whole = limits.vector
    sequences = Open(limits, demand(histogram, limits) if weights is None else weights, rule)
    least = need(min(histogram, default=1))
    runs, opened = [], 0
    for length in sorted(histogram, reverse=True):
        wanted, rank, left = need(length), 0, histogram[length]
        if (wanted > whole).any():
            raise ValueError(f"a piece of {length} tokens fits no sequence")
        while left:
            slot = sequences.best(wanted)
            if slot is None:
                most = int((whole // wanted).min())
                residual, first, count, each = whole, opened, -(-left // most), most
                opened += count
            else:
                residual, first, count = sequences.take(slot)
                # a sequence that has the shortest residual has it all the more with another piece in it
                each = int((residual // wanted).min()) if rule == "norm" else 1
            full, rest = min(count, left // each), 0
            if full < count:
                rest = left - full * each
            offset = int(whole[0] - residual[0])
            after = [(full, each)] * (full > 0) + [(1, rest)] * (rest > 0)
            for number, pieces in after:
                runs.append((length, rank, first, pieces, offset))
                room = residual - pieces * wanted
                if (room >= least).all():
                    sequences.add(room, first, number)
                first, count = first + number, count - number
                rank, left = rank + number * pieces, left - number * pieces
            if count:
                sequences.add(residual, first, count)
    return runs


def numbered(pieces: DataFrame, length: int) -> DataFrame:
    """Pieces with ``_block``, the task that made them, and ``_row``, their place among equals there.

    Lengths are in the column at position ``length``.
    """
    names = [*pieces.columns, "_block", "_row"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId()
        seen: dict[int, int] = {}
        for batch in batches:
            rows = np.zeros(batch.num_rows, np.int64)
            lengths = batch.column(length).to_numpy(zero_copy_only=False)
            order = np.argsort(lengths, kind="stable")
            found, at, counts = np.unique(lengths[order], return_index=True, return_counts=True)
            for n, a, count in zip(found.tolist(), at.tolist(), counts.tolist()):
                rows[order[a : a + count]] = np.arange(count) + seen.get(n, 0)
                seen[n] = seen.get(n, 0) + count
            more = [pa.array(np.full(batch.num_rows, block, np.int64)), pa.array(rows)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names)

    return pieces.mapInArrow(run, f"{_kinds(pieces)}, _block long, _row long")


def _kinds(frame: DataFrame) -> str:
    return ", ".join(f"{n} {t}" for n, t in frame.dtypes)


def pack(pieces: DataFrame, limits: Limits = Limits(), rule: str = "norm") -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces with ``length``; other columns are carried along.

    Lengths run from 1 to ``limits.tokens``. No pieces give no rows.
    """
    own = [f"c{i}" for i in range(len(pieces.columns))]
    at = pieces.columns.index("length")
    kept = stored(numbered(pieces.toDF(*own), at).withColumn("_length", F.col(own[at])), "pieces")
    counts = kept.groupBy("_length", "_block").agg(F.count("*").alias("_n"))
    histogram = {r[0]: r[1] for r in counts.groupBy("_length").agg(F.sum("_n")).collect()}  # a row per length
    before = Window.partitionBy("_length").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("_length", "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    ranked = kept.join(bases, ["_length", "_block"]).select(*own, (F.col("_base") + F.col("_row")).alias("_rank"))
    kinds = _kinds(pieces.toDF(*own))
    placed = ranked.mapInArrow(_placer(sorted(plan(histogram, limits, rule)), at), f"{kinds}, sequence_id long, offset long")
    return placed.toDF(*pieces.columns, "sequence_id", "offset")


def _placer(runs: list[tuple[int, int, int, int, int]], column: int):
    """Look ranks, in the last column, up: the run with the largest (length, first rank) not above a piece's."""
    length, rank, sequence, each, offset = (np.array(c, np.int64) for c in zip(*runs or [(0, 0, 0, 1, 0)]))
    found, first = np.unique(length, return_index=True)
    spans = {int(n): (int(a), int(b)) for n, a, b in zip(found, first, [*first[1:], len(length)])}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column(column).to_numpy(zero_copy_only=False)
            ranks = batch.columns[-1].to_numpy(zero_copy_only=False)
            at = np.zeros(len(ranks), np.int64)
            for n in np.unique(lengths):
                a, b = spans[int(n)]
                mine = lengths == n
                at[mine] = a + np.searchsorted(rank[a:b], ranks[mine], side="right") - 1
            turn = ranks - rank[at]
            places = [pa.array(sequence[at] + turn // each[at]), pa.array(offset[at] + turn % each[at] * lengths)]
            names = [*batch.schema.names[:-1], "sequence_id", "offset"]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *places], names)

    return run


def best_fit(docs: DataFrame, limits: Limits = Limits(), rule: str = "norm") -> DataFrame:
    """Pieces of all documents, ids included, with their places."""
    return pack(tokenized(docs, limits.tokens), limits, rule)


def bins_query(docs: DataFrame) -> DataFrame:
    """Contract of the query: the checksum of a piece's ids goes through the packing instead of the ids."""
    pieces = tokenized(docs).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return pack(pieces).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )
