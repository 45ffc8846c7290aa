"""Packing of tokenized documents by shortest-pack-first over the length histogram.

Documents become token ids and are cut into pieces of at most ``capacity`` ids. Only the histogram
of piece lengths, at most ``capacity`` numbers, reaches the driver. There lengths are placed longest
first, each into the open packs that hold least; packs with the same content stay one pattern with a
count, which is split when only part of it gets a length. Every placement is a run of ranks within
a length, so the plan is joined back to the pieces by rank. Ranks come from counts per length and
stored block, never from one task that sees a whole length.
"""

from __future__ import annotations

import heapq
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.tables import stored, texts
from tickloom.llm.wordcache import Encoded, WordCache, flat, of_file

CAPACITY = 2048
END_ID = 1
TOKENIZER = "word_bpe_49k.json"
#: A token that the vocabulary knows as special.
BETWEEN = "<|startoftext|>"
#: What keeps a text from being lower-cased here: letters beyond Latin, a dotted capital i, special tokens.
UNUSUAL = re.compile(r"[^\x00-\u012f\u0131-\u024f]|<\|")
STOP = re.compile(r"(?<=[A-Za-z0-9])([.,])(?= |$)")
#: Texts whose words are encoded together, and words in a batch; no result depends on it.
TOGETHER = 500

PIECES = "doc_id long, start long, length long, doc_tokens long, ids binary"


class TokenIds:
    """Ids of texts by the tokenizers library.

    Its normaliser and splitter treat a space or line feed as a border that nothing crosses, so
    the ids of a text are those of its words in a row.
    """

    def __init__(self, path: str):
        # a task has one core; the other ones have tasks of their own
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.between = self.tokenizer.token_to_id(BETWEEN)
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        self.last[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.cache = WordCache(self._encode)

    def _encode(self, words: list[str]) -> Encoded:
        plain = [w for w in words if w.isalpha()]
        rest = [w for w in words if not w.isalpha()]
        parts = [part for part in (self._letters(plain), self._any(rest)) if part]
        return [*plain, *rest], *(np.concatenate(column) for column in zip(*parts))

    def _letters(self, words: list[str]) -> tuple[np.ndarray, ...] | None:
        """Many words of letters in one text: each is one run for the splitter, whose last id says so.

        Other white space than words have between them does not occur, so as many last ids as words
        are one for each; if the library's idea of a letter differs, they are encoded apart.
        """
        if not words:
            return None
        ids = self._row([" ".join(words[i : i + TOGETHER]) for i in range(0, len(words), TOGETHER)])
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) != len(words):
            return self._any(words)
        return ids, np.diff(ends, prepend=0), np.ones(len(words), bool)

    def _any(self, words: list[str]) -> tuple[np.ndarray, ...] | None:
        """Any words in one text, with a special token between them."""
        if not words:
            return None
        if any(BETWEEN[:2] in word for word in words):
            return flat([x.ids for x in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)])
        ids = self._row([BETWEEN.join(["", *words[i : i + TOGETHER]]) for i in range(0, len(words), TOGETHER)])
        starts = np.flatnonzero(ids == self.between)
        lengths = np.diff(starts, append=len(ids)) - 1
        return ids[ids != self.between], lengths, np.ones(len(words), bool)

    def _row(self, texts: list[str]) -> np.ndarray:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return np.concatenate([np.array(x.ids, np.uint32) for x in found])

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        return [ids for ids, _ in self.cache([plainer(text).split(" ") for text in texts])]


def plainer(text: str) -> str:
    """A text of the same ids with fewer different words.

    The vocabulary has no capitals, so Latin letters that lower-casing maps one to one are mapped here;
    a full stop or comma between a letter or digit and white space is a token of its own.
    """
    text = text.replace("\n", " ")
    if not UNUSUAL.search(text):
        text = text.lower()
    return STOP.sub(r" \1", text)


def tokenized(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None) -> DataFrame:
    """Pieces of all documents: ``doc_id, start, length, doc_tokens, ids`` (little-endian uint32).

    A null text is empty; every document ends with the id 1, so each has a piece. A document of
    more than ``capacity`` ids is cut every ``capacity`` ids. Repeated rows are kept.
    """
    path = tokenizer or public_tokenizers.path(TOKENIZER)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = of_file(TokenIds, path)
        for batch in batches:
            for part in (batch.slice(i, TOGETHER) for i in range(0, batch.num_rows, TOGETHER)):
                rows: list[tuple] = []
                found = encode([text.as_py() or "" for text in part.column(1)])
                for doc, ids in zip(part.column(0).to_pylist(), found):
                    ids = np.append(ids, np.uint32(END_ID)).astype("<u4")
                    for start in range(0, len(ids), capacity):
                        piece = ids[start : start + capacity]
                        rows.append((doc, start, len(piece), len(ids), piece.tobytes()))
                yield _batch(rows)

    return texts(docs).mapInArrow(run, PIECES)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = ["doc_id", "start", "length", "doc_tokens", "ids"]
    kinds = [pa.int64()] * 4 + [pa.binary()]
    columns = list(zip(*rows)) or [()] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def pack_histogram(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Runs ``(length, first rank, ranks, first sequence, offset)`` of a packing.

    Ranks ``first .. first + ranks`` of a length go, one each, to as many consecutive
    sequences, at the same offset. Open patterns are kept by what they hold already.
    """
    runs = []
    open_packs: list[tuple[int, int, int]] = []  # (held, first sequence, sequences)
    sequences = 0
    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            if open_packs and open_packs[0][0] + length <= capacity:
                held, first, count = heapq.heappop(open_packs)
                take = min(count, left)
                if take < count:
                    heapq.heappush(open_packs, (held, first + take, count - take))
            else:
                held, first, take = 0, sequences, left
                sequences += take
            runs.append((length, rank, take, first, held))
            if held + length < capacity:
                heapq.heappush(open_packs, (held + length, first, take))
            rank += take
            left -= take
    return runs


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces with ``doc_id, start, length``.

    Lengths run from 1 to ``capacity``. Other columns are carried along, so drop large ones first.
    """
    names = pieces.columns
    kept = stored(pieces.withColumn("_block", F.spark_partition_id()), "pieces")
    counts = kept.groupBy("length", "_block").agg(F.count("*").alias("_n"))
    histogram = {r[0]: r[1] for r in counts.groupBy("length").agg(F.sum("_n")).collect()}
    runs = sorted(pack_histogram(histogram, capacity))
    before = Window.partitionBy("length").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(
        "length", "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base")
    )
    within = Window.partitionBy("length", "_block").orderBy("doc_id", "start")
    ranked = kept.withColumn("_row", F.row_number().over(within) - 1).join(bases, ["length", "_block"])
    ranked = ranked.select(*names, (F.col("_base") + F.col("_row")).alias("_rank"))
    return ranked.mapInArrow(_placer(runs, names), _placed_schema(kept.select(names)))


def _placed_schema(frame: DataFrame) -> str:
    return ", ".join(f"`{n}` {t}" for n, t in frame.dtypes) + ", sequence_id long, offset long"


def _placer(runs: list[tuple], names: list[str]):
    """Look ranks up in the runs; a run is found by the largest (length, first rank) not above."""
    length, first, _, sequence, offset = (np.array(c, np.int64) for c in zip(*runs or [(0,) * 5]))
    starts = {int(n): (int(a), int(b)) for n, a, b in _spans(length)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column("length").to_numpy(zero_copy_only=False)
            ranks = batch.column("_rank").to_numpy(zero_copy_only=False)
            at = np.zeros(len(ranks), np.int64)
            for n in np.unique(lengths):
                a, b = starts[int(n)]
                mine = lengths == n
                at[mine] = a + np.searchsorted(first[a:b], ranks[mine], side="right") - 1
            columns = [batch.column(n) for n in names]
            columns += [pa.array(sequence[at] + ranks - first[at]), pa.array(offset[at])]
            yield pa.RecordBatch.from_arrays(columns, [*names, "sequence_id", "offset"])

    return run


def _spans(values: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Each value of a sorted array with the slice it fills."""
    found, at = np.unique(values, return_index=True)
    return zip(found, at, [*at[1:], len(values)])


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None) -> DataFrame:
    """Contract of the query: one row per piece with the checksum of its ids, without the ids."""
    pieces = tokenized(docs, capacity, tokenizer)
    pieces = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return pack(pieces, capacity).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )
