"""SentencePiece models run by the tokenizers library, encoding and decoding with checked parity.

The model's protobuf is parsed here. Its normaliser, white-space mark, scores and byte fallback are rebuilt
as a tokenizer: a unigram model from its scores, a byte-pair model with merges in order of the
scores of what they make. The library encodes batches with several threads.

Pieces never run across the start of a word (a mark after something else) unless the vocabulary has such a
piece, which is checked. So a text is encoded word by word, each distinct word once per task, and
every such word is compared with SentencePiece itself, in both directions.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.tables import texts
from tickloom.llm.wordcache import Encoded, WordCache, flat, of_file

MODEL = "piece_bpe_32k.model"
MARK = "▁"
#: Kinds of pieces and of models: fixed values of the format.
NORMAL, UNK, CONTROL, USER, BYTE = 1, 2, 3, 4, 6
UNIGRAM, BPE = 1, 2
#: Threads of the library in a task, texts whose words are encoded together; no result depends on these.
THREADS, TOGETHER = 2, 500


def fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of a protobuf message: ints, 4 or 8 raw bytes, or bytes."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = number()
        kind = key & 7
        if kind == 0:
            yield key >> 3, number()
            continue
        size = {1: 8, 5: 4}.get(kind) or number()
        yield key >> 3, data[at : at + size]
        at += size


class Model:
    """What a model file says: pieces (text, score, kind), kind of model, normaliser, special ids."""

    def __init__(self, data: bytes):
        self.pieces: list[tuple[str, float, int]] = []
        trainer: dict[int, object] = {}
        normal: dict[int, object] = {}
        for number, value in fields(data):
            if number == 1:
                piece = dict(fields(value))
                score = float(np.frombuffer(piece.get(2, b"\0\0\0\0"), "<f4")[0])
                self.pieces.append((piece.get(1, b"").decode(), score, piece.get(3, NORMAL)))
            elif number == 2:
                trainer = dict(fields(value))
            elif number == 3:
                normal = dict(fields(value))
        self.kind = trainer.get(3, UNIGRAM)
        self.byte_fallback = bool(trainer.get(35, 0))
        self.charsmap = normal.get(2, b"")
        self.dummy_prefix = bool(normal.get(3, 1))
        self.trim = bool(normal.get(4, 1))
        self.ids = {text: i for i, (text, _, _) in enumerate(self.pieces)}
        self.unk = next((i for i, p in enumerate(self.pieces) if p[2] == UNK), 0)

    def merges(self) -> list[tuple[str, str]]:
        """Pairs of pieces that make a piece, best score of the result first."""
        usable = {t for t, _, kind in self.pieces if kind in (NORMAL, USER)}
        found = []
        for text, score, kind in self.pieces:
            if kind == NORMAL:
                for cut in range(1, len(text)):
                    left, right = text[:cut], text[cut:]
                    if left in usable and right in usable:
                        found.append((-score, self.ids[left], self.ids[right], left, right))
        return [(left, right) for *_, left, right in sorted(found)]

    def tokenizer(self):
        """The tokenizers-library form; it takes one word that already has its mark."""
        from tokenizers import Tokenizer, decoders, models, normalizers

        vocabulary = {t: i for i, (t, _, _) in enumerate(self.pieces)}
        if self.kind == UNIGRAM:
            scored = [(t, s) for t, s, _ in self.pieces]
            tokenizer = Tokenizer(models.Unigram(scored, unk_id=self.unk, byte_fallback=self.byte_fallback))
        elif self.kind == BPE:
            unk = self.pieces[self.unk][0]
            tokenizer = Tokenizer(
                models.BPE(vocabulary, self.merges(), unk_token=unk, fuse_unk=True, byte_fallback=self.byte_fallback)
            )
        else:
            raise ValueError(f"no unigram or byte-pair model: kind {self.kind}")
        steps = [normalizers.Precompiled(self.charsmap)] if self.charsmap else []
        tokenizer.normalizer = normalizers.Sequence([*steps, normalizers.Replace(" ", MARK)])
        tokenizer.decoder = decoders.Sequence(
            [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
        )
        return tokenizer

    def crossing(self) -> list[str]:
        """Pieces that would run across the start of a word."""
        return [t for t, _, kind in self.pieces if kind in (NORMAL, USER) and MARK in t.lstrip(MARK)]


class Codec:
    """Encodes and decodes texts word by word and counts words on which the backends differ."""

    #: Spaces with the word after them, or spaces at the end.
    WORD = re.compile(r" *[^ ]+| +")

    def __init__(self, path: str, threads: int = THREADS):
        os.environ["TOKENIZERS_PARALLELISM"], os.environ["RAYON_NUM_THREADS"] = "true", str(threads)
        import sentencepiece

        with open(path, "rb") as file:
            self.model = Model(file.read())
        if self.model.crossing() or self.model.charsmap or self.model.trim:
            # white space is then rewritten before it is cut, so only whole texts are safe
            self.WORD = re.compile(r"(?s).+")
        self.tokenizer = self.model.tokenizer()
        self.reference = sentencepiece.SentencePieceProcessor(model_file=path)
        self.cache = WordCache(self._encode)

    def _encode(self, words: list[str]) -> Encoded:
        """Ids of words, all threads at once, and whether SentencePiece agrees both ways."""
        encoded = [x.ids for x in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        decoded = self.tokenizer.decode_batch(encoded, skip_special_tokens=False)
        expected = self.reference.encode([self._as_first(w) for w in words], num_threads=1)
        back = self.reference.decode(encoded)
        same = []
        for word, ids, text, other, original in zip(words, encoded, decoded, expected, back):
            if word == " ":  # the prefix alone, which SentencePiece does not add to an empty text
                other = [self.reference.piece_to_id(MARK)]
            same.append(ids == other and self._bare(text) == original)
        return words, *flat(encoded, same)

    def _as_first(self, word: str) -> str:
        """A word as SentencePiece must get it, for the prefix that it adds itself."""
        return word[1:] if self.model.dummy_prefix and word[:1] == " " else word

    def prepared(self, text: str) -> str:
        if not text:
            return ""
        return " " + text if self.model.dummy_prefix else text

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, bool]]:
        """Ids of texts and whether both backends agree on all words of a text."""
        return self.cache([self.WORD.findall(self.prepared(text)) for text in texts])

    def decode(self, ids: list[int]) -> str:
        """The text of ids; the prefix that encoding put in front goes."""
        return self._bare(self.tokenizer.decode(ids, skip_special_tokens=False))

    def _bare(self, text: str) -> str:
        return text[1:] if self.model.dummy_prefix and text[:1] == " " else text


def encoded(docs: DataFrame, model: str | None = None) -> DataFrame:
    """``doc_id, ids, same``: ids (little-endian uint32) of every whole text, null as empty, and parity."""
    path = model or public_tokenizers.path(MODEL)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = of_file(Codec, path)
        for batch in batches:
            for part in (batch.slice(i, TOGETHER) for i in range(0, batch.num_rows, TOGETHER)):
                found = codec.encode([t.as_py() or "" for t in part.column(1)])
                ids = pa.array([x.astype("<u4").tobytes() for x, _ in found], pa.binary())
                same = pa.array([mark for _, mark in found], pa.bool_())
                yield pa.RecordBatch.from_arrays([part.column(0), ids, same], ["doc_id", "ids", "same"])

    return texts(docs).mapInArrow(run, "doc_id long, ids binary, same boolean")


def decoded(rows: DataFrame, model: str | None = None) -> DataFrame:
    """``doc_id, ids`` to ``doc_id, text``."""
    path = model or public_tokenizers.path(MODEL)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(path)
        for batch in batches:
            back = [codec.decode(np.frombuffer(x.as_py() or b"", "<u4").tolist()) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(back, pa.string())], ["doc_id", "text"])

    return rows.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def pieces_query(docs: DataFrame) -> DataFrame:
    return encoded(docs).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_pieces"),
        F.crc32("ids").alias("ids_crc32"),
        F.col("same").alias("parity"),
    )
