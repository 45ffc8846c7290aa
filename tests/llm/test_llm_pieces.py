import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_brute import documents, hard_texts

from tickloom.llm import pieces

PATH = public_tokenizers.path(pieces.MODEL)


@pytest.fixture(scope="module")
def processor():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


CODEC = pieces.Codec(PATH)


@settings(max_examples=400, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"], exclude_characters="\0") | st.sampled_from("  \n▁é你"), max_size=80))
def test_same_as_sentencepiece(text):
    processor = CODEC.reference
    ids, same = CODEC.encode([text])[0]
    assert same and ids.tolist() == processor.encode(text)
    assert CODEC.decode(ids.tolist()) == processor.decode(ids.tolist())


@settings(max_examples=200, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"], exclude_characters="\0▁"), max_size=80))
def test_exact_round_trip(text):
    ids, _ = CODEC.encode([text])[0]
    assert CODEC.decode(ids.tolist()) == text


def test_model_file_is_parsed(processor):
    model = CODEC.model
    assert len(model.pieces) == processor.vocab_size()
    for i in (0, 1, 3, 300, 5000, 31_999):
        assert model.pieces[i][0] == processor.id_to_piece(i)
        assert model.pieces[i][1] == pytest.approx(processor.get_score(i))
    assert (model.kind, model.byte_fallback, model.dummy_prefix, model.crossing()) == (pieces.BPE, True, True, [])


def varint(n):
    out = b""
    while True:
        n, low = n >> 7, n & 127
        out += bytes([low | 128 if n else low])
        if not n:
            return out


def field(number, value):
    if isinstance(value, int):
        return varint(number << 3) + varint(value)
    if isinstance(value, float):
        return varint(number << 3 | 5) + np.array(value, "<f4").tobytes()
    return varint(number << 3 | 2) + varint(len(value)) + value


def unigram_file(path):
    """A small unigram model with byte fallback, written by hand."""
    entries = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)]
    entries += [(f"<0x{b:02X}>", -20.0, 6) for b in range(256)]
    entries += [("▁", -3.0, 1), ("a", -4.0, 1), ("b", -4.0, 1), ("▁ab", -4.5, 1), ("ab", -5.0, 1), ("ba", -5.5, 1), ("▁a", -4.2, 1)]
    data = b"".join(field(1, field(1, t.encode()) + field(2, s) + field(3, k)) for t, s, k in entries)
    data += field(2, field(3, pieces.UNIGRAM) + field(35, 1)) + field(3, field(1, b"identity") + field(3, 1) + field(4, 0))
    path.write_bytes(data)
    return str(path)


def test_unigram_scores(tmp_path):
    path = unigram_file(tmp_path / "unigram.model")
    codec = pieces.Codec(path)
    processor = sentencepiece.SentencePieceProcessor(model_file=path)
    for text in ("ab", "abab ba", "a b ab", "  ab", "aé b"):
        ids, same = codec.encode([text])[0]
        assert ids.tolist() == processor.encode(text) and same, text
        assert codec.decode(ids.tolist()) == text


def test_query_over_odd_rows(spark, processor):
    texts = hard_texts(random.Random(41))
    rows = pieces.pieces_query(documents(spark, texts)).collect()
    expected = []
    for i, text in texts:
        ids = processor.encode(text or "")
        expected.append((repr(i), len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), True))
    assert sorted((repr(r.doc_id), r.n_pieces, r.ids_crc32, r.parity) for r in rows) == sorted(expected)
    assert pieces.pieces_query(documents(spark, {})).count() == 0


def test_decoding_whole_documents(spark):
    texts = hard_texts(random.Random(42))
    back = pieces.decoded(pieces.encoded(documents(spark, texts)))
    assert sorted((repr(r.doc_id), r.text) for r in back.collect()) == sorted((repr(i), t or "") for i, t in texts)


def test_difference_is_reported():
    codec = pieces.Codec(PATH)
    plain = codec.reference

    class Other:
        def encode(self, words, num_threads):
            return [ids[:-1] for ids in plain.encode(words, num_threads=1)]

        decode = plain.decode
        piece_to_id = plain.piece_to_id

    codec.reference = Other()
    assert [same for _, same in codec.encode(["some words", ""])] == [False, True]
