"""The shared table of prefixes holds no more than the pieces need, with the same encodings."""

import random

import public_tokenizers
import pytest

from quern.llm import bpe


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary(bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")))


def test_only_needed_prefixes_are_worked_out(vocabulary):
    draw = random.Random(8)
    words = ["".join(draw.choices("aeiounrstldhéñß '1", k=draw.randrange(1, 20))) for _ in range(3000)]
    pieces = [w.encode()[: bpe.LONGEST_PREFIX] for w in words] + [bytes(draw.choices(range(256), k=9)) for _ in range(500)]
    encoder = bpe.Encoder(vocabulary, public_tokenizers.PATTERN)
    for piece in pieces:
        whole = vocabulary.ranks.get(piece)
        expected = [whole] if whole is not None else vocabulary.walk(piece, vocabulary.last_lengths(piece, []))
        assert encoder.encode_piece(piece) == expected
    prefixes = {p[:end] for p in pieces if p not in vocabulary.ranks for end in range(1, len(p) + 1)}
    assert set(encoder._last) <= prefixes and len(encoder._last) < 0.8 * len(prefixes)


def test_a_vocabulary_that_lacks_a_byte():
    encoder = bpe.Encoder(bpe.Vocabulary({b"a": 0, b"b": 1, b"ab": 2}), ".+")
    assert encoder.encode("abab") == [2, 2]
    with pytest.raises(ValueError, match="lacks a byte"):
        encoder.encode("abxa")
