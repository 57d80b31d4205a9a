"""Problems 8 and 10 with more distinct words than a task remembers."""

import random

import pytest

from foreglass.llm import tokens
from foreglass.llm.pieces import split_block, split_text
from foreglass.llm.tokens import Encoder, Merges, load


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(8)) + rng.choice(["", "", ".", ".\n\n"]) for _ in range(n))


@pytest.mark.parametrize("remembered", [0, 5, 2000])
def test_pieces_when_words_are_forgotten(monkeypatch, remembered):
    merges = Merges(*load())
    rng = random.Random(remembered)
    blocks = [[words(rng, rng.choice([3, 300, 900])) for _ in range(4)] + ["x" * 3000] for _ in range(3)]
    expected = [[(i, k, p) for i, t in enumerate(block) for k, p in enumerate(split_text(t, Encoder(merges))) if Encoder(merges).count(t) > 512] for block in blocks]
    monkeypatch.setattr(tokens, "REMEMBERED_WORDS", remembered)
    encoder = Encoder(merges)
    assert [list(split_block(block, encoder)) for block in blocks] == expected
    encoder.forget()
    assert len(encoder.known) <= remembered
