"""Problems 8 and 10: token ids and pieces."""

import random

import pytest
from hypothesis import given, settings, strategies as st

tokenizers = pytest.importorskip("tokenizers")

from foreglass.llm.pieces import pieces, split_text  # noqa: E402
from foreglass.llm.tokens import VOCABULARY, Encoder, Merges, encode, load  # noqa: E402


@pytest.fixture(scope="module")
def reference():
    t = tokenizers.Tokenizer.from_file(VOCABULARY)
    t.encode_special_tokens = True
    return t


@pytest.fixture(scope="module")
def encoder():
    return Encoder(Merges(*load()))


TEXTS = ["", " ", "hello world", "don't  stop\n\n\tnow  ", "<|endoftext|> is text", "naïve Ünïcode 漢字かな 🎈🎈 русский", "a" * 3000, "1234567890" * 50, "  x", "aaaa aaaa baab" * 20, "é" * 400 + "\n" * 50]


def test_ids_equal_the_reference(encoder, reference):
    expected = [e.ids for e in reference.encode_batch(TEXTS, add_special_tokens=False)]
    assert encoder.ids(TEXTS) == expected
    assert [encoder.count(t) for t in TEXTS] == [len(e) for e in expected]


@settings(max_examples=150, deadline=None)
@given(st.text(st.characters(codec="utf-8", max_codepoint=0x2FFF, exclude_categories=("Cn", "Cs", "Co"))))
def test_any_text_equals_the_reference(encoder, reference, text):
    assert encoder.ids([text])[0] == reference.encode(text, add_special_tokens=False).ids


def test_table_of_ids(spark, reference):
    rows = [(i, t, "x") for i, t in enumerate([*TEXTS, None])] + [(0, "again", "x"), (None, "no id", "x")]
    got = encode(spark.createDataFrame(rows, "doc_id long, text string, ids string"), "doc_id", "text").collect()
    assert len(got) == len(rows)
    expected = sorted((r[0] if r[0] is not None else -1, reference.encode(r[1] or "", add_special_tokens=False).ids) for r in rows)
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.ids) for r in got) == expected
    assert encode(spark.createDataFrame([], "doc_id long, text string"), "doc_id", "text").count() == 0


def story(seed, n):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeéfgh漢🎈") for _ in range(rng.randrange(1, 9)))
    return "".join(word() + rng.choice([" "] * 8 + [". ", ".\n", "\n\n", ",  ", "? "]) for _ in range(n))


@pytest.mark.parametrize("text", [story(0, 900), story(1, 3000), "a" * 9000, "字" * 4000, " " * 9000, "\n" * 5000, "x y " * 3000, "🎈" * 3000])
@pytest.mark.parametrize("limit,overlap", [(512, 64), (40, 8), (30, 0)])
def test_pieces_cover_the_text_within_the_limit(encoder, reference, text, limit, overlap):
    out = split_text(text, encoder, limit, overlap)
    assert out[0][0] == out[0][1] == 0 and out[-1][2] == len(text)
    assert "".join(text[core:end] for _, core, end, _ in out) == text
    for k, (begin, core, end, tokens) in enumerate(out):
        assert begin <= core < end and tokens == len(reference.encode(text[begin:end], add_special_tokens=False).ids) <= limit
        assert len(reference.encode(text[begin:core], add_special_tokens=False).ids) <= overlap
        assert k == 0 or core == out[k - 1][2] and begin >= out[k - 1][1]


def test_cuts_lie_at_the_strongest_boundaries(encoder):
    paragraph = "One plain sentence of some words stands here. " * 8
    text = "\n\n".join([paragraph.strip()] * 9)
    for _, core, _, _ in split_text(text, encoder, 120, 16)[1:]:
        assert text[:core].endswith(("\n\n", ". ", ".")) and (core == len(text) or text[core] in "\nO ")


def test_table_of_pieces(spark, encoder):
    long, edge = story(2, 1500), "a b" * 170
    rows = [(1, long), (2, None), (3, ""), (4, "short"), (5, edge)]
    got = pieces(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text").collect()
    assert {r.doc_id for r in got} == {i for i, t in rows if t and encoder.count(t) > 512}
    own = sorted((r for r in got if r.doc_id == 1), key=lambda r: r.piece)
    assert [r.piece for r in own] == list(range(len(own))) and all(r.text == long[r.begin:r.end] for r in own)
    with pytest.raises(ValueError):
        pieces(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text", 10, 10)
