"""Problem 10: splitting oversized texts at natural boundaries.

Method: recursive bisection. A text is cut at the strongest boundary near its
midpoint, halves that still exceed the limit minus the overlap are cut again,
and overlaps are attached at the end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from foreglass.llm.tokens import VOCABULARY, Encoder, Merges, blocks, shared_merges

#: Strength of the boundary before a position: paragraph, line, sentence, word, inside a word.
PARAGRAPH, LINE, SENTENCE, WORD, INSIDE = 4, 3, 2, 1, 0

_BREAKS = regex.compile(r"(?P<paragraph>\n[^\S\n]*\n\s*)|(?P<line>\n)|(?P<sentence>[.!?…]+[\"'”’)\]]*\s+|[。！？]+[”」』）]*)")
#: A cut may lie this share of the tokens to each side of the midpoint.
SLACK = 0.25


class Ruler:
    """Character positions where a text may be cut, their strength, and the tokens before them."""

    def __init__(self, text: str, encoder: Encoder, words: list[str]):
        self.text = text
        known = encoder.known
        self.place = np.concatenate([[0], np.cumsum([len(w) for w in words], dtype=np.int64)])
        self.tokens = np.concatenate([[0.0], np.cumsum([len(known[w]) for w in words], dtype=float)])
        strength = np.zeros(len(text) + 2, np.int8)
        kinds = {"paragraph": PARAGRAPH, "line": LINE, "sentence": SENTENCE}
        for found in _BREAKS.finditer(text):
            strength[found.end()] = kinds[found.lastgroup]
        codes = np.frombuffer((text + "  ").encode("utf-32-le", "surrogatepass"), np.uint32)
        blank = (codes == 32) | ((codes >= 9) & (codes <= 13))
        # A blank that begins a word belongs to it: the boundary lies before the blank.
        before = codes[self.place] == 32
        ahead = np.where(before, strength[np.minimum(self.place + 1, len(text))], 0)
        word = np.where(before | ((self.place > 0) & blank[np.maximum(self.place - 1, 0)]), WORD, INSIDE)
        self.strength = np.maximum(np.maximum(strength[self.place], ahead), word)
        self.encoder, self.refined = encoder, False

    def count(self, begin: int, end: int) -> int:
        """Tokens of ``text[begin:end]``. Words depend on one character ahead at most, so only the last ones are split again."""
        if self.refined:
            return self.encoder.count(self.text[begin:end])
        a, b = int(np.searchsorted(self.place, begin)), int(np.searchsorted(self.place, end))
        last = max(a, b - 3)
        return int(self.tokens[last] - self.tokens[a]) + self.encoder.count(self.text[int(self.place[last]):end])

    def refine(self, index: int) -> int:
        """Put cuts at every character into the word after place ``index``; the number of new cuts."""
        self.refined = True
        a, b = int(self.place[index]), int(self.place[index + 1])
        if b - a < 2:
            return 0
        sizes = np.cumsum([len(c.encode("utf-8", "surrogatepass")) for c in self.text[a:b]])
        inner = self.tokens[index] + sizes[:-1] * (self.tokens[index + 1] - self.tokens[index]) / sizes[-1]
        self.place = np.insert(self.place, index + 1, np.arange(a + 1, b))
        self.tokens = np.insert(self.tokens, index + 1, inner)
        self.strength = np.insert(self.strength, index + 1, np.full(b - a - 1, INSIDE))
        return b - a - 1


def cut_positions(ruler: Ruler, limit: int) -> list[int]:
    """Places where the text is cut, so that no part has more than ``limit`` tokens by the ruler."""
    done: list[int] = []
    todo = [(0, len(ruler.place) - 1)]
    while todo:
        a, b = todo.pop()
        tokens = ruler.tokens
        low, high = tokens[a], tokens[b]
        if high - low <= limit:
            done.append(b)
            continue
        middle, slack = (low + high) / 2, (high - low) * SLACK
        first = max(a + 1, int(np.searchsorted(tokens, middle - slack)))
        last = min(b - 1, int(np.searchsorted(tokens, middle + slack, "right")) - 1)
        if first > last:  # one long word lies over the middle
            widest = a + int(np.argmax(np.diff(tokens[a:b + 1])))
            if added := ruler.refine(widest):
                done = [i + added if i > widest else i for i in done]
                todo = [(x + added if x > widest else x, y + added if y > widest else y) for x, y in todo]
                todo.append((a, b + added))
                continue
            if b - a == 1:  # a single character
                done.append(b)
                continue
            first = last = min(max(a + 1, int(np.searchsorted(tokens, middle))), b - 1)
        strength = ruler.strength[first:last + 1]
        strongest = first + np.flatnonzero(strength == strength.max())
        best = int(strongest[np.argmin(np.abs(tokens[strongest] - middle))])
        todo += [(a, best), (best, b)]
    return sorted(done)


def split_text(text: str, encoder: Encoder, limit: int = 512, overlap: int = 64, words: list[str] | None = None) -> list[tuple[int, int, int, int]]:
    """``(begin, core, end, tokens)`` of each piece, in characters: it holds ``text[begin:end]`` and repeats ``text[begin:core]``.

    The cores follow each other without gap; each piece has at most ``limit``
    tokens, counted on its own text.
    """
    if words is None:
        (words,) = encoder.words([text])
    whole = sum(len(encoder.known[w]) for w in words)
    if whole <= limit:
        return [(0, 0, len(text), whole)]
    ruler = Ruler(text, encoder, words)
    room = limit - overlap
    while True:
        cuts = cut_positions(ruler, room)  # may refine the ruler
        ends = [int(p) for p in ruler.place[cuts]]
        out, start, fits = [], 0, True
        for end in ends:
            begin = _overlap_begin(ruler, out[-1][1], start, overlap) if start else 0
            size = ruler.count(begin, end)
            # a cut may cost a token or two on each side of it
            while begin < start and (size > limit or ruler.count(begin, start) > overlap):
                begin = int(ruler.place[np.searchsorted(ruler.place, begin, "right")])
                size = ruler.count(begin, end)
            fits &= size <= limit or end - start == 1
            out.append((begin, start, end, size))
            start = end
        if fits:
            return out
        room = room * 3 // 4
        ruler = Ruler(text, encoder, encoder.words([text])[0])


def _overlap_begin(ruler: Ruler, previous: int, start: int, overlap: int) -> int:
    """Where the overlap before ``start`` begins: the first natural boundary within ``overlap`` tokens, not before ``previous``."""
    at = int(np.searchsorted(ruler.place, start))
    first = int(np.searchsorted(ruler.tokens, ruler.tokens[at] - overlap))
    natural = np.flatnonzero(ruler.strength[first:at] > INSIDE)
    return max(previous, int(ruler.place[first + natural[0] if len(natural) else first]))


def split_block(texts: list[str], encoder: Encoder, limit: int = 512, overlap: int = 64) -> Iterator[tuple[int, int, tuple[int, int, int, int]]]:
    """``(place in the block, number, piece)`` of the texts over ``limit`` tokens, pieces as in ``split_text``."""
    encoder.forget()  # only here: the words of the whole block are looked up until its end
    split = encoder.words(texts)
    for i, (text, words) in enumerate(zip(texts, split, strict=True)):
        if sum(len(encoder.known[w]) for w in words) > limit:
            for number, piece in enumerate(split_text(text, encoder, limit, overlap, words)):
                yield i, number, piece


def pieces(df: DataFrame, identifier: str, text: str, limit: int = 512, overlap: int = 64, path: str = VOCABULARY) -> DataFrame:
    """``(identifier, piece, begin, core, end, tokens, text)`` of every text over ``limit`` tokens, numbered from 0.

    ``begin``, ``core`` and ``end`` are character positions; ``begin`` to
    ``core`` repeats the end of the piece before, at most ``overlap`` tokens. A
    text within the limit, null or empty gives no row. A word longer than the
    limit is cut between characters; a single character is never cut. Each row
    stands for itself: repeated identifiers repeat their pieces, and nothing is
    shuffled.
    """
    if not 0 <= overlap < limit:
        raise ValueError("overlap must be smaller than limit")
    merges = shared_merges(df.sparkSession, path)
    # A text has at most as many tokens as bytes.
    long = df.select(df[identifier].alias("id"), df[text].alias("text")).filter(F.octet_length("text") > limit)
    kind = long.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(Merges(*merges.value))
        for block in blocks(batches):
            texts = block.column("text").to_pylist()
            source, out = [], []
            for i, number, piece in split_block(texts, encoder, limit, overlap):
                source.append(i)
                out.append((number, *piece, texts[i][piece[0]:piece[2]]))
            if source:
                numbers = [pa.array([o[k] for o in out], pa.int32()) for k in range(5)]
                yield pa.RecordBatch.from_arrays([block.column("id").take(pa.array(np.array(source))), *numbers, pa.array([o[5] for o in out], pa.string())], names=["id", "piece", "begin", "core", "end", "tokens", "text"])

    out = long.mapInArrow(run, f"id {kind}, piece int, begin int, core int, end int, tokens int, text string")
    return out.withColumnRenamed("id", identifier)
