"""Problem 8: encoding the corpus with a public byte-level BPE tokenizer.

Method: merge replay over the word index of a corpus block. All distinct words
of the block stand in one linked list; an inverted index leads from each token
pair to its word positions; merges are applied in rank order and touch only
the neighbours of a merged pair.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession

# Fixed value: the public split pattern of the tokenizer.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Default place of the vocabulary file, read on the driver only.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"

#: Characters of text whose words are replayed together, and words whose ids a task remembers from block to block.
BLOCK_CHARS = 2_000_000
REMEMBERED_WORDS = 400_000


def byte_letters() -> list[str]:
    """The letter that stands for each byte in the vocabulary file: printable Latin-1 bytes for themselves, the rest from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, free = {b: chr(b) for b in printable}, 256
    for b in range(256):
        if b not in letters:
            letters[b] = chr(free)
            free += 1
    return [letters[b] for b in range(256)]


def load(path: str = VOCABULARY) -> tuple[list[int], list[int], list[int], list[int]]:
    """Ids of the single bytes; left, right and merged id of each merge in rank order (about 1 MB together)."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    vocab = model["vocab"]
    pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    return [vocab[x] for x in byte_letters()], [vocab[a] for a, _ in pairs], [vocab[b] for _, b in pairs], [vocab[a + b] for a, b in pairs]


class Merges:
    """The merge table with the rank of each pair."""

    def __init__(self, of_bytes: list[int], left: list[int], right: list[int], whole: list[int]):
        self.bytes, self.left, self.right, self.whole = of_bytes, left, right, whole
        self.rank = {a << 20 | b: r for r, (a, b) in enumerate(zip(left, right, strict=True))}


def replay(words: list[str], merges: Merges) -> list[tuple[int, ...]]:
    """Token ids of each word."""
    token: list[int] = []
    starts = []
    after: list[int] = []
    before: list[int] = []
    for word in words:
        start = len(token)
        starts.append(start)
        token += [merges.bytes[b] for b in word.encode("utf-8", "surrogatepass")]
        end = len(token)
        after += range(start + 1, end + 1)
        before += range(start - 1, end - 1)
        if end > start:
            after[-1], before[start] = -1, -1
    rank = merges.rank
    places: dict[int, list[int]] = {}
    for p, q in enumerate(after):
        if q >= 0 and (r := rank.get(token[p] << 20 | token[q])) is not None:
            places.setdefault(r, []).append(p)
    queue = list(places)
    heapq.heapify(queue)

    def note(p: int, q: int) -> None:
        r = rank.get(token[p] << 20 | token[q])
        if r is not None:
            if r in places:
                places[r].append(p)
            else:
                places[r] = [p]
                heapq.heappush(queue, r)

    while queue:
        r = heapq.heappop(queue)
        left, right, whole = merges.left[r], merges.right[r], merges.whole[r]
        for p in sorted(places.pop(r)):
            q = after[p]
            if token[p] != left or q < 0 or token[q] != right:
                continue
            token[p], token[q] = whole, -1
            after[p] = following = after[q]
            if following >= 0:
                before[following] = p
                note(p, following)
            if (previous := before[p]) >= 0:
                note(previous, p)
    out = []
    for start, end in zip(starts, [*starts[1:], len(token)], strict=True):
        out.append(tuple(t for t in token[start:end] if t >= 0))
    return out


class Encoder:
    """Splits texts into words and remembers the ids of words already replayed.

    Words stay known until ``forget``, which belongs between blocks only: what
    ``words`` returned may be looked up in ``known`` until then.
    """

    def __init__(self, merges: Merges):
        self.merges, self.known, self.split = merges, {}, regex.compile(PATTERN).findall

    def words(self, texts: Iterable[str]) -> list[list[str]]:
        split = [self.split(t) for t in texts]
        known = self.known
        if new := list({w for words in split for w in words if w not in known}):
            known.update(zip(new, replay(new, self.merges), strict=True))
        return split

    def forget(self) -> None:
        """Drop the remembered words if there are too many."""
        if len(self.known) > REMEMBERED_WORDS:
            self.known.clear()

    def ids(self, texts: list[str]) -> list[list[int]]:
        known = self.known
        return [[i for w in words for i in known[w]] for words in self.words(texts)]

    def count(self, text: str) -> int:
        known = self.known
        (words,) = self.words([text])
        return sum(len(known[w]) for w in words)


def blocks(batches: Iterator[pa.RecordBatch], text: str = "text", chars: int = BLOCK_CHARS) -> Iterator[pa.RecordBatch]:
    """Slices of the batches that hold about ``chars`` bytes of text or a single row."""
    for batch in batches:
        sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)) if batch.num_rows else []
        at = 0
        while at < batch.num_rows:
            done = sizes[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(sizes, done + chars, "right")))
            yield batch.slice(at, end - at)
            at = end


def shared_merges(spark: SparkSession, path: str = VOCABULARY):
    """The merge table as a broadcast; its size is that of the vocabulary, whatever the data's."""
    return spark.sparkContext.broadcast(load(path))


def encode(df: DataFrame, identifier: str, text: str, path: str = VOCABULARY) -> DataFrame:
    """``(identifier, ids)``: the token ids of every text, without special tokens.

    Null and empty texts give an empty list; strings that look like special
    tokens are ordinary text. Each row gives one row: nothing is shuffled. The
    identifier may be null or repeat. Other columns are dropped.
    """
    merges = shared_merges(df.sparkSession, path)
    picked = df.select(df[identifier].alias("id"), df[text].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(Merges(*merges.value))
        for block in blocks(batches):
            encoder.forget()
            rows = encoder.ids([t or "" for t in block.column("text").to_pylist()])
            offsets = np.zeros(len(rows) + 1, np.int32)
            np.cumsum([len(r) for r in rows], out=offsets[1:])
            values = np.fromiter((i for r in rows for i in r), np.int32, int(offsets[-1]))
            yield pa.RecordBatch.from_arrays([block.column("id"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))], names=["id", "ids"])

    kind = picked.schema["id"].dataType.simpleString()
    return picked.mapInArrow(run, f"id {kind}, ids array<int>").withColumnRenamed("id", identifier)
