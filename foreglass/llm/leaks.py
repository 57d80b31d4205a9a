"""Problem 9: evaluation texts that leaked into the corpus.

Method: latent semantic retrieval. A randomised SVD of the TF-IDF passages of
corpus and items gives a latent space; passages of the corpus whose cosine to
a passage of an item is high, looked up in clusters of the items' vectors, are
candidates, and so are passages that share runs of words with an item, which no
leak is without; word alignments (longest common subsequence with a bound on
errors), many at a time, settle each of them.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from foreglass.session import written

#: Least successive words of an item that make a leak, and words for each allowed error.
LEAST_WORDS = 12
WORDS_PER_ERROR = 8
#: Words of a passage, steps between passages in the search, dimensions of the latent space and least cosine of a candidate.
PASSAGE = 12
STEP = 2
RANK = 256
LEAST_COSINE = 0.55
#: Distinct words and passages of the items that are searched for together: the bound of the latent space and of the broadcast. More items are searched in several blocks.
MAX_TERMS = 4096
MAX_PASSAGES = 50_000
#: Bytes of item text that the driver cuts into blocks at a time, about.
CHUNK_BYTES = 4 << 20
#: Clusters of item passages that a passage of the corpus is compared with; their number is the root of the number of passages.
PROBES = 8
#: Alignments worked out together.
TOGETHER = 256
#: Words searched together.
BLOCK_WORDS = 100_000

# Letters without canonical decomposition, tags that part no words, and lines that are page furniture.
_LETTERS = {"ø": "o", "æ": "ae", "œ": "oe", "ß": "ss", "ł": "l", "đ": "d", "ð": "d", "þ": "th", "ı": "i", "ħ": "h"}
_LETTER = re.compile("[" + "".join(_LETTERS) + "]")
_MARKS = regex.compile(r"[\p{Mn}\p{Me}\p{Cf}]+")
_INLINE = re.compile(r"</?(?:b|i|u|s|em|strong|span|a|sup|sub|mark|small|code|font|q|cite|abbr|wbr)(?:\s[^<>]*)?/?>", re.I)
_TAG = re.compile(r"""<!--.*?-->|</?[a-z!](?:[^<>]{0,300}|[\w:-]*(?:\s+[\w:-]+\s*=\s*(?:"[^"<>]*"|'[^'<>]*'))+\s*/?)>""", re.I | re.S)
_LINK = re.compile(r"\]\([^()\s]*\)")
_FURNITURE = re.compile(r"^[^\S\n]*(?:[\[(]?\s*(?:continued|page|sheet|p\.)[^\n]{0,24}\d+\s*[\])]?|(?:user|assistant|system)\s*:|[-*•]|\d{1,3}[.)])(?=\s|$)", re.I | re.M)
_SOFT = re.compile("\u00ad\\s*")
_HYPHENATED = re.compile(r"[-‐‑¬](?<=\w.)[^\S\n]*\n[^\S\n]*(?:[>|*#][^\S\n]*)?(?=\w)")
_WITHIN = re.compile(r"['’`´‘ʼ\-‐‑‒](?<=\w.)(?=\w)|[.,](?<=\d.)(?=\d)")
_WORD = re.compile(r"[^\W_]+")


def plain_words(text: str) -> list[str]:
    """Words apart from case, punctuation, diacritics, typography, markup and layout."""
    text = text.replace("\r\n", "\n").replace("\r", "\n")
    if "&" in text:
        text = html.unescape(text)
    if "<" in text:
        text = _TAG.sub(" ", _INLINE.sub("", text))
    if "](" in text:
        text = _LINK.sub("] ", text)
    plain = text.isascii()
    if not plain:
        text = _SOFT.sub("", text)
        text = _MARKS.sub("", unicodedata.normalize("NFKD", text))
    text = _HYPHENATED.sub("", _FURNITURE.sub(" ", text)).lower()
    if not plain:
        text = _LETTER.sub(lambda m: _LETTERS[m[0]], text)
    return _WORD.findall(_WITHIN.sub("", text))


@dataclass
class Items:
    """A block of evaluation items as word numbers; ``terms`` leads from a word to its number from 1 on. Ids repeat for the parts of a long item."""

    ids: list
    words: list[np.ndarray]
    terms: dict[str, int]

    @property
    def size(self) -> int:
        """Terms of the latent space, with 0 for words of no item."""
        return len(self.terms) + 1


def item_parts(own: list[str], terms: int, passages: int) -> Iterator[list[str]]:
    """An item in parts of at most so many distinct words and passages. They overlap by twice the longest passage that decides a leak, so none is lost."""
    overlap = 4 * LEAST_WORDS
    most = max(overlap + LEAST_WORDS, min(terms, passages * STEP))
    for begin in range(0, max(1, len(own) - overlap), most - overlap):
        yield own[begin:begin + most]


def item_blocks(items: DataFrame, identifier: str, text: str, most_terms: int = MAX_TERMS, most_passages: int = MAX_PASSAGES, chunk: int = CHUNK_BYTES) -> Iterator[Items]:
    """The items of at least ``LEAST_WORDS`` words in blocks of bounded size; null ids and texts are left out, repeated rows count once.

    The driver reads the table in chunks by the hash of the id, each of about
    ``chunk`` bytes, however large the table is.
    """
    rows = items.select(F.col(identifier).alias("id"), F.col(text).alias("text")).filter("id is not null and text is not null")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks = max(1, -(-size // chunk))
    block = Items([], [], {})
    passages = 0
    for number in range(chunks):
        part = rows if chunks == 1 else rows.filter(F.pmod(F.xxhash64("id"), F.lit(chunks)) == number)
        for row in sorted(part.distinct().collect(), key=lambda r: (r.id, r.text)):
            for own in item_parts(plain_words(row.text), most_terms, most_passages):
                if len(own) < LEAST_WORDS:
                    continue
                new = {w for w in own if w not in block.terms}
                if block.ids and (len(block.terms) + len(new) > most_terms or passages + len(own) // STEP + 1 > most_passages):
                    yield block
                    block, passages = Items([], [], {}), 0
                block.ids.append(row.id)
                block.words.append(np.array([block.terms.setdefault(w, len(block.terms) + 1) for w in own], np.int32))
                passages += len(own) // STEP + 1
    if block.ids:
        yield block


def numbered(documents: DataFrame, identifier: str, text: str, terms) -> DataFrame:
    """``(id, words)``: each document's words as numbers of the item words, 0 for all others."""
    picked = documents.select(F.col(identifier).alias("id"), F.col(text).alias("text")).filter("id is not null and text is not null")
    kind = picked.schema["id"].dataType.simpleString()

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = terms.value.get
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                rows = [[known(w, 0) for w in plain_words(t)] for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(rows, pa.list_(pa.int32()))], names=["id", "words"])

    return picked.mapInArrow(number, f"id {kind}, words array<int>")


def _passages(words: np.ndarray) -> np.ndarray:
    """A document's words in rows of ``PASSAGE``, the last one filled up with 0."""
    return np.pad(words, (0, -len(words) % PASSAGE)).reshape(-1, PASSAGE)


def _batch_passages(lists: pa.ListArray) -> np.ndarray:
    """The passages of all documents of a batch, each document's last one filled up with 0."""
    offsets = lists.offsets.to_numpy()
    words = lists.values.to_numpy(zero_copy_only=False)[offsets[0]:offsets[-1]]
    sizes = np.diff(offsets)
    begins = np.concatenate([[0], np.cumsum(-(-sizes // PASSAGE) * PASSAGE)])
    out = np.zeros(begins[-1], words.dtype)
    out[np.arange(len(words)) + np.repeat(begins[:-1] - (offsets[:-1] - offsets[0]), sizes)] = words
    return out.reshape(-1, PASSAGE)


def term_statistics(texts: DataFrame, size: int) -> tuple[np.ndarray, int]:
    """Passages of the corpus that hold each item term, and the number of passages, over all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(size, np.int64)
        total = 0
        for batch in batches:
            p = _batch_passages(batch.column("words"))
            total += len(p)
            p = np.sort(p[(p > 0).any(axis=1)], axis=1)
            first = np.ones(p.shape, bool)
            first[:, 1:] = p[:, 1:] != p[:, :-1]
            held += np.bincount(p[first], minlength=size)
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(some, -1), pa.int32()), pa.array(np.append(held[some], total), pa.int64())], names=["term", "n"])

    held, total = np.zeros(size), 0
    for r in texts.select("words").mapInArrow(count, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():  # at most MAX_TERMS + 2 rows
        if r.term < 0:
            total = r.n
        else:
            held[r.term] = r.n
    return held, total


def _normal_matrix(p: np.ndarray, idf: np.ndarray, size: int) -> np.ndarray:
    """The products of all terms of each passage, weighted by TF-IDF and scaled to passages of length 1, summed by ``term * size + term``."""
    weights = idf[p]
    norm = np.sqrt((weights**2).sum(axis=1, keepdims=True))
    weights = np.where(p > 0, weights / norm, 0)
    out = np.zeros(size * size)
    for at in range(0, len(p), 10_000):
        terms, w = p[at:at + 10_000].astype(np.int64), weights[at:at + 10_000]
        cells, products = terms[:, :, None] * size + terms[:, None, :], w[:, :, None] * w[:, None, :]
        use = products > 0
        out += np.bincount(cells[use], products[use], size * size)
    return out


def corpus_matrix(texts: DataFrame, idf, size: int) -> np.ndarray:
    """The normal matrix of all passages of the corpus. Each task sums its own; what is collected is bounded by ``MAX_TERMS`` squared."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = idf.value
        out, held, n = np.zeros(size * size), [], 0
        for batch in batches:
            p = _batch_passages(batch.column("words"))
            held.append(p[(p > 0).any(axis=1)])
            n += len(held[-1])
            if n > 50_000:
                out += _normal_matrix(np.concatenate(held), weights, size)
                held, n = [], 0
        if n:
            out += _normal_matrix(np.concatenate(held), weights, size)
        some = np.flatnonzero(out)
        for at in range(0, len(some), 100_000):
            cells = some[at:at + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int64()), pa.array(out[cells])], names=["cell", "value"])

    summed = texts.select("words").mapInArrow(add, "cell long, value double").groupBy("cell").agg(F.sum("value").alias("value"))
    out = np.zeros(size * size)
    cells = summed.toArrow()
    out[cells.column("cell").to_numpy()] = cells.column("value").to_numpy()
    return out.reshape(size, size)


def randomised_basis(normal: np.ndarray, rank: int, seed: int = 42, extra: int = 16, turns: int = 4) -> np.ndarray:
    """The leading right singular vectors of the passages behind a normal matrix, by a randomised range finder with power iterations."""
    width = min(rank + extra, len(normal))
    q = np.linalg.qr(normal @ np.random.default_rng(seed).standard_normal((len(normal), width)))[0]
    for _ in range(turns):
        q = np.linalg.qr(normal @ q)[0]
    values, vectors = np.linalg.eigh(q.T @ normal @ q)
    return q @ vectors[:, np.argsort(-values)[:rank]]


def windows(words: np.ndarray, step: int) -> np.ndarray:
    """Begins of the passages of a text, the last one at its end."""
    last = max(0, len(words) - PASSAGE)
    begins = np.arange(0, last + 1, step)
    return begins if begins[-1] == last else np.append(begins, last)


def _vectors(words: np.ndarray, begins: np.ndarray, basis: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Latent vectors of passages, divided by the length of their full TF-IDF vector."""
    at = np.minimum(begins[:, None] + np.arange(PASSAGE), len(words) - 1)
    terms = words[at]
    length = np.sqrt((idf[terms] ** 2).sum(axis=1, keepdims=True))
    return (basis[terms].sum(axis=1) / length).astype(np.float32)


def aligned(texts: list[np.ndarray], items: list[np.ndarray], least: int = LEAST_WORDS, per_error: int = WORDS_PER_ERROR) -> np.ndarray:
    """For each text and item: whether ``least`` or more successive words of the item stand in the text with at most one word in ``per_error`` changed, missing or added.

    Longest alignments by number of errors, row by row for all pairs at once. A
    stretch of twice ``least`` words can be halved without raising its error
    rate in one of the halves, so two errors are enough to look at.
    """
    errors = (2 * least - 1) // per_error
    needs = np.array([max(least, per_error * e) for e in range(errors + 1)])
    rows, columns = max(map(len, texts)), max(map(len, items))
    kind = np.int16 if columns < 30_000 else np.int32
    text = np.zeros((rows, len(texts), 1), np.int32)  # 0 matches nothing and, after the end, adds nothing that a missing word does not
    item = np.full((len(items), columns), -1, np.int32)
    for i, (t, w) in enumerate(zip(texts, items, strict=True)):
        text[:len(t), i, 0], item[i, :len(w)] = t, w
    inside = (item >= 0).astype(kind)
    before = np.zeros((errors + 1, len(items), columns + 1), kind)
    best, now = before.copy(), before.copy()
    for word in text:
        match = (item == word) & (word > 0)
        now[0, :, 1:] = np.where(match, before[0, :, :-1] + 1, 0)
        for e in range(1, errors + 1):
            changed = np.where(match, before[e, :, :-1], before[e - 1, :, :-1]) + 1
            other = np.maximum(now[e - 1, :, :-1] + 1, before[e - 1, :, 1:])
            now[e, :, 1:] = np.maximum(changed, other) * inside
        np.maximum(best, now, out=best)
        before, now = now, before
    return (best.max(axis=2) >= needs[:, None]).any(axis=0)


def _runs(words: np.ndarray, n: int = 5) -> np.ndarray:
    """Hashes of all runs of ``n`` item words (0 where another word is among them)."""
    if len(words) < n:
        return np.zeros(0, np.int64)
    parts = np.lib.stride_tricks.sliding_window_view(words.astype(np.int64), n)
    factors = np.array([31**k * 1_000_003 + k for k in range(n)], np.int64)
    return np.where((parts > 0).all(axis=1), (parts * parts * factors + parts).sum(axis=1), 0)


class Clusters:
    """Vectors of item passages in clusters around the root of their number of centres."""

    def __init__(self, vectors: np.ndarray, seed: int = 42, turns: int = 5):
        rng = np.random.default_rng(seed)
        unit = vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
        self.centres = unit[rng.permutation(len(unit))[:max(1, int(np.sqrt(len(unit))))]] if len(unit) else unit
        nearest = np.zeros(len(unit), np.int64)
        for _ in range(turns if len(unit) else 0):
            nearest = np.concatenate([(unit[i:i + 4096] @ self.centres.T).argmax(axis=1) for i in range(0, len(unit), 4096)])
            sums = np.zeros_like(self.centres)
            np.add.at(sums, nearest, unit)
            norms = np.linalg.norm(sums, axis=1, keepdims=True)
            self.centres = np.where(norms > 0, sums / np.maximum(norms, 1e-9), self.centres).astype(np.float32)
        order = np.argsort(nearest, kind="stable")
        ends = np.searchsorted(nearest[order], np.arange(len(self.centres) + 1))
        self.members = [order[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
        self.vectors = [np.ascontiguousarray(vectors[m].T) for m in self.members]

    def near(self, x: np.ndarray, cosine: float, probes: int = PROBES) -> tuple[np.ndarray, np.ndarray]:
        """``(row of x, member)`` of the pairs with a cosine from ``cosine`` on, looked for in each row's ``probes`` nearest clusters."""
        if not len(self.centres) or not len(x):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        near = x @ self.centres.T
        probes = min(probes, len(self.centres))
        chosen = np.argpartition(-near, probes - 1, axis=1)[:, :probes]
        order = np.argsort(chosen, axis=None, kind="stable")
        cluster, row = chosen.ravel()[order], order // probes
        edges = np.searchsorted(cluster, np.arange(len(self.centres) + 1))
        rows, members = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for c in np.flatnonzero(np.diff(edges)):
            own = row[edges[c]:edges[c + 1]]
            r, m = np.nonzero(x[own] @ self.vectors[c] >= cosine)
            rows.append(own[r])
            members.append(self.members[c][m])
        return np.concatenate(rows), np.concatenate(members)


class Searcher:
    """Finds the items of a block in texts of word numbers."""

    def __init__(self, items: Items, idf: np.ndarray, basis: np.ndarray, cosine: float = LEAST_COSINE):
        self.items, self.idf, self.cosine = items, idf, cosine
        self.basis = np.ascontiguousarray(basis * idf[:, None], np.float32)
        self.basis[0] = 0
        begins = [windows(words, STEP) for words in items.words]
        self.owner = np.repeat(np.arange(len(begins)), [len(b) for b in begins])
        self.vectors = np.concatenate([np.zeros((0, basis.shape[1]), np.float32), *(_vectors(w, b, self.basis, idf) for w, b in zip(items.words, begins, strict=True))])
        self.clusters = Clusters(self.vectors)
        self.runs = [np.unique(_runs(w)) for w in items.words]
        every = np.concatenate([np.zeros(0, np.int64), *self.runs])
        order = np.argsort(every, kind="stable")
        self.every_run, self.run_owner = every[order], np.repeat(np.arange(len(self.runs)), [len(r) for r in self.runs])[order]

    def passages(self, texts: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """``(text, begin, latent vector)`` of the passages that could have a cosine from ``cosine`` on, some thousands at a time."""
        begins = [windows(t, STEP) for t in texts]
        source = np.repeat(np.arange(len(texts)), [len(b) for b in begins])
        starts = np.cumsum([0] + [len(t) for t in texts[:-1]])
        words = np.concatenate(texts)
        at = np.concatenate([b + s for b, s in zip(begins, starts, strict=True)])
        ends = np.minimum(at + PASSAGE, (starts + [len(t) for t in texts])[source])
        energy = self.idf[words] ** 2
        own = np.concatenate([[0.0], np.cumsum(np.where(words > 0, energy, 0))])
        whole = np.concatenate([[0.0], np.cumsum(energy)])
        # The cosine is at most the share of a passage's length that lies in item words.
        could = np.flatnonzero((own[ends] - own[at]) >= self.cosine**2 * (whole[ends] - whole[at]))
        for first in range(0, len(could), 4000):
            chunk = could[first:first + 4000]
            place = at[chunk][:, None] + np.arange(PASSAGE)
            terms = np.where(place < ends[chunk][:, None], words[np.minimum(place, len(words) - 1)], 0)
            length = np.sqrt(np.maximum(whole[ends[chunk]] - whole[at[chunk]], 1e-9))[:, None]
            yield source[chunk], at[chunk] - starts[source[chunk]], (self.basis[terms].sum(axis=1) / length).astype(np.float32)

    def candidates(self, texts: list[np.ndarray]) -> np.ndarray:
        """Rows of ``(text, item, begin of the passage)`` with a cosine from ``cosine`` on."""
        found = [np.zeros((0, 3), np.int64)]
        for source, begin, x in self.passages(texts):
            rows, members = self.clusters.near(x, self.cosine)
            found.append(np.stack([source[rows], self.owner[members], begin[rows]], axis=1))
        return np.concatenate(found)

    def shared_runs(self, texts: list[np.ndarray]) -> np.ndarray:
        """Rows of ``(text, item, begin of the run)`` where two runs of five item words stand near each other.

        Every leak has them, whatever its cosine: 11 of 12 words in two
        unchanged parts hold three runs, 14 of 16 words in three parts two.
        """
        starts = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]])
        hashes = _runs(np.concatenate([x for t in texts for x in (t, np.zeros(1, t.dtype))]))
        some = np.flatnonzero(hashes)
        first = np.searchsorted(self.every_run, hashes[some], "left")
        n = np.searchsorted(self.every_run, hashes[some], "right") - first
        at = np.repeat(some, n)
        item = self.run_owner[np.repeat(first - np.cumsum(n) + n, n) + np.arange(len(at))]
        source = np.searchsorted(starts, at, "right") - 1
        order = np.lexsort((at, item, source))
        source, item, at = source[order], item[order], at[order]
        near = (np.diff(source) == 0) & (np.diff(item) == 0) & (np.diff(at) <= 2 * LEAST_WORDS)
        use = np.append(near, False) | np.append(False, near) if len(at) else np.zeros(0, bool)
        return np.stack([source[use], item[use], at[use] - starts[source[use]]], axis=1)

    def search(self, texts: list[np.ndarray]) -> list[tuple[int, int]]:
        """``(text, item)`` of every leak."""
        if not texts or not self.items.ids:
            return []
        hits = np.unique(np.concatenate([self.candidates(texts), self.shared_runs(texts)]), axis=0)
        if not len(hits):
            return []
        margin = 2 * LEAST_WORDS + PASSAGE
        new = np.append(True, (np.diff(hits[:, 0]) != 0) | (np.diff(hits[:, 1]) != 0) | (np.diff(hits[:, 2]) > 2 * margin + PASSAGE))
        begins, ends = np.flatnonzero(new), np.append(np.flatnonzero(new)[1:], len(hits)) - 1
        pairs = []
        for a, b in zip(begins, ends, strict=True):
            text, item = int(hits[a, 0]), int(hits[a, 1])
            part = texts[text][max(0, hits[a, 2] - margin):hits[b, 2] + PASSAGE + margin]
            # An alignment with so few errors has a run of five unchanged words.
            if self._shares_run(part, item):
                pairs.append((text, item, part))
        # parts of like sizes are aligned together
        pairs.sort(key=lambda x: (len(self.items.words[x[1]]) // 32, len(x[2])))
        found = set()
        for at in range(0, len(pairs), TOGETHER):
            some = pairs[at:at + TOGETHER]
            yes = aligned([p for _, _, p in some], [self.items.words[i] for _, i, _ in some])
            found |= {(t, i) for (t, i, _), ok in zip(some, yes, strict=True) if ok}
        return sorted(found)

    def _shares_run(self, part: np.ndarray, item: int) -> bool:
        own, runs = self.runs[item], _runs(part)
        runs = runs[runs != 0]
        at = np.searchsorted(own, runs)
        return bool((own[np.minimum(at, len(own) - 1)] == runs).any())


def latent_space(texts: DataFrame, items: Items, rank: int = RANK) -> tuple[np.ndarray, np.ndarray]:
    """``(idf, basis)`` from all passages of the corpus and, with the same total weight, of the items."""
    spark, size = texts.sparkSession, items.size
    held, total = term_statistics(texts, size)
    idf = np.log1p((total + 1) / (held + 1))
    idf[0] = np.median(idf[1:]) if size > 1 else 1.0
    corpus = corpus_matrix(texts, spark.sparkContext.broadcast(idf), size)
    own = _normal_matrix(np.concatenate([_passages(w[k:]) for w in items.words for k in (0, PASSAGE // 2)]), idf, size).reshape(size, size)
    balance = np.trace(corpus) / np.trace(own) if np.trace(own) else 1.0
    return idf, randomised_basis(corpus + max(balance, 1e-9) * own, min(rank, size))


def leaks(documents: DataFrame, identifier: str, text: str, items: DataFrame, item_identifier: str, item_text: str, most_terms: int = MAX_TERMS, most_passages: int = MAX_PASSAGES) -> DataFrame:
    """``(identifier, item_identifier)`` of every document that holds a passage of an item.

    A passage is at least ``LEAST_WORDS`` successive words of the item, with
    at most one word in ``WORDS_PER_ERROR`` changed, missing or added. Null
    texts and ids are left out; a text or item with fewer words never matches;
    empty tables give an empty result. Documents are searched where they are:
    only word counts, cells of the normal matrix and found pairs are shuffled.
    What is broadcast is one block of items, bounded by ``most_terms`` words
    and ``most_passages`` passages; a larger table of items is searched block
    by block, each over all documents.
    """
    kind, item_kind = documents.schema[identifier].dataType.simpleString(), items.schema[item_identifier].dataType.simpleString()
    pairs = None
    for block in item_blocks(items, item_identifier, item_text, most_terms, most_passages):
        found = _block_leaks(documents, identifier, text, block, kind, item_kind)
        pairs = found if pairs is None else written(pairs.union(found))
    if pairs is None:
        return documents.sparkSession.createDataFrame([], f"{identifier} {kind}, {item_identifier} {item_kind}")
    return pairs.distinct().select(F.col("doc").alias(identifier), F.col("item").alias(item_identifier))


def _block_leaks(documents: DataFrame, identifier: str, text: str, known: Items, kind: str, item_kind: str) -> DataFrame:
    context = documents.sparkSession.sparkContext
    texts = written(numbered(documents, identifier, text, context.broadcast(known.terms)))
    idf, basis = latent_space(texts, known)
    shared = context.broadcast(Searcher(known, idf, basis))
    item_type = pa.array(known.ids).type

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searcher = shared.value
        ids = searcher.items.ids
        for batch in batches:
            rows = [r.values.to_numpy(zero_copy_only=False) for r in batch.column("words")]
            ends = np.cumsum([len(r) for r in rows]) // BLOCK_WORDS
            found = []
            for group in np.split(np.arange(len(rows)), np.flatnonzero(np.diff(ends)) + 1):
                full = [g for g in group if len(rows[g]) >= LEAST_WORDS - 1]
                found += [(full[t], i) for t, i in searcher.search([rows[g] for g in full])]
            yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array([t for t, _ in found], pa.int64())), pa.array([ids[i] for _, i in found], item_type)], names=["doc", "item"])

    return texts.mapInArrow(search, f"doc {kind}, item {item_kind}")
