"""A language model of character n-grams, fitted on a bounded sample of labelled texts."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

#: Labelled texts of each language that the model is fitted on, and languages it knows, at most: the bound of the sample.
TEXTS = 200
LANGUAGES = 40
#: Labelled texts that a language needs; rarer labels are taken for errors.
LEAST_TEXTS = 5
#: Buckets of the hashed n-grams.
BUCKETS = 1 << 16
#: A text is of no known language if more than this share of its n-grams was never seen.
MOST_UNSEEN = 0.6
#: Code points from here on count by themselves too: a sign of these scripts says as much as three Latin letters.
SIGNS = 0x370

OTHER = "other"


def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() if not 0xD800 <= c < 0xE000 else False for c in range(0x20000)), bool, 0x20000)


_IS_LETTER = _letters()


def features(text: str) -> np.ndarray:
    """Hashed character trigrams of the words, with one blank on each side, and the single signs of scripts beyond Latin."""
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    letter = _IS_LETTER[np.minimum(codes, 0x1FFFF)]
    codes = np.where(letter, codes, 32)
    if len(codes) < 3:
        return np.zeros(0, np.int64)
    kept = letter[:-2] & letter[1:-1] | letter[1:-1] & letter[2:] | letter[:-2] & letter[2:]
    grams = (codes[:-2] * 1_000_003 + codes[1:-1] * 8_191 + codes[2:] * 131)[kept]
    signs = codes[letter & (codes >= SIGNS)] * 2_147_483_647
    return (np.concatenate([grams, signs]) * 0x9E3779B97F4A7C1 & 0x7FFFFFFFFFFF) >> 21 & (BUCKETS - 1)


@dataclass
class Languages:
    """Log-likelihood of each n-gram in each language, as differences from the mean; zero for n-grams never seen."""

    names: list[str]
    weights: np.ndarray
    seen: np.ndarray

    @classmethod
    def fit(cls, texts: list[str], labels: list[str]) -> Languages:
        """Naive Bayes. Texts that the first fit places in another language than their label are left out of the second."""
        found = [features(t) for t in texts]
        model = cls._once(found, labels)
        kept = [i for i, f in enumerate(found) if model.best(f) == labels[i]]
        names = {labels[i] for i in kept}
        return cls._once([found[i] for i in kept], [labels[i] for i in kept]) if names == set(labels) else model

    @classmethod
    def _once(cls, found: list[np.ndarray], labels: list[str]) -> Languages:
        names = sorted(set(labels))
        if not names:
            return cls([], np.zeros((BUCKETS, 0), np.float32), np.zeros(BUCKETS, bool))
        counts = np.zeros((BUCKETS, len(names)))
        for i, name in enumerate(names):
            own = [f for f, label in zip(found, labels, strict=True) if label == name]
            counts[:, i] = np.bincount(np.concatenate(own), minlength=BUCKETS)
        seen = counts.any(axis=1)
        total = counts.sum(axis=0)
        share = (counts + 0.5 * total / max(1.0, total.mean())) / np.maximum(total, 1)
        logs = np.log(np.maximum(share, 1e-12))
        weights = np.where(seen[:, None], logs - logs.mean(axis=1, keepdims=True), 0)
        return cls(names, weights.astype(np.float32), seen)

    def best(self, found: np.ndarray) -> str | None:
        """The most likely language of a text's features; OTHER if too few were ever seen, None without any."""
        if not len(found) or not self.names:
            return None
        if np.count_nonzero(self.seen[found]) < (1 - MOST_UNSEEN) * len(found):
            return OTHER
        return self.names[int(self.weights[found].sum(axis=0).argmax())]

    def of(self, text: str) -> str | None:
        return self.best(features(text))


def labelled_sample(df: DataFrame, identifier: str, text: str, label: str, texts: int = TEXTS, languages: int = LANGUAGES) -> tuple[list[str], list[str]]:
    """``(texts, labels)`` of at most ``texts`` rows of each of the ``languages`` most frequent labels, by the hash of the identifier.

    Labels count in lower case and up to a hyphen. Each task keeps at most
    ``texts`` rows of a label before they meet.
    """
    plain = F.nullif(F.substring_index(F.lower(F.trim(F.col(label))), "-", 1), F.lit(""))
    rows = df.select(F.col(identifier).alias("id"), F.col(text).alias("text"), plain.alias("label")).filter("label is not null and length(trim(text)) > 0")
    names = [r.label for r in rows.groupBy("label").count().filter(F.col("count") >= LEAST_TEXTS).orderBy(F.desc("count"), "label").limit(languages).collect()]
    place = F.row_number().over(Window.partitionBy("label").orderBy(F.xxhash64("id"), "id"))
    picked = rows.filter(F.col("label").isin(names)).withColumn("place", place).filter(F.col("place") <= texts).select("text", "label").collect()
    picked.sort(key=lambda r: (r.label, r.text))
    return [r.text for r in picked], [r.label for r in picked]
