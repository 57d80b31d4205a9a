"""Problem 6: broken prompt and response pairs.

Method: prompt and response are aligned by shingle containment and longest
common subsequence to find copies; sentences of the response are aligned with
refusal templates; languages are compared by a model of character n-grams that
is fitted on a bounded sample of labelled texts.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from foreglass.llm.language import Languages

#: Share of a copy's words that stand in the prompt in the same order.
COPY_SHARE = 0.85

# Contents that stand for no content.
PLACEHOLDERS = frozenset(["", "n a", "na", "none", "null", "nil", "nan", "tbd", "todo", "to do", "to be determined", "to be added", "no content", "not available", "not applicable", "no answer", "no response", "empty", "unknown", "undefined", "pending", "placeholder", "content here", "insert text here", "coming soon", "lorem ipsum"])

MOST_PLACEHOLDER_WORDS = max(len(p.split()) for p in PLACEHOLDERS)

# Refusal templates. REFUSE and ACT stand for the phrases below; the words of a template must follow in this order.
REFUSALS = [t.split() for t in [
    "SELF REFUSE ACT",
    "REFUSE ACT request",
    "against my policy",
    "against our policy",
    "against my guidelines",
    "conflicts with my guidelines",
    "conflicts with our guidelines",
    "SELF REFUSE",
    "SELF have to pass on this",
    "SELF must pass on this",
    "beyond what SELF am permitted",
    "beyond what SELF am allowed",
    "not something SELF can do",
    "not something SELF can help",
    "REFUSE appropriate for me to",
    "not appropriate for me to",
    "no answer can be given",
    "outside what SELF can",
    "SELF do not ACT",
    "SELF do not provide opinions",
    "SELF do not provide advice",
]]
# Who refuses, how, and what is refused.
_SELF = r"\b(?:i|we|this (?:model|system|assistant|ai|tool|service|bot)|the (?:assistant|ai|model)|as an ai(?: language)?(?: model| assistant)?)\b"
_REFUSE_PLAIN = r"\b(?:must decline|have to decline|has to decline|must refuse|have to refuse|has to refuse|decline|refuse|would rather not|would prefer not|prefer not|have been told not|has been told not|have been instructed not|has been instructed not)\b(?: to\b)?"
_REFUSE = r"\b(?:(?:can|could|will|would|may|shall|must) not(?: be able to| be)?|(?:am|are|is) (?:not able|unable|not in a position|not permitted|not allowed|not authori[sz]ed)(?: to)?|(?:am|are|is) not going to|(?:do|does) not feel comfortable)\b"
_ACT = r"\b(?:help(?:ing)?|assist(?:ing)?|comply|complying|answer(?:ing)?|comment(?:ing)?|writ(?:e|ing)|produc(?:e|ing)|provid(?:e|ing)|judg(?:e|ing)|rework(?:ing)?|rewrit(?:e|ing)|tak(?:e|ing) (?:a side|sides)|discuss(?:ing)?|evaluat(?:e|ing)|analy[sz](?:e|ing)|speculat(?:e|ing)|do (?:that|this|so)|fulfil+|complete (?:this|that|the)|generat(?:e|ing)|respond(?:ing)?|predict(?:ing)?|forecast(?:ing)?|offer(?:ing)?|shar(?:e|ing)|engag(?:e|ing)|continu(?:e|ing) with|creat(?:e|ing)|draft(?:ing)?|weigh in|advis(?:e|ing)|giv(?:e|ing) (?:an?|any|my|our) (?:\w+ )?(?:assessment|opinion|answer|view|advice|prediction|forecast|analysis|judg[e]?ment)|giv(?:e|ing) (?:opinions|advice|predictions|assessments|answers))\b"
_HINT = re.compile(r"not\b|n't\b|declin|refus|unable|pass on|beyond what|outside what|policy|guidelines|no answer")
_CONTRACTIONS = [("can't", "can not"), ("cannot", "can not"), ("won't", "will not"), ("n't", " not"), ("i'm", "i am"), ("we're", "we are"), ("i'd", "i would"), ("we'd", "we would"), ("i've", "i have"), ("we've", "we have"), ("it's", "it is"), ("i'll", "i will")]

_HEADING = re.compile(r"\s*(?:#{1,6}(?:\s.*)?|(?:\*\*|__)[^*_\n]{1,80}(?:\*\*|__)\s*:?|[\w ]{1,40}:)\s*")
_QUOTED = re.compile(r"\"[^\"\n]*\"|“[^”\n]*”|„[^“”\n]*[“”]|«[^»\n]*»|‹[^›\n]*›|「[^」\n]*」")
_SENTENCES = re.compile(r"(?<=[.!?。！？;])\s*|\n+")
_FINISHED = re.compile(r"[.!?。！？؟।][\"”’»')\]*_`」』）]*$")
_DOTS = re.compile(r"(?:\.\.\.?|…|。。)[\"”’»')\]*_`]*$")
_TOKEN = re.compile(r"[぀-ヿ㐀-鿿豈-﫿]|[^\W_぀-ヿ㐀-鿿豈-﫿]+")


def words(text: str) -> list[str]:
    """Words apart from case, punctuation and layout; punctuation within a word or number is dropped, Han and Kana signs stand alone."""
    plain = re.sub(r"(?<=\w)[^\w\s](?=\w)", "", unicodedata.normalize("NFKC", text).lower())
    return _TOKEN.findall(plain)


def lcs_length(a: list[str], b: list[str]) -> int:
    """Length of the longest common subsequence, bit-parallel over ``a``."""
    if not a or not b:
        return 0
    at: dict[str, int] = {}
    for i, w in enumerate(a):
        at[w] = at.get(w, 0) | 1 << i
    full = (1 << len(a)) - 1
    rest = full
    for w in b:
        both = rest & at.get(w, 0)
        rest = ((rest + both) | (rest - both)) & full
    return len(a) - rest.bit_count()


def is_copy(answer: list[str], prompt: list[str], counted: Counter) -> bool:
    """True if enough words of the answer stand in the prompt in the same order; ``counted`` are the prompt's words."""
    if not answer or not prompt:
        return False
    least = COPY_SHARE * len(answer)
    # Containment of one-word shingles bounds the common subsequence from above; longer shingles would not.
    if sum(w in counted for w in answer) < least or sum((Counter(answer) & counted).values()) < least:
        return False
    return lcs_length(answer, prompt) >= least


def is_empty(text: str | None) -> bool:
    if text is None:
        return True
    found: list[str] = []
    for line in re.split(r"[\n\r\u2028\u2029]+", text):
        if line.strip() and not _HEADING.fullmatch(line):
            found += re.findall(r"[^\W_]+", line.lower())
            if len(found) > MOST_PLACEHOLDER_WORDS:
                return False
    return " ".join(found) in PLACEHOLDERS


def is_refusal(text: str) -> bool:
    """True if a sentence outside quotation marks aligns with a refusal template."""
    plain = text.replace("’", "'").lower()
    if not _HINT.search(plain):
        return False
    plain = _QUOTED.sub(" ", plain)
    for sentence in _SENTENCES.split(plain):
        if not _HINT.search(sentence):  # every template needs one of these
            continue
        for short, long in _CONTRACTIONS:
            sentence = sentence.replace(short, long)
        sentence = re.sub(_SELF, " SELF ", sentence)
        sentence = re.sub(_REFUSE_PLAIN, " REFUSE DECLINE ", sentence)
        sentence = re.sub(_REFUSE, " REFUSE ", sentence)
        tokens = re.findall(r"\w+", re.sub(_ACT, " ACT ", sentence))
        if "SELF" in tokens or "REFUSE" in tokens or "my" in tokens or "me" in tokens or "answer" in tokens or "ACT" in tokens:
            held = set(tokens)
            if any(held.issuperset(t) and _aligned(tokens, t) for t in REFUSALS):
                return True
    return False


def _aligned(tokens: list[str], template: list[str]) -> bool:
    """True if all words of the template follow in the tokens, at most one word apart (``answer`` counts as an act)."""
    if template == ["SELF", "REFUSE"]:
        return any(tokens[i] == "SELF" and tokens[i + 1:i + 3] == ["REFUSE", "DECLINE"] and "ACT" in tokens[i + 3:i + 6] for i in range(len(tokens)))
    if lcs_length(template, tokens) < len(template):
        return False
    for start, token in enumerate(tokens):
        if token == template[0]:
            at = start
            for word in template[1:]:
                step = next((k for k in range(at + 1, min(at + 3, len(tokens))) if tokens[k] == word), None)
                if step is None:
                    break
                at = step
            else:
                return True
    return False


def is_truncated(text: str) -> bool:
    s = text.rstrip()
    return not _FINISHED.search(s) or bool(_DOTS.search(s))


class Prompt:
    """The words of each prompt text and the language of the reference, worked out once for all answers."""

    def __init__(self, prompts: list[str | None], reference: str | None, languages: Languages):
        self.words = [(own, Counter(own)) for own in (words(p) for p in prompts if p)]
        self.languages = languages
        self.language = languages.of(reference) if reference else None


def defect(answer: str | None, prompt: Prompt) -> str | None:
    """The defect of an answer, at most one, in this order: empty, refusal, copy, language, truncated.

    Null prompts are no ground for a defect, nor is a text without words.
    """
    if is_empty(answer):
        return "empty"
    if is_refusal(answer):
        return "refusal"
    own = words(answer)
    if any(is_copy(own, p, counted) for p, counted in prompt.words):
        return "copy"
    if prompt.language and (prompt.languages.of(answer) or prompt.language) != prompt.language:
        return "language"
    return "truncated" if is_truncated(answer) else None


def defects(df: DataFrame, identifier: str, answers: dict[str, Column], prompts: list[str], reference: str, languages: Languages) -> DataFrame:
    """``(identifier, field_name, defect)`` of every defective answer; an identifier counts once.

    ``answers`` maps field names to columns. ``languages`` is a fitted model of
    bounded size. Null identifiers are left out. Each row is judged by itself
    and in whole; only found defects are shuffled, to drop repeated ones. An
    empty input gives an empty result.
    """
    names = list(answers)
    picked = df.select(F.col(identifier).alias("id"), *(c.alias(f"a{i}") for i, c in enumerate(answers.values())), *(F.col(p).alias(f"p{i}") for i, p in enumerate(prompts)), F.col(reference).alias("reference")).filter("id is not null")
    n_prompts = len(prompts)
    shared = df.sparkSession.sparkContext.broadcast(languages)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            columns = {n: batch.column(n).to_pylist() for n in batch.schema.names if n != "id"}
            rows, fields, kinds = [], [], []
            for i in range(batch.num_rows):
                prompt = Prompt([columns[f"p{k}"][i] for k in range(n_prompts)], columns["reference"][i], model)
                for k, name in enumerate(names):
                    if kind := defect(columns[f"a{k}"][i], prompt):
                        rows.append(i)
                        fields.append(name)
                        kinds.append(kind)
            yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(rows, pa.int64())), pa.array(fields, pa.string()), pa.array(kinds, pa.string())], names=["id", "field_name", "defect"])

    kind = picked.schema["id"].dataType.simpleString()
    found = picked.mapInArrow(judge, f"id {kind}, field_name string, defect string")
    return found.groupBy("id", "field_name").agg(F.min("defect").alias("defect")).withColumnRenamed("id", identifier)
