"""Problems 3, 6 and 9: cut texts, broken answers, leaked items."""

import random

import numpy as np
import pytest

from foreglass.llm.defects import Prompt, defect, defects, lcs_length
from foreglass.llm.language import LANGUAGES, OTHER, Languages, labelled_sample
from foreglass.llm.leaks import LEAST_WORDS, aligned, leaks, plain_words, randomised_basis
from foreglass.llm.truncation import significant_lengths, truncated, truncation_rates

OUTCOMES = '{"Ann": 1, "Bob\'s Cup": 0}'


ENDINGS = [
    (None, False), ("", False), (" \n ", False), ("A finished sentence.", False), ("Is it? ", False), ('He said "yes."', False), ("完。", False),
    ("An unfinished", True), ("Ends with a comma,", True), ("It stops here...", True), ("It stops here…", True), ("bro�", True), ("A list\n- ", True), ("A list\n- item.\n2.", True), ("## Rationale", True),
    ('x <probabilities>{"Ann": 0.5}</probabilities>', False), ('x.\n{"Ann": 0.5, "Bob": 0.5}', False), ('x.\n<probabilities>{"Ann": 0.5', True), ('x.\n<probabilities>{"Ann": 0.5,\n', True), ('x.\n<probabilities>\n', True), ('{"a": 1}</probabi', True), ('{"A.', True),
    ('```json\n{"Ann": 1}\n```', False), ("Why.\nAnn: 0.50\nBob's Cup: 0.50", False), ("Why.\nAnn: 0.50", True), ("Why.\nAnn: 0.50\nBob's Cup: 0.5", True), ("Why.\nAnn: 0.50\nBob's Cu", True), ("x.\nHm... no", True), ("Hm... it ends well.", False),
]


def test_endings(spark):
    df = spark.createDataFrame([(i, "m", t, OUTCOMES) for i, (t, _) in enumerate(ENDINGS)], "id int, model string, content string, market_outcome string")
    found = {r.id: r.truncated for r in truncated(df, "id", "model", "content", "market_outcome")[0].collect()}
    assert [(t, found[i]) for i, (t, _) in enumerate(ENDINGS)] == ENDINGS


def test_significant_lengths_and_rates(spark):
    rng = random.Random(0)
    rows = [(i, "cuts", "x" * rng.randrange(100, 400) + ".", OUTCOMES) for i in range(1500)]
    rows += [(2000 + i, "cuts", "y" * 298 + " 3.", OUTCOMES) for i in range(60)]  # a number cut at its point, always at 301
    rows += [(3000 + i, "none", "x" * rng.randrange(100, 400) + ".", OUTCOMES) for i in range(1500)]
    rows += rows[:50] + [(None, "none", "x", OUTCOMES), (9000, None, "cut of", OUTCOMES)]
    df = spark.createDataFrame(rows, "id int, model string, content string, market_outcome string")
    flagged, lengths = truncated(df, "id", "model", "content", "market_outcome")
    assert {(r.source, r.unit, r.length) for r in lengths.collect()} == {("cuts", "chars", 301), ("cuts", "bytes", 301)}
    rates = {r.source: (r.n, r.n_truncated) for r in truncation_rates(flagged).collect()}
    assert rates == {"cuts": (1560, 60), "none": (1500, 0), "": (1, 1)}
    empty = truncated(df.limit(0), "id", "model", "content", "market_outcome")
    assert empty[0].count() == empty[1].count() == 0


def test_lcs_against_dynamic_programming():
    rng = random.Random(1)
    for _ in range(200):
        a, b = ([rng.choice("abcd") for _ in range(rng.randrange(12))] for _ in range(2))
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1, j + 1] = table[i, j] + 1 if x == y else max(table[i, j + 1], table[i + 1, j])
        assert lcs_length(a, b) == table[-1, -1]


ORIGINAL = "The base rate for the cup is close to 29.5% over 262 earlier cases. Recent form counts for more than history here, so Balarmere gets a small bonus."
TITLE = "Who wins the cup in Balarmere?"
FRENCH = "Les sources se contredisent et le cours de 31 centimes paraît dépassé. Si la décision tombait plus tôt, c'est elle qui en profiterait le plus."


@pytest.mark.parametrize("answer,kind", [
    (None, "empty"), ("", "empty"), ("  \n", "empty"), ("## Source Analysis\n", "empty"), ("**Rationale**:", "empty"), ("N/A", "empty"), ("(no content)", "empty"), ("[]", "empty"), ("...", "empty"),
    ("I can't help with this.", "refusal"), ("Sorry, this goes beyond what I am permitted to discuss.", "refusal"), ("As an AI model I do not give opinions on future events.", "refusal"), ("It would not be appropriate for me to evaluate this question.", "refusal"), ('The task concerns "Who wins?" This system would rather not take a side on this question. You may look elsewhere.', "refusal"), ("no answer can be given because it is against my policy please rephrase", "refusal"), ("I don’t feel comfortable producing this content.", "refusal"),
    ("I cannot rule out a late change, since the board meets again on Monday and both sides want one.", None), ("The board declined to comment on the date. The price was stale that day.", None), ('The note says "I cannot help with this request." and nothing else of use was found in it.', None), ("Officials refuse to accept the first count. It may be held again in May.", None),
    ("> " + ORIGINAL.upper().replace(".", ""), "copy"), ("Sure, here it is: " + ORIGINAL, "copy"), (TITLE, "copy"), (ORIGINAL.replace("history", "luck").replace("close", "near"), "copy"),
    ("The base rate for the cup says little, as nobody looked at the last three seasons at all.", None),
    (FRENCH, "language"), ("两者之间的差距只剩下21分。 没有迹象表明活动会推迟。", "language"), ('A headline reads "' + FRENCH[:69] + '" but the desk gives no figure for it and the rest of the text is about the weather.', None),
    ("The sources are mixed and the pri", "truncated"), ("The sources are mixed and the…", "truncated"), ("The sources are mixed and the...", "truncated"), ("The sour", "truncated"), ("The sources are mixed, and the last one is old.", None),
])
def test_defects(languages, answer, kind):
    assert defect(answer, Prompt([TITLE, ORIGINAL], ORIGINAL, languages)) == kind


def test_defects_without_prompts_and_long_texts(languages):
    assert defect(FRENCH, Prompt([None, None], None, languages)) is None
    long = " ".join(f"word{i} number {i} stands here." for i in range(20_000))
    assert defect(long, Prompt([long + " More."], long, languages)) == "copy"
    assert languages.of("123 456") is None and languages.of(FRENCH) == "fr"
    assert languages.of("ขอบคุณสำหรับคำถามของคุณในวันนี้") == OTHER and Languages.fit([], []).of(FRENCH) is None


def test_languages_of_held_out_texts(spark, languages):
    texts, labels = labelled_sample(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), "doc_id", "text", "lang", 20)
    assert len(texts) > 50 and max(map(labels.count, set(labels))) <= 20 and len(set(labels)) <= LANGUAGES
    right = sum(languages.of(t) == label for t, label in zip(texts, labels, strict=True))
    assert right >= 0.9 * len(texts)  # some labels are wrong


def test_defects_of_a_table(spark, languages):
    schema = "aug_id int, title string, original_rationale string, augmented_rationale struct<source_analysis: string, rationale: string>, defect string"
    rows = [(1, TITLE, ORIGINAL, None, "x"), (1, TITLE, ORIGINAL, None, "x"), (2, None, None, ("Fine so far.", "cut o"), None), (None, TITLE, ORIGINAL, None, "x")]
    df = spark.createDataFrame(rows, schema)
    answers = {k: df[f"augmented_rationale.{k}"] for k in ("source_analysis", "rationale")}
    got = sorted(map(tuple, defects(df, "aug_id", answers, ["title", "original_rationale"], "original_rationale", languages).collect()))
    assert got == [(1, "rationale", "empty"), (1, "source_analysis", "empty"), (2, "rationale", "truncated")]
    assert defects(df.limit(0), "aug_id", answers, ["title"], "title", languages).count() == 0


NOUNS = "ferry quarry orchard telescope canal bell audit choir anchor lantern barrel bridge ticket jury bank crew petition tower reservoir clerk".split()
VERBS = "blocked supplied alarmed divided rescued delayed overtook replaced ignored persuaded financed startled".split()


def sentence(rng, n):
    return " ".join(f"{rng.choice(NOUNS)} {rng.choice(VERBS)} {rng.choice(NOUNS)} {rng.randrange(400)}" for _ in range(n))


def test_words_apart_from_dress():
    plain = plain_words("The night ferry's old-fashioned bell isn't lost")
    for dressed in ("THE NIGHT FERRY’S old-fash-\nioned bell isn't lost!", "<p>The <b>night</b> ferry's old-fashioned&nbsp;bell isn’t lost</p>", "> The night f​erry's **old-fashioned**\n> bell isn't lost.", "Thé nïght ferry's | old‑fashioned | bell isn't lo­st", "- The night ferry's\n\n(continued, sheet 4)\n\nold-fashioned bell\nuser: isn't lost"):
        assert plain_words(dressed) == plain, dressed


def edits(words, item):
    """Brute force: the least errors of any stretch of the text against each stretch of at least 12 item words."""
    for i in range(len(item) - LEAST_WORDS + 1):
        for j in range(i + LEAST_WORDS, min(len(item), i + 2 * LEAST_WORDS) + 1):
            part = item[i:j]
            row = np.zeros(len(words) + 1, int)  # an alignment may begin anywhere in the text
            for k, w in enumerate(part):
                new = np.empty_like(row)
                new[0] = k + 1
                for t, x in enumerate(words):
                    new[t + 1] = min(row[t] + (w != x or x == 0), row[t + 1] + 1, new[t] + 1)
                row = new
            if row.min() * 8 <= len(part):
                return True
    return False


def test_alignment_against_brute_force():
    rng = random.Random(4)
    seen = set()
    for _ in range(150):
        item = [rng.randrange(1, 30) for _ in range(rng.randrange(12, 30))]
        a = rng.randrange(len(item) - 9)
        text = item[a:a + rng.randrange(9, 25)]
        for _ in range(rng.randrange(4)):
            at = rng.randrange(len(text))
            text[at:at + rng.randrange(2)] = [rng.choice([0, 31])] * rng.randrange(2)
        text = [0, 5] + text + [7, 0]
        expected = edits(text, item)
        seen.add(expected)
        assert aligned([np.array(text)], [np.array(item)])[0] == expected, (text, item)
    assert seen == {True, False}


def test_basis_spans_the_leading_directions():
    rng = np.random.default_rng(0)
    a = rng.standard_normal((300, 5)) @ rng.standard_normal((5, 60))
    basis = randomised_basis(a.T @ a, 5)
    assert np.linalg.norm(a - a @ basis @ basis.T) < 1e-6 * np.linalg.norm(a)


def test_leaks_are_found_with_noise(spark):
    rng = random.Random(5)
    items = [(i, sentence(rng, 12)) for i in range(30)]
    documents, truth = [], set()
    for d in range(300):
        text = sentence(rng, 20).split()
        kind = d % 6
        if kind < 3:
            item, words = items[rng.randrange(30)]
            words = words.split()
            size = rng.choice([16, 24, 40])
            a = rng.randrange(len(words) - size + 1)
            passage = words[a:a + size]
            if kind == 1:
                passage[size // 2] = "changed"
            if kind == 2:
                passage = [w.upper() for w in passage]
            text[30:30] = passage
            truth.add((d, item))
        elif kind == 3:
            text[30:30] = items[d % 30][1].split()[:6]  # a short common phrase
        documents.append((d, " ".join(text)))
    documents += [(900, None), (901, ""), (902, "short"), (903, " ".join(w for _, t in documents[:200] if t for w in t.split()))]
    df = spark.createDataFrame(documents, "doc_id long, text string").withColumnRenamed("x", "x")
    found = {tuple(r) for r in leaks(df, "doc_id", "text", spark.createDataFrame(items, "item_id long, text string"), "item_id", "text").collect()}
    long = {p for p in found if p[0] == 903}
    found -= long
    assert truth <= found and len(found - truth) <= 2
    assert {i for _, i in long} == {i for d, i in truth if d < 200} | {i for _, i in long}
    empty = spark.createDataFrame([], "item_id long, text string")
    assert leaks(df, "doc_id", "text", empty, "item_id", "text").count() == 0
    assert leaks(df.limit(0), "doc_id", "text", spark.createDataFrame(items, "item_id long, text string"), "item_id", "text").count() == 0
