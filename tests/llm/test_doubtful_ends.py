"""Problem 3: full stops after a last number, judged by the word before it."""

import random

from foreglass.llm.truncation import truncated, truncation_rates


def test_doubtful_ends_by_shares_of_each_model(spark):
    rng = random.Random(3)
    rows = []

    def add(model, text):
        rows.append((len(rows), model, text, None))
        return len(rows) - 1

    def padded(n, end):
        return "x" * (n - len(end) - 1) + " " + end

    for model in ("limited", "other"):
        for _ in range(1500):
            add(model, "x" * rng.randrange(100, 400) + ".")
        for _ in range(40):
            add(model, "It was about 4.5 then, with a count of 7. The bid of 3.2 fell. A bid of 8. It ended.")
    # one transfer cut after 'about' elsewhere must not clear the cuts at the limit
    cuts = {add("limited", padded(301, "about 3.")) for _ in range(60)}
    cuts |= {add("limited", padded(137, "about 42.")), add("other", padded(163, "about 42."))}
    whole = {add("limited", padded(301, "of 3.")), add("limited", padded(211, "of 17.")), add("other", padded(205, "of 9.")), add("other", padded(219, "some 9."))}
    # words of one model say nothing about another
    for _ in range(40):
        add("few", "It was near 4. Then it was near 5. It ended.")
    for _ in range(40):
        add("other", "It was near 4.5 for long. It ended.")
    whole.add(add("few", padded(150, "near 4.")))
    cuts.add(add("other", padded(151, "near 4.")))
    rows += rows[-5:]
    df = spark.createDataFrame(rows, "id int, model string, content string, market_outcome string")
    flagged = truncated(df, "id", "model", "content", "market_outcome")[0]
    found = {r.id for r in flagged.collect() if r.truncated}
    assert found == cuts and not found & whole
    assert {r.source: r.n_truncated for r in truncation_rates(flagged).collect()} == {"limited": 61, "other": 2, "few": 0}


def test_every_flagged_row_names_its_hazard(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randrange(2, 9)))
    text = lambda n: " ".join(word() for _ in range(n)) + "."
    rows = [("limited", t[:300] if len(t := text(rng.randrange(20, 90))) > 300 else t) for _ in range(1500)]
    rows += [("torn", t if rng.random() < 0.8 else t[:rng.randrange(30, len(t))].rstrip(" .") + "x") for t in (text(rng.randrange(20, 90)) for _ in range(1500))]
    rows += [("sound", text(rng.randrange(20, 90))) for _ in range(1500)] + [("sound", "it breaks off in the mid"), ("sound", None), ("sound", " ")]
    df = spark.createDataFrame([(i, s, t, None) for i, (s, t) in enumerate(rows)], "id int, source string, text string, outcomes string")
    flagged, hazards = truncated(df, "id", "source", "text", "outcomes")
    rates = {r.source: r for r in truncation_rates(flagged).collect()}
    cut_off = sum(s == "limited" and len(t) == 300 and not t.endswith(".") for s, t in rows if t)
    assert rates["limited"].n_length == cut_off and rates["limited"].n_truncated == rates["limited"].n_length
    assert rates["torn"].n_transfer + rates["torn"].n_ending == rates["torn"].n_truncated > 200 and rates["torn"].n_ending <= 3
    assert (rates["sound"].n_truncated, rates["sound"].n_ending) == (1, 1)
    found = {(r.source, r.unit) for r in hazards.collect()}
    assert found == {("limited", "chars"), ("limited", "bytes"), ("torn", "transfer")}
    assert {r.length for r in hazards.filter("source = 'limited'").collect()} == {300}
    empty, none = truncated(df.limit(0), "id", "source", "text", "outcomes")
    assert empty.count() == none.count() == 0
