import pytest
from pyspark.sql import functions as F

from foreglass.functions import text


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values)) if values else spark.range(1)
    return df.select(column.alias("x")).collect()[0].x


def test_market_lists(spark):
    for given, expected in [('["A", "B"]', "A, B"), ("['A', 'B']", "A, B"), ('{"A": 1, "B": 0}', "A, B"), ("?", text.NO_OUTCOME), ("[1", text.NO_OUTCOME)]:
        assert one(spark, text.market_list_text(F.col("m")), m=given) == expected


def test_thinking_is_split_at_the_tag(spark):
    for given, thinking, content in [("<think>a</think> b", "a", "b"), ("only", None, "only"), ("a</think>", "a", ""), (None, None, None)]:
        t, c = text.split_thinking(F.col("t"))
        df = spark.createDataFrame([(given,)], "t string").select(t.alias("t"), c.alias("c"))
        assert tuple(df.collect()[0]) == (thinking, content)


def test_thinking_ids(spark):
    df = spark.createDataFrame([([1, 9, 2, 9, 3],), ([1, 2],), ([],)], "i array<int>")
    t, c = text.split_thinking_ids(F.col("i"), 9)
    assert [(r.t, r.c) for r in df.select(t.alias("t"), c.alias("c")).collect()] == [([1, 9, 2, 9], [3]), ([], [1, 2]), ([], [])]


def test_probability_blocks(spark):
    block, strict = text.tagged_probabilities(F.col("c")), text.strict_probabilities(F.col("c"))
    for given, loose, tight in [('x<probabilities>{"A": 0.5}</probabilities>', '{"A": 0.5}', '{"A": 0.5}'), ('<probabilities>\n{"A": 1}\n</probabilities>', '{"A": 1}', '{"A": 1}'), ('{"A": 1}', '{"A": 1}', None), ('<probabilities>{"A": 1}', '<probabilities>{"A": 1}', '{"A": 1}'), ('{"A": 1}</probabilities>', '{"A": 1}', None)]:
        assert one(spark, block, c=given) == loose
        assert one(spark, strict, c=given) == tight
    assert one(spark, text.probabilities_of(F.col("c")), c='{"probabilities": {"A": 0.5}}') == {"A": 0.5}
    assert one(spark, text.probabilities_of(F.col("c")), c="{'A': 0.5}") == {"A": 0.5}
    assert one(spark, text.probabilities_of(F.col("c")), c="nothing") is None


def test_rationales(spark):
    rows = [(1, ("a leakage", "b", "c")), (2, ("a Leakage", "the vanilla reasoning", "original rationale")), (3, None), (4, (None, "b", "c"))]
    df = spark.createDataFrame(rows, "i int, augmented_rationale struct<source_analysis: string, market_analysis: string, rationale: string>")
    got = {r.i: tuple(r.augmented_rationale) for r in text.clean_rationales(df).collect()}
    assert got == {2: ("a Leakage", "the given context", "given context"), 4: (None, "b", "c")}
    answers = text.clean_rationales(df).select("i", text.assistant_text(F.col("augmented_rationale"), F.lit("{}")).alias("a"))
    assert {r.i: r.a is None for r in answers.collect()} == {2: False, 4: True}


def test_chats(spark):
    df = spark.range(1).select(text.chat(F.lit("s"), F.lit("u"), F.lit("a")).alias("three"), text.chat(F.lit("s"), F.lit("u")).alias("two"), F.array(text.message("user", F.lit("u"))).alias("one"))
    r = df.select(*(text.without_assistant(F.col(c)).alias(c) for c in df.columns)).collect()[0]
    assert [m.role for m in r.three] == [m.role for m in r.two] == ["system", "user"] and r.one is None


def test_prompts_without_market_data(spark):
    with_data = one(spark, text.user_prompt(F.lit("t"), F.lit("A"), F.lit("s"), F.lit('{"A": 1}')))
    for missing in (None, "", "{}"):
        without = one(spark, text.user_prompt(F.lit("t"), F.lit("A"), F.lit("s"), F.lit(missing).cast("string")))
        assert "Market prices" not in without and "Market prices" in with_data


def test_small_helpers(spark):
    assert one(spark, text.clean_title(F.col("t")), t=' <event>"A title"</event> ') == "A title"
    assert one(spark, text.month_day(F.col("t")), t="2025-03-09 14") == "03_09"
    assert one(spark, text.month_day(F.col("t")), t="soon") is None
    assert len(one(spark, text.prompt_hash(F.lit("a"), F.lit("b")))) == 8


def test_tolerant_json_reads_odd_rows_only_where_needed(spark):
    df = spark.createDataFrame([(1, '{"a": 1}'), (2, '```json\n{"a": 2}\n```'), (3, None), (4, "{")], "i int, t string")
    got = {r.i: r.v and r.v.a for r in text.tolerant_json(df, "t", "struct<a: int>", "v").collect()}
    assert got[1] == 1 and got[2] == 2 and got[3] is None


@pytest.mark.parametrize("title", ["", "nan", None])
def test_failed_titles_leave_the_old_one(spark, title):
    from foreglass.operators.enrich import with_augmented_titles

    df = spark.createDataFrame([("e", "old")], "event_ticker string, title string")
    new = spark.createDataFrame([("e", title)], "event_ticker string, augmented_title string")
    assert with_augmented_titles(df, new).collect()[0].title == "old"
