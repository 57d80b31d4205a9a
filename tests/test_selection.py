import pytest

from foreglass.operators import analyze, sampling, selection

SCHEMA = "row_id int, forecaster string, event_ticker string, submission_id string, round int, brier_score double"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def ids(df):
    return sorted(r.row_id for r in df.collect())


@pytest.fixture()
def empty(spark):
    return frame(spark, [])


def test_top_absolute(spark):
    df = frame(spark, [(i, f"f{i}", "e", "s", 0, s) for i, s in enumerate([0.3, 0.1, 0.1, None, 0.2])] + [(9, "f", "e", None, 0, 0.0)])
    assert ids(selection.top_absolute(df, "brier_score", "row_id", top_k=2)) == [1, 2]
    assert ids(selection.top_absolute(df, "brier_score", "row_id", top_p=0.1)) == [1]  # at least one
    assert ids(selection.top_absolute(df, "brier_score", "row_id", top_k=4, min_val=0.2)) == [1, 2, 4]
    with pytest.raises(ValueError):
        selection.top_absolute(df, "brier_score", "row_id", top_p=1.5)


def test_z_score_skips_groups_it_makes_no_sense_for(spark):
    good = [(i, f"f{i}", "e", "s", 0, 0.5) for i in range(9)] + [(9, "f9", "e", "s", 0, 0.05)]
    repeated = [(20 + i, "f", "e", "t", 0, 0.5 * i) for i in range(3)]
    flat = [(30 + i, f"f{i}", "e", "u", 0, 0.5) for i in range(3)]
    single = [(40, "f", "e", "v", 0, 0.0)]
    df = frame(spark, good + repeated + flat + single)
    assert ids(selection.top_z_score(df, "brier_score", "row_id", 1.5)) == [9]
    assert ids(selection.top_z_score(df, "brier_score", "row_id", 1.5, max_mean=0.9)) == []


def test_ambiguous_needs_every_score_above_the_bound(spark):
    df = frame(spark, [(1, "a", "e", "s", 0, 0.2), (2, "b", "e", "s", 0, 0.25), (3, "c", "e", "s", 0, 0.16), (4, "a", "e", "t", 0, 0.15), (5, "b", "e", "t", 0, 0.2), (6, "a", "e", "u", 0, 0.2), (7, "b", "e", "u", 0, None)])
    assert ids(selection.ambiguous(df, "brier_score", "row_id")) == [1, 3]
    assert ids(selection.ambiguous(df, "brier_score", "row_id", top_k=1)) == [3]


def test_combine_keeps_the_earliest_part(spark):
    a = frame(spark, [(5, "f", "e", "s", 0, 0.1)])
    c = frame(spark, [(1, "f", "e", "s", 0, 0.2), (2, "g", "e", "s", 0, 0.2)])
    assert ids(selection.combine([a, c], "row_id", c)) == [2, 5]
    assert ids(selection.combine([], "row_id", c)) == [1, 2]


def test_filters_of_an_empty_table(empty):
    for df in (selection.top_absolute(empty, "brier_score", "row_id"), selection.top_z_score(empty, "brier_score", "row_id"), selection.ambiguous(empty, "brier_score", "row_id", top_k=2), selection.deduplicate_problems(empty, "row_id"), selection.cap_per_event(empty, ["row_id"])):
        assert df.columns == empty.columns and df.count() == 0


def test_deduplication_and_limits(spark):
    df = frame(spark, [(1, "a", "e", "s", 0, 0.5), (2, "b", "e", "s", 0, 0.1), (3, "c", "e", "t", 0, None), (4, "c", None, None, 0, 0.3), (5, "d", None, None, 0, 0.2)])
    assert ids(selection.deduplicate_problems(df, "row_id")) == [1, 3, 4]
    assert ids(selection.deduplicate_problems(df, "row_id", "best_brier")) == [2, 3, 5]
    assert ids(selection.deduplicate_problems(df, "row_id", "random", 7)) == ids(selection.deduplicate_problems(df.repartition(5), "row_id", "random", 7))
    assert ids(selection.limit_problems(df, "row_id", 2, shuffle=False)) == [1, 2]
    assert selection.limit_problems(df, "row_id", None).count() == 5


def test_membership(spark):
    df = frame(spark, [(1, "a", "e", "s", 0, 0.5), (2, "a", None, None, 0, 0.5), (3, "a", "e", "t", 0, 0.5)])
    held = spark.createDataFrame([("e", "s"), (None, None)], "event_ticker string, submission_id string")
    assert ids(selection.exclude_pairs(df, held)) == [3]
    assert ids(selection.exclude_pairs(df, held.drop("event_ticker"))) == [1, 2, 3]
    todo, kept = selection.remaining_work(df, spark.createDataFrame([("s", "a"), ("z", "a")], "submission_id string, forecaster string"))
    assert ids(todo) == [2, 3] and kept.count() == 1


def test_split_keeps_events_whole_and_is_seeded(spark):
    df = frame(spark, [(i, "f", f"e{i % 17}", "s", 0, 0.1) for i in range(400)])
    split = sampling.split_by_event(df, 0.25, 3)
    by_event = {}
    for r in split.collect():
        by_event.setdefault(r.event_ticker, set()).add(r.split)
    assert all(len(s) == 1 for s in by_event.values())
    assert 100 <= split.filter("split = 'test'").count() < 100 + 24
    again = {(r.row_id, r.split) for r in sampling.split_by_event(df.repartition(3), 0.25, 3).collect()}
    assert again == {(r.row_id, r.split) for r in split.collect()}
    assert sampling.split_by_event(df.limit(0), 0.25).count() == 0


def test_category_sample_keeps_budget_and_cap(spark):
    rows = [(i, f"e{i % 20}", "A" if i % 20 < 10 else ("B" if i % 20 < 15 else "C")) for i in range(200)]
    df = spark.createDataFrame(rows, "row_id int, event_ticker string, category string")
    got = sampling.category_sample(df, {"A": 7, "B": 100}, "row_id", 3, other=4).collect()
    count = lambda c: sum(r.category == c for r in got)
    assert (count("A"), count("B"), count("C")) == (7, 15, 4)
    events = [r.event_ticker for r in got]
    assert max(map(events.count, events)) <= 3


def test_assignment(spark):
    df = spark.createDataFrame([(i,) for i in range(50)], "row_id int")
    disjoint = sampling.assign_random(df, ["a", "b"], 0.4, "row_id", overlap=False).collect()
    assert len({r.row_id for r in disjoint}) == len(disjoint) == 40
    same = sampling.assign_random(df, ["a", "b"], 0.4, "row_id", same_sample=True).collect()
    assert {r.row_id for r in same if r.augmenter == "a"} == {r.row_id for r in same if r.augmenter == "b"}
    assert sampling.assign_repetitive(df, ["a", "b"]).count() == 100
    with pytest.raises(ValueError):
        sampling.assign_random(df, ["a", "b"], 0.6, "row_id", overlap=False)


def test_report_names_every_value(spark):
    df = frame(spark, [(i, f"f{i}", "e", "s", 0, 0.5) for i in range(9)] + [(9, "f9", "e", "s", 0, 0.05)])
    text = analyze.report([analyze.sweep_z(df, "brier_score", "row_id"), analyze.sweep_ambiguous(df, "brier_score", "row_id")], analyze.estimate_traces(df, "brier_score", "row_id", 2, 0.5))
    assert "min_z" in text and "union" in text
