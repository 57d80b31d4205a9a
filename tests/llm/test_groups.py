"""Problems 1, 2, 4 and 5: samples, splits, best rows and cutoffs, against brute force."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from foreglass.llm.cutoff import cutoffs, select_ranks, sorted_arrays
from foreglass.llm.queries import scored
from foreglass.llm.raking import RakedSample, rake, repaired_quotas
from foreglass.llm.splits import bound_labels, bound_pairs, components, plain_hex, plain_ticker, split_together
from foreglass.llm.topn import top_n


def scored_rows(n=4000, seed=0):
    rng = random.Random(seed)
    rows = [("hot" if rng.random() < 0.4 else f"g{rng.randrange(300)}", rng.choice([0.0, 0.1, 0.2, round(rng.random(), 3)]), rng.choice(["b", "a", None, "é", "Z"]), i, "extra") for i in range(n)]
    rows += rng.sample(rows, 200)
    return rows + [(None, 0.1, "a", n + 1, "extra")]


SCORED = "g string, s double, f string, i int, position string"


@pytest.mark.parametrize("block", [100, 100_000])
def test_top_n_against_brute_force(spark, block):
    rows = scored_rows()
    groups = defaultdict(set)
    for g, s, f, i, _ in rows:
        if g is not None:
            groups[g].add((s, f is not None, (f or "").encode(), i))
    expected = {(g, r[3]): k + 1 for g, rs in groups.items() for k, r in enumerate(sorted(rs)[:3])}
    df = spark.createDataFrame(rows, SCORED).repartition(6)
    got = {(r.g, r.i): r.position for r in top_n(df, "g", ["s", "f", "i"], 3, block).collect()}
    assert got == expected
    assert got == {(r.g, r.i): r.position for r in top_n(df.repartition(2), "g", ["s", "f", "i"], 3).collect()}


def test_top_n_of_nothing(spark):
    assert top_n(spark.createDataFrame([], SCORED), "g", ["s", "i"], 3).count() == 0


@pytest.mark.parametrize("array_rows", [10, 300, 50_000])
def test_cutoffs_against_brute_force(spark, array_rows):
    rows = scored_rows(3000, 1) + [("g1", float("nan"), "a", -1, ""), ("g1", None, "a", -2, "")]
    rows += [("low", float("-inf") if i % 2 else 0.5, "a", 10_000 + i, "") for i in range(120)] + [("high", float("inf"), "a", 20_000 + i, "") for i in range(90)]
    groups = defaultdict(dict)
    for g, s, _, i, _ in rows:
        if g is not None and s is not None and s == s:
            groups[g][i] = s
    report, kept = cutoffs(spark.createDataFrame(rows, SCORED), "g", "s", "i", (1, 5), array_rows)
    found = {r.source: (r.cutoff, r.n_scored, r.n_kept) for r in report.collect()}
    ids = {(r.source, r.id) for r in kept.collect()}
    expected, expected_ids = {}, set()
    for g, by_id in groups.items():
        values = sorted(by_id.values())
        cutoff = values[max(1, len(values) // 5) - 1]
        expected_ids |= {(g, i) for i, s in by_id.items() if s <= cutoff}
        expected[g] = (cutoff, len(values), sum(s <= cutoff for s in values))
    assert found == expected and ids == expected_ids


def test_cutoffs_of_nothing_and_of_one_score(spark):
    report, kept = cutoffs(spark.createDataFrame([], SCORED), "g", "s", "i", (1, 5))
    assert report.count() == kept.count() == 0
    same = spark.createDataFrame([("g", 0.5, "a", i, "") for i in range(500)], SCORED)
    report, kept = cutoffs(same, "g", "s", "i", (1, 5), array_rows=50)
    assert report.collect()[0].n_kept == 500 == kept.count()


def test_every_source_is_found_by_rounds_over_bounded_arrays(spark):
    rng = random.Random(5)
    rows = [("hot", rng.random(), None, i, "") for i in range(5000)] + [(f"g{i % 40}", rng.random(), None, 10_000 + i, "") for i in range(400)]
    arrays = sorted_arrays(spark.createDataFrame(rows, SCORED), "g", "s", "i", 100).cache()
    assert arrays.agg(F.max(F.size("scores"))).first()[0] <= 100
    assert arrays.filter("source = 'hot'").count() >= 50
    wanted = arrays.groupBy("source").agg(F.sum(F.size("scores")).alias("n")).withColumn("k", F.greatest(F.lit(1), F.expr("n div 5")))
    found, rounds = select_ranks(arrays, wanted)
    by_source = defaultdict(list)
    for g, s, *_ in rows:
        by_source[g].append(s)
    assert {r.source: r.cutoff for r in found.collect()} == {g: sorted(v)[max(1, len(v) // 5) - 1] for g, v in by_source.items()}
    assert 1 < rounds < 12


def test_rounds_on_the_smallest_tables(spark):
    rows = scored(spark, "/root/testdata/sf0.001")
    arrays = sorted_arrays(rows, "submission_id", "brier_score", "score_id").cache()
    wanted = arrays.groupBy("source").agg(F.sum(F.size("scores")).alias("n")).withColumn("k", F.greatest(F.lit(1), F.expr("n div 5")))
    found, rounds = select_ranks(arrays, wanted)
    assert rounds > 0 and found.count() == rows.select("submission_id").distinct().count()


def union_find(rows):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in rows:
        parent[find(a)] = find(b)
    return {x: find(x) for x in list(parent)}


def test_components_against_union_find(spark):
    rng = random.Random(2)
    edges = [(f"v{rng.randrange(400)}", f"v{rng.randrange(400)}") for _ in range(260)] + [("hub", f"v{i}") for i in range(0, 150)] + [("v1", "v1"), (None, "v2"), ("v3", None)]
    roots = {r.vertex: r.root for r in components(spark.createDataFrame(edges, "u string, v string")).collect()}
    truth = union_find([e for e in edges if None not in e])
    groups = defaultdict(set)
    for v in truth:
        groups[roots.get(v, v)].add(truth[v])
    assert all(len(g) == 1 for g in groups.values()) and len(groups) == len(set(truth.values()))
    assert components(spark.createDataFrame([], "u string, v string")).count() == 0


def test_chain_is_one_component(spark):
    edges = [(f"v{i:03}", f"v{i + 1:03}") for i in range(200)]
    roots = components(spark.createDataFrame(edges, "u string, v string")).collect()
    assert len(roots) == 200 and len({r.root for r in roots}) == 1


def test_identifiers_in_every_notation(spark):
    df = spark.createDataFrame([(" a-1 ", "{AB12-0}"), ("A-1\t", "ab120"), ("  ", "0000-0"), (None, None), ("b", "  ")], "t string, s string")
    rows = df.select(plain_ticker(F.col("t")).alias("t"), plain_hex(F.col("s")).alias("s")).collect()
    assert [tuple(r) for r in rows] == [("A-1", "ab120"), ("A-1", "ab120"), (None, None), (None, None), ("B", None)]


def test_splits_keep_bound_rows_together(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice(["HOT"] * 3 + [f"e{k}" for k in range(300)] + [None]), rng.choice([f"{k:x}f" for k in range(900)] + ["0", None]), "x") for i in range(3000)]
    df = spark.createDataFrame(rows, "id int, e string, s string, component string")
    shares = [("train", 0.6), ("test", 0.2), ("validation", 0.2)]
    got = {r.id: r.split_name for r in split_together(df, "id", plain_ticker(F.col("e")), plain_hex(F.col("s")), shares).collect()}
    assert set(got) == set(range(3000))
    labels = union_find([(("r", i), ("e", e.upper())) for i, e, _, _ in rows if e] + [(("r", i), ("s", s)) for i, _, s, _ in rows if s and s != "0"])
    by_component = defaultdict(set)
    sizes = Counter(labels.get(("r", i), i) for i in got)
    for i, split in got.items():
        by_component[labels.get(("r", i), i)].add(split)
    assert all(len(s) == 1 for s in by_component.values())
    counts = Counter(got.values())
    if max(sizes.values()) <= 0.6 * 3000:
        assert abs(counts["train"] / 3000 - 0.6) < 0.05
    assert split_together(df.limit(0), "id", F.col("e"), F.col("s"), shares).count() == 0


def test_pairs_of_bound_hubs(spark):
    df = spark.createDataFrame([("A", "1"), ("B", "1"), ("B", "2"), ("C", "2"), ("D", "3"), ("D", "4"), ("E", None), (None, "1")], "hub string, spoke string")
    roots, _ = bound_labels(df, "hub", "spoke")
    assert sorted(map(tuple, bound_pairs(roots).collect())) == [("A", "B"), ("A", "C"), ("B", "C")]


def test_raking_meets_both_margins():
    counts = np.array([[50.0, 10], [30, 60]])
    w = counts * rake(counts, [np.array([0.3, 0.7]), np.array([0.5, 0.5])])
    assert w.sum(axis=1) / w.sum() == pytest.approx([0.3, 0.7]) and w.sum(axis=0) / w.sum() == pytest.approx([0.5, 0.5])
    assert rake(np.zeros((2, 2)), [np.array([0.5, 0.5])] * 2).tolist() == [[1, 1], [1, 1]]


def test_quotas_are_repaired_within_the_size():
    targets = [{"name": "a", "share": 0.9, "min_rows": 5}, {"name": "b", "share": 0.05, "min_rows": 20}, {"name": "c", "share": 0.05, "min_rows": 10}]
    assert repaired_quotas(targets, {"a": 500, "b": 500, "c": 3}, 100) == {"a": 77, "b": 20, "c": 3}
    assert repaired_quotas(targets, {"a": 500, "b": 10, "c": 30}, 20) == {"a": 5, "b": 10, "c": 5}


def test_sample_keeps_targets_minimums_and_the_cap(spark):
    rows = [(f"e{k % 120}", f"s{k}", [" Sports", "SPORTS", "sports\t", "Art", "art ", None, "Other", ""][(k % 120) % 8], k % 3, "x") for k in range(1500)]
    rows += rows[:200]
    df = spark.createDataFrame(rows, "event string, record string, category string, round int, listed string")
    targets = spark.createDataFrame([("Sports", 0.6, 5, 100), ("Art", 0.3, 5, 100), ("Missing", 0.1, 20, 100)], "category string, target_share double, min_rows int, sample_size long")
    sample = RakedSample(df, targets, "event", "record", "category", "round")
    report = {r.category: r for r in sample.report().collect()}
    supply = {r.category: r for r in sample.shortfalls().collect()}
    assert {c: r.short for c, r in supply.items()} == {c: r.short for c, r in report.items()}
    assert report["Missing"].short == 20 and report["Sports"].short == report["Art"].short == 0
    assert report["Sports"].available == 45 * 5 and report["Art"].available == 30 * 5
    drawn = sample.rows.collect()
    assert len({(r.event, r.record) for r in drawn}) == len(drawn)
    assert Counter(r.category for r in drawn) == {"Sports": 67, "Art": 33}  # what Missing lacks is drawn from the others
    assert max(Counter(r.event for r in drawn).values()) <= 5
    again = RakedSample(df.repartition(9), targets, "event", "record", "category", "round").rows.collect()
    assert {(r.event, r.record) for r in again} == {(r.event, r.record) for r in drawn}
    nothing = RakedSample(df.limit(0), targets, "event", "record", "category", "round")
    assert nothing.rows.count() == 0 and all(r.short > 0 for r in nothing.report().collect())


def test_report_and_draw_against_each_other(spark):
    rows = [(f"e{k % 90}", f"s{k}", ["Sports", "art", "Space", "Tiny"][(k * 7 + k // 90) % 4 if k % 5 else 0], k % 4) for k in range(900)]
    df = spark.createDataFrame(rows, "event string, record string, category string, round int")
    targets = spark.createDataFrame([("Sports", 0.3, 5, 150), ("Art", 0.3, 5, 150), ("Space", 0.39, 5, 150), ("Tiny", 0.01, 30, 150)], "category string, target_share double, min_rows int, sample_size long")
    sample = RakedSample(df, targets, "event", "record", "category", "round")
    drawn = sample.rows.collect()
    assert len(drawn) == 150 and max(Counter(r.event for r in drawn).values()) <= 5
    counts = Counter(r.category for r in drawn)
    report = {r.category: r for r in sample.report().collect()}
    assert {c: r.drawn for c, r in report.items()} == dict(counts) and counts["Tiny"] == 30
    assert all(abs(r.gap - (r.target_share - r.drawn / 150)) < 1e-12 for r in report.values())
    margins = sample.margin_report().collect()
    assert sum(r.drawn for r in margins) == 150 and max(abs(r.gap) for r in margins) < 0.1
    supply = {r.category: (r.available, r.short) for r in sample.shortfalls().collect()}
    by_event = Counter((r[2].title(), r[0]) for r in rows)
    assert {c: sum(min(5, n) for (k, _), n in by_event.items() if k == c) for c in supply} == {c: a for c, (a, _) in supply.items()}


def test_what_a_category_lacks_is_drawn_from_the_others():
    targets = [{"name": "a", "share": 0.5, "min_rows": 0}, {"name": "b", "share": 0.3, "min_rows": 0}, {"name": "c", "share": 0.2, "min_rows": 0}]
    assert repaired_quotas(targets, {"a": 10, "b": 500, "c": 500}, 100) == {"a": 10, "b": 54, "c": 36}
    assert sum(repaired_quotas(targets, {"a": 10, "b": 20, "c": 5}, 100).values()) == 35


def test_quotas_against_every_slot():
    rng = random.Random(9)
    for _ in range(300):
        targets = [{"name": f"c{i}", "share": rng.choice([0.0, 0.1, 0.25, round(rng.random(), 2)]), "min_rows": rng.choice([0, 0, 3, 20])} for i in range(rng.randrange(1, 6))]
        have, size = {t["name"]: rng.choice([0, 5, 40, 200]) for t in targets}, rng.choice([0, 1, 10, 50, 150, 900])
        slots = []
        for t in targets:
            n, least = t["name"], min(have[t["name"]], t["min_rows"])
            slots += [(0.0 if j <= least else (j - 0.5) / t["share"], n, j) for j in range(1, have[n] + 1) if j <= least or t["share"] > 0]
        counts = Counter(n for _, n, _ in sorted(slots)[:size])
        assert repaired_quotas(targets, have, size) == {t["name"]: counts[t["name"]] for t in targets}
    big = repaired_quotas([{"name": "a", "share": 0.5, "min_rows": 0}, {"name": "b", "share": 0.5, "min_rows": 0}], {"a": 10**12, "b": 10**12}, 10**9)
    assert big == {"a": 5 * 10**8, "b": 5 * 10**8}


def test_more_cells_than_the_driver_holds_are_fitted_alike(spark):
    rows = [(f"e{k}", f"s{k}", "ab"[k % 3 % 2], (k * k) % 5) for k in range(300)]
    df = spark.createDataFrame(rows, "event string, record string, category string, round int")
    targets = spark.createDataFrame([("a", 0.2, 5, 60), ("b", 0.7, 5, 60), ("none", 0.1, 5, 60)], "category string, target_share double, min_rows int, sample_size long")
    pairs = [{(r.category, r.margin): r.weight for r in RakedSample(df, targets, "event", "record", "category", "round", driver_cells=n).weights.collect()} for n in (1000, 2)]
    assert pairs[0] == pytest.approx(pairs[1], rel=1e-6)
