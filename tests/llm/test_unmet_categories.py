"""Problem 1: the categories that fall short come from the drawn sample."""

from collections import defaultdict

import pytest

from foreglass.llm import raking
from foreglass.llm.queries import QUERIES
from foreglass.llm.raking import RakedSample
from foreglass.session import scratch
from tests.oracle_check import DATA

ROWS, TARGETS = "event string, record string, category string, round int", "category string, target_share double, min_rows int, sample_size long"


def test_found_goes_through_every_step(spark, monkeypatch):
    ran, drawn = set(), []
    for step in ("rake", "repaired_quotas", "group_positions"):
        monkeypatch.setattr(raking, step, lambda *a, _step=step, _run=getattr(raking, step), **k: ran.add(_step) or _run(*a, **k))
    report = RakedSample.report
    monkeypatch.setattr(RakedSample, "report", lambda self: drawn.append(self.rows.count()) or report(self))
    with scratch(spark):
        found = [r.category for r in QUERIES["p1_found"](spark, DATA).collect()]
        assert ran == {"rake", "repaired_quotas", "group_positions"} and len(drawn) == 1 and drawn[0] > 0
        reported = [r.category for r in QUERIES["p1_report"](spark, DATA).collect() if r.short]
    assert sorted(found) == sorted(reported) and found


def listed(name, n, event="e", per_event=5):
    return [(f"{event}{k // per_event}", f"{name.strip().lower()}{k}", name, k % 3) for k in range(n)]


@pytest.mark.parametrize(
    "rows,targets,expected",
    [
        # a minimum beyond the sample's size leaves nothing for the others, who have the records
        (listed("a", 60) + listed("b", 60, "f"), [("a", 0.5, 50, 40), ("b", 0.5, 0, 40)], {"a": (60, 50, 40), "b": (60, 20, 0)}),
        # one record too few, and just enough
        (listed("A ", 29) + listed("b", 30, "f"), [("a", 0.5, 0, 60), ("B", 0.5, 0, 60)], {"a": (29, 30, 29), "B": (30, 30, 30)}),
        # six and more of an event count as five
        (listed("a", 40, per_event=20) + listed("b", 80, "f"), [("a", 0.2, 0, 60), ("b", 0.8, 0, 60)], {"a": (10, 12, 10), "b": (80, 48, 50)}),
        # records that stand under both categories, in shared events
        (listed("a", 20) + [(e, r, "b", m) for e, r, _, m in listed("a", 20)], [("a", 0.5, 0, 40), ("b", 0.5, 0, 40)], {"a": (20, 20, None), "b": (20, 20, None)}),
        # no wish, no records, nothing to draw
        (listed("a", 3), [("a", 1.0, 0, 3), ("none", 0.0, 0, 3), ("least", 0.0, 1, 3)], {"a": (3, 3, 3), "none": (0, 0, 0), "least": (0, 1, 0)}),
        ([], [("a", 1.0, 0, 3)], {"a": (0, 3, 0)}),
        (listed("a", 3), [], {}),
    ],
)
def test_unmet_against_brute_force(spark, rows, targets, expected):
    with scratch(spark):
        sample = RakedSample(spark.createDataFrame(rows + rows[:2], ROWS), spark.createDataFrame(targets, TARGETS), "event", "record", "category", "round")
        report = {r.category: r for r in sample.report().collect()}
        found = sorted(r.category for r in sample.unmet().collect())
    events = defaultdict(set)
    for e, r, c, _ in rows:
        events[c.strip().lower(), e].add(r)
    have = {c: sum(min(5, len(v)) for (k, _), v in events.items() if k == c.lower()) for c in report}
    assert {c: (have[c], r.wanted, r.drawn if expected[c][2] is not None else None) for c, r in report.items()} == expected
    assert found == sorted(c for c, r in report.items() if have[c] < r.wanted)


@pytest.mark.parametrize("shares", [{"a": 0.3, "b": 0.7, "zero": 0.0}, {"a": 0.0, "b": 0.0, "zero": 0.0, "none": 1.0}])
def test_shares_of_zero_are_fitted_alike(spark, shares):
    rows = [(f"e{k}", f"s{k}", "ab"[k % 3 % 2], (k * k) % 5) for k in range(90)] + [(f"z{k}", f"z{k}", "zero", 9 + k % 2) for k in range(8)]
    df, targets = spark.createDataFrame(rows, ROWS), spark.createDataFrame([(c, s, 1, 30) for c, s in shares.items()], TARGETS)
    with scratch(spark):
        fits = []
        for cells in (1000, 2):
            sample = RakedSample(df, targets, "event", "record", "category", "round", driver_cells=cells)
            fits.append(({(r.category, r.margin): r.weight for r in sample.weights.collect()}, sorted(r.category for r in sample.unmet().collect())))
    assert fits[0][0] == pytest.approx(fits[1][0], rel=1e-6) and fits[0][1] == fits[1][1] == ["none"] * ("none" in shares)
