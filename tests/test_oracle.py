import pytest

import __spark_entry__ as entry
from foreglass.operators.ranking import rank_forecasters
from foreglass.queries import core
from foreglass.queries.views import scores
from foreglass.session import scratch
from tests.oracle_check import DATA, assert_equal

def test_only_random_draws_have_no_oracle():
    assert set(core.QUERIES) - set(core.ORACLE) == {"bootstrap_ci"}


@pytest.mark.parametrize("name", sorted(core.ORACLE))
def test_matches_oracle(spark, name):
    with scratch(spark):
        assert_equal(spark, entry.queries()[name], entry.oracle_sql()[name])


def test_intervals_belong_to_the_ranking(spark):
    """The draws are random, but seeded; ranks and scores are those without intervals."""
    rows = {r.forecaster: r for r in entry.queries()["bootstrap_ci"](spark, DATA).collect()}
    plain = {r.forecaster: (r.rank, r.score) for r in rank_forecasters(scores(spark, DATA)).collect()}
    assert {f: (r.rank, r.score) for f, r in rows.items()} == plain
    margins = {f: r["90.0% ci"] for f, r in rows.items()}
    assert margins == {r.forecaster: r["90.0% ci"] for r in entry.queries()["bootstrap_ci"](spark, DATA).collect()}
    assert all(m is None or float(m.removeprefix("±")) >= 0 for m in margins.values())


def test_entry(spark):
    rows = entry.entry(spark).orderBy("rank").collect()
    assert [r.score for r in rows] == sorted(r.score for r in rows) and rows[0]["rank"] == 1
