import random

from foreglass.plans.prefix import group_positions, running_total
from foreglass.plans.skew import hot_keys, skewed_left_join


def test_positions_of_groups_larger_than_a_partition(spark):
    random.seed(0)
    rows = [("hot", random.randrange(50), i) for i in range(3000)] + [(f"g{i % 100}", random.randrange(5), 10_000 + i) for i in range(1000)]
    rows += random.sample(rows, 300)  # repeated rows count once
    random.shuffle(rows)
    got = {(r.g, r.s, r.i): r.position for r in group_positions(spark.createDataFrame(rows, "g string, s int, i int"), "g", ["s", "i"]).collect()}
    expected, last, n = {}, None, 0
    for row in sorted(set(rows)):
        n = n + 1 if row[0] == last else 1
        last = row[0]
        expected[row] = n
    assert got == expected


def test_positions_with_nulls_and_nothing(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", None, 1), ("a", 1, 2)], "g string, s int, i int")
    assert sorted((r.i, r.position) for r in group_positions(df, "g", ["s", "i"]).collect()) == [(1, 1), (2, 2)]
    assert group_positions(df.limit(0), "g", ["s", "i"]).count() == 0
    assert group_positions(df, "g", ["s", "i"], keep=1).count() == 1


def test_running_total(spark):
    rows = [(i, (i * 7) % 13) for i in range(500)]
    got = {r.k: r.running for r in running_total(spark.createDataFrame(rows, "k int, w int").repartition(7), ["k"], "w").collect()}
    total = 0
    for k, w in rows:
        assert got[k] == total
        total += w


def test_hot_keys_are_salted_and_joined_once(spark):
    left = spark.createDataFrame([("hot", i) for i in range(500)] + [(f"k{i}", i) for i in range(50)] + [(None, -1)], "k string, i int")
    right = spark.createDataFrame([("hot", "H"), ("k3", "three")], "k string, v string")
    assert [r.k for r in hot_keys(left, "k", 100).collect()] == ["hot"]
    joined = skewed_left_join(left, right, "k", ["i"], 100).collect()
    assert len(joined) == 551
    assert sum(r.v == "H" for r in joined) == 500 and sum(r.v == "three" for r in joined) == 1
