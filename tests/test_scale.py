"""Bounds that hold whatever the size: salts, partitions, and what is left in the shared folder."""

import os
import types

import pytest
from pyspark.sql import functions as F

from foreglass import session
from foreglass.plans import skew
from foreglass.plans.prefix import group_positions


def test_every_salt_follows_a_fixed_number_of_rows(spark):
    # 400 keys just below and 3 above the old limit of one part in 10,000 (here scaled down with the rows)
    rows = [(f"k{i}", j) for i in range(400) for j in range(9)] + [(f"hot{i}", j) for i in range(3) for j in range(1000)]
    df = spark.createDataFrame(rows, "key string, id long")
    hot = skew.hot_keys(df, "key", hot_rows=8)
    assert hot.count() == 403
    sizes = skew.salted(df, "key", ["id"], hot).groupBy("key", "salt").count()
    assert sizes.agg(F.max("count")).first()[0] <= 3 * 8
    assert skew.hot_keys(df, "key", hot_rows=8, most=3).count() == 3
    assert {r.salts for r in skew.hot_keys(df, "key", hot_rows=8, most=3).collect()} == {125}


def test_skewed_join_keeps_every_row(spark):
    left = spark.createDataFrame([("a", i) for i in range(500)] + [("b", 1), (None, 2), ("c", 3)], "key string, id long")
    right = spark.createDataFrame([("a", 1.5), ("b", 2.5)], "key string, value double")
    got = skew.skewed_left_join(left, right, "key", ["id"], hot_rows=50)
    assert got.count() == 503
    assert {(r.key, r.value) for r in got.collect()} == {("a", 1.5), ("b", 2.5), ("c", None), (None, None)}


def test_range_partitions_follow_the_input(spark, monkeypatch):
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    assert session.input_bytes(df) > 10_000
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert session.partitions(df) == least
    monkeypatch.setattr(session, "PARTITION_BYTES", session.input_bytes(df) // 30)
    assert session.partitions(df) >= 30
    monkeypatch.setattr(session, "MOST_PARTITIONS", 20)
    assert session.partitions(df) == 20


def test_scopes_leave_nothing_behind(spark):
    folder = session.shared_folder(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    checkpoints = {d: set(os.listdir(os.path.join(folder, d))) for d in before}
    with session.scratch(spark):
        df = spark.range(1000).select((F.col("id") % 7).cast("string").alias("g"), "id")
        assert group_positions(session.written(df), "g", ["id"], keep=2).count() == 14
        gone = session.written(df)
        session.discard(gone)
        assert not os.path.exists(gone._scratch_path.removeprefix("file:"))
    after = set(os.listdir(folder))
    assert {d: set(os.listdir(os.path.join(folder, d))) for d in before} == checkpoints
    assert all(not os.listdir(os.path.join(folder, d)) for d in after - before)


def test_a_cluster_needs_a_shared_folder():
    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)

    fake = types.SimpleNamespace(sparkContext=Context(), conf=types.SimpleNamespace(get=lambda *_: None))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(fake)
    assert session.is_local("local[8]") and not session.is_local("local-cluster[3,2,1024]")
