"""Hashes, ranks, splits, batches and copies."""

from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from rungwise.functions.hashing import FOLD, LOW_32, hash_constant, integer_key, mixed, row_hash
from rungwise.operators import growth, ranking, splits


def keys(spark, n, start=0):
    return spark.range(start, start + n).withColumnRenamed("id", "k")


def test_row_hash_is_exact_for_any_key(spark):
    values = [0, 1, 7, 2**31, 2**32 - 1, 2**32, 2**40 + 3, 2**62 + 11, 2**63 - 1, -1, -(2**63)]
    df = spark.createDataFrame([(v,) for v in values], "k long")
    for draw in range(6):
        got = [r[0] for r in df.select(row_hash("k", 42, draw)).collect()]
        assert got == [expected_hash(v, 42, draw) for v in values]


def expected_hash(key, seed=0, draw=0):
    upper = (key >> 32 & LOW_32) * FOLD & LOW_32
    return mixed((key & LOW_32) ^ upper ^ hash_constant(seed, draw))


def test_row_hash_mixes():
    keys_of = range(15000)
    first, second = ({k for k in keys_of if expected_hash(k, s) < 0.7 * 2**32} for s in (0, 1))
    assert abs(len(first & second) / 15000 - 0.49) < 0.01
    order = sorted(keys_of, key=expected_hash)
    assert len({b - a for a, b in zip(order, order[1:])}) > 1000
    assert len({expected_hash(5 + (k << 32)) for k in range(100)}) == 100


def test_null_keys_go_one_way(spark):
    df = spark.createDataFrame([(None,), (1,), (2,)], "k long")
    assert splits.split_part(df, "k").filter("k is null").first()["part"] == "train"
    assert splits.kfold_assign(df, "k").filter("k is null").first()["fold"] == 0
    assert splits.shuffle_rows(df, "k").filter("k is null").first()["position"] == 1


def test_head_split_of_any_bigint(spark):
    values = sorted([-(2**63), -(2**62), -5, 0, 7, 2**61, 2**63 - 2, 2**63 - 1])
    df = spark.createDataFrame([(v,) for v in values], "k long")
    for n in (1, 3, 5, 7):
        valid, train = splits.head_split(df, "k", n)
        assert sorted(r[0] for r in valid.collect()) == values[:n] and train.count() == 8 - n


def test_row_hash_takes_other_keys(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "s string, i int")
    got = [r[0] for r in df.select(row_hash(integer_key("s", "i"))).collect()]
    assert len(set(got)) == 2 and all(0 <= g < 2**32 for g in got)


def test_split_parts_are_disjoint_and_whole(spark):
    df = keys(spark, 5000)
    train, test = splits.hash_split(df, "k")
    a, b = ({r[0] for r in part.collect()} for part in (train, test))
    assert not a & b and a | b == set(range(5000)) and abs(len(a) - 3500) < 50
    again, _ = splits.hash_split(df.repartition(7), "k")
    assert {r[0] for r in again.collect()} == a


def test_split_keeps_rows_without_key(spark):
    df = spark.createDataFrame([(None,), (1,), (2,)], "k long")
    assert sum(part.count() for part in splits.hash_split(df, "k")) == 3
    assert sum(part.count() for part in splits.head_split(df, "k", 1)) == 3


def test_folds_cover_the_training_part(spark):
    train, _ = splits.hash_split(keys(spark, 10000), "k")
    sizes = dict(splits.kfold_assign(train, "k").groupBy("fold").count().collect())
    assert sorted(sizes) == [0, 1, 2, 3, 4] and max(sizes.values()) < 1.1 * min(sizes.values())


@pytest.mark.parametrize("n", [0, 1, 10, 999, 1000, 5000])
def test_head_split(spark, n):
    scattered = keys(spark, 1000).select((F.col("k") * F.col("k") * 977 - 10**6).alias("k"))
    values = sorted(k * k * 977 - 10**6 for k in range(1000))
    valid, train = splits.head_split(scattered, "k", n)
    assert sorted(r[0] for r in valid.collect()) == values[:n]
    assert sorted(r[0] for r in train.collect()) == values[n:]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.sets(st.integers(-(2**40), 2**40), min_size=1, max_size=40), n=st.integers(1, 45))
def test_nth_smallest(spark, values, n):
    df = spark.createDataFrame([(v,) for v in values], "k long")
    assert ranking.nth_smallest(df, "k", n, slots=4) == sorted(values)[min(n, len(values)) - 1]


def test_hash_rank_is_a_permutation_in_hash_order(spark):
    df = keys(spark, 3000)
    rows = ranking.hash_rank(df, "k", seed=5).collect()
    order = sorted(range(3000), key=lambda k: expected_hash(k, 5))
    assert [r["k"] for r in sorted(rows, key=lambda r: r["position"])] == order
    assert order != sorted(order)


def test_hash_rank_breaks_ties_by_key(spark):
    tied = 3 ^ (FOLD * 1 & LOW_32) | 1 << 32  # folds to the same 32 bits as 3
    df = spark.createDataFrame([(v,) for v in (tied, 3, 4)], "k long")
    rows = {r["k"]: r["position"] for r in ranking.hash_rank(df, "k").collect()}
    assert sorted(rows.values()) == [1, 2, 3] and rows[tied] == rows[3] + 1


def test_shuffled_rows_come_out_in_order(spark):
    positions = [r["position"] for r in splits.shuffle_rows(keys(spark, 2000), "k", 42).collect()]
    assert positions == list(range(1, 2001))


def test_global_rank_matches_sort(spark):
    df = keys(spark, 1500).select("k", (F.col("k") % 7).alias("g"))
    ranked = ranking.global_rank(df, [F.desc("g"), F.asc("k")])
    rows = sorted(ranked.collect(), key=lambda r: r["position"])
    assert [r["position"] for r in rows] == list(range(1, 1501))
    assert [(r["g"], r["k"]) for r in rows] == sorted(((k % 7, k) for k in range(1500)), key=lambda t: (-t[0], t[1]))


@pytest.mark.parametrize("size,replicas,count", [(64, 1, 16), (64, 4, 4), (1000, 1, 1), (7, 1, 143)])
def test_batches_are_full_but_the_last(spark, size, replicas, count):
    sizes = splits.batch_assign(keys(spark, 1000), "k", size, 42, replicas).groupBy("batch_id").count().collect()
    by_batch = dict(sizes)
    assert sorted(by_batch) == list(range(count))
    assert all(by_batch[b] == size * replicas for b in range(count - 1))
    assert sum(by_batch.values()) == 1000


def test_empty_table(spark):
    empty = keys(spark, 0)
    assert splits.batch_assign(empty, "k", 8).count() == 0
    assert [p.count() for p in splits.head_split(empty, "k", 5)] == [0, 0]
    assert growth.bag_multiply(empty, 3).count() == 0


@pytest.mark.parametrize("m,slices,partitions", [(1, 1, None), (31, 1, 4), (31, 4, 3), (5, 9, None)])
def test_bag_multiply(spark, m, slices, partitions):
    df = keys(spark, 20).withColumn("v", F.col("k") * 2)
    grown = growth.bag_multiply(df, m, partitions, slices, copy="copy")
    rows = grown.collect()
    assert len(rows) == 20 * m
    assert {(r["k"], r["copy"]) for r in rows} == {(k, c) for k in range(20) for c in range(m)}
    assert growth.bag_multiply(df, m, partitions, slices).columns == df.columns


def test_multiply_moves_each_row_once(spark):
    """Rows are spread before they multiply: the explode sits above the exchange."""
    plan = growth.bag_multiply(keys(spark, 20), 351, 4)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index("Repartition")
    assert plan.count("Generate") == 1 and "Join" not in plan


def test_multiply_rejects_no_copies(spark):
    with pytest.raises(ValueError):
        growth.bag_multiply(keys(spark, 1), 0)


@pytest.mark.parametrize("max_m,step,last", [(401, 40, 401), (600, 30, 571), (200, 10, 191)])
def test_ladder_rungs(max_m, step, last):
    rungs = growth.ladder_rungs(max_m, step)
    assert rungs[:2] == [1, step + 1] and rungs[-1] == last


def test_ladder_frames_match_sizes(spark):
    df = keys(spark, 10)
    assert [(m, frame.count()) for m, frame in growth.scaling_ladder(df, 21, 10)] == [(m, m * df.count()) for m in (1, 11, 21)]


def test_union_by_position_and_name(spark):
    a = spark.createDataFrame([(1, 2)], "x int, y int")
    b = spark.createDataFrame([(3, 4)], "y int, x int")
    assert sorted(map(tuple, growth.union_all(a, b, a).collect())) == [(1, 2), (1, 2), (3, 4)]
    assert sorted(map(tuple, growth.union_all(a, b, by_name=True).collect())) == [(1, 2), (4, 3)]
