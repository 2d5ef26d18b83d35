"""Set algebra: NULLs, bags, properties, caps, skew."""

import random

import pytest
from hypothesis import given, settings, strategies as st

from fraclake.functions.unsigned import signed
from fraclake.operators import hash_sets as sets

hashes = st.lists(st.integers(0, 60).map(lambda v: signed((v << 58) | v)), max_size=40)


def frame(spark, values, k=31):
    return spark.createDataFrame([(k, v) for v in values], "ksize int, hash bigint")


@settings(max_examples=8, deadline=None)
@given(hashes, hashes)
def test_comparison_properties(spark, a, b):
    one = sets.comparison(sets.membership(frame(spark, a), frame(spark, b))).first()
    x, y = set(a), set(b)
    assert (one.a_total, one.b_total, one.intersection, one.a_only, one.b_only) == (
        len(x), len(y), len(x & y), len(x - y), len(y - x))
    assert one.a_total == one.intersection + one.a_only
    assert one.jaccard_similarity == (len(x & y) / len(x | y) if x | y else 0.0)


def test_null_hashes_are_always_different(spark):
    a, b = frame(spark, [1, None, None]), frame(spark, [None, 2])
    counts = sets.difference_counts(sets.membership(a, b)).first()
    assert (counts.a_not_b, counts.b_not_a) == (2, 2)
    rows = sets.difference(sets.unique_hashes(a), sets.unique_hashes(b)).collect()
    assert {r.hash for r in rows} == {1, None}


def test_buckets_do_not_change_the_difference(spark):
    rng = random.Random(3)
    a = [rng.getrandbits(20) for _ in range(800)]
    b = [rng.getrandbits(20) for _ in range(500)] + a[:200]
    members = sets.membership(frame(spark, a), frame(spark, b))
    total = sets.difference_counts(members).first()
    for bits in (1, 5, 9):
        per = sets.difference_counts_by_bucket(members, bits).collect()
        assert sum(r.a_not_b for r in per) == total.a_not_b and sum(r.b_not_a for r in per) == total.b_not_a
    lost = sets.difference(sets.unique_hashes(frame(spark, a)), sets.unique_hashes(frame(spark, b)))
    assert lost.count() == total.a_not_b == len(set(a) - set(b))


def test_rollup_reports_only_the_right_sides_ksizes(spark):
    a = frame(spark, [1, 2], 15).union(frame(spark, [1], 21))
    b = frame(spark, [2, 3], 15).union(frame(spark, [9], 31))
    got = {r.ksize: r.rhs_not_in_lhs for r in sets.difference_rollup(sets.membership(a, b)).collect()}
    assert got == {15: 1, 31: 1, None: 2}


def test_union_is_idempotent_and_order_free(spark):
    a, b = frame(spark, [1, 2, 2]), frame(spark, [2, 3])
    key = lambda df: sorted(r.hash for r in sets.unique_hashes(df).collect())
    assert key(sets.union_of(a, b)) == key(sets.union_of(b, a, a)) == [1, 2, 3]
    assert key(sets.intersection(sets.unique_hashes(a), sets.unique_hashes(b))) == [2]
    assert key(sets.keep_ksizes(sets.union_of(a, frame(spark, [7], 15)), [15])) == [7]


@pytest.mark.parametrize("scaled", [1, 1000])
def test_row_cap_matches_a_sort(spark, scaled):
    rng = random.Random(8)
    top = (1 << 64) // scaled
    values = [rng.randrange(top) for _ in range(400)]
    bag = values + values[:100] + [values[7]] * 300  # one hash holds a large share of the rows
    rng.shuffle(bag)
    df = spark.createDataFrame([(signed(v),) for v in bag], "hash bigint")
    ordered = sorted(bag)
    for cap in (1, 50, 399, 600, len(bag), 10 * len(bag)):
        got = [r.hash for r in sets.first_rows_distinct(df, cap).collect()]
        assert sorted(got) == sorted({signed(v) for v in ordered[:cap]})


def test_row_cap_keeps_null_hashes(spark):
    df = spark.createDataFrame([(5,), (None,), (None,), (7,)], "hash bigint")
    assert [{r.hash for r in sets.first_rows_distinct(df, n).collect()} for n in (1, 3, 9)] == [{None}, {None, 5}, {None, 5, 7}]


def test_unsigned_sort(spark):
    values = [0, (1 << 63) - 1, 1 << 63, (1 << 64) - 1]
    rows = sets.sorted_hashes(frame(spark, [signed(v) for v in reversed(values)])).collect()
    assert [r.hash for r in rows] == [signed(v) for v in values]


def test_counting_takes_one_shuffle_of_the_hashes(spark, tmp_path):
    for name in "ab":
        spark.range(1000).selectExpr("31 AS ksize", "id AS hash").write.parquet(str(tmp_path / name))
    a, b = (spark.read.parquet(str(tmp_path / n)) for n in "ab")
    plan = sets.comparison(sets.membership(a, b))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
