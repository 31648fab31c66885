"""Randomised checks (hypothesis) of the operators with hand-written reference semantics."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from sediment.operators.joins import fanout_left_join, left_join_keys
from sediment.operators.merge import latest_per_key, merge_coalesce

SETTINGS = settings(max_examples=8, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])
HOT = {1: 10_000, 3: 1}
keys = st.one_of(st.none(), st.integers(0, 4))


@SETTINGS
@given(left=st.lists(st.tuples(keys, st.integers(0, 99)), max_size=25),
       right=st.lists(st.tuples(keys, st.integers(0, 99)), max_size=25),
       buckets=st.sampled_from([1, 3]))
def test_fanout_join_matches_nested_loop(spark, left, right, buckets):
    l = spark.createDataFrame(left, "k int, v int")
    r = spark.createDataFrame(right, "rk int, w int")
    got = sorted(map(tuple, fanout_left_join(l, r, "k", "rk", ["w"], hot_rows=HOT[buckets]).collect()),
                 key=repr)
    want = []
    for k, v in left:
        ws = [w for rk, w in right if k is not None and rk == k]
        want += [(k, v, w) for w in ws] or [(k, v, None)]
    assert got == sorted(want, key=repr)
    assert sorted(map(tuple, left_join_keys(l, r, ["k"], ["rk"], ["w"]).collect()), key=repr) == got


@SETTINGS
@given(rows=st.lists(st.tuples(keys, st.integers(0, 9), st.text("ab", max_size=2)), max_size=30))
def test_latest_per_key_matches_python(spark, rows):
    df = spark.createDataFrame(rows, "k int, ts int, v string")
    got = sorted(map(tuple, latest_per_key(df, ["k"], ["ts"]).collect()), key=repr)
    best = {}
    for k, ts, v in rows:
        if k is not None and (k not in best or (ts, v) > best[k][1:]):
            best[k] = (k, ts, v)
    want = list(best.values()) + [r for r in rows if r[0] is None]
    assert got == sorted(want, key=repr)


@SETTINGS
@given(left=st.lists(st.tuples(keys, st.one_of(st.none(), st.integers(0, 9))), max_size=15),
       right=st.lists(st.tuples(keys, st.one_of(st.none(), st.integers(0, 9))), max_size=15))
def test_merge_coalesce_matches_python(spark, left, right):
    l = spark.createDataFrame(left, "k int, a int")
    r = spark.createDataFrame(right, "k int, a int")
    got = sorted(map(tuple, merge_coalesce(l, r, ["k"], ["k", "a"]).collect()), key=repr)
    want, matched_right = [], set()
    for lk, la in left:
        partners = [(j, ra) for j, (rk, ra) in enumerate(right) if lk is not None and rk == lk]
        for j, ra in partners:
            matched_right.add(j)
            want.append((lk, la if la is not None else ra))
        if not partners:
            want.append((lk, la))
    want += [(rk, ra) for j, (rk, ra) in enumerate(right) if j not in matched_right]
    assert got == sorted(want, key=repr)


def _ladder(v, steps, default, inclusive):
    if v is None:
        return default
    for bound, label in steps:
        if (v >= bound) if inclusive else (v > bound):
            return label
    return default


@SETTINGS
@given(values=st.lists(st.one_of(st.none(), st.integers(-5, 12000),
                                 st.sampled_from([0, 9, 10, 11, 49, 50, 99, 100, 101, 999, 1000,
                                                  1001, 9999, 10000, 10001])), min_size=1,
                       max_size=60))
def test_numeric_ladders_match_python(spark, values):
    from pyspark.sql import functions as F
    from sediment.functions import rules as R
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v bigint")
    cases = [
        (R.popularity_category, R.POPULARITY_STRICT, R.POPULARITY_STRICT_ELSE, False),
        (R.popularity_tier, R.POPULARITY_TIERS, R.POPULARITY_TIERS_ELSE, True),
        (R.fork_activity_level, R.FORK_ACTIVITY, R.FORK_ACTIVITY_ELSE, True),
        (R.issue_volume_level, R.ISSUE_VOLUME, R.ISSUE_VOLUME_ELSE, True),
        (R.activity_level, R.COMMENT_ACTIVITY, R.COMMENT_ACTIVITY_ELSE, False),
    ]
    rows = df.orderBy("i").select(*[fn(F.col("v")).alias(f"c{j}")
                                    for j, (fn, *_r) in enumerate(cases)]).collect()
    for j, (_fn, steps, default, inclusive) in enumerate(cases):
        assert [r[j] for r in rows] == [_ladder(v, steps, default, inclusive) for v in values]
