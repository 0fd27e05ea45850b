import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from quizlake.functions import gf
from quizlake.operators import reconcile

SCHEMA = "id bigint, name string, slug string"


def brute(main, copy):
    last = {}
    for r in copy:
        last[r[0]] = max(last.get(r[0], r), r, key=lambda x: (x[3], x[1] is not None, x[1] or "", x[2] is not None, x[2] or ""))
    m, out = {r[0]: r for r in main}, set()
    for i in m.keys() | last.keys():
        if i not in last:
            out.add(("t", i, "only_in_main"))
        elif i not in m:
            out.add(("t", i, "only_in_copy"))
        else:
            out |= {("t", i, f) for k, f in ((1, "name"), (2, "slug")) if m[i][k] != last[i][k]}
    return out


@settings(max_examples=40, deadline=None)
@given(st.sets(st.integers(0, 10**6), max_size=40), st.sets(st.integers(0, 10**6), max_size=12), st.sets(st.integers(0, 10**6), max_size=12))
def test_rational_recovers_the_difference(shared, left, right):
    left, right = left - shared - right, right - shared
    right -= left
    z = np.arange(gf.P - 1000, gf.P - 1000 + 34, dtype=np.int64)
    one, two = (np.array(sorted(s), dtype=np.int64) for s in (shared | left, shared | right))
    f = gf.evaluations(one, z) * np.array([gf.inverse(v) for v in gf.evaluations(two, z)], dtype=np.int64) % gf.P
    num, den = gf.rational(f, z, len(one) - len(two), 2)
    assert {int(x) for x in one[gf.value(num, one) == 0]} == left
    assert {int(x) for x in two[gf.value(den, two) == 0]} == right


def test_rational_refuses_more_than_the_bound():
    z = np.arange(gf.P - 1000, gf.P - 1000 + 18, dtype=np.int64)
    f = gf.evaluations(np.arange(1, 40), z)
    assert gf.rational(f, z, 39, 2) is None


def check(spark, main, copy):
    m = spark.createDataFrame(main, SCHEMA)
    c = spark.createDataFrame([(*r, "x") for r in copy], SCHEMA + ", synced_at int, __id string")
    got = {tuple(r) for r in reconcile.reconcile({"t": (m, c)}).collect()}
    assert got == brute(main, copy)


def test_small_cases(spark):
    main = [(1, "a", "b"), (2, None, ""), (3, "x", None), (4, "", "y"), (None, "n", "n"), (6, "same", "same")]
    copy = [(1, "a", "b", 1), (1, "a", "c", 2), (2, "", None, 1), (3, "x", None, 5), (3, "x", None, 5), (3, "old", None, 1), (5, "q", "r", 1), (None, "n", "m", 3), (6, "same", "same", 9)]
    check(spark, main, copy)


def test_many_differences_and_empty_sides(spark):
    rng = random.Random(1)
    main = [(i, "n" * rng.randrange(3), str(i % 7)) for i in range(700)]
    copy = [(i, a, b if rng.random() < 0.6 else b + "!", 1) for i, a, b in main if rng.random() < 0.9]
    check(spark, main, copy)
    check(spark, main[:30], [])
    check(spark, [], copy[:30])
    check(spark, [], [])


def test_very_long_text(spark):
    text = "long " * 100_000
    check(spark, [(1, text, "s")], [(1, text + "x", "s", 1)])
