import datetime as dt
import random

from quizlake.operators import orphans

SPECS = (("child", "recorded_at", {"a_id": "a", "b_id": "b"}),)


def t(n):
    return None if n is None else dt.datetime(2024, 1, 1) + dt.timedelta(days=n)


def frames(spark, child, a, b):
    one = lambda rows: spark.createDataFrame([(i, t(x), "z") for i, x in rows], "id bigint, loaded_at timestamp_ntz, salt string")
    return {"child": spark.createDataFrame([(i, x, y, t(z), "k") for i, x, y, z in child], "id bigint, a_id bigint, b_id bigint, recorded_at timestamp_ntz, key string"), "a": one(a), "b": one(b)}


def brute(child, a, b):
    first = {}
    for name, rows in (("a_id", a), ("b_id", b)):
        for i, x in rows:
            old = first.get((name, i), (x,))[0]
            first[name, i] = (None if x is None or old is None else min(x, old),)
    out = set()
    for i, x, y, z in child:
        for name, k in (("a_id", x), ("b_id", y)):
            if k is None:
                continue
            p = first.get((name, k))
            if p is None or (p[0] is not None and z is not None and p[0] > z):
                out.add(("child", name, i, "unknown" if z is None else t(z).strftime("%Y-%m")))
    return out


def rows_of(state):
    return {tuple(r) for r in orphans.cases(state).collect()}


def test_any_batches_give_the_same_cases(spark):
    rng = random.Random(3)
    pick = lambda n: rng.choice([None, *range(n)])
    child = [(i, 1 if rng.random() < 0.4 else pick(8), pick(8), pick(90)) for i in range(300)]
    a = [(i, pick(60)) for i in range(6)] + [(1, 5)]
    b = [(i, pick(60)) for i in (0, 2, 3, 7)]
    want = brute(child, a, b)
    assert want
    for cuts in ([], [t(20)], [t(10), t(30), t(70)]):
        assert rows_of(orphans.replay(frames(spark, child, a, b), cuts, SPECS)) == want


def test_empty_tables(spark):
    child = [(1, 5, None, 3), (2, None, None, None)]
    assert rows_of(orphans.replay(frames(spark, child, [], []), [], SPECS)) == {("child", "a_id", 1, "2024-01")}
    assert rows_of(orphans.replay(frames(spark, [], [(1, 2)], []), [], SPECS)) == set()


def test_deletions_reopen_and_arrivals_resolve(spark):
    f = frames(spark, [(1, 5, None, 3), (2, 5, None, 1)], [(5, 2)], [])
    log = spark.createDataFrame([("a", 5, t(9)), ("a", 5, t(8)), ("b", 1, t(1))], "table_name string, row_id bigint, deleted_at timestamp_ntz")
    refs, arrivals = orphans.references(f, SPECS), orphans.parents(f, SPECS)
    one = orphans.advance(orphans.OrphanState(), refs, arrivals)
    assert {(r.row_id, r.reason) for r in one.pending.collect()} == {(2, "late")}
    none = refs.limit(0)
    two = orphans.advance(one, none, arrivals.limit(0), orphans.deletions(log))
    assert {(r.row_id, r.reason, r.opened_at, r.resolved_at) for r in two.pending.collect()} == {(2, "late", t(1), t(2)), (1, "deleted", t(9), None), (2, "deleted", t(9), None)}
    again = frames(spark, [], [(5, 12)], [])
    three = orphans.advance(two, none, orphans.parents(again, SPECS))
    assert {(r.row_id, r.reason, r.resolved_at) for r in three.pending.collect()} == {(2, "late", t(2)), (1, "deleted", t(12)), (2, "deleted", t(12))}
    counts = {r.period: (r.n_cases, r.n_open, r.n_late, r.n_reopened) for r in orphans.snapshot(three).collect()}
    assert counts == {"2024-01": (1, 0, 1, 2)}


def test_logged_deletions_reopen_in_the_batches(spark):
    child = [(1, 5, None, 3), (2, 5, None, 30), (3, 6, None, 3), (4, 7, None, 3), (5, 5, None, None), (6, 5, None, 9)]
    f = frames(spark, child, [(6, 1)], [])
    log = spark.createDataFrame([("a", 5, t(8)), ("a", 5, t(9)), ("a", 6, t(9)), ("z", 7, t(9))], "table_name string, row_id bigint, deleted_at timestamp_ntz")
    want = {(1, "deleted"), (5, "deleted"), (6, "deleted"), (2, "missing"), (4, "missing")}  # 6 was restored
    for cuts in ([], [t(5)], [t(5), t(9), t(20)]):
        after = [{(r.row_id, r.reason) for r in s.pending.collect()} for s in orphans.states(f, cuts, SPECS, log)]
        assert after[-1] == want
        if len(cuts) == 3:
            assert after[:3] == [{(4, "missing")}, {(4, "missing")}, want - {(2, "missing")}]


def test_snapshots_count_reopened(spark):
    from quizlake.plans import problems

    sf = "/root/testdata/sf0.001"
    last = problems.p5_snapshots(spark, sf).collect()
    assert sum(r.n_reopened for r in last) > 0
    end = max(r.year for r in last)
    total = {tuple(r)[1:] for r in last if r.year == end}
    assert total == {tuple(r) for r in problems.p5_counts(spark, sf).collect()}


def test_a_restarted_stream_goes_on_from_the_stored_state(spark, tmp_path):
    """Two runs over one checkpoint: the second one resolves an orphan that the first one left waiting, and a deletion reopens what the first one saw."""
    from quizlake.streaming import feeds

    src, seen = str(tmp_path / "refs"), []

    def run(child, parents, deleted):
        refs = orphans.references(frames(spark, child, [], []), SPECS)
        refs.write.mode("append").parquet(src)
        stream = spark.readStream.schema(refs.schema).parquet(src)
        arrivals = lambda: orphans.parents(frames(spark, [], parents, []), SPECS)
        log = spark.createDataFrame([("a", k, t(x)) for k, x in deleted], "table_name string, row_id bigint, deleted_at timestamp_ntz")
        q = feeds.watch_orphans(stream, arrivals, lambda s: seen.append({(r.row_id, r.reason, r.resolved_at) for r in orphans.found(s).collect()}), str(tmp_path / "cp"), lambda: orphans.deletions(log))
        q.awaitTermination(60)

    run([(1, 5, None, 3), (2, 6, None, 4)], [(6, 1)], [])
    assert seen[-1] == {(1, "missing", None)}
    run([(3, 7, None, 5)], [(5, 8), (6, 1)], [(6, 9)])
    assert seen[-1] == {(1, "late", t(8)), (3, "missing", None), (2, "deleted", None)}


def test_settled_cases_leave_the_pending_state(spark):
    f = frames(spark, [(1, 5, None, 3), (2, 6, None, 3)], [(5, 10), (6, 50)], [])
    after = list(orphans.states(f, [t(20), t(40)], SPECS))
    assert {r.row_id for r in after[0].pending.collect()} == {1, 2}
    assert {r.row_id for r in after[1].pending.collect()} == {2} and {r.row_id for r in after[1].settled.collect()} == {1}
    assert {(r.row_id, r.reason) for r in orphans.found(after[2]).collect()} == {(1, "late"), (2, "late")}
