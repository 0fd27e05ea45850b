import datetime as dt
import itertools
import random
import sqlite3
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quizlake import catalog, schema, session
from quizlake.operators import coverage, dedup, merge, records, validate, views
from quizlake.streaming import feeds


def tables(spark, **rows):
    out = {}
    for n, t in (schema.TABLES | schema.DOCUMENTED).items():
        out[n] = spark.createDataFrame(rows.get(n, []), t.schema)
    return out


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


D = dt.date


def test_levels_and_cycles():
    assert schema.levels() == [["question_set"], ["question_set_edition"], ["packet", "question", "tournament"], ["packet_question", "round", "team", "tossup"], ["game", "player"], ["buzz"]]
    assert schema.dependents()["tournament"] == {"round", "team"}
    with pytest.raises(ValueError):
        schema.levels({"a": schema.Table("id bigint", (), {"x": "b"}), "b": schema.Table("id bigint", (), {"y": "a"})})


def test_views(spark):
    t = tables(
        spark,
        question_set=[(1, "S", "s", "easy 1")], question_set_edition=[(1, 1, "E", "e", None)], packet=[(1, 1, "P")],
        tournament=[(1, "T", "t", 1, None, "hs", None, None)], round=[(1, 1, 3, 1, False), (2, 1, 4, None, False)],
        team=[(1, 1, "A", "a"), (2, 1, "B", "b")], player=[(1, 1, "X", "x"), (2, None, "Y", "y")],
        game=[(1, 1, 20, 1, None), (2, 2, 20, 1, 2), (3, 1, 20, 1, 2)],
        question=[(1, "q", None, None, None, "C", "c", "D", "d", None, None, "m", None, 1)], tossup=[(1, 1, "text", "ans", "as", "ap")],
        buzz=[(5, 1, 1, 1, 10, 10), (4, 1, 3, 1, 10, -5), (6, 1, 1, 1, None, 0), (7, 1, 1, 1, None, 0), (8, None, 1, 1, 3, 0), (9, 2, 1, 1, 3, 0)],
        bonus=[(1, 1, "l", "ls")], bonus_part=[(1, 1, 1, "p", "ps", "a", "as", "ap", 10, "e")],
    )
    assert got(views.game_info(t)) == [(1, "a", None, "t", "hs", 3, "P", "s", "e", "easy 1"), (3, "a", "b", "t", "hs", 3, "P", "s", "e", "easy 1")]
    assert got(views.player_info(t)) == [(1, "x", "X", "a", "t")]
    assert got(views.tossup_info(t)) == [(1, 1, "q", "text", "ans", "as", "ap", "c", "d", "m")]
    assert views.bonus_part_info(t).count() == 1
    assert got(views.buzz_info(t)) == [(4, 1, 1, 3, "text", "ans", "C", "D", "t", "a", "x", 10, -5)]
    assert views.buzz_info(tables(spark)).count() == 0


def test_rules(spark):
    t = tables(
        spark,
        question_set_edition=[(1, 1, "E", "e", None), (2, 1, "F", "f", None)], question_set=[(1, "S", "s", ""), (2, "S2", "s2", "easy 1")],
        packet=[(1, 1, "P"), (2, 2, "Q")],
        tournament=[(1, "T", "t", 1, None, "hs", None, D(2024, 1, 1)), (2, "U", "u", 1, None, "ms", None, D(2024, 1, 8)), (3, "V", "v", 1, None, "ms", None, D(2024, 1, 9))],
        round=[(1, 1, 1, 1, False), (2, 1, 2, 2, False), (3, 2, 1, 1, False), (4, 3, 1, 1, False)],
        team=[(1, 1, "A", "a"), (2, 2, "B", "b")], player=[(1, 1, "X", "x")], game=[(1, 1, 20, 1, None), (2, 3, 20, 1, 2), (3, 4, 20, None, None)],
        question=[(1, "q", "m", None, None, "C", "c", None, None, None, None, None, None, 1), (2, "q", "m", None, None, "C", "c", None, None, None, None, None, None, 1), (3, "r", None, None, None, None, None, None, None, None, None, None, None, None)],
        tossup=[(1, 1, "t1", None, None, None), (2, 1, "t2", None, None, None), (3, 3, "t3", None, None, None)],
        packet_question=[(1, 1, 1, 1), (2, 2, 1, 1), (3, 2, 2, 3)],
        buzz=[(1, 1, 1, 1, 5, 10), (2, 1, 2, 1, 6, 10), (3, 1, 1, 2, 5, 0), (4, 1, 3, 2, 7, 0), (5, 1, 1, 3, 1, 0)],
    )
    assert got(validate.rounds(t)) == [(2, 2, 1)]
    assert got(validate.packet_questions(t)) == [(2, 2, 1), (3, 2, None)]
    assert got(validate.games(t)) == [(2, 2, 1, 2)]
    assert got(validate.buzzes(t)) == [(5, None, 1, 1)]
    assert got(validate.date_gaps(t)) == [(2, "2024-01-01", "2024-01-09", 2, 8)]
    assert got(validate.edition_levels(t)) == [(1, 2), (2, 0)]
    assert got(validate.full_slugs(t)) == [(1, "s_e", None), (2, "s_f", None)]
    assert got(validate.multiple_tossups(t)) == [(1, 2)]
    assert [(r.id, r.text) for r in validate.duplicate_questions(t).orderBy("id", "text").collect()] == [(1, "t1"), (1, "t2"), (2, None)]
    assert got(validate.backfilled(t)) == [(1, 1, "several"), (2, 1, "no_packet"), (3, 2, None)]
    with pytest.raises(AssertionError):
        validate.require(validate.rounds(t), "rounds")
    validate.require(validate.rounds(tables(spark)), "rounds")


def sequential(rows):
    """Row by row: a null of the new row's key is a wildcard, the least id wins."""
    kept, out = [], []
    for key in rows:
        hit = next((i for i, k in enumerate(kept) if all(a is None or a == b for a, b in zip(key, k))), None)
        if hit is None:
            kept.append(key)
            hit = len(kept) - 1
        out.append(hit + 1)
    return out


def test_merge_equals_row_by_row(spark):
    spec = schema.Table("id bigint, a bigint, b string, note string", ("a", "b"))
    rng = random.Random(5)
    pick = lambda: [rng.choice([None, 1, 2, 3]), rng.choice([None, "", "x", "1:x"]), rng.choice("pq")]
    for keys in ([(1, "2", "n"), (1, None, "n")], [(1, None, "n"), (1, "2", "n")], [(5, "6", "n"), (None, None, "n")], [tuple(pick()) for _ in range(60)]):
        one = spark.createDataFrame([(i, *k) for i, k in enumerate(keys)], spec.schema)
        id_map, merged, diffs = merge.merge_table(merge.stacked([one, one], spec), spec)
        want = sequential([k[:2] for k in keys] * 2)
        assert [r.new_id for r in id_map.orderBy("src", "old_id").collect()] == want
        assert merged.count() == max(want)
        assert diffs.where("column_name = 'note' and old_value = new_value").isEmpty()


def test_merge_databases(spark):
    one = tables(spark, question_set=[(7, "S", "s", "d")], question_set_edition=[(3, 7, "E", "e", None)], tournament=[(1, "T", "t", 3, None, None, None, None)])
    two = tables(spark, question_set=[(1, "S2", "s", "d"), (2, "N", "n", "d")], question_set_edition=[(9, 1, "E", "e", None), (8, 2, "E", "e", None)])
    names = {k: schema.TABLES[k] for k in ("question_set", "question_set_edition", "tournament")}
    maps, merged, diffs = merge.merge_databases([one, two], names)
    assert got(maps["question_set_edition"]) == [(0, 3, 1), (1, 8, 2), (1, 9, 1)]
    assert got(merged["question_set_edition"].select("id", "question_set_id")) == [(1, 1), (2, 2)]
    assert got(merge.difference_text(diffs["question_set"])) == [(1, 1, 1, "Differences:\n\tname: S -> S2")]
    orphan = tables(spark, tournament=[(1, "T", "t", 99, None, None, None, None)])
    with pytest.raises(Exception, match="no question_set_edition"):
        merge.merge_databases([orphan], names)[1]["tournament"].collect()


def test_dedup(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "a", None), (3, "b", 1), (4, None, None), (5, None, None), (6, "c", 2)], "id bigint, k string, v int")
    assert [r.id for r in dedup.keep_first(df, ["k", "v"]).orderBy("id").collect()] == [1, 3, 4, 6]
    assert sorted(r.id for r in dedup.duplicated(df, ["k", "v"]).collect()) == [1, 2, 4, 5]
    assert got(dedup.value_counts(df, "k")) == [("a", 2), ("b", 1), ("c", 1)]
    assert got(dedup.distinct_counts(df, ["k", "v"])) == [("k", 3), ("v", 2)]
    assert [(r.id, r["rank"]) for r in dedup.ranked(df, F.col("id").desc()).orderBy("rank").collect()] == [(6 - i, i + 1) for i in range(6)]


def test_reach_sums_over_many_slabs_and_chunks_are_brute_force_ones_and_send_no_bitmaps(spark, monkeypatch):
    """Both axes from one pass; a task a slab reads the pairs where they lie, so no row of the matrix is shuffled."""
    pairs = sorted({(f"p{(k * 7919) % 1009 % 150}", (k * k) % 611 % (300 if k % 3 else 40)) for k in range(900)})
    df, turned = spark.createDataFrame(pairs, "player string, item bigint"), spark.createDataFrame([(i, p) for p, i in pairs], "player bigint, item string")
    monkeypatch.setattr(coverage, "CHUNK", 100)
    monkeypatch.setattr(coverage, "WORDS", 1)
    at = {i: {p for p, j in pairs if j == i} for _, i in pairs}
    of = {p: {i for q, i in pairs if q == p} for p, _ in pairs}
    reach = {(p, j) for p in of for i in of[p] for q in at[i] for j in of[q]}
    sums = [dict(Counter(x[k] for x in reach)) for k in (0, 1)]
    found = coverage.sums(df)
    assert dict(got(found["player"])) == sums[0] and dict(got(found["item"])) == sums[1]
    found = coverage.sums(turned)
    assert dict(got(found["item"])) == sums[0] and dict(got(found["player"])) == sums[1]
    m = coverage.Reach(df)
    plan = m.slabwise(None, None, "axis string, block long, data binary")._jdf.queryExecution().executedPlan().toString()
    assert m.slabs > 1 and m.chunks.count() > 1 and "CartesianProduct" in plan and "Exchange" not in plan


def test_coverage(spark):
    pairs = spark.createDataFrame([("p1", "a"), ("p2", "a"), ("p2", "b"), ("p3", "c")], "player string, item string")
    assert got(coverage.reach_activity(pairs)) == [("p1", 2), ("p2", 2), ("p3", 1)]
    rng = random.Random(2)
    many = {(f"p{rng.randrange(40)}", rng.randrange(60)) for _ in range(120)}
    reach = {p: len({i for q, i in many if any((p, j) in many and (q, j) in many for j in range(60))}) for p in {p for p, _ in many}}
    assert dict(got(coverage.reach_activity(spark.createDataFrame(sorted(many), "player string, item bigint")))) == reach
    assert got(coverage.density(pairs)) == [(3, 3, 5, 500 / 9)]  # p1 reaches b through p2


def test_charts(spark):
    df = spark.createDataFrame([(x,) for x in (0, 1, 4, 10, None)], "x int")
    assert got(records.histogram(df, F.col("x"), 5)) == [(0, 0.0, 2), (2, 4.0, 1), (4, 8.0, 1)]
    assert got(records.dense_frequencies(df.where("x < 5"), F.col("x"))) == [(0, 1), (1, 1), (2, 0), (3, 0), (4, 1)]
    assert records.dense_frequencies(df.where("x > 99"), F.col("x")).count() == 0


def test_catalog_and_sqlite(spark, tmp_path):
    path = str(tmp_path / "quiz.db")
    with sqlite3.connect(path) as con:
        con.execute("CREATE TABLE season_team (id INTEGER PRIMARY KEY, tournament_id INTEGER, name VARCHAR, slug VARCHAR, start DATE, ok BOOLEAN, x FLOAT)")
        con.execute("INSERT INTO season_team VALUES (1, 2, 'A', 'a', '2024-05-01', 1, 1.5), (2, NULL, NULL, 'b', NULL, 0, NULL)")
        con.execute("CREATE TABLE season_empty (id INTEGER)")
        con.execute("CREATE TABLE other (id INTEGER)")
    c = catalog.Catalog.load_sqlite(spark, path).pruned("season_")
    assert c.list_tables() == ["empty", "team"]
    assert got(c.tables["team"]) == [(1, 2, "A", "a", D(2024, 5, 1), True, 1.5), (2, None, None, "b", None, False, None)]
    assert c.tables["empty"].count() == 0
    c.save(str(tmp_path / "out"))
    again = catalog.Catalog.load(spark, str(tmp_path / "out"))
    assert again.list_tables() == ["empty", "team"]
    assert catalog.differing_rows(c.tables["team"], again.tables["team"]).isEmpty()
    assert catalog.differing_rows(c.tables["team"], again.tables["team"].where("id = 1")).count() == 1
    assert got(again.sql("SELECT id FROM team WHERE name IS NULL")) == [(2,)]
    assert again.column_exists("team", "slug")
    assert got(catalog.matching(again.tables["team"], {"name": None, "nothing": 3}).select("id")) == [(2,)]
    assert [r.id for r in again.head("team", 1).collect()] == [1]
    assert catalog.with_column_if_absent(again.tables["team"], "new", "int").columns[-1] == "new"
    assert all(df.count() == 0 for df in itertools.islice(catalog.Catalog.empty(spark).tables.values(), 3))


def test_stream_of_buzzes(spark, tmp_path):
    rows = [(i, 1, 1, i % 3, dt.datetime(2024, 1, 1)) for i in range(9)] + [(20, 1, 1, None, dt.datetime(2024, 1, 1))]
    schema_ = "id bigint, player_id bigint, tossup_id bigint, buzz_position int, recorded_at timestamp_ntz"
    spark.createDataFrame(rows, schema_).write.parquet(str(tmp_path / "in"))
    q = feeds.distinct_buzzes(spark.readStream.schema(schema_).parquet(str(tmp_path / "in"))).writeStream.format("memory").queryName("buzzes").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "cp")).start()
    q.awaitTermination(60)
    assert spark.table("buzzes").count() == 3


def test_activity_ranks_of_both_axes_come_from_one_pass(spark, monkeypatch):
    pairs = spark.createDataFrame([("a", 1), ("a", 2), ("b", 2), ("b", 3), ("c", 4)], "player string, item bigint")
    reached = coverage.sums(pairs)
    monkeypatch.setattr(coverage, "Reach", None)  # no second pass
    assert got(coverage.activity_ranks(pairs, "player", reached)) == [("a", 3, 1), ("b", 3, 2), ("c", 1, 3)]
    assert got(coverage.activity_ranks(pairs, "item", reached)) == [(1, 2, 1), (2, 2, 2), (3, 2, 3), (4, 1, 4)]


def test_reach_keeps_the_pairs_once_besides_the_numbers(spark, monkeypatch):
    pairs, kept = spark.createDataFrame([("a", 1), ("a", 2), ("b", 2), ("c", 4)], "player string, item bigint"), []
    monkeypatch.setattr(coverage, "cut", lambda df: kept.append(df.columns) or session.cut(df))
    coverage.Reach(pairs)
    assert kept == [["player", "n"], ["item", "n"], ["chunk", "starts", "members"]]


SF = "/root/testdata/sf0.001"


def test_responses_follow_the_first_of_repeated_buzzes_and_carry_keys_only(spark):
    """Player 1 buzzes twice at the same place of tossup 1, first outside the season; 9 has no team, tossup 3 no question; 1 and 2 share a slug."""
    from quizlake.plans import rules

    t = tables(
        spark,
        tournament=[(1, "A", "2024-a", 1, None, None, None, None), (2, "B", "1999-b", 1, None, None, None, None), (3, "C", None, 1, None, None, None, None)],
        round=[(k, k, 1, 1, False) for k in (1, 2, 3)], game=[(k, k, 1, 1, 2) for k in (1, 2, 3)], team=[(1, 1, "T", "t")],
        player=[(1, 1, "a", "a"), (2, 1, "a2", "a"), (3, 1, "n", None), (9, 7, "z", "z")],
        question=[tuple(1 if c in ("id", "question_set_edition_id") else "x" for c in schema.TABLES["question"].names)],
        tossup=[tuple({"id": k, "question_id": q}.get(c, "x") for c in schema.TABLES["tossup"].names) for k, q in ((1, 1), (2, 1), (3, 5))],
        buzz=[(1, 1, 2, 1, 7, 10), (2, 1, 1, 1, 7, 10), (3, 1, 1, 2, 7, 10), (4, 2, 1, 2, 8, 10), (5, 9, 1, 2, 8, 10), (6, 1, 1, 3, 8, 10), (7, 3, 1, 2, 8, 10), (8, None, 1, 2, 8, 10), (9, 1, 1, 1, None, 10), (10, 1, 3, 1, 9, 10)],
    )
    assert got(views.responses(t, "20")) == [("a", 2)]
    assert got(views.responses({**t, "buzz": t["buzz"].where("id > 1")}, "20")) == [("a", 1), ("a", 2)]
    plan = rules._pairs(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan  # as of rows that are kept whole


def test_first_buzzes_of_few_tossups_read_their_buzzes_alone(spark):
    from quizlake.plans import relational

    few = relational.season_tossups(spark, SF).orderBy("tossup_id").limit(3).select("tossup_id")
    found = relational.season_tossups(spark, SF, few)
    assert got(found) == got(relational.season_tossups(spark, SF).join(few, "tossup_id", "left_semi").select(*found.columns)) and found.count() == 3
    assert "LeftSemi, BuildRight" in found._jdf.queryExecution().executedPlan().toString()  # the buzzes lie where they were read
    assert got(relational.season_tossups(spark, SF, few.where("false"))) == []
