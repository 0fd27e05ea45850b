"""Small cases with results worked out by hand: the reach matrix, records, spans, lookups, stored copies."""

import re
import time

import pytest
from pyspark.sql import functions as F

from quizlake import catalog, session
from quizlake.functions import segment, text
from quizlake.operators import cocluster, coverage, merge, records


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_reach_matrix_sums_density_ranks_and_low_activity(spark):
    """a meets 1 and 2, b 2 and 3, c 4: a and b reach 1, 2 and 3, c reaches 4 (raw pairs would give other figures)."""
    p = spark.createDataFrame([("a", 1), ("a", 2), ("b", 2), ("b", 3), ("c", 4)], "player string, item bigint")
    assert rows(coverage.reach_activity(p)) == [("a", 3), ("b", 3), ("c", 1)]
    assert rows(coverage.reach_activity(p, "item")) == [(1, 2), (2, 2), (3, 2), (4, 1)]
    d = coverage.density(p).first()
    assert (d.n_players, d.n_items, d.n_pairs) == (3, 4, 7) and abs(d.density - 700 / 12) < 1e-9
    assert rows(coverage.low_activity(p, 2)) == [(4, 1)]
    assert rows(coverage.activity_ranks(p, "item").select("item", "rank")) == [(1, 1), (2, 2), (3, 3), (4, 4)]


def test_record_fields(spark):
    """Categories are slugs, the answer is the sanitised one, the set goes by its slug."""
    t = {
        "question_set": spark.createDataFrame([(1, "Set One", "set-one", "easy (level 1)")], "id bigint, name string, slug string, difficulty string"),
        "question_set_edition": spark.createDataFrame([(2, 1)], "id bigint, question_set_id bigint"),
        "question": spark.createDataFrame([(3, "Science", "science", "Physics", "physics", "Science-Physics", "science-physics", "Science - Physics", 2)], "id bigint, category string, category_slug string, subcategory string, subcategory_slug string, category_main string, category_main_slug string, category_full string, question_set_edition_id bigint"),
        "tossup": spark.createDataFrame([(4, 3, "<b>Name</b> it.", "<b>raw</b>", "raw", "r")], "id bigint, question_id bigint, question string, answer string, answer_sanitized string, answer_primary string"),
    }
    r = records.described(t).first()
    assert (r.qid, r.question, r.answer, r.answer_primary) == ("quiz-4", "Name it.", "raw", "r")
    m = r.metadata
    assert (m.category, m.subcategory, m.category_main, m.category_full, m.difficulty, m.question_set) == ("science", ["physics"], "science-physics", "Science - Physics", "easy", "set-one")


def test_semicolon_counts_the_words_before_it():
    four = "one two three four ; five six seven"
    assert segment.semicolon_spans(four) == [(0, len(four))]
    assert segment.semicolon_spans("one two three four five ; six") == [(0, 25), (25, 29)]


def test_supplied_spans_and_unclosed_quotes(spark):
    df = spark.createDataFrame([("abcdef",)], "q string")
    own = F.array(F.struct(F.lit(1).alias("start"), F.lit(3).alias("end")))
    assert [tuple(s) for s in df.select(segment.clue_spans(F.col("q"), "supplied", own)).first()[0]] == [(1, 3)]
    with pytest.raises(ValueError):
        segment.clue_spans(F.col("q"), "supplied")
    assert not segment.unclosed('He said "one. Two three four five six seven." And then he left the room for good.')


def test_open_quotes_redundancy_bars_and_highlights(spark):
    q = spark.createDataFrame([('a "b',), ("a “b",), ('“a "b',), ("a",)], "q string").select(text.open_quotes(F.col("q")).alias("r")).select("r.*")
    assert [tuple(r) for r in q.collect()] == [('"', False), ("“", False), ('"', True), (None, False)]
    c = spark.createDataFrame([("x", "y", "x-y"), ("x", "y", "y"), ("x", "y", "z"), ("x", None, "z")], "c string, s string, m string")
    assert [r[0] for r in c.select(text.is_redundant_main(F.col("c"), F.col("s"), F.col("m"))).collect()] == [True, True, False, False]
    b = spark.createDataFrame([("x", 4), ("y", 3)], "value string, n bigint")
    assert {r.value: r.bar for r in records.bars(b, 4).collect()} == {"x": "████", "y": "███▒"}
    assert spark.createDataFrame([("A. B. A. ",)], "q string").select(text.n_matches(F.col("q"), "[A-Z]\\. ")).first()[0] == 3


def test_exactly_one_and_console_table(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, "c")], "id bigint, name string")
    assert catalog.exactly_one(df, {"id": 1}).first().name == "a"
    for k in (2, 9):
        with pytest.raises(LookupError):
            catalog.exactly_one(df, {"id": k})
    assert catalog.console_table(df.orderBy("id").limit(1)).split("\n") == ["+----+------+", "| id | name |", "|----+------|", "|  1 | a    |", "+----+------+"]


def test_a_failed_save_leaves_what_was_stored(spark, tmp_path):
    path = str(tmp_path / "db")
    one = spark.createDataFrame([(1,)], "id bigint")
    catalog.Catalog(spark, {"x_a": one, "b": one}).save(path)
    bad = spark.range(1).select(F.raise_error(F.lit("no")).cast("bigint").alias("id"))
    with pytest.raises(Exception):  # noqa: B017
        catalog.Catalog(spark, {"x_a": one.limit(0), "b": bad}).save(path)
    back = catalog.Catalog.load(spark, path)
    assert back.list_tables() == ["b", "x_a"] and back.tables["x_a"].count() == 1
    assert back.pruned("x_").list_tables() == ["a"]
    assert catalog.differing_rows(one, back.tables["b"].union(one)).count() == 1


def test_merge_takes_only_the_parents_it_needs():
    assert sorted(merge.with_parents(["player"])) == ["player", "question_set", "question_set_edition", "team", "tournament"]


def test_ward_order_puts_near_points_side_by_side():
    import numpy as np

    order = cocluster.ward_order(np.array([[0.0], [10.0], [0.5], [10.4]]))
    assert abs(order.index(0) - order.index(2)) == 1 and abs(order.index(1) - order.index(3)) == 1


def test_products_of_the_blocks_equal_the_reach_matrix(spark):
    """Row and column sums from one product each."""
    p = spark.createDataFrame([("a", 1), ("a", 2), ("b", 2), ("b", 3), ("c", 4)], "player string, item bigint")
    m = cocluster.Blocks(p)
    for axis, other in (("player", "item"), ("item", "player")):
        sums = {r[0]: r.x[0] for r in m.rows(m.times(m.ones(other), 1, axis), 1, axis).collect()}
        assert sums == {r[0]: r.n_reached for r in coverage.reach_activity(p, axis).collect()}


def test_vectors_come_from_slabs_in_a_pass_a_round_and_equal_dense_ones(spark, monkeypatch):
    """Three loose groups, several slabs and chunks; six passes for the vectors, one for the clusters' sums, and no stored matrix."""
    import numpy as np

    rng = np.random.default_rng(5)
    pairs = sorted({(f"p{g * 100 + rng.integers(70):03}", int(g * 200 + rng.integers(90))) for g in range(3) for _ in range(130)} | {(f"p{g}00", g * 200 + 290) for g in range(3)} | {("p000", 205), ("p100", 405)})
    p, passes, slabwise = spark.createDataFrame(pairs, "player string, item bigint"), [], coverage.Reach.slabwise
    monkeypatch.setattr(coverage, "CHUNK", 60)
    monkeypatch.setattr(coverage, "WORDS", 1)
    monkeypatch.setattr(coverage.Reach, "slabwise", lambda *a, **k: passes.append(1) or slabwise(*a, **k))
    m = cocluster.Blocks(p)
    assert m.reach.slabs > 1 and m.reach.chunks.count() > 1
    players, items = ({r[0]: r.x for r in x.collect()} for x in cocluster.vectors(m))
    assert len(passes) == 6
    names, ids = sorted({q for q, _ in pairs}), sorted({i for _, i in pairs})
    met = np.zeros((len(names), len(ids)))
    met[[names.index(q) for q, _ in pairs], [ids.index(i) for _, i in pairs]] = 1
    reach = (met @ met.T @ met > 0).astype(float)
    c = np.ones((len(ids), 1))
    for _ in range(3):
        r = 1 / (reach @ c)
        c = 1 / (reach.T @ r)

    def upright(x):
        w, q = np.linalg.eigh(x.T @ x)
        return x @ (q / np.sqrt(w))[:, ::-1]

    x = upright(np.concatenate([np.sqrt(c), np.random.default_rng(0).standard_normal((32768, 4))[: len(ids)]], axis=1))
    for _ in range(3):
        y = upright(np.sqrt(r) * (reach @ (np.sqrt(c) * x)))
        x = upright(np.sqrt(c) * (reach.T @ (np.sqrt(r) * y)))
    assert np.allclose(np.abs([players[n] for n in names]), np.abs(y[:, 1:]), atol=1e-4)
    assert np.allclose(np.abs([items[i] for i in ids]), np.abs(x[:, 1:]), atol=1e-4)
    passes.clear()
    rows, columns, means, column_means = cocluster.clustered(p, 3)
    assert len(passes) == 7
    label, column = {r[0]: r.cluster for r in rows.collect()}, {r[0]: r.cluster for r in columns.collect()}
    assert set(label) == set(names) and set(column) == set(ids)
    for k, i, mean in means.collect():
        assert abs(mean - reach[[label[n] == k for n in names], ids.index(i)].mean()) < 1e-6
    for k, n, mean in column_means.collect():
        assert abs(mean - reach[names.index(n), [column[i] == k for i in ids]].mean()) < 1e-6


def test_cluster_means_keep_no_bitmaps_and_a_partial_sum_a_task(spark, monkeypatch):
    def none(*a, **k):
        raise AssertionError("the matrix is stored")

    monkeypatch.setattr(coverage, "reach_bitmaps", none)
    monkeypatch.setattr(cocluster, "reach_bitmaps", none, raising=False)
    monkeypatch.setattr(coverage, "WORDS", 1)
    pairs = sorted({(f"p{k * 37 % 400:03}", k * k % 53) for k in range(900)} | {(f"q{k}", 60 + k % 3) for k in range(9)})
    p, kept = spark.createDataFrame(pairs, "player string, item bigint"), []
    monkeypatch.setattr(cocluster, "cut", lambda df: kept.append(session.cut(df)) or kept[-1])
    m = cocluster.Blocks(p)
    assert m.reach.slabs > 3
    m.times(m.ones("player"), 1, "item")
    assert kept[0].where("axis = 'item'").count() <= m.reach.chunks.count() * spark.sparkContext.defaultParallelism
    got = cocluster.cluster_means(p, 2).collect()
    assert {(r.axis, r.cluster) for r in got} == {(a, c) for a in ("row", "column") for c in (0, 1)}
    assert len(got) == 2 * (len({q for q, _ in pairs}) + len({i for _, i in pairs})) and all(0 <= r["mean"] <= 1 for r in got)


def test_cluster_means_let_go_of_the_pairs_and_of_partial_sums(spark, monkeypatch):
    def shuffles():
        files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString(" ")
        return set(re.findall(r"shuffle_(\d+)_", files))

    pairs = [(f"p{k * 37 % 40:03}", k * k % 53) for k in range(300)]
    p, left, slabwise = spark.createDataFrame(pairs, "player string, item bigint").repartition(4, "player").distinct(), [], coverage.Reach.slabwise
    session.swept(spark)
    before = shuffles()

    def counted(self, *a, **k):
        time.sleep(1)  # what is let go is removed a little later
        left.append(len(shuffles() - before))
        return slabwise(self, *a, **k)

    monkeypatch.setattr(coverage.Reach, "slabwise", counted)
    rows = cocluster.clustered(p, 2)[0]
    assert rows.count() == 40 and len(left) == 7
    assert left[0] == 0 and max(left) <= 20
