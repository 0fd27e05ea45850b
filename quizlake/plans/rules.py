"""Queries of the consistency rules, the backfill, the pruned copy, the merge and the response matrix, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quizlake import catalog
from quizlake.operators import cocluster, coverage, dedup, merge, reconcile, validate, views
from quizlake.plans import domain
from quizlake.plans.relational import _BUZZ, _SEASON, YEARS, _sql, season_tossups
from quizlake.schema import TABLES, levels
from quizlake.session import cut, shared_path, table

#: tables that have a copy
COPIED = ("question", "team", "player")


def _stack(frames: dict[str, DataFrame]) -> DataFrame:
    out = None
    for n, df in frames.items():
        one = df.select(F.lit(n).alias("table_name"), "*")
        out = one if out is None else out.unionByName(one)
    return out


def prune_rename_equal(spark: SparkSession, sf: str) -> DataFrame:
    """A database with prefixed and other tables is stored, loaded, pruned, renamed, stored and loaded again; rows and differing rows against the originals."""
    t = {n: table(spark, sf, n) for n in domain.DELIVERED}
    stored, pruned = shared_path(spark, "stored"), shared_path(spark, "pruned")
    catalog.Catalog(spark, {f"season_{n}": df for n, df in t.items()} | {"other": t["team"]}).save(stored)
    catalog.Catalog.load(spark, stored).pruned("season_").save(pruned)
    found = catalog.Catalog.load(spark, pruned)
    each = {}
    for n in found.list_tables():
        differing = catalog.differing_rows(t[n], found.tables[n]).agg(F.count(F.lit(1)).alias("n_differing"))
        each[n] = found.tables[n].agg(F.count(F.lit(1)).alias("n_rows")).join(differing, F.lit(True))  # two single rows
    return _stack(each)


def _merged(spark: SparkSession, sf: str, *names: str):
    """The modelled tables and their copies as two sources, with the named tables and their parents merged (all of them unless named).
    Unmatched references become null here, since the data holds some."""
    one = domain.tables(spark, sf)
    two = one | {n: reconcile.latest(table(spark, sf, f"{n}_copy"), "id", [c for c in TABLES[n].names if c != "id"], "synced_at") for n in COPIED}
    return merge.merge_databases([one, two], merge.with_parents(names or TABLES), strict=False)


def merge_id_map(spark: SparkSession, sf: str) -> DataFrame:
    return _stack(_merged(spark, sf)[0])


def merge_output(spark: SparkSession, sf: str) -> DataFrame:
    return _merged(spark, sf, "buzz")[1]["buzz"]


def merge_games(spark: SparkSession, sf: str) -> DataFrame:
    return _merged(spark, sf, "game")[1]["game"]


def merge_diff(spark: SparkSession, sf: str) -> DataFrame:
    return merge.difference_text(_merged(spark, sf, "player")[2]["player"])


def merge_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    """What the merged tables still hold several times: questions of one slug, metadata and category, teams and players of one name."""
    t = _merged(spark, sf, "question", "player")[1]
    keys = {"question": ["slug", "metadata", "category_full"], "team": ["tournament_id", "name"], "player": ["team_id", "name"]}
    return _stack({n: dedup.duplicated(t[n].select("id", dedup.unique_key(k).alias("unique_key")), ["unique_key"]) for n, k in keys.items()})


def _pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Players, by slug, and the tossups of the season that they buzzed on."""
    return views.responses(domain.tables(spark, sf), YEARS).withColumnRenamed("tossup_id", "item")


def _reached(spark: SparkSession, sf: str) -> DataFrame:
    return cut(_pairs(spark, sf))


def activity_ranks(spark: SparkSession, sf: str) -> DataFrame:
    """Rows and columns of the reach matrix by falling activity."""
    p = _reached(spark, sf)
    reached = coverage.sums(p)
    one = {by: coverage.activity_ranks(p, by, reached).select(F.col(by).cast("string").alias("key"), "n_reached", "rank") for by in ("player", "item")}
    return _stack(one).withColumnRenamed("table_name", "axis")


def low_activity(spark: SparkSession, sf: str) -> DataFrame:
    """Tossups that few players reach, with their first buzz's tournament and category."""
    low = cut(coverage.low_activity(_reached(spark, sf)).withColumnRenamed("item", "tossup_id"))
    return season_tossups(spark, sf, low).join(low, "tossup_id").select("tossup_id", "tournament", F.col("question_category").alias("category"), "n_reached")


def bicluster_summary(spark: SparkSession, sf: str) -> DataFrame:
    return cocluster.biclusters(_pairs(spark, sf)).orderBy(F.desc("density"), "row_cluster", "column_cluster").limit(5)


def cluster_means(spark: SparkSession, sf: str) -> DataFrame:
    return cocluster.cluster_means(_pairs(spark, sf))


def v_dup_question(spark: SparkSession, sf: str) -> DataFrame:
    """The questions of both systems together."""
    t = domain.tables(spark, sf)
    own = [c for c in TABLES["question"].names]
    return validate.duplicate_questions(t | {"question": t["question"].select(own).unionByName(table(spark, sf, "question_copy").select(own))})


def _rule(f):
    return lambda s, d: f(domain.tables(s, d))


QUERIES = {
    "v_round": _rule(validate.rounds), "v_packet_question": _rule(validate.packet_questions), "v_game": _rule(validate.games), "v_buzz": _rule(validate.buzzes), "v_date_gap": _rule(validate.date_gaps),
    "v_level": _rule(validate.edition_levels), "v_full_slug": _rule(validate.full_slugs), "v_multi_tossup": _rule(validate.multiple_tossups),
    "v_pk_unique": _rule(lambda t: validate.repeated_ids(t, ["question", "tossup", "player", "team", "buzz"])), "backfill_edition": _rule(validate.backfilled),
    "response_pairs": _pairs, "reach_activity": lambda s, d: coverage.reach_activity(_reached(s, d)), "density": lambda s, d: coverage.density(_reached(s, d)),
} | {f.__name__: f for f in (prune_rename_equal, merge_id_map, merge_output, merge_games, merge_diff, merge_duplicates, activity_ranks, low_activity, bicluster_summary, cluster_means, v_dup_question)}

_P = f"{domain.SQL}, {_BUZZ}, {_SEASON}, p AS (SELECT DISTINCT player, tossup_id AS item FROM buzz_info WHERE starts_with(tournament, '20'))"
_REACH = f"{_P}, near AS (SELECT DISTINCT a.player, b.player AS other FROM p a JOIN p b ON b.item = a.item), reach AS (SELECT DISTINCT near.player, p.item FROM near JOIN p ON p.player = near.other)"


def _merge_sql(tail: str) -> str:
    """Rows in order of source and id; the first row that agrees wherever this row's key has a value. Rows with whole keys only need grouping."""
    parts, maps = [domain.SQL], {}
    for n in (t for level in levels() for t in level):
        spec = TABLES[n]
        own = [c for c in spec.names if c != "id"]
        two = n if n not in COPIED else f"(SELECT * FROM {n}_copy QUALIFY row_number() OVER (PARTITION BY id ORDER BY synced_at DESC) = 1)"
        fks = spec.fks
        columns = ", ".join(f"m_{c}.new_id AS {c}" if c in fks else f"x.{c}" for c in own)
        joins = " ".join(f"LEFT JOIN {maps[p]} m_{c} ON m_{c}.src = x.src AND m_{c}.old_id = x.{c}" for c, p in fks.items())
        agree = " AND ".join(f"(r.{k} IS NULL OR q.{k} = r.{k})" for k in spec.natural_key)
        parts.append(
            f"{n}_seq AS (SELECT row_number() OVER (ORDER BY x.src, x.old_id) AS seq, x.src, x.old_id, {columns} FROM (SELECT 0 AS src, id AS old_id, {', '.join(own)} FROM {n} UNION ALL SELECT 1, id, {', '.join(own)} FROM {two}) x {joins}), "
            f"{n}_first AS (SELECT seq, min(seq) OVER (PARTITION BY {', '.join(spec.natural_key)}) AS first_seq FROM {n}_seq WHERE {' AND '.join(f'{k} IS NOT NULL' for k in spec.natural_key)} "
            f"UNION ALL SELECT r.seq, min(q.seq) FROM {n}_seq r JOIN {n}_seq q ON {agree} WHERE {' OR '.join(f'r.{k} IS NULL' for k in spec.natural_key)} GROUP BY r.seq), "
            f"{n}_new AS (SELECT seq, row_number() OVER (ORDER BY seq) AS new_id FROM {n}_first WHERE seq = first_seq), "
            f"{n}_map AS (SELECT s.src, s.old_id, w.new_id, s.seq, f.first_seq FROM {n}_seq s JOIN {n}_first f ON f.seq = s.seq JOIN {n}_new w ON w.seq = f.first_seq)"
        )
        maps[n] = f"{n}_map"
    return "WITH " + ", ".join(parts) + " " + tail


def _twice(n: str, keys: list[str]) -> str:
    key = " || ', ' || ".join(f"coalesce(CAST(s.{k} AS VARCHAR), 'None')" for k in keys)
    return f"SELECT '{n}' AS table_name, w.new_id AS id, {key} AS unique_key FROM {n}_new w JOIN {n}_seq s ON s.seq = w.seq QUALIFY count(*) OVER (PARTITION BY {key}) > 1"


_GAPS = "SELECT u.tossup_id, min(t.end_date) AS a, max(t.end_date) AS b, count(DISTINCT t.end_date) AS n_ends FROM buzz u JOIN game g ON g.id = u.game_id JOIN round r ON r.id = g.round_id JOIN tournament t ON t.id = r.tournament_id WHERE t.end_date IS NOT NULL AND u.tossup_id IS NOT NULL GROUP BY 1"
SQL = {
    "v_round": _sql("SELECT r.id, p.question_set_edition_id AS packet_edition, t.question_set_edition_id AS tournament_edition FROM round r JOIN packet p ON p.id = r.packet_id JOIN tournament t ON t.id = r.tournament_id WHERE p.question_set_edition_id IS DISTINCT FROM t.question_set_edition_id"),
    "v_packet_question": _sql("SELECT x.id, p.question_set_edition_id AS packet_edition, q.question_set_edition_id AS question_edition FROM packet_question x JOIN packet p ON p.id = x.packet_id JOIN question q ON q.id = x.question_id WHERE p.question_set_edition_id IS DISTINCT FROM q.question_set_edition_id"),
    "v_game": _sql("SELECT g.id, r.tournament_id, a.tournament_id AS team_one_tournament, b.tournament_id AS team_two_tournament FROM game g JOIN round r ON r.id = g.round_id LEFT JOIN team a ON a.id = g.team_one_id LEFT JOIN team b ON b.id = g.team_two_id WHERE a.tournament_id <> r.tournament_id OR b.tournament_id <> r.tournament_id"),
    "v_buzz": _sql("SELECT b.id, q.question_set_edition_id AS question_edition, t.question_set_edition_id AS game_edition, t2.question_set_edition_id AS player_edition FROM buzz b JOIN game g ON g.id = b.game_id JOIN round r ON r.id = g.round_id JOIN tournament t ON t.id = r.tournament_id JOIN player p ON p.id = b.player_id JOIN team a ON a.id = p.team_id JOIN tournament t2 ON t2.id = a.tournament_id JOIN tossup u ON u.id = b.tossup_id JOIN question q ON q.id = u.question_id WHERE q.question_set_edition_id IS DISTINCT FROM t.question_set_edition_id OR q.question_set_edition_id IS DISTINCT FROM t2.question_set_edition_id"),
    "v_date_gap": _sql(f"SELECT tossup_id, strftime(a, '%Y-%m-%d') AS first_end, strftime(b, '%Y-%m-%d') AS last_end, n_ends, date_diff('day', a, b) AS gap FROM ({_GAPS}) WHERE date_diff('day', a, b) > 7"),
    "v_level": _sql("SELECT e.id, count(DISTINCT CASE WHEN t.id IS NOT NULL THEN coalesce(t.level, '~null') END) AS n_levels FROM question_set_edition e LEFT JOIN tournament t ON t.question_set_edition_id = e.id GROUP BY 1 HAVING n_levels <> 1"),
    "v_full_slug": _sql("SELECT e.id, s.slug || '_' || e.slug AS full_slug, nullif(split_part(s.difficulty, ' ', 1), '') AS difficulty FROM question_set_edition e JOIN question_set s ON s.id = e.question_set_id"),
    "v_multi_tossup": "SELECT question_id, count(*) AS n FROM tossup WHERE question_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1",
    "v_dup_question": "WITH k AS (SELECT id, coalesce(slug, 'None') || ', ' || coalesce(author, 'None') || ', ' || coalesce(editor, 'None') || ', ' || coalesce(metadata, 'None') || ', ' || coalesce(CAST(question_set_edition_id AS VARCHAR), 'None') AS unique_key FROM (SELECT id, slug, author, editor, metadata, question_set_edition_id FROM question UNION ALL SELECT id, slug, author, editor, metadata, question_set_edition_id FROM question_copy)), d AS (SELECT *, count(*) OVER (PARTITION BY unique_key) AS n FROM k) SELECT unique_key, d.id, n, u.question AS text FROM d LEFT JOIN tossup u ON u.question_id = d.id WHERE n > 1",
    "v_pk_unique": " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS n_rows, count(DISTINCT id) AS n_ids FROM {n}" for n in ("question", "tossup", "player", "team", "buzz")),
    "backfill_edition": _sql("""SELECT q.id, coalesce(q.question_set_edition_id, CASE WHEN e.n = 1 THEN e.edition END) AS question_set_edition_id, CASE WHEN e.n IS NULL THEN 'no_packet' WHEN e.n > 1 THEN 'several' WHEN q.question_set_edition_id IS NOT NULL AND q.question_set_edition_id IS DISTINCT FROM e.edition THEN 'conflict' END AS problem
      FROM question q LEFT JOIN (SELECT question_id, count(DISTINCT coalesce(p.question_set_edition_id, -1)) AS n, min(p.question_set_edition_id) AS edition FROM packet_question x JOIN packet p ON p.id = x.packet_id WHERE question_id IS NOT NULL GROUP BY 1) e ON e.question_id = q.id"""),
    "prune_rename_equal": " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS n_rows, 0::BIGINT AS n_differing FROM {n}" for n in domain.DELIVERED),
    "merge_id_map": _merge_sql(" UNION ALL ".join(f"SELECT '{n}' AS table_name, src, old_id, new_id FROM {n}_map" for n in TABLES)),
    "merge_output": _merge_sql("SELECT w.new_id AS id, s.player_id, s.game_id, s.tossup_id, s.buzz_position, s.value FROM buzz_new w JOIN buzz_seq s ON s.seq = w.seq"),
    "merge_games": _merge_sql("SELECT w.new_id AS id, s.round_id, s.tossups_read, s.team_one_id, s.team_two_id FROM game_new w JOIN game_seq s ON s.seq = w.seq"),
    "merge_duplicates": _merge_sql(" UNION ALL ".join(_twice(n, k) for n, k in (("question", ["slug", "metadata", "category_full"]), ("team", ["tournament_id", "name"]), ("player", ["team_id", "name"])))),
    "merge_diff": _merge_sql("""SELECT src, old_id, new_id, 'Differences:' || chr(10) || string_agg(chr(9) || c || ': ' || coalesce(o, 'None') || ' -> ' || coalesce(v, 'None'), chr(10) ORDER BY c) AS text FROM (
      SELECT m.src, m.old_id, m.new_id, x.c, x.o, x.v FROM player_map m JOIN player_seq s ON s.seq = m.seq JOIN player_seq k ON k.seq = m.first_seq,
      LATERAL (VALUES ('team_id', CAST(k.team_id AS VARCHAR), CAST(s.team_id AS VARCHAR)), ('name', k.name, s.name), ('slug', k.slug, s.slug)) x(c, o, v) WHERE m.seq <> m.first_seq AND x.o IS DISTINCT FROM x.v) GROUP BY 1, 2, 3"""),
    "response_pairs": f"WITH {_P} SELECT * FROM p",
    "reach_activity": f"WITH {_REACH} SELECT player, count(*) AS n_reached FROM reach GROUP BY 1",
    "density": f"WITH {_REACH} SELECT count(DISTINCT player) AS n_players, count(DISTINCT item) AS n_items, count(*) AS n_pairs, CAST(100 AS DOUBLE) * count(*) / (count(DISTINCT player) * count(DISTINCT item)) AS density FROM reach",
    "activity_ranks": f"WITH {_REACH} SELECT 'player' AS axis, player AS key, n AS n_reached, row_number() OVER (ORDER BY n DESC, player) AS rank FROM (SELECT player, count(*) AS n FROM reach GROUP BY 1) "
    "UNION ALL SELECT 'item', CAST(item AS VARCHAR), n, row_number() OVER (ORDER BY n DESC, item) FROM (SELECT item, count(*) AS n FROM reach GROUP BY 1)",
    "low_activity": f"WITH {_REACH} SELECT s.tossup_id, s.tournament, s.category, n AS n_reached FROM (SELECT item, count(*) AS n FROM reach GROUP BY 1 HAVING count(*) < 300) r JOIN season_tossups s ON s.tossup_id = r.item",
}
