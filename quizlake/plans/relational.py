"""Queries of the views, filters, joins, aggregations, sorts and set operations, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quizlake import catalog
from quizlake.functions import text
from quizlake.operators import dedup, records, validate, views
from quizlake.plans import domain
from quizlake.schema import TABLES, dependents, levels
from quizlake.session import table

#: Fixed value: what the slugs of the season's tournaments start with.
YEARS = "20"
#: so many keys are broadcast
FEW = 1 << 17

_BUZZ = """
buzz_rows AS (SELECT b.id, b.player_id, b.tossup_id, b.game_id, u.question AS question_text, u.answer AS question_answer, q.category AS question_category, q.subcategory AS question_subcategory,
  t.slug AS tournament, a.slug AS team, p.slug AS player, b.buzz_position, b.value
  FROM buzz b JOIN player p ON p.id = b.player_id JOIN team a ON a.id = p.team_id JOIN tossup u ON u.id = b.tossup_id JOIN question q ON q.id = u.question_id
  JOIN game g ON g.id = b.game_id JOIN round r ON r.id = g.round_id JOIN tournament t ON t.id = r.tournament_id),
buzz_info AS (SELECT * FROM buzz_rows WHERE buzz_position IS NOT NULL QUALIFY row_number() OVER (PARTITION BY player_id, tossup_id, buzz_position ORDER BY id) = 1)
"""


def _sql(body: str, *more: str) -> str:
    return "WITH " + ", ".join([domain.SQL, *more]) + " " + body


def _q(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return table(spark, sf, name)


def season(spark: SparkSession, sf: str) -> DataFrame:
    """The buzzes of the tournaments whose slug starts with the year prefix."""
    return views.buzz_info(domain.tables(spark, sf)).where(F.col("tournament").startswith(YEARS))


def season_tossups(spark: SparkSession, sf: str, only: DataFrame | None = None) -> DataFrame:
    """The first buzz of each tossup of the season, or of those in ``only`` (tossup_id): repeats are of one tossup, so others' buzzes can stay out."""
    t = domain.tables(spark, sf)
    if only is not None:
        keys = only.select("tossup_id")
        t["buzz"] = t["buzz"].join(F.broadcast(keys) if keys.limit(FEW + 1).count() <= FEW else keys, "tossup_id", "left_semi")
    rows = views.buzz_info(t).where(F.col("tournament").startswith(YEARS))
    return dedup.keep_first(rows.select("id", "tossup_id", "tournament", "question_category", "question_subcategory"), ["tossup_id"])


def category_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Buzzed tossups by main category."""
    return dedup.value_counts(season_tossups(spark, sf), text.category_main(F.col("question_category"), F.col("question_subcategory")))


def category_main_redundancy(spark: SparkSession, sf: str) -> DataFrame:
    """Questions whose stored main category says more than the category and subcategory do."""
    return _q(spark, sf, "question").where(~text.is_redundant_main(F.col("category"), F.col("subcategory"), F.col("category_main"))).select("id", "category_main")


def distinct_tossups(spark: SparkSession, sf: str) -> DataFrame:
    rows = dedup.keep_first(_q(spark, sf, "buzz").where("tossup_id is not null"), ["tossup_id"])
    return rows.select("tossup_id", "id", "player_id", "game_id", "buzz_position", "value")


def nunique_report(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.distinct_counts(_q(spark, sf, "buzz"), ["player_id", "game_id", "tossup_id", "value"])


def dup_rows(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.duplicated(_q(spark, sf, "question").select("id", "slug"), ["slug"])


def slug_name_conflicts(spark: SparkSession, sf: str) -> DataFrame:
    """Slugs with several names over both copies and the three pairs of columns: a row per name. Null is a slug and a name like others."""
    out = None
    for name in ("question", "question_copy"):
        three = F.array(*(F.struct(F.col(slug).alias("slug"), F.col(value).alias("name")) for slug, value in (("category_slug", "category"), ("subcategory_slug", "subcategory"), ("category_main_slug", "category_main"))))
        df = _q(spark, sf, name).select(F.explode(three).alias("r")).select("r.*")
        out = df if out is None else out.unionByName(df)
    names = out.distinct()
    several = names.groupBy(F.col("slug").alias("s")).agg(F.count(F.lit(1)).alias("n_names")).where("n_names > 1")
    return names.join(several, F.col("slug").eqNullSafe(F.col("s"))).select("slug", "name", "n_names")


def dup_groups(spark: SparkSession, sf: str) -> DataFrame:
    q = _q(spark, sf, "question")
    keyed = q.select(F.col("id"), dedup.unique_key(["slug", "question_set_edition_id"]).alias("k"))
    return dedup.group_lists(keyed, ["k"], F.col("id")).select("k", "n", F.array_join(F.transform("items", lambda x: x.cast("string")), ",").alias("ids"))


def key_difference(spark: SparkSession, sf: str) -> DataFrame:
    """Tossups of buzzes that the tossup table lacks."""
    return dedup.key_difference(_q(spark, sf, "buzz").where("tossup_id is not null").select(F.col("tossup_id").alias("id")), _q(spark, sf, "tossup"), "id")


def key_intersection(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.key_intersection(_q(spark, sf, "player"), _q(spark, sf, "player_copy"), "slug")


def subset_diff(spark: SparkSession, sf: str) -> DataFrame:
    left, right = _q(spark, sf, "player"), _q(spark, sf, "player_copy")
    return validate.subset_differences(left, right, "slug", [c for c in catalog.shared_fields(left, right) if c != "slug"])


def first_slug_match(spark: SparkSession, sf: str) -> DataFrame:
    two = dedup.keep_first(_q(spark, sf, "team_copy").where("slug is not null").select("id", "slug"), ["slug"])
    return _q(spark, sf, "team").select(F.col("id").alias("left_id"), "slug").join(two.select("slug", F.col("id").alias("right_id")), "slug")


def semi_by_slug(spark: SparkSession, sf: str) -> DataFrame:
    """Buzzes of the player with a given slug, sorted by value and position."""
    players = _q(spark, sf, "player").where(F.col("slug") == "house-account").select(F.col("id").alias("player_id"))
    return _q(spark, sf, "buzz").join(players, "player_id", "left_semi").select("id", "player_id", "tossup_id", "buzz_position", "value").orderBy("value", "buzz_position", "id")


def max_buzz_position(spark: SparkSession, sf: str) -> DataFrame:
    return _q(spark, sf, "buzz").where("tossup_id is not null").groupBy("tossup_id").agg(F.max("buzz_position").alias("max_position"))


def _latest(spark: SparkSession, sf: str) -> DataFrame:
    b = _q(spark, sf, "buzz").where("tossup_id is not null and buzz_position is not null")
    return b.groupBy("tossup_id").agg(F.max_by(F.struct("id", "game_id", "buzz_position"), F.struct("buzz_position", -F.col("id"))).alias("r")).select("tossup_id", "r.*")


def latest_buzz(spark: SparkSession, sf: str) -> DataFrame:
    return _latest(spark, sf).select("tossup_id", "id", "buzz_position")


def stats_url(spark: SparkSession, sf: str) -> DataFrame:
    t = domain.tables(spark, sf)
    games = views.game_info(t).select(F.col("id").alias("game_id"), "qset")
    slugs = t["tossup"].select(F.col("id").alias("tossup_id"), "question_id").join(t["question"].select(F.col("id").alias("question_id"), "slug"), "question_id")
    return _latest(spark, sf).join(games, "game_id").join(slugs, "tossup_id").select("tossup_id", F.concat(F.lit("https://stats.example/"), "qset", F.lit("/tossup/"), "slug").alias("url"))


def join_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of each table and of its view."""
    t, out = domain.tables(spark, sf), None
    for name, view in (("player", views.player_info), ("buzz", views.buzz_info), ("tossup", views.tossup_info), ("game", views.game_info)):
        n, joined = (df.agg(F.count(F.lit(1)).alias(c)) for df, c in ((t[name], "n_rows"), (view(t), "n_joined")))
        one = n.join(joined, F.lit(True)).select(F.lit(name).alias("table_name"), "n_rows", "n_joined")  # two single rows
        out = one if out is None else out.unionByName(one)
    return out


def filter_buzzes(spark: SparkSession, sf: str) -> DataFrame:
    rows = catalog.matching(_q(spark, sf, "buzz"), {"value": -5, "game_id": None, "no_such_column": 1})
    return rows.select("id", "player_id", "tossup_id", "value")


def prefix_filter(spark: SparkSession, sf: str) -> DataFrame:
    """Buzzes of tournaments whose slug starts with the year prefix."""
    return season(spark, sf).select("id", "tournament", "buzz_position")


def one_tournament(spark: SparkSession, sf: str) -> DataFrame:
    """The one tournament with an id."""
    return catalog.exactly_one(_q(spark, sf, "tournament"), {"id": 101}).select("id", "slug")


def table_columns(spark: SparkSession, sf: str) -> DataFrame:
    """The stored tables among the modelled ones, and their columns in order."""
    found = catalog.Catalog.load(spark, sf)
    rows = [(n, k, c) for n in found.list_tables() if n in TABLES for k, c in enumerate(found.tables[n].columns, 1)]
    return spark.createDataFrame(rows, "table_name string, position int, column_name string")


def schema_levels(spark: SparkSession, sf: str) -> DataFrame:
    """The modelled tables by topological level, and how many tables refer to each."""
    children = dependents()
    return spark.createDataFrame([(k, t, len(children[t])) for k, level in enumerate(levels()) for t in level], "level int, table_name string, n_dependents int")


def table_head(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.Catalog.load(spark, sf, ["team"]).head("team").select("id", "tournament_id", "name", "slug")


def search_text(spark: SparkSession, sf: str) -> DataFrame:
    return _q(spark, sf, "tossup").where(catalog.contains_text("question", "COMPOSER")).select("id", "question_id")


def regex_search(spark: SparkSession, sf: str) -> DataFrame:
    return _q(spark, sf, "tossup").where(F.col("question").rlike("(?U)[A-Z]\\. [A-Z]\\. ")).select("id", text.highlight(F.col("question"), "[A-Z]\\. [A-Z]\\. ").alias("html"))


def regex_report(spark: SparkSession, sf: str) -> DataFrame:
    """The first ten matching texts by id, each with its matches, beside the number of all matching texts."""
    found = _q(spark, sf, "tossup").where(F.col("question").rlike("(?U)[A-Z]\\. [A-Z]\\. "))
    total = found.agg(F.count(F.lit(1)).alias("n_total"))  # one row
    first = found.select("id", text.n_matches(F.col("question"), "[A-Z]\\. [A-Z]\\. ").alias("n_matches")).orderBy("id").limit(10)
    return first.join(total, F.lit(True))


def duplicate_share(spark: SparkSession, sf: str) -> DataFrame:
    """Rank of each buzz among those of its (player, tossup), by position."""
    w = Window.partitionBy("player_id", "tossup_id").orderBy("buzz_position", "id")
    return _q(spark, sf, "buzz").where("player_id is not null and tossup_id is not null").select("id", F.row_number().over(w).alias("nth")).where("nth > 1")


QUERIES = {
    "game_info": lambda s, d: views.game_info(domain.tables(s, d)),
    "player_info": lambda s, d: views.player_info(domain.tables(s, d)),
    "tossup_info": lambda s, d: views.tossup_info(domain.tables(s, d)),
    "bonus_part_info": lambda s, d: views.bonus_part_info(domain.tables(s, d)),
    "buzz_info": lambda s, d: views.buzz_info(domain.tables(s, d)),
    "category_bars": lambda s, d: records.bars(category_counts(s, d)),
} | {
    f.__name__: f
    for f in (
        filter_buzzes, prefix_filter, one_tournament, table_columns, schema_levels, table_head, search_text, regex_search, regex_report, category_counts, category_main_redundancy, nunique_report, distinct_tossups,
        dup_rows, slug_name_conflicts, dup_groups, key_difference, key_intersection, subset_diff, first_slug_match, semi_by_slug, max_buzz_position, latest_buzz, stats_url, join_counts, duplicate_share,
    )
}

_MAIN = "CASE WHEN starts_with(subcategory, category) OR ends_with(subcategory, category) THEN subcategory ELSE category || '-' || subcategory END"
_SEASON = "season_tossups AS (SELECT tossup_id, tournament, question_category AS category, question_subcategory AS subcategory FROM buzz_info WHERE starts_with(tournament, '20') QUALIFY row_number() OVER (PARTITION BY tossup_id ORDER BY id) = 1)"
_COUNTS = f"SELECT value, count(*) AS n FROM (SELECT {_MAIN} AS value FROM season_tossups) WHERE value IS NOT NULL GROUP BY 1"
_LATEST = "latest AS (SELECT tossup_id, id, game_id, buzz_position FROM buzz WHERE tossup_id IS NOT NULL AND buzz_position IS NOT NULL QUALIFY row_number() OVER (PARTITION BY tossup_id ORDER BY buzz_position DESC, id) = 1)"
_GAME = """game_info AS (SELECT g.id, a.slug AS team1, b.slug AS team2, t.slug AS tournament, t.level, r.number AS round, p.name AS packet, s.slug AS qset, e.slug AS edition, s.difficulty
  FROM game g JOIN round r ON r.id = g.round_id JOIN tournament t ON t.id = r.tournament_id JOIN packet p ON p.id = r.packet_id
  JOIN question_set_edition e ON e.id = p.question_set_edition_id JOIN question_set s ON s.id = e.question_set_id LEFT JOIN team a ON a.id = g.team_one_id LEFT JOIN team b ON b.id = g.team_two_id)"""
SQL = {
    "game_info": _sql("SELECT * FROM game_info", _GAME),
    "player_info": "SELECT p.id, p.slug, p.name, a.slug AS team, t.slug AS tournament FROM player p JOIN team a ON a.id = p.team_id JOIN tournament t ON t.id = a.tournament_id",
    "tossup_info": "SELECT u.id, question_id, q.slug, question, answer, answer_sanitized, answer_primary, q.category_slug AS category, q.subcategory_slug AS subcategory, q.category_main_slug AS category_main FROM tossup u JOIN question q ON q.id = u.question_id",
    "bonus_part_info": _sql("SELECT p.id, bonus_id, question_id, q.slug, leadin, leadin_sanitized, part, part_number, part_sanitized, answer, answer_sanitized, answer_primary, value, difficulty_modifier, q.category_slug AS category, q.subcategory_slug AS subcategory, q.category_main_slug AS category_main FROM bonus_part p JOIN bonus b ON b.id = p.bonus_id JOIN question q ON q.id = b.question_id"),
    "buzz_info": _sql("SELECT * FROM buzz_info", _BUZZ),
    "category_counts": _sql(_COUNTS, _BUZZ, _SEASON),
    "category_bars": _sql(f"SELECT value, n, repeat('█', k) || repeat('▒', 20 - k) AS bar FROM (SELECT value, n, CAST(floor(n * 20 / max(n) OVER ()) AS INTEGER) AS k FROM ({_COUNTS}))", _BUZZ, _SEASON),
    "category_main_redundancy": "SELECT id, category_main FROM question WHERE coalesce(category_main NOT IN (category || '-' || subcategory, subcategory), true)",
    "one_tournament": "SELECT id, slug FROM tournament WHERE id = 101",
    "table_columns": "SELECT table_name, ordinal_position AS position, column_name FROM information_schema.columns WHERE table_name IN ('packet_question', 'question', 'tossup', 'tournament', 'team', 'player', 'game', 'buzz')",
    "schema_levels": """SELECT CAST(level AS INTEGER) AS level, table_name, CAST(n AS INTEGER) AS n_dependents FROM (VALUES (0, 'question_set', 1), (1, 'question_set_edition', 3), (2, 'packet', 2), (2, 'question', 2), (2, 'tournament', 2),
      (3, 'packet_question', 0), (3, 'round', 1), (3, 'team', 2), (3, 'tossup', 1), (4, 'game', 1), (4, 'player', 1), (5, 'buzz', 0)) v(level, table_name, n)""",
    "filter_buzzes": "SELECT id, player_id, tossup_id, value FROM buzz WHERE value = -5 AND game_id IS NULL",
    "prefix_filter": _sql("SELECT id, tournament, buzz_position FROM buzz_info WHERE starts_with(tournament, '20')", _BUZZ),
    "table_head": "SELECT id, tournament_id, name, slug FROM team ORDER BY id LIMIT 10",
    "search_text": "SELECT id, question_id FROM tossup WHERE question ILIKE '%COMPOSER%'",
    "regex_search": r"""SELECT id, regexp_replace(question, '([A-Z]\. [A-Z]\. )', '<span class="hit">\1</span>', 'g') AS html FROM tossup WHERE regexp_matches(question, '[A-Z]\. [A-Z]\. ')""",
    "regex_report": r"""WITH m AS (SELECT id, len(regexp_extract_all(question, '[A-Z]\. [A-Z]\. ')) AS n_matches FROM tossup WHERE regexp_matches(question, '[A-Z]\. [A-Z]\. '))
      SELECT id, CAST(n_matches AS INTEGER) AS n_matches, (SELECT count(*) FROM m) AS n_total FROM m ORDER BY id LIMIT 10""",
    "nunique_report": " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_distinct FROM buzz" for c in ("player_id", "game_id", "tossup_id", "value")),
    "distinct_tossups": "SELECT tossup_id, id, player_id, game_id, buzz_position, value FROM buzz WHERE tossup_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY tossup_id ORDER BY id) = 1",
    "dup_rows": "SELECT id, slug FROM question QUALIFY count(*) OVER (PARTITION BY slug) > 1",
    "slug_name_conflicts": "SELECT slug, name, n_names FROM (SELECT *, count(*) OVER (PARTITION BY slug) AS n_names FROM ("
    + " UNION ".join(f"SELECT {f}_slug AS slug, {f} AS name FROM {t}" for t in ("question", "question_copy") for f in ("category", "subcategory", "category_main"))
    + ")) WHERE n_names > 1",
    "dup_groups": "SELECT coalesce(slug, 'None') || ', ' || coalesce(CAST(question_set_edition_id AS VARCHAR), 'None') AS k, count(*) AS n, string_agg(CAST(id AS VARCHAR), ',' ORDER BY id) AS ids FROM question GROUP BY 1 HAVING count(*) > 1",
    "key_difference": "SELECT DISTINCT tossup_id AS id FROM buzz WHERE tossup_id IS NOT NULL AND tossup_id NOT IN (SELECT id FROM tossup)",
    "key_intersection": "SELECT slug FROM player INTERSECT SELECT slug FROM player_copy",
    "subset_diff": """WITH l AS (SELECT slug, name FROM player QUALIFY row_number() OVER (PARTITION BY slug ORDER BY id) = 1), r AS (SELECT slug, name FROM player_copy QUALIFY row_number() OVER (PARTITION BY slug ORDER BY id, synced_at) = 1)
      SELECT l.slug, CASE WHEN r.slug IS NULL THEN 'missing' ELSE 'name' END AS field_name, CASE WHEN r.slug IS NOT NULL THEN l.name END AS left_value, r.name AS right_value FROM l LEFT JOIN r ON r.slug = l.slug WHERE r.slug IS NULL OR l.name IS DISTINCT FROM r.name""",
    "first_slug_match": "SELECT a.id AS left_id, a.slug, b.id AS right_id FROM team a JOIN (SELECT slug, min(id) AS id FROM team_copy GROUP BY slug) b ON b.slug = a.slug",
    "semi_by_slug": "SELECT id, player_id, tossup_id, buzz_position, value FROM buzz WHERE player_id IN (SELECT id FROM player WHERE slug = 'house-account')",
    "max_buzz_position": "SELECT tossup_id, max(buzz_position) AS max_position FROM buzz WHERE tossup_id IS NOT NULL GROUP BY 1",
    "latest_buzz": f"WITH {_LATEST} SELECT tossup_id, id, buzz_position FROM latest",
    "stats_url": _sql("SELECT l.tossup_id, 'https://stats.example/' || g.qset || '/tossup/' || q.slug AS url FROM latest l JOIN game_info g ON g.id = l.game_id JOIN tossup u ON u.id = l.tossup_id JOIN question q ON q.id = u.question_id", _GAME, _LATEST),
    "join_counts": _sql("""SELECT 'player' AS table_name, (SELECT count(*) FROM player) AS n_rows, count(*) AS n_joined FROM player p JOIN team a ON a.id = p.team_id JOIN tournament t ON t.id = a.tournament_id
      UNION ALL SELECT 'buzz', (SELECT count(*) FROM buzz), count(*) FROM buzz_info UNION ALL SELECT 'tossup', (SELECT count(*) FROM tossup), count(*) FROM tossup u JOIN question q ON q.id = u.question_id
      UNION ALL SELECT 'game', (SELECT count(*) FROM game), count(*) FROM game_info""", _BUZZ, _GAME),
    "duplicate_share": "SELECT id, row_number() OVER (PARTITION BY player_id, tossup_id ORDER BY buzz_position NULLS FIRST, id) AS nth FROM buzz WHERE player_id IS NOT NULL AND tossup_id IS NOT NULL QUALIFY nth > 1",
}
