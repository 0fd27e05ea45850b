"""The denormalising views. Tables come as a dict of DataFrames; dimensions join by key and Catalyst decides what to broadcast."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quizlake.operators.dedup import keep_first

Tables = Mapping[str, DataFrame]


def _as(df: DataFrame, alias: str, key: str = "id", **columns: str) -> DataFrame:
    """The key as ``alias_key`` and columns renamed: new=old."""
    return df.select(F.col(key).alias(f"{alias}_key"), *(F.col(old).alias(new) for new, old in columns.items()))


def game_info(t: Tables) -> DataFrame:
    sets = _as(t["question_set"], "s", qset="slug", difficulty="difficulty")
    editions = _as(t["question_set_edition"], "e", edition="slug", set_id="question_set_id")
    packets = _as(t["packet"], "p", packet="name", edition_id="question_set_edition_id")
    rounds = _as(t["round"], "r", round="number", r_tournament="tournament_id", r_packet="packet_id")
    tournaments = _as(t["tournament"], "t", tournament="slug", level="level")
    one, two = _as(t["team"], "a", team1="slug"), _as(t["team"], "b", team2="slug")
    return (
        t["game"].select("id", "round_id", "team_one_id", "team_two_id")
        .join(rounds, F.col("round_id") == F.col("r_key"))
        .join(tournaments, F.col("r_tournament") == F.col("t_key"))
        .join(packets, F.col("r_packet") == F.col("p_key"))
        .join(editions, F.col("edition_id") == F.col("e_key"))
        .join(sets, F.col("set_id") == F.col("s_key"))
        .join(one, F.col("team_one_id") == F.col("a_key"), "left")
        .join(two, F.col("team_two_id") == F.col("b_key"), "left")
        .select("id", "team1", "team2", "tournament", "level", "round", "packet", "qset", "edition", "difficulty")
    )


def player_info(t: Tables) -> DataFrame:
    teams = _as(t["team"], "a", team="slug", a_tournament="tournament_id")
    return (
        t["player"].select("id", "slug", "name", "team_id")
        .join(teams, F.col("team_id") == F.col("a_key"))
        .join(_as(t["tournament"], "t", tournament="slug"), F.col("a_tournament") == F.col("t_key"))
        .select("id", "slug", "name", "team", "tournament")
    )


def _slugs(t: Tables) -> DataFrame:
    return _as(t["question"], "q", slug="slug", category="category_slug", subcategory="subcategory_slug", category_main="category_main_slug")


def tossup_info(t: Tables) -> DataFrame:
    return (
        t["tossup"].select("id", "question_id", "question", "answer", "answer_sanitized", "answer_primary")
        .join(_slugs(t), F.col("question_id") == F.col("q_key"))
        .select("id", "question_id", "slug", "question", "answer", "answer_sanitized", "answer_primary", "category", "subcategory", "category_main")
    )


def bonus_part_info(t: Tables) -> DataFrame:
    bonuses = _as(t["bonus"], "b", question_id="question_id", leadin="leadin", leadin_sanitized="leadin_sanitized")
    return (
        t["bonus_part"].join(bonuses, F.col("bonus_id") == F.col("b_key")).join(_slugs(t), F.col("question_id") == F.col("q_key"))
        .select("id", "bonus_id", "question_id", "slug", "leadin", "leadin_sanitized", "part", "part_number", "part_sanitized", "answer", "answer_sanitized", "answer_primary", "value", "difficulty_modifier", "category", "subcategory", "category_main")
    )


def _placed(t: Tables) -> DataFrame:
    """Buzzes of known games, with the game's tournament."""
    rounds = _as(t["round"], "r", r_tournament="tournament_id").join(_as(t["tournament"], "t", tournament="slug"), F.col("r_tournament") == F.col("t_key")).select("r_key", "tournament")
    games = _as(t["game"], "g", g_round="round_id").join(rounds, F.col("g_round") == F.col("r_key")).select("g_key", "tournament")
    return t["buzz"].select("id", "player_id", "tossup_id", "game_id", "buzz_position", "value").join(games, F.col("game_id") == F.col("g_key")).drop("g_key")


def _described(t: Tables, buzzes: DataFrame) -> DataFrame:
    players = _as(t["player"], "p", player="slug", p_team="team_id").join(_as(t["team"], "a", team="slug"), F.col("p_team") == F.col("a_key")).select("p_key", "player", "team")
    tossups = _as(t["tossup"], "u", question_text="question", question_answer="answer", u_question="question_id")
    questions = _as(t["question"], "q", question_category="category", question_subcategory="subcategory")
    return (
        buzzes.join(players, F.col("player_id") == F.col("p_key"))
        .join(tossups.join(questions, F.col("u_question") == F.col("q_key")), F.col("tossup_id") == F.col("u_key"))
        .select("id", "player_id", "tossup_id", "game_id", "question_text", "question_answer", "question_category", "question_subcategory", "tournament", "team", "player", "buzz_position", "value")
    )


def buzz_rows(t: Tables) -> DataFrame:
    """One row per buzz with a player and a game; the tournament is the game's."""
    return _described(t, _placed(t))


def buzz_info(t: Tables) -> DataFrame:
    """buzz_rows without repeats and without buzzes that have no position.

    The position is part of the key, so the filter comes first; players and tossups only depend on the key, so their
    columns, the texts among them, are joined after the repeats are gone.
    """
    kept = keep_first(_placed({**t, "buzz": t["buzz"].where("buzz_position is not null")}), ["player_id", "tossup_id", "buzz_position"])
    return _described(t, kept.withColumn("buzz_position", F.col("buzz_position").cast("int")))


def responses(t: Tables, prefix: str) -> DataFrame:
    """player (slug), tossup_id: those of the ``buzz_info`` rows whose tournament's slug starts with ``prefix``, once each.

    Of a buzz only its keys and whether its tournament is meant travel, and slugs join where repeats are gone. Rows lie by player and
    then by tossup, which serves the repeats, the joins and the last distinct without further exchanges."""
    placed = _placed({**t, "buzz": t["buzz"].where("buzz_position is not null and player_id is not null and tossup_id is not null")})
    rows = placed.select("id", "player_id", "tossup_id", "buzz_position", F.coalesce(F.col("tournament").startswith(prefix), F.lit(False)).alias("meant")).repartition("player_id")
    kept = rows.groupBy("player_id", "tossup_id", "buzz_position").agg(F.min_by("meant", F.coalesce("id", F.lit(2**63 - 1))).alias("meant"))
    ids = kept.where("meant").select("player_id", "tossup_id").distinct()
    players = _as(t["player"], "p", player="slug", p_team="team_id").where("player is not null").join(_as(t["team"], "a"), F.col("p_team") == F.col("a_key")).select("p_key", "player")
    tossups = _as(t["tossup"], "u", u_question="question_id").join(_as(t["question"], "q"), F.col("u_question") == F.col("q_key"), "left_semi")
    return ids.join(players, F.col("player_id") == F.col("p_key")).select("player", "tossup_id").join(tossups, F.col("tossup_id") == F.col("u_key"), "left_semi").distinct()
