"""Consistency rules. Each gives its violations as rows; ``require`` turns them into an error."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quizlake.functions.text import first_token
from quizlake.operators.dedup import unique_key

Tables = Mapping[str, DataFrame]
#: Fixed value: days between the ends of tournaments on one question.
MAX_GAP = 7


def require(violations: DataFrame, rule: str) -> None:
    if rows := violations.limit(3).collect():
        raise AssertionError(f"{rule}: {rows}")


def _pick(df: DataFrame, **columns: str) -> DataFrame:
    return df.select(*(F.col(old).alias(new) for new, old in columns.items()))


def rounds(t: Tables) -> DataFrame:
    """Rounds whose packet is of another edition than their tournament."""
    p = _pick(t["packet"], packet_id="id", packet_edition="question_set_edition_id")
    m = _pick(t["tournament"], tournament_id="id", tournament_edition="question_set_edition_id")
    return t["round"].select("id", "packet_id", "tournament_id").join(p, "packet_id").join(m, "tournament_id").where(~F.col("packet_edition").eqNullSafe(F.col("tournament_edition"))).select("id", "packet_edition", "tournament_edition")


def packet_questions(t: Tables) -> DataFrame:
    """Packet questions whose question is of another edition than the packet."""
    p = _pick(t["packet"], packet_id="id", packet_edition="question_set_edition_id")
    q = _pick(t["question"], question_id="id", question_edition="question_set_edition_id")
    return t["packet_question"].select("id", "packet_id", "question_id").join(p, "packet_id").join(q, "question_id").where(~F.col("packet_edition").eqNullSafe(F.col("question_edition"))).select("id", "packet_edition", "question_edition")


def games(t: Tables) -> DataFrame:
    """Games with a team that is not of the round's tournament."""
    r = _pick(t["round"], round_id="id", tournament_id="tournament_id")
    one, two = _pick(t["team"], team_one_id="id", one="tournament_id"), _pick(t["team"], team_two_id="id", two="tournament_id")
    g = t["game"].select("id", "round_id", "team_one_id", "team_two_id").join(r, "round_id").join(one, "team_one_id", "left").join(two, "team_two_id", "left")
    return g.where((F.col("one") != F.col("tournament_id")) | (F.col("two") != F.col("tournament_id"))).select("id", "tournament_id", F.col("one").alias("team_one_tournament"), F.col("two").alias("team_two_tournament"))


def buzzes(t: Tables) -> DataFrame:
    """Buzzes whose question is of another edition than the game's or the player's tournament."""
    m = _pick(t["tournament"], tournament_id="id", edition="question_set_edition_id")
    g = _pick(t["game"], game_id="id", round_id="round_id").join(_pick(t["round"], round_id="id", tournament_id="tournament_id"), "round_id").join(m, "tournament_id").select("game_id", F.col("edition").alias("game_edition"))
    p = _pick(t["player"], player_id="id", team_id="team_id").join(_pick(t["team"], team_id="id", tournament_id="tournament_id"), "team_id").join(m, "tournament_id").select("player_id", F.col("edition").alias("player_edition"))
    u = _pick(t["tossup"], tossup_id="id", question_id="question_id").join(_pick(t["question"], question_id="id", question_edition="question_set_edition_id"), "question_id").select("tossup_id", "question_edition")
    b = t["buzz"].select("id", "game_id", "player_id", "tossup_id").join(g, "game_id").join(p, "player_id").join(u, "tossup_id")
    off = ~F.col("question_edition").eqNullSafe(F.col("game_edition")) | ~F.col("question_edition").eqNullSafe(F.col("player_edition"))
    return b.where(off).select("id", "question_edition", "game_edition", "player_edition")


def date_gaps(t: Tables, max_gap: int = MAX_GAP) -> DataFrame:
    """Tossups used in tournaments that ended more than max_gap days apart. Unknown ends are left out."""
    m = _pick(t["tournament"], tournament_id="id", end_date="end_date").where("end_date is not null")
    ends = _pick(t["game"], game_id="id", round_id="round_id").join(_pick(t["round"], round_id="id", tournament_id="tournament_id"), "round_id").join(m, "tournament_id").select("game_id", "end_date")
    used = t["buzz"].select("tossup_id", "game_id").join(ends, "game_id").where("tossup_id is not null").groupBy("tossup_id").agg(F.min("end_date").alias("first_end"), F.max("end_date").alias("last_end"), F.count_distinct("end_date").alias("n_ends"))
    return used.withColumn("gap", F.date_diff("last_end", "first_end")).where(F.col("gap") > max_gap).select("tossup_id", F.date_format("first_end", "yyyy-MM-dd").alias("first_end"), F.date_format("last_end", "yyyy-MM-dd").alias("last_end"), "n_ends", "gap")


def edition_levels(t: Tables) -> DataFrame:
    """Editions that don't have exactly one distinct level (null is one), editions without tournaments included."""
    m = t["tournament"].select(F.col("question_set_edition_id").alias("id"), F.struct("level").alias("level"))
    n = t["question_set_edition"].select("id").join(m, "id", "left").groupBy("id").agg(F.size(F.collect_set("level")).cast("long").alias("n_levels"))
    return n.where("n_levels <> 1")


def full_slugs(t: Tables) -> DataFrame:
    """Every edition's full slug and the first word of its set's difficulty."""
    s = _pick(t["question_set"], question_set_id="id", set_slug="slug", difficulty="difficulty")
    return t["question_set_edition"].select("id", "question_set_id", "slug").join(s, "question_set_id").select("id", F.concat("set_slug", F.lit("_"), "slug").alias("full_slug"), first_token(F.col("difficulty")).alias("difficulty"))


def multiple_tossups(t: Tables) -> DataFrame:
    return t["tossup"].where("question_id is not null").groupBy("question_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def duplicate_questions(t: Tables) -> DataFrame:
    """Questions that share their natural key with another one, and their tossups' texts."""
    q = t["question"].select("id", unique_key(["slug", "author", "editor", "metadata", "question_set_edition_id"]).alias("unique_key"))
    texts = t["tossup"].select(F.col("question_id").alias("id"), F.col("question").alias("text"))
    shared = q.groupBy("unique_key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return q.join(shared, "unique_key").join(texts, "id", "left").select("unique_key", "id", "n", "text")


def repeated_ids(t: Tables, names: list[str]) -> DataFrame:
    """Per table: rows and distinct ids."""
    out = None
    for n in names:
        ids = t[n].groupBy("id").agg(F.count(F.lit(1)).alias("n"))
        one = ids.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count("id").alias("n_ids")).select(F.lit(n).alias("table_name"), "n_rows", "n_ids")
        out = one if out is None else out.unionByName(one)
    return out


def subset_differences(left: DataFrame, right: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Keys of left that right lacks (field_name ``missing``), and fields that differ from right's first row of the key."""
    one, two = (df.where(F.col(key).isNotNull()).groupBy(key).agg(F.min_by(F.struct(*fields), "id").alias(a)) for df, a in ((left, "l"), (right, "r")))
    both = one.join(two, key, "left")
    changed = F.array_compact(F.array(*(F.when(~F.col(f"l.{f}").eqNullSafe(F.col(f"r.{f}")), F.struct(F.lit(f).alias("field_name"), F.col(f"l.{f}").cast("string").alias("left_value"), F.col(f"r.{f}").cast("string").alias("right_value"))) for f in fields)))
    gone = F.array(F.struct(F.lit("missing").alias("field_name"), F.lit(None).cast("string").alias("left_value"), F.lit(None).cast("string").alias("right_value")))
    return both.select(key, F.explode(F.when(F.col("r").isNull(), gone).otherwise(changed)).alias("d")).select(key, "d.*")


def single_edition(t: Tables) -> DataFrame:
    """question_id, edition, n: the distinct editions (null is one) of each question's packets; edition is set if there is one."""
    p = _pick(t["packet"], packet_id="id", edition="question_set_edition_id")
    seen = t["packet_question"].select("question_id", "packet_id").where("question_id is not null").join(p, "packet_id").select("question_id", F.struct("edition").alias("e"))
    return seen.groupBy("question_id").agg(F.collect_set("e").alias("es")).select("question_id", F.when(F.size("es") == 1, F.col("es")[0]["edition"]).alias("edition"), F.size("es").cast("long").alias("n"))


def backfilled(t: Tables) -> DataFrame:
    """Questions with their edition taken from their packets, and what stands against it: no_packet, several, conflict."""
    e = single_edition(t).withColumnRenamed("question_id", "id")
    stored = F.col("question_set_edition_id")
    problem = F.when(F.col("n").isNull(), "no_packet").when(F.col("n") > 1, "several").when(stored.isNotNull() & ~stored.eqNullSafe(F.col("edition")), "conflict")
    return t["question"].select("id", "question_set_edition_id").join(e, "id", "left").select("id", F.coalesce(stored, "edition").alias("question_set_edition_id"), problem.alias("problem"))
