"""The modelled tables over a data directory. Parents that are not delivered are derived from the keys that refer to them; one
round in 29 is put into another tournament than its teams', so that the rule on games has something to find."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quizlake.session import table

DELIVERED = ("question", "tossup", "packet_question", "tournament", "team", "player", "game", "buzz")


def tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    t = {n: table(spark, sf_dir, n) for n in DELIVERED}
    editions = t["question"].select(F.col("question_set_edition_id").alias("id")).union(t["tournament"].select("question_set_edition_id")).where("id is not null").distinct()
    day = F.date_add(F.lit("2018-01-01").cast("date"), (F.col("id") * 37 % 2000).cast("int"))
    t["question_set_edition"] = editions.select("id", (F.col("id") % 7).alias("question_set_id"), F.concat(F.lit("Edition "), "id").alias("name"), F.concat(F.lit("ed-"), "id").alias("slug"), day.alias("date"))
    sets = editions.select((F.col("id") % 7).alias("id")).distinct()
    t["question_set"] = sets.select("id", F.concat(F.lit("Set "), "id").alias("name"), F.concat(F.lit("set-"), "id").alias("slug"), F.when(F.col("id") % 3 == 0, "easy (level 1)").when(F.col("id") % 3 == 1, "regular").otherwise("").alias("difficulty"))
    pq = t["packet_question"].where("packet_id is not null").select("packet_id", "question_id").join(t["question"].select(F.col("id").alias("question_id"), "question_set_edition_id"), "question_id", "left")
    t["packet"] = pq.groupBy(F.col("packet_id").alias("id")).agg(F.min("question_set_edition_id").alias("question_set_edition_id")).select("id", "question_set_edition_id", F.concat(F.lit("Packet "), "id").alias("name"))
    held = t["game"].where("round_id is not null").select("round_id", "team_one_id").join(t["team"].select(F.col("id").alias("team_one_id"), "tournament_id"), "team_one_id", "left")
    rounds = held.groupBy(F.col("round_id").alias("id")).agg(F.min("tournament_id").alias("tournament_id"))
    firsts = t["packet"].groupBy((F.col("id") % 97).alias("k")).agg(F.min("id").alias("packet_id"))
    t["round"] = (
        rounds.join(firsts, F.col("id") % 97 == F.col("k"), "left")
        .select("id", F.when(F.col("id") % 29 == 0, F.col("tournament_id") + 1).otherwise(F.col("tournament_id")).alias("tournament_id"), (F.col("id") % 20 + 1).cast("int").alias("number"), F.when(F.col("id") % 23 != 0, F.col("packet_id")).alias("packet_id"), (F.col("id") % 10 == 0).alias("exclude_from_individual"))
    )
    t["bonus"] = t["tossup"].select("id", "question_id", F.col("answer").alias("leadin"), F.col("answer_sanitized").alias("leadin_sanitized"))
    part = F.explode(F.array(F.lit(1), F.lit(2), F.lit(3)))
    text = F.concat("answer_primary", F.lit(" "), F.col("part_number").cast("string"))
    t["bonus_part"] = t["tossup"].select("id", "answer", "answer_sanitized", "answer_primary", part.alias("part_number")).select(
        (F.col("id") * 3 + F.col("part_number")).alias("id"), "part_number", F.col("id").alias("bonus_id"), text.alias("part"), text.alias("part_sanitized"), "answer", "answer_sanitized", "answer_primary", F.lit(10).alias("value"),
        F.substring(F.lit("emh"), F.col("part_number"), F.lit(1)).alias("difficulty_modifier"),
    )
    return t


#: the same derivations for the SQL side
SQL = """
question_set_edition AS (SELECT id, id % 7 AS question_set_id, 'Edition ' || id AS name, 'ed-' || id AS slug, DATE '2018-01-01' + CAST(id * 37 % 2000 AS INTEGER) AS date
  FROM (SELECT question_set_edition_id AS id FROM question UNION SELECT question_set_edition_id FROM tournament) WHERE id IS NOT NULL),
question_set AS (SELECT DISTINCT id % 7 AS id, 'Set ' || (id % 7) AS name, 'set-' || (id % 7) AS slug,
  CASE (id % 7) % 3 WHEN 0 THEN 'easy (level 1)' WHEN 1 THEN 'regular' ELSE '' END AS difficulty FROM question_set_edition),
packet AS (SELECT packet_id AS id, min(q.question_set_edition_id) AS question_set_edition_id, 'Packet ' || packet_id AS name
  FROM packet_question pq LEFT JOIN question q ON q.id = pq.question_id WHERE packet_id IS NOT NULL GROUP BY packet_id),
round AS (SELECT r.id, CASE WHEN r.id % 29 = 0 THEN r.tournament_id + 1 ELSE r.tournament_id END AS tournament_id, CAST(r.id % 20 + 1 AS INTEGER) AS number, CASE WHEN r.id % 23 <> 0 THEN f.packet_id END AS packet_id, r.id % 10 = 0 AS exclude_from_individual
  FROM (SELECT round_id AS id, min(t.tournament_id) AS tournament_id FROM game g LEFT JOIN team t ON t.id = g.team_one_id WHERE round_id IS NOT NULL GROUP BY round_id) r
  LEFT JOIN (SELECT id % 97 AS k, min(id) AS packet_id FROM packet GROUP BY 1) f ON r.id % 97 = f.k),
bonus AS (SELECT id, question_id, answer AS leadin, answer_sanitized AS leadin_sanitized FROM tossup),
bonus_part AS (SELECT t.id * 3 + n AS id, n AS part_number, t.id AS bonus_id, answer_primary || ' ' || n AS part, answer_primary || ' ' || n AS part_sanitized, answer, answer_sanitized, answer_primary,
  10 AS value, substr('emh', n, 1) AS difficulty_modifier FROM tossup t, (SELECT unnest([1, 2, 3])::INTEGER AS n))
"""
