"""The queries of the training-data problems; the SQL that exists is for small exact cases and is in the tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quizlake.llm import abuse, canonical, leakage, names, neardup, packing, sentences
from quizlake.session import table


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical.map_questions(table(spark, sf_dir, "question"), table(spark, sf_dir, "category_ref"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentences.spans(table(spark, sf_dir, "tossup"), "id", "question").withColumnRenamed("id", "tossup_id")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.pairs(table(spark, sf_dir, "tossup"), "id", "question").select(F.col("a").alias("tossup_id_a"), F.col("b").alias("tossup_id_b"))


def p3_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per text: its class of equal texts and the number of other classes it is linked to."""
    found, members = neardup.class_pairs(table(spark, sf_dir, "tossup"), "id", "question")
    ends = found.select(F.explode(F.array("a", "b")).alias("rep")).groupBy("rep").agg(F.count(F.lit(1)).alias("n_links"))
    return members.join(ends, "rep", "left").select(F.col("id").alias("tossup_id"), F.col("rep").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    teams, players = names.entities(table(spark, sf_dir, "team"), table(spark, sf_dir, "player"))
    return names.pairs(teams).select(F.lit("team").alias("table_name"), "id_a", "id_b").unionByName(names.pairs(players).select(F.lit("player").alias("table_name"), "id_a", "id_b"))


def p4_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every linked row with its entity and the number of spellings of that entity."""
    teams, players = names.entities(table(spark, sf_dir, "team"), table(spark, sf_dir, "player"))
    rows = teams.select(F.lit("team").alias("table_name"), "id", "name", "entity").unionByName(players.select(F.lit("player").alias("table_name"), "id", "name", "entity"))
    sizes = rows.groupBy("table_name", "entity").agg(F.count_distinct("name").alias("n_spellings"))
    return rows.join(sizes, ["table_name", "entity"]).select("table_name", "id", "entity", "n_spellings")


def p7_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.containers(table(spark, sf_dir, "documents"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leakage.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_item"))


def p8_leaked_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per item: in how many documents it leaked, and in how many sources."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return p8_found(spark, sf_dir).join(docs, "doc_id").groupBy("item_id").agg(F.count_distinct("doc_id").alias("n_docs"), F.count_distinct("source").alias("n_sources"))


def _scored(spark: SparkSession, sf_dir: str, columns: list[str]) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return abuse.scores(docs, abuse.fit(abuse.labelled(docs, table(spark, sf_dir, "doc_label"))), columns)


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir, ["doc_id"]).where(F.col("score") >= abuse.THRESHOLD).select("doc_id").distinct()


def p9_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per source: documents, those found abusive, and their share."""
    bad = F.count_if(F.col("score") >= abuse.THRESHOLD)
    return _scored(spark, sf_dir, ["source"]).groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), bad.alias("n_abusive"), (bad / F.count(F.lit(1))).alias("rate"))


QUERIES = {"p1_found": p1_found, "p2_found": p2_found, "p3_found": p3_found, "p3_links": p3_links, "p4_found": p4_found, "p4_entities": p4_entities, "p7_containers": p7_containers, "p8_found": p8_found, "p8_leaked_items": p8_leaked_items, "p9_found": p9_found, "p9_rates": p9_rates}
SQL: dict[str, str] = {}
