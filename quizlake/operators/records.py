"""Nested export, clues as rows, and the numbers behind the charts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quizlake.functions import segment, text


def described(t: Mapping[str, DataFrame], prefix: str = "quiz") -> DataFrame:
    """One nested record per tossup, without clue spans. Categories are slugs, the answer is the sanitised one."""
    s = t["question_set"].select(F.col("id").alias("set_id"), F.col("slug").alias("set_slug"), "difficulty")
    e = t["question_set_edition"].select(F.col("id").alias("edition_id"), F.col("question_set_id").alias("set_id")).join(s, "set_id")
    q = t["question"].select(F.col("id").alias("question_id"), "category_slug", "subcategory_slug", "category_main_slug", "category_full", F.col("question_set_edition_id").alias("edition_id")).join(e, "edition_id", "left")
    u = t["tossup"].select("id", "question_id", text.sanitize(F.col("question")).alias("question"), "answer_sanitized", "answer_primary").join(q, "question_id")
    meta = F.struct(
        F.col("category_slug").alias("category"), F.array("subcategory_slug").alias("subcategory"), F.col("category_main_slug").alias("category_main"), "category_full",
        text.first_token(F.col("difficulty")).alias("difficulty"), F.col("set_slug").alias("question_set"),
    )
    return u.select(F.concat(F.lit(f"{prefix}-"), F.col("id").cast("string")).alias("qid"), "question", F.col("answer_sanitized").alias("answer"), "answer_primary", meta.alias("metadata"))


def clue_records(t: Mapping[str, DataFrame], prefix: str = "quiz", scheme: str = "best") -> DataFrame:
    """The records with their clue spans."""
    return described(t, prefix).select("qid", "question", "answer", "answer_primary", segment.clue_spans(F.col("question"), scheme).alias("clue_spans"), "metadata")


def clues(rows: DataFrame, key: str = "id") -> DataFrame:
    """key, clue_no (from 0), clue, n_words. rows: key, question, spans."""
    each = rows.select(key, F.posexplode(text.apply_spans(F.col("question"), F.col("spans"))).alias("clue_no", "clue"))
    return each.select(key, "clue_no", text.strip(F.col("clue")).alias("clue")).withColumn("n_words", text.token_count(F.col("clue")))


def histogram(df: DataFrame, value: Column, bins: int, by: str | None = None) -> DataFrame:
    """bin, low, n (for each value of ``by``): equal widths from least to greatest value, the last bin closed. Empty bins are left out."""
    groups = [by] if by else []
    v = df.select(*groups, value.cast("double").alias("x")).where("x is not null")
    ends = v.groupBy(*groups).agg(F.min("x").alias("least"), F.max("x").alias("most"))  # a row per value of ``by``
    width = (F.col("most") - F.col("least")) / bins
    k = F.when(width == 0, F.lit(0)).otherwise(F.least(F.floor((F.col("x") - F.col("least")) / F.when(width > 0, width)), F.lit(bins - 1))).cast("int")
    return v.join(F.broadcast(ends), groups or F.lit(True)).groupBy(*groups, k.alias("bin"), (F.col("least") + k * width).alias("low")).agg(F.count(F.lit(1)).alias("n"))


def dense_frequencies(df: DataFrame, value: Column, by: str | None = None) -> DataFrame:
    """value, n (for each value of ``by``) for every integer between the least and the greatest value of all, zeros included."""
    groups = [by] if by else []
    n = df.select(*groups, value.cast("int").alias("value")).where("value is not null").groupBy(*groups, "value").agg(F.count(F.lit(1)).alias("n"))
    span = n.agg(F.min("value").alias("a"), F.max("value").alias("b")).where("a is not null").select(F.explode(F.sequence("a", "b")).alias("value"))
    if by:
        span = n.select(by).distinct().join(span, F.lit(True))  # a few values of ``by`` with the range's integers
    return span.join(n, [*groups, "value"], "left").select(*groups, "value", F.coalesce("n", F.lit(0)).alias("n"))


def only_in_first(a: Column, b: Column) -> Column:
    """Elements of a that b lacks, in the order of a."""
    return F.filter(a, lambda x: ~F.array_contains(b, x))


def bars(counts: DataFrame, width: int = 20) -> DataFrame:
    """value, n, bar: the count as a share of the greatest count."""
    top = counts.agg(F.max("n").alias("top"))  # one row
    filled = F.floor(F.col("n") * width / F.col("top")).cast("int")
    return counts.join(F.broadcast(top), F.lit(True)).select("value", "n", F.concat(F.repeat(F.lit("█"), filled), F.repeat(F.lit("▒"), F.lit(width) - filled)).alias("bar"))
