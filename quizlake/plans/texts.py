"""Queries of the sanitiser, the buzz positions and the clue spans, with their SQL where it can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quizlake.functions import segment, text
from quizlake.operators import dedup, records, views
from quizlake.plans import domain
from quizlake.plans.relational import _BUZZ
from quizlake.session import cut, spread, table


def _tossups(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "tossup").select("id", "question_id", "question")


def _step(f: Callable[[Column], Column]):
    return lambda spark, sf: _tossups(spark, sf).select("id", f(F.col("question")).alias("clean"))


def sanitize_instruction(spark: SparkSession, sf: str) -> DataFrame:
    return _tossups(spark, sf).select("id", text.instruction(F.col("question")).alias("r")).select("id", "r.text", "r.instruction")


def _positions(spark: SparkSession, sf: str) -> DataFrame:
    """Each tossup's tokens once, joined to the buzzes."""
    words = text.tokens(text.sanitize(F.col("question")))
    t = _tossups(spark, sf).where("question is not null").select(F.col("id").alias("tossup_id"), words.alias("words"), text.buzz_offset(F.col("question")).alias("offset"))
    b = table(spark, sf, "buzz").where("buzz_position is not null").select("id", "tossup_id", "buzz_position")
    return b.join(t, "tossup_id").withColumn("position", text.aligned(F.col("buzz_position"), F.col("offset")))


def aligned_positions(spark: SparkSession, sf: str) -> DataFrame:
    return _positions(spark, sf).select("id", "position", text.char_index(F.col("words"), F.col("position")).alias("char_index"))


def _offsets(spark: SparkSession, sf: str) -> DataFrame:
    """Words of each text, and of its instruction."""
    return _tossups(spark, sf).where("question is not null").select(F.col("id").alias("tossup_id"), text.token_count(text.sanitize(F.col("question"))).alias("n_words"), text.buzz_offset(F.col("question")).alias("offset"))


def _differences(spark: SparkSession, sf: str) -> DataFrame:
    """tossup_id, last, n_words, d: the last aligned position of each buzzed tossup, and how many words come after it."""
    last = views.buzz_info(domain.tables(spark, sf)).groupBy("tossup_id").agg(F.max("buzz_position").alias("last"))
    both = last.join(_offsets(spark, sf), "tossup_id").select("tossup_id", text.aligned(F.col("last"), F.col("offset")).alias("last"), "n_words")
    return both.withColumn("d", F.col("n_words") - F.col("last"))


def position_match_report(spark: SparkSession, sf: str) -> DataFrame:
    """Last aligned positions against the words: counts and percentages by class, and the median of the large differences."""
    d = cut(_differences(spark, sf).select("d", text.position_class(F.col("d")).alias("class")))
    total = d.agg(F.count(F.lit(1)).alias("total"), F.median(F.when(F.col("class") == "large", F.col("d"))).cast("double").alias("median_large"))  # one row
    n = d.groupBy("class").agg(F.count(F.lit(1)).alias("n"))
    return n.join(F.broadcast(total), F.lit(True)).select("class", "n", (F.lit(100).cast("double") * F.col("n") / F.col("total")).alias("percent"), "median_large")


def bucket_hist(spark: SparkSession, sf: str) -> DataFrame:
    """Tossups by fives of the distance between words and last position."""
    return _differences(spark, sf).groupBy(F.floor(F.abs("d") / 5).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def sample_bucket(spark: SparkSession, sf: str) -> DataFrame:
    """Ten tossups of the 22nd five, drawn by a seeded hash."""
    d = _differences(spark, sf).where(F.floor(F.abs("d") / 5) == 22)
    return d.select("tossup_id", "last", "n_words").orderBy(F.md5(F.concat(F.lit("0:"), F.col("tossup_id").cast("string"))), "tossup_id").limit(10)


def multi_buzz_groups(spark: SparkSession, sf: str) -> DataFrame:
    """(player, tossup) and (team, tossup) groups with several buzzes in order of aligned position, repeats at one position left out."""
    b = views.buzz_info(domain.tables(spark, sf)).select("id", "player_id", "tossup_id", "team", "value", "buzz_position").join(_offsets(spark, sf), "tossup_id")
    b = b.withColumn("buzz_position", text.aligned(F.col("buzz_position"), F.col("offset"))).drop("offset", "n_words")
    b = cut(dedup.keep_first(b, ["player_id", "tossup_id", "buzz_position"]))
    item = F.struct("buzz_position", "id", "player_id", "value")
    show = F.array_join(F.transform("items", lambda x: F.concat_ws(":", x["buzz_position"].cast("string"), x["id"].cast("string"), x["player_id"].cast("string"), x["value"].cast("string"))), ",")
    one = dedup.group_lists(b, ["player_id", "tossup_id"], item).select(F.lit("player").alias("kind"), F.col("player_id").cast("string").alias("who"), "tossup_id", "n", show.alias("buzzes"))
    two = dedup.group_lists(b, ["team", "tossup_id"], item).select(F.lit("team").alias("kind"), F.col("team").alias("who"), "tossup_id", "n", show.alias("buzzes"))
    return one.unionByName(two)


def prefix_predicates(spark: SparkSession, sf: str) -> DataFrame:
    """Texts that start with an instruction before and after they are sanitised."""
    q = F.col("question")
    return _tossups(spark, sf).agg(F.count(F.lit(1)).alias("n"), F.count_if(q.startswith("<em>")).alias("n_raw"), F.count_if(text.sanitize(q).startswith("<em>")).alias("n_led"))


def open_quotes(spark: SparkSession, sf: str) -> DataFrame:
    """Texts with an open quotation: its sign, and whether both kinds are open."""
    return _tossups(spark, sf).select("id", text.open_quotes(text.sanitize(F.col("question"))).alias("r")).select("id", "r.*").where("quote is not null")


def token_html(spark: SparkSession, sf: str) -> DataFrame:
    return _tossups(spark, sf).select("id", text.token_html(text.tokens(text.sanitize(F.col("question")))).alias("html"))


def _spans(spark: SparkSession, sf: str, f: Callable[[Column], Column]) -> DataFrame:
    """One row per text, spans as start-end pairs."""
    q = spread(_tossups(spark, sf)).where("question is not null").select("id", text.sanitize(F.col("question")).alias("question"))
    return q.withColumn("spans", f(F.col("question")))


def _shown(df: DataFrame) -> DataFrame:
    return df.select("id", F.array_join(F.transform("spans", lambda s: F.concat_ws("-", s["start"].cast("string"), s["end"].cast("string"))), " ").alias("spans"))


def semicolon_spans(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(_spans(spark, sf, segment.spans_udf(segment.semicolon_spans)))


def case_merge(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(_spans(spark, sf, segment.spans_udf(lambda t: segment.merge_short(t, segment.rule_split(t)))))


def quote_merge(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(_spans(spark, sf, segment.spans_udf(lambda t: segment.merge_quotes(t, segment.rule_split(t))[0])))


def unclosed_quotes(spark: SparkSession, sf: str) -> DataFrame:
    """Texts with balanced quotation marks over whose spans one stays open."""
    q = spread(_tossups(spark, sf)).where("question is not null").select("id", text.sanitize(F.col("question")).alias("question"))
    return q.where(segment.unclosed_flag(F.col("question"))).select("id")


def clue_spans(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(_spans(spark, sf, segment.clue_spans))


def supplied_spans(spark: SparkSession, sf: str) -> DataFrame:
    """The scheme of spans that come with the texts (here two halves): they are taken as they are."""
    q = _tossups(spark, sf).select("id", text.sanitize(F.col("question")).alias("question")).where(text.token_count(F.col("question")) > 0)
    length = F.length("question")
    whole = F.array(F.struct(F.lit(0).alias("start"), F.floor(length / 2).cast("int").alias("end")), F.struct(F.floor(length / 2).cast("int").alias("start"), length.alias("end")))
    return _shown(q.withColumn("spans", segment.clue_spans(F.col("question"), "supplied", whole)))


def record_metadata(spark: SparkSession, sf: str) -> DataFrame:
    """The nested records without their spans, laid flat."""
    r = records.described(domain.tables(spark, sf))
    return r.select("qid", "question", "answer", "answer_primary", "metadata.category", F.array_join("metadata.subcategory", "|", "None").alias("subcategory"), "metadata.category_main", "metadata.category_full", "metadata.difficulty", "metadata.question_set")


def clue_records(spark: SparkSession, sf: str) -> DataFrame:
    return records.clue_records(domain.tables(spark, sf))


def _clues(spark: SparkSession, sf: str) -> DataFrame:
    return records.clues(_spans(spark, sf, segment.clue_spans))


def _piped(spark: SparkSession, sf: str) -> DataFrame:
    """id, pipeline, question, spans of both pipelines."""
    q = spread(_tossups(spark, sf)).where("question is not null").select("id", text.sanitize(F.col("question")).alias("question"))
    both = q.select("id", "question", segment.clue_spans(F.col("question"), "rule").alias("a"), segment.clue_spans(F.col("question"), "untrained").alias("b"))
    each = F.array(F.struct(F.lit("rule").alias("pipeline"), F.col("a").alias("spans")), F.struct(F.lit("untrained").alias("pipeline"), F.col("b").alias("spans")))
    return both.select("id", "question", F.explode(each).alias("r")).select("id", "question", "r.*")


def _piped_words(spark: SparkSession, sf: str) -> DataFrame:
    clue = F.explode(text.apply_spans(F.col("question"), F.col("spans")))
    return cut(_piped(spark, sf).select("pipeline", clue.alias("clue")).select("pipeline", text.token_count(F.col("clue")).alias("n_words")))


def clue_hist(spark: SparkSession, sf: str) -> DataFrame:
    """Words per clue."""
    return records.histogram(cut(_clues(spark, sf).select("n_words")), F.col("n_words"), 49)


def clue_frequencies(spark: SparkSession, sf: str) -> DataFrame:
    """Clues per tossup, over the chosen spans and over either pipeline's."""
    best = _spans(spark, sf, segment.clue_spans).select(F.lit("best").alias("pipeline"), F.size("spans").alias("n_clues"))
    rows = cut(best.unionByName(_piped(spark, sf).select("pipeline", F.size("spans").alias("n_clues"))))
    return records.dense_frequencies(rows, F.col("n_clues"), "pipeline")


def clue_length_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Mean and median of the words per clue, by pipeline."""
    return _piped_words(spark, sf).groupBy("pipeline").agg(F.count(F.lit(1)).alias("n"), F.avg("n_words").alias("mean"), F.median("n_words").cast("double").alias("median"))


def longest_clues(spark: SparkSession, sf: str) -> DataFrame:
    """The first twenty by falling word count, in order of text and clue among equals."""
    return _clues(spark, sf).orderBy(F.desc("n_words"), "id", "clue_no").limit(20)


def shortest_clues(spark: SparkSession, sf: str) -> DataFrame:
    """The last twenty of the same order, still falling."""
    last = _clues(spark, sf).orderBy("n_words", F.desc("id"), F.desc("clue_no")).limit(20)
    return last.orderBy(F.desc("n_words"), "id", "clue_no")


def longest_clue_texts(spark: SparkSession, sf: str) -> DataFrame:
    """The ten clues of the rule pipeline with the most characters."""
    rows = records.clues(_spans(spark, sf, lambda q: segment.clue_spans(q, "rule")))
    return rows.select("id", "clue_no", "clue", F.length("clue").alias("n_chars")).orderBy(F.desc("n_chars"), "id", "clue_no").limit(10)


def tokenizer_diff(spark: SparkSession, sf: str) -> DataFrame:
    """Texts whose two pipelines disagree: how many spans each has, and the clues of one that the other lacks."""
    both = _spans(spark, sf, lambda q: segment.clue_spans(q, "rule")).withColumn("other", segment.clue_spans(F.col("question"), "untrained")).where(~F.col("spans").eqNullSafe(F.col("other")))
    one, two = text.apply_spans(F.col("question"), F.col("spans")), text.apply_spans(F.col("question"), F.col("other"))
    return both.select("id", F.size("spans").alias("n_rule"), F.size("other").alias("n_untrained"), F.size(records.only_in_first(one, two)).alias("only_rule"), F.size(records.only_in_first(two, one)).alias("only_untrained"))


def span_count_differences(spark: SparkSession, sf: str) -> DataFrame:
    d = F.abs(F.col("n_rule") - F.col("n_untrained"))
    return tokenizer_diff(spark, sf).select("id", d.alias("difference")).orderBy("difference", "id").limit(10)


def word_hist(spark: SparkSession, sf: str) -> DataFrame:
    """Words per clue in fifty bins, by pipeline."""
    return records.histogram(_piped_words(spark, sf), F.col("n_words"), 50, "pipeline")


def text_hist(spark: SparkSession, sf: str) -> DataFrame:
    """Characters per text in fifty bins."""
    return records.histogram(_tossups(spark, sf).select(F.length("question").alias("n")), F.col("n"), 50)


def text_lengths(spark: SparkSession, sf: str) -> DataFrame:
    n = text.token_count(text.sanitize(F.col("question")))
    return _tossups(spark, sf).where("question is not null").agg(F.sum(n).alias("n_words"), F.median(n).alias("median_words"), F.sum(F.length("question").cast("long")).alias("n_chars"))


QUERIES = {
    "sanitize_entities": _step(text.convert_entities), "sanitize_mod_notes": _step(text.remove_moderator_notes), "sanitize_tags": _step(text.remove_tags),
    "sanitize_guides": _step(text.remove_guides), "sanitize_power": _step(text.remove_power_mark), "sanitize": _step(text.sanitize),
    "token_count": lambda s, d: _tossups(s, d).select("id", text.token_count(text.sanitize(F.col("question"))).alias("n_words")),
    "buzz_offset": lambda s, d: _tossups(s, d).select("id", text.buzz_offset(F.col("question")).alias("n_words")),
} | {f.__name__: f for f in (
        sanitize_instruction, aligned_positions, position_match_report, bucket_hist, sample_bucket, multi_buzz_groups, prefix_predicates, open_quotes, token_html, semicolon_spans, case_merge, quote_merge, unclosed_quotes, clue_spans,
        supplied_spans, clue_records, record_metadata, clue_hist, clue_frequencies, clue_length_stats, longest_clues, shortest_clues, longest_clue_texts, tokenizer_diff, span_count_differences, word_hist, text_hist, text_lengths,
    )
}

_SPACES = r"\s\v\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


def _re2(pattern: str) -> str:
    """A pattern with Unicode white space for the SQL side."""
    return pattern.replace(r"[^\s)]", f"[^{_SPACES})]").replace(r"[\s\x1c-\x1f]", f"[{_SPACES}]").replace(r"\S", f"[^{_SPACES}]").replace(r"(\s", f"([{_SPACES}]").replace(r"]*\s*", f"]*[{_SPACES}]*").replace("'", "''") if not pattern.startswith(r"\s") else f"[{_SPACES}]" + _re2(pattern[2:])


def _gone(x: str, pattern: str, by: str = "") -> str:
    return f"regexp_replace({x}, '{_re2(pattern)}', '{by}', 'g')"


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^[{_SPACES}]+|[{_SPACES}]+$', '', 'g')"


def _entities(x: str) -> str:
    for a, b in text.ENTITIES:
        x = f"replace({x}, '{a}', '{b.replace(chr(39), chr(39) * 2)}')"
    return x


def _notes(x: str) -> str:
    return _gone(_gone(x, text.MODERATOR, r"\1"), text.TO_END)


def _guides(x: str) -> str:
    for p in text.GUIDES:
        x = _gone(x, p)
    return x


_LED = f"""led AS (SELECT id, q, CASE WHEN cut THEN {_strip("substr(q, start + 1)")} ELSE q END AS text, CASE WHEN starts_with(q, '<em>') THEN note WHEN q IS NOT NULL THEN '' END AS instruction FROM (
  SELECT *, starts_with(q, '<em>') AND (starts_with(note, 'Note to') OR ends_with(note, '.') OR dot) AS cut FROM (
  SELECT *, {_strip(_gone("substr(q, 1, start)", text.TAGS))} AS note FROM (
  SELECT id, q, s0 + CASE WHEN substr(q, s0 + 1, 1) = '.' THEN 1 ELSE 0 END AS start, substr(q, s0 + 1, 1) = '.' AS dot FROM (
  SELECT id, question AS q, CASE WHEN strpos(question, '</em>') > 0 THEN strpos(question, '</em>') + 4 ELSE 4 END AS s0 FROM tossup)))))"""
_CLEAN = f"clean AS (SELECT id, {_strip('replace(' + _guides(_gone(_notes(_entities('text')), text.TAGS)) + f", '{text.POWER}', '')")} AS clean, instruction FROM led)"
_WORDS = f"words AS (SELECT id, clean, list_filter(regexp_split_to_array(clean, '[{_SPACES}]+'), lambda x: x <> '') AS w, CAST(len(list_filter(regexp_split_to_array(instruction, '[{_SPACES}]+'), lambda x: x <> '')) AS INTEGER) AS off FROM clean)"
_ALL = f"WITH {_LED}, {_CLEAN}, {_WORDS} "
_DIFFERENCES = f"WITH {domain.SQL}, {_BUZZ}, {_ALL[5:]}, d AS (SELECT tossup_id, greatest(last - off, 0) AS last, CAST(len(w) AS INTEGER) AS n_words, CAST(len(w) AS INTEGER) - greatest(last - off, 0) AS d FROM (SELECT tossup_id, max(buzz_position) AS last FROM buzz_info GROUP BY 1) b JOIN words ON words.id = b.tossup_id WHERE clean IS NOT NULL)"
SQL = {
    "sanitize_entities": f"SELECT id, {_entities('question')} AS clean FROM tossup",
    "sanitize_mod_notes": f"SELECT id, {_notes('question')} AS clean FROM tossup",
    "sanitize_tags": f"SELECT id, {_gone('question', text.TAGS)} AS clean FROM tossup",
    "sanitize_guides": f"SELECT id, {_guides('question')} AS clean FROM tossup",
    "sanitize_power": f"SELECT id, replace(question, '{text.POWER}', '') AS clean FROM tossup",
    "sanitize_instruction": f"WITH {_LED} SELECT id, text, instruction FROM led",
    "sanitize": f"WITH {_LED}, {_CLEAN} SELECT id, clean FROM clean",
    "token_count": _ALL + "SELECT id, CAST(len(w) AS INTEGER) AS n_words FROM words",
    "buzz_offset": _ALL + "SELECT id, off AS n_words FROM words",
    "aligned_positions": _ALL + "SELECT b.id, greatest(b.buzz_position - off, 0) AS position, CAST(coalesce(list_sum(list_transform(w[1:greatest(b.buzz_position - off, 0) + 1], lambda x: length(x))), 0) AS INTEGER) + greatest(b.buzz_position - off, 0) AS char_index FROM buzz b JOIN words ON words.id = b.tossup_id WHERE b.buzz_position IS NOT NULL AND clean IS NOT NULL",
    "position_match_report": _DIFFERENCES
    + """ SELECT CASE WHEN d = 0 THEN 'exact' WHEN abs(d) <= 2 THEN 'within_2' WHEN abs(d) <= 5 THEN 'within_5' WHEN d < 0 THEN 'invalid' ELSE 'large' END AS class, count(*) AS n, CAST(100 AS DOUBLE) * count(*) / (SELECT count(*) FROM d) AS percent,
      (SELECT CAST(median(d) AS DOUBLE) FROM d WHERE d > 5) AS median_large FROM d GROUP BY 1""",
    "bucket_hist": _DIFFERENCES + " SELECT CAST(floor(abs(d) / 5) AS BIGINT) AS bucket, count(*) AS n FROM d GROUP BY 1",
    "sample_bucket": _DIFFERENCES + " SELECT tossup_id, last, n_words FROM d WHERE floor(abs(d) / 5) = 22 ORDER BY md5('0:' || tossup_id), tossup_id LIMIT 10",
    "multi_buzz_groups": f"WITH {domain.SQL}, {_BUZZ}, {_ALL[5:]}"
    + """, moved AS (SELECT i.id, player_id, tossup_id, team, value, greatest(buzz_position - off, 0) AS p FROM buzz_info i JOIN words ON words.id = i.tossup_id WHERE clean IS NOT NULL QUALIFY row_number() OVER (PARTITION BY player_id, tossup_id, p ORDER BY i.id) = 1)
      SELECT 'player' AS kind, CAST(player_id AS VARCHAR) AS who, tossup_id, count(*) AS n, string_agg(concat_ws(':', p, id, player_id, value), ',' ORDER BY p, id) AS buzzes FROM moved GROUP BY player_id, tossup_id HAVING count(*) > 1
      UNION ALL SELECT 'team', team, tossup_id, count(*), string_agg(concat_ws(':', p, id, player_id, value), ',' ORDER BY p, id) FROM moved GROUP BY team, tossup_id HAVING count(*) > 1""",
    "prefix_predicates": f"WITH {_LED}, {_CLEAN} SELECT count(*) AS n, (SELECT count(*) FROM tossup WHERE starts_with(question, '<em>')) AS n_raw, count(*) FILTER (starts_with(clean, '<em>')) AS n_led FROM clean",
    "open_quotes": f"""WITH {_LED}, {_CLEAN}, c AS (SELECT id, length(clean) - length(replace(clean, '"', '')) AS s, length(clean) - length(replace(clean, '“', '')) AS a, length(clean) - length(replace(clean, '”', '')) AS b FROM clean)
      SELECT id, CASE WHEN s % 2 = 1 THEN '"' ELSE '“' END AS quote, s % 2 = 1 AND a > b AS both FROM c WHERE s % 2 = 1 OR a > b""",
    "token_html": _ALL + """SELECT id, CASE WHEN clean IS NOT NULL THEN array_to_string(list_transform(w, lambda x, i: '<span class="token" title="' || (i - 1) || '">' || x || '</span>'), '') END AS html FROM words""",
    "supplied_spans": _ALL + "SELECT id, '0-' || length(clean) // 2 || ' ' || length(clean) // 2 || '-' || length(clean) AS spans FROM words WHERE len(w) > 0",
    "record_metadata": f"WITH {domain.SQL}, {_LED}, {_CLEAN}"
    + """ SELECT 'quiz-' || u.id AS qid, c.clean AS question, u.answer_sanitized AS answer, u.answer_primary, q.category_slug AS category, coalesce(q.subcategory_slug, 'None') AS subcategory, q.category_main_slug AS category_main, q.category_full,
      nullif(split_part(s.difficulty, ' ', 1), '') AS difficulty, s.slug AS question_set FROM tossup u JOIN clean c ON c.id = u.id JOIN question q ON q.id = u.question_id
      LEFT JOIN question_set_edition e ON e.id = q.question_set_edition_id LEFT JOIN question_set s ON s.id = e.question_set_id""",
    "text_hist": "WITH v AS (SELECT CAST(length(question) AS DOUBLE) AS x FROM tossup WHERE question IS NOT NULL), e AS (SELECT min(x) AS a, max(x) AS b FROM v) SELECT CAST(least(floor((x - a) / ((b - a) / 50)), 49) AS INTEGER) AS bin, a + CAST(least(floor((x - a) / ((b - a) / 50)), 49) AS INTEGER) * ((b - a) / 50) AS low, count(*) AS n FROM v, e GROUP BY 1, 2",
    "text_lengths": _ALL + "SELECT CAST(sum(len(w)) AS BIGINT) AS n_words, CAST(median(len(w)) AS DOUBLE) AS median_words, (SELECT CAST(sum(length(question)) AS BIGINT) FROM tossup) AS n_chars FROM words WHERE clean IS NOT NULL",
}
