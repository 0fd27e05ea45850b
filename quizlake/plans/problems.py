"""The queries of the general data problems (orphan references, differing copies) and their SQL."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quizlake.operators import orphans, reconcile
from quizlake.session import cut, table

TABLES_5 = ("buzz", "packet_question", "tossup", "player", "game", "question")


def _replayed(spark: SparkSession, sf_dir: str, log: bool = False) -> orphans.OrphanState:
    """The tables as a first load and the increment of the last year."""
    tables = {t: table(spark, sf_dir, t) for t in TABLES_5}
    last = tables["buzz"].agg(F.date_trunc("year", F.max("recorded_at")).cast("timestamp_ntz").alias("t")).first()["t"]
    return orphans.replay(tables, [last] if last is not None else [], log=table(spark, sf_dir, "deleted_row") if log else None)


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orphans.cases(_replayed(spark, sf_dir))


def p5_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts by table, field and month as things stand after all deletions."""
    return orphans.snapshot(_replayed(spark, sf_dir, log=True))


def p5_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts after each year's batch of references, arrivals and deletions; the last year's takes all later rows, too."""
    tables = {t: table(spark, sf_dir, t) for t in TABLES_5}
    ends = orphans.references(tables).agg(F.year(F.min("recorded_at")).alias("lo"), F.year(F.max("recorded_at")).alias("hi")).first()
    years = [] if ends["lo"] is None else list(range(ends["lo"], ends["hi"] + 1))
    out = None
    for k, state in enumerate(orphans.states(tables, [dt.datetime(y, 1, 1) for y in years[1:]], log=table(spark, sf_dir, "deleted_row"))):
        one = cut(orphans.snapshot(state).select(F.lit(years[k] if years else None).cast("int").alias("year"), "*"))
        out = one if out is None else out.unionByName(one)
    return out


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.reconcile({t: (table(spark, sf_dir, t), table(spark, sf_dir, f"{t}_copy")) for t in ("question", "team", "player")})


QUERIES = {"p5_found": p5_found, "p5_counts": p5_counts, "p5_snapshots": p5_snapshots, "p6_found": p6_found}

_REFS = """
refs AS (
  SELECT 'buzz' AS table_name, 'tossup_id' AS field_name, id AS row_id, 'tossup' AS parent_table, tossup_id AS k, recorded_at FROM buzz
  UNION ALL SELECT 'buzz', 'player_id', id, 'player', player_id, recorded_at FROM buzz
  UNION ALL SELECT 'buzz', 'game_id', id, 'game', game_id, recorded_at FROM buzz
  UNION ALL SELECT 'packet_question', 'question_id', id, 'question', question_id, recorded_at FROM packet_question),
parents AS (
  SELECT 'tossup' AS parent_table, id, loaded_at FROM tossup UNION ALL SELECT 'player', id, loaded_at FROM player
  UNION ALL SELECT 'game', id, loaded_at FROM game UNION ALL SELECT 'question', id, loaded_at FROM question),
found AS (
  SELECT r.table_name, r.field_name, r.row_id, coalesce(strftime(r.recorded_at, '%Y-%m'), 'unknown') AS period, p.id IS NULL AS missing
  FROM refs r LEFT JOIN parents p ON p.parent_table = r.parent_table AND p.id = r.k
  WHERE r.k IS NOT NULL AND (p.id IS NULL OR p.loaded_at > r.recorded_at))
"""


_STATES = """
span AS (SELECT min(year(recorded_at)) AS lo, max(year(recorded_at)) AS hi FROM refs WHERE k IS NOT NULL),
ends AS (SELECT y::INT AS year, CASE WHEN y < hi THEN make_timestamp(y + 1, 1, 1, 0, 0, 0) END AS upto FROM (SELECT unnest(range(lo, hi + 1)) AS y, hi FROM span)),
gone AS (
  SELECT table_name AS parent_table, row_id AS k, max(deleted_at) AS deleted_at FROM deleted_row d
  WHERE NOT EXISTS (SELECT 1 FROM parents p WHERE p.parent_table = d.table_name AND p.id = d.row_id) GROUP BY 1, 2),
states AS (
  SELECT e.year, r.table_name, r.field_name, coalesce(strftime(r.recorded_at, '%Y-%m'), 'unknown') AS period,
    CASE WHEN p.loaded_at >= e.upto THEN 'missing' WHEN p.loaded_at > r.recorded_at THEN 'late' WHEN p.id IS NOT NULL THEN NULL
      WHEN g.k IS NULL OR r.recorded_at > g.deleted_at THEN 'missing' WHEN e.upto IS NULL OR g.deleted_at < e.upto THEN 'deleted' END AS reason
  FROM refs r JOIN ends e ON r.recorded_at IS NULL OR e.upto IS NULL OR r.recorded_at < e.upto
  LEFT JOIN parents p ON p.parent_table = r.parent_table AND p.id = r.k LEFT JOIN gone g ON g.parent_table = r.parent_table AND g.k = r.k
  WHERE r.k IS NOT NULL)
"""


_COUNTED = "count(*) FILTER (reason <> 'deleted') AS n_cases, count(*) FILTER (reason = 'missing') AS n_open, count(*) FILTER (reason = 'late') AS n_late, count(*) FILTER (reason = 'deleted') AS n_reopened"


def _compared(name: str, fields: list[str]) -> str:
    last = f"SELECT DISTINCT ON (id) * FROM {name}_copy ORDER BY id, synced_at DESC"
    return " UNION ALL ".join(
        [
            f"SELECT '{name}' AS table_name, id AS row_id, 'only_in_main' AS field_name FROM {name} WHERE id NOT IN (SELECT id FROM {name}_copy)",
            f"SELECT '{name}', id, 'only_in_copy' FROM (SELECT DISTINCT id FROM {name}_copy) WHERE id NOT IN (SELECT id FROM {name})",
            *(f"SELECT '{name}', m.id, '{f}' FROM {name} m JOIN ({last}) c ON c.id = m.id WHERE m.{f} IS DISTINCT FROM c.{f}" for f in fields),
        ]
    )


SQL = {
    "p5_found": f"WITH {_REFS} SELECT DISTINCT table_name, field_name, row_id, period FROM found",
    "p5_counts": f"WITH {_REFS}, {_STATES} SELECT table_name, field_name, period, {_COUNTED} FROM states WHERE reason IS NOT NULL AND year = (SELECT hi FROM span) GROUP BY 1, 2, 3",
    "p5_snapshots": f"WITH {_REFS}, {_STATES} SELECT year, table_name, field_name, period, {_COUNTED} FROM states WHERE reason IS NOT NULL GROUP BY 1, 2, 3, 4",
    "p6_found": " UNION ALL ".join(
        [
            _compared("question", "slug metadata author editor category category_slug subcategory subcategory_slug subsubcategory category_main category_main_slug category_full question_set_edition_id".split()),
            _compared("team", ["tournament_id", "name", "slug"]),
            _compared("player", ["team_id", "name", "slug"]),
        ]
    ),
}
