"""The tables: columns, primary key, unique key and foreign keys. Spark enforces none of them; the validators and the merge use them."""

from __future__ import annotations

import graphlib
from dataclasses import dataclass, field

from pyspark.sql.types import StructType


@dataclass(frozen=True)
class Table:
    """unique: the natural key (empty: all columns but the id). fks: column -> parent table."""

    columns: str
    unique: tuple[str, ...] = ()
    fks: dict[str, str] = field(default_factory=dict)
    pk: str = "id"

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(self.columns)

    @property
    def names(self) -> list[str]:
        return [c.split()[0] for c in self.columns.split(", ")]

    @property
    def natural_key(self) -> list[str]:
        return list(self.unique) or [c for c in self.names if c != self.pk]


TABLES = {
    "question_set": Table("id bigint, name string, slug string, difficulty string", ("slug",)),
    "question_set_edition": Table("id bigint, question_set_id bigint, name string, slug string, date date", ("question_set_id", "slug"), {"question_set_id": "question_set"}),
    "packet": Table("id bigint, question_set_edition_id bigint, name string", ("name",), {"question_set_edition_id": "question_set_edition"}),
    "packet_question": Table("id bigint, packet_id bigint, question_number int, question_id bigint", ("packet_id", "question_id"), {"packet_id": "packet", "question_id": "question"}),
    "question": Table(
        "id bigint, slug string, metadata string, author string, editor string, category string, category_slug string, subcategory string, subcategory_slug string, "
        "subsubcategory string, category_main string, category_main_slug string, category_full string, question_set_edition_id bigint",
        ("slug", "author", "editor", "metadata", "question_set_edition_id"),
        {"question_set_edition_id": "question_set_edition"},
    ),
    "tossup": Table("id bigint, question_id bigint, question string, answer string, answer_sanitized string, answer_primary string", ("question_id", "question"), {"question_id": "question"}),
    "tournament": Table("id bigint, name string, slug string, question_set_edition_id bigint, location string, level string, start_date date, end_date date", ("slug",), {"question_set_edition_id": "question_set_edition"}),
    "round": Table("id bigint, tournament_id bigint, number int, packet_id bigint, exclude_from_individual boolean", (), {"tournament_id": "tournament", "packet_id": "packet"}),
    "team": Table("id bigint, tournament_id bigint, name string, slug string", ("tournament_id", "slug"), {"tournament_id": "tournament"}),
    "player": Table("id bigint, team_id bigint, name string, slug string", ("team_id", "slug"), {"team_id": "team"}),
    "game": Table("id bigint, round_id bigint, tossups_read int, team_one_id bigint, team_two_id bigint", (), {"round_id": "round", "team_one_id": "team", "team_two_id": "team"}),
    "buzz": Table(
        "id bigint, player_id bigint, game_id bigint, tossup_id bigint, buzz_position int, value int",
        ("player_id", "game_id", "tossup_id", "buzz_position"),
        {"player_id": "player", "game_id": "game", "tossup_id": "tossup"},
    ),
}
#: documented tables that the merge and the rules leave alone
DOCUMENTED = {
    "bonus": Table("id bigint, question_id bigint, leadin string, leadin_sanitized string", (), {"question_id": "question"}),
    "bonus_part": Table("id bigint, part_number int, bonus_id bigint, part string, part_sanitized string, answer string, answer_sanitized string, answer_primary string, value int, difficulty_modifier string", (), {"bonus_id": "bonus"}),
    "bonus_hash": Table("hash string, question_id bigint, bonus_id bigint", (), {"bonus_id": "bonus"}, "hash"),
    "tossup_hash": Table("hash string, question_id bigint, tossup_id bigint", (), {"tossup_id": "tossup"}, "hash"),
    "bonus_part_direct": Table("id bigint, team_id bigint, game_id bigint, bonus_part_id bigint, value int", (), {"team_id": "team", "game_id": "game", "bonus_part_id": "bonus_part"}),
}


def dependents(tables: dict[str, Table] = TABLES) -> dict[str, set[str]]:
    """Parent -> tables that refer to it."""
    out: dict[str, set[str]] = {t: set() for t in tables}
    for t, spec in tables.items():
        for parent in spec.fks.values():
            out[parent].add(t)
    return out


def levels(tables: dict[str, Table] = TABLES) -> list[list[str]]:
    """Tables by topological level, alphabetical within one; a cycle is a ValueError."""
    sorter = graphlib.TopologicalSorter({t: set(spec.fks.values()) for t, spec in tables.items()})
    try:
        sorter.prepare()
    except graphlib.CycleError as e:
        raise ValueError(f"the foreign keys form a cycle: {e.args[1]}") from e
    out = []
    while sorter.is_active():
        ready = sorted(sorter.get_ready())
        out.append(ready)
        sorter.done(*ready)
    return out
