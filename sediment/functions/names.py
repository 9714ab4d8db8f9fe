"""Plan-time rules over table and column names."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from fnmatch import fnmatchcase

from sediment.specs import FK_RULES, MAIN_TABLES, MIGRATED_NAMES, UNMERGED_NAME_PARTS, UNMERGED_NAMES, FkRule


def match_rule(column: str, rules: Sequence[FkRule] = FK_RULES) -> FkRule | None:
    """The first rule whose pattern fits the column name, or None for a plain column."""
    return next((r for r in rules if any(fnmatchcase(column, p) for p in r.patterns)), None)


def is_searchable_shadow(table: str) -> bool:
    """Search-index and view-like tables, told by their name."""
    lowered = table.lower()
    return any(part in lowered for part in UNMERGED_NAME_PARTS)


def mergeable(tables: Iterable[str], include: Iterable[str] = ()) -> list[str]:
    """Tables a merge fills. `include` adds tables back that the name rules leave out."""
    wanted = set(include)
    return [
        t
        for t in tables
        if t in wanted or not (is_searchable_shadow(t) or t in UNMERGED_NAMES)
    ]


def split_main_minor(tables: Iterable[str]) -> tuple[list[str], list[str]]:
    """Main tables in dependency order, then the others as they come."""
    present = list(tables)
    main = [t for t in MAIN_TABLES if t in present]
    return main, [t for t in present if t not in MAIN_TABLES]


def plain_copies(legacy_tables: Iterable[str], target_tables: Iterable[str]) -> list[str]:
    """Tables the migration copies column by column."""
    legacy = set(legacy_tables)
    return [
        t
        for t in target_tables
        if t in legacy and not is_searchable_shadow(t) and t not in MIGRATED_NAMES
    ]


def common(columns: Iterable[str], other: Iterable[str]) -> list[str]:
    """Names of `columns` that `other` has too, in the order of `columns`; case matters."""
    known = set(other)
    return [c for c in columns if c in known]


def pointer_columns(columns: Iterable[str]) -> list[str]:
    """Chat columns that point at a chat's last message. `_` in the name pattern is any one character."""
    picked = []
    for column in columns:
        lowered = column.lower()
        hit = fnmatchcase(lowered, "*message?row?id*") or fnmatchcase(lowered, "*message?sort?id*")
        if hit and "ephemeral" not in lowered:
            picked.append(column)
    return picked


def listing(names: Iterable[str]) -> str:
    """Names joined by commas."""
    return ",".join(names)
