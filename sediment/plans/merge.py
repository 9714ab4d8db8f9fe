"""Merge N snapshots into one archive.

Phase 1, main tables in key order: union the snapshots, remap the foreign keys inside the natural key,
keep one row per key, give it its new id, and write the map from old to new ids. Only key columns travel.
Phase 2, every table on its own: fetch the kept rows' other columns by (snapshot, old id), remap the
remaining foreign keys, rebuild derived columns.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import nullcontext
from copy import copy
from dataclasses import dataclass, field
from functools import partial, reduce
from threading import BoundedSemaphore, Lock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sediment.errors import InvalidSnapshot
from sediment.functions.names import common, listing, mergeable, split_main_minor
from sediment.operators import derive
from sediment.operators.align import align, cast_losses, common_columns, has_surrogate, lossy_columns
from sediment.operators.checks import repeated_ids, split_nulls
from sediment.operators.dedupe import distinct_on_all, keyed_distinct
from sediment.operators.ids import assign_ordered_ids
from sediment.operators.keymap import rank_zip_map, strict_map
from sediment.operators.lookup import BROADCAST_BYTES, Sized, lookup
from sediment.operators.rank import RankedSnapshot, rank_column, rank_snapshots
from sediment.operators.remap import PLACE, ROW, foreign_keys, placed, remap
from sediment.operators.support import GROUP, KIND, WANT, WANT_KIND, unsupported
from sediment.sources import sqlite
from sediment.sources.archive import Archive, Constraints, SqliteArchive, open_archive, read_union
from sediment.sources.sink import Publisher, check_output
from sediment.specs import ID, NEW_ID, OLD_ID, RANK, SNAPSHOT, TIME, FkRule, TableSpec, WeakKey, default_specs
from sediment.staging import Staging

# Tables with a treatment of their own at the end of a merge.
PROPS = "props"
EMPTIED = "backup_changes"
FREQUENT = {"frequent": "jid_row_id", "frequents": "jid"}

# Folders next to the tables of a written archive.
MAPS = "_maps"
REJECTED = "_rejected"

# Folder of what is written while several keys of a table are settled.
KEYS = "_keys"

# Tables worked on at a time, and those of them that are shuffled.
AT_ONCE, SHUFFLED_AT_ONCE = 6, 2


@dataclass
class MergeResult:
    """Tables of the merged archive and what happened on the way."""

    tables: dict[str, DataFrame]
    maps: dict[str, DataFrame]
    quarantine: dict[str, DataFrame]
    ranked: list[RankedSnapshot]
    notes: list[str] = field(default_factory=list)
    staging: Staging | None = None

    def discard(self) -> None:
        """Deletes the intermediate tables that unwritten results still read from."""
        if self.staging is not None:
            self.staging.drop()


@dataclass
class Survivors:
    """Kept rows of a main table: key columns, (snapshot, old id) and new id."""

    rows: DataFrame
    columns: list[str]


def together(work: Callable, parts: Sequence) -> None:
    """Runs `work` for parts that do not depend on each other, so a small one does not wait for a large one."""
    with ThreadPoolExecutor(AT_ONCE) as pool:
        list(pool.map(work, parts))


class Merge:
    """One run over a fixed list of archives."""

    def __init__(
        self,
        spark: SparkSession,
        archives: Sequence[Archive],
        specs: Mapping[str, TableSpec],
        staging: Staging,
        map_mode: str = "strict",
        stale: str = "null",
        include_tables: Sequence[str] = (),
        broadcast_bytes: int = BROADCAST_BYTES,
        main_tables: Sequence[str] | None = None,
    ):
        if map_mode not in ("strict", "rank_zip"):
            raise ValueError(f"map_mode must be 'strict' or 'rank_zip', not {map_mode!r}")
        self.spark, self.specs, self.staging = spark, specs, staging
        self.map_mode, self.stale, self.limit = map_mode, stale, broadcast_bytes
        self.archives = dict(enumerate(archives))
        self.notes: list[str] = []
        self.maps: dict[str, Sized] = {}
        self.survivors: dict[str, Survivors] = {}
        self.refused: dict[str, DataFrame] = {}
        # Tables that need each other: NOT NULL columns that point at one another, rows that may enter, rows that are refused for them.
        self.deferred: dict[str, tuple[str, ...]] = {}
        self.entered: dict[str, DataFrame] = {}
        self.unsupported: dict[str, DataFrame] = {}
        # Written key columns of such tables, which do not change between the two times they are built.
        self.narrow: dict[str, DataFrame] = {}
        self.sure: set[str] = set()
        # Parents' columns for looser keys, written once for all tables that ask.
        self.parents: dict[tuple[str, str], Sized] = {}
        self._reading_parents = Lock()

        together(lambda a: [a.schema(t) for t in mergeable(a.tables(), include_tables)], list(self.archives.values()))
        self.ranked = self._rank()
        self.base = self.archives[next(r.snapshot_id for r in self.ranked if r.is_base)]
        names = mergeable(self.base.tables(), include_tables)
        self.main, self.minor = split_main_minor(names)
        if main_tables is not None:
            self.main = [t for t in self.main if t in main_tables]
        left_out = [t for t in self.base.tables() if t not in names and t != PROPS]
        if left_out:
            self.notes.append(f"not merged: {listing(left_out)}")
        self._report(names)

    # -- reading -----------------------------------------------------------------------------

    def _rank(self) -> list[RankedSnapshot]:
        for a in self.archives.values():
            if "message" in a.tables() and TIME in a.schema("message").names:
                if isinstance(a.schema("message")[TIME].dataType, T.FractionalType):
                    raise InvalidSnapshot(f"message times are not whole numbers in: {a.path}")
        times = read_union(
            self.spark,
            [(i, a) for i, a in self.archives.items() if "message" in a.tables()],
            "message",
            [TIME],
            lambda df, keep: df.select(*keep, F.col(TIME).try_cast("long").alias(TIME)),
        )
        paths = [a.path for a in self.archives.values()]
        if times is None:
            raise InvalidSnapshot("no snapshot has a message table")
        return rank_snapshots(self.spark, paths, times)

    def spec(self, table: str) -> TableSpec:
        declared = self.base.constraints(table)
        known = self.specs.get(table, TableSpec(table))
        return known.with_declared(declared.not_null, declared.unique, declared.defaults)

    def base_schema(self, table: str) -> T.StructType:
        """The base's columns, with the surrogate and foreign keys as long."""
        fields = self.base.schema(table).fields
        ids = {ID, *foreign_keys(table, (f.name for f in fields))}
        return T.StructType(
            [T.StructField(f.name, T.LongType() if f.name in ids else f.dataType) for f in fields]
        )

    def sharing(self, table: str) -> list[tuple[int, Archive]]:
        """Archives that have the table and at least one of the base's columns of it."""
        names = self.base.schema(table).names
        return [
            (i, a)
            for i, a in self.archives.items()
            if table in a.tables() and common_columns(a.schema(table).names, names)
        ]

    def union(self, table: str, columns: Sequence[str] | None = None) -> DataFrame | None:
        """All snapshots' rows of a table in the base's columns, with snapshot_id and merge_rank."""
        full, defaults = self.base_schema(table), self.spec(table).defaults
        renumber = has_surrogate(full.names)
        wanted = {ID, *(full.names if columns is None else columns)}
        base = T.StructType([f for f in full.fields if f.name in wanted])
        df = read_union(
            self.spark,
            self.sharing(table),
            table,
            base.names,
            lambda df, keep: align(df, base, defaults, keep, renumber),
        )
        return None if df is None else df.withColumn(RANK, rank_column(self.ranked))

    def _check_ids(self, table: str) -> None:
        """Stops if a snapshot's ids repeat or are missing: (snapshot, old id) tells all rows apart from here on.

        Archives whose store sees to that are not read for it.
        """
        if table in self.sure:
            return
        self.sure.add(table)
        doubtful = [(i, a) for i, a in self.sharing(table) if not a.constraints(table).sure_ids]
        ids = T.StructType([T.StructField(ID, T.LongType())])
        rows = read_union(self.spark, doubtful, table, [ID], lambda df, keep: align(df, ids, keep=keep))
        if rows is None:
            return
        bad = repeated_ids(rows, SNAPSHOT, OLD_ID).limit(5).collect()
        if bad:
            shown = "; ".join(f"{self.archives[r[SNAPSHOT]].path}: {r[OLD_ID]} in {r['n']} rows" for r in bad)
            raise InvalidSnapshot(f"{table}: {ID} missing or repeated: {shown}")

    def _report(self, names: Sequence[str]) -> None:
        """Notes on what the base's catalog leaves out, from the catalogs; values are counted only
        where a column changes its type."""
        losses: dict[tuple, list[tuple[int, Archive]]] = {}
        for i, archive in self.archives.items():
            extra_tables = [t for t in mergeable(archive.tables()) if t not in names]
            if extra_tables:
                self.notes.append(f"{archive.path}: tables the base lacks: {listing(extra_tables)}")
            for table in common(names, archive.tables()):
                base, have = self.base_schema(table), archive.schema(table)
                extra = [c for c in have.names if c not in base.names]
                if not common_columns(have.names, base.names):
                    self.notes.append(f"{archive.path}: {table} skipped, no common columns")
                if extra:
                    self.notes.append(f"{archive.path}: {table} columns the base lacks: {listing(extra)}")
                if table in self.main and ID in base.names and ID not in have.names:
                    raise InvalidSnapshot(f"{archive.path}: {table} has no {ID}")
                if lossy_columns(have, base):
                    losses.setdefault((table, have.json()), []).append((i, archive))
        parts = [self._losses(table, members) for (table, _), members in losses.items()]
        parts += [self._misfits(table) for table in names]
        # One row per snapshot, table and column.
        for part in parts:
            for r in part.where("n > 0").collect() if part is not None else ():
                path = self.archives[r[SNAPSHOT]].path
                self.notes.append(f"{path}: {r['name']}.{r['column']}: {r['n']} values did not fit")

    def _losses(self, table: str, members: list[tuple[int, Archive]]) -> DataFrame:
        """Values that do not fit the base's types: one scan for all snapshots whose table is alike."""
        base, have = self.base_schema(table), members[0][1].schema(table)
        columns = lossy_columns(have, base)
        rows = read_union(self.spark, members, table, columns, lambda df, keep: df.select(*keep, *columns))
        return cast_losses(rows, base, SNAPSHOT).withColumn("name", F.lit(table))

    def _misfits(self, table: str) -> DataFrame | None:
        """Values a store holds that are not of their column's type."""
        kept: dict[tuple, list[tuple[int, SqliteArchive]]] = {}
        for i, a in self.sharing(table):
            if isinstance(a, SqliteArchive):
                kept.setdefault(a.scan_group(table), []).append((i, a))
        if not kept:
            return None
        counted = (
            sqlite.misfits(self.spark, [(i, a.path) for i, a in members], members[0][1].info(table))
            for members in kept.values()
        )
        wanted = F.col("column").isin(self.base_schema(table).names)
        return reduce(DataFrame.unionByName, counted).where(wanted).withColumn("name", F.lit(table))

    # -- phase 1: keys, ids, maps ------------------------------------------------------------

    def build_keys(self) -> None:
        """Main tables whose keys do not point at each other run at the same time.

        Whether a row enters is settled by its keys, unique keys and NOT NULL columns, so the maps they need come first. Tables
        that need each other's, or a table its own, are built together if only NOT NULL columns make it so.
        """
        waiting = [t for t in self.main if self.sharing(t) and ID in self.base_schema(t).names]
        while waiting:
            ready = [t for t in waiting if not self._key_targets(t) & set(waiting)]
            if ready:
                together(self._build_key, ready)
            else:
                ready = self._circle(waiting)
                self._build_circle(ready)
            waiting = [t for t in waiting if t not in ready]

    def _key_targets(self, table: str, not_null: bool = True) -> set[str]:
        """Tables whose maps are needed before this table's key is known, and with `not_null` before it is known which rows enter."""
        spec, names = self.spec(table), self.base_schema(table).names
        further = [c for k in spec.unique if set(k) <= set(names) for c in k]
        parts = [*spec.natural_key, *spec.map_key, *(w.column for w in spec.weak_key), *further]
        fks = foreign_keys(table, names)
        return {fks[c].target for c in (*parts, *(spec.not_null if not_null else ())) if c in fks}

    def _circle(self, waiting: Sequence[str]) -> list[str]:
        """The fewest waiting tables that need each other and no other waiting one."""

        def reached(table: str) -> set[str]:
            found: set[str] = set()
            more = {table}
            while more:
                found |= more
                more = {x for t in more for x in self._key_targets(t) & set(waiting)} - found
            return found

        tables = min((reached(t) for t in waiting), key=len)
        if self.map_mode == "rank_zip" or any(self._key_targets(t, not_null=False) & tables for t in tables):
            raise InvalidSnapshot(f"keys or NOT NULL columns that point at each other: {listing(sorted(tables))}")
        for t in tables:
            # Which of several keys a row goes by hangs on the rows that enter, and these would hang on that.
            if len(self._further_keys(t)) + bool(self.spec(t).natural_key) > 1:
                raise InvalidSnapshot(f"several keys in {t}, whose NOT NULL columns point in a circle: {listing(sorted(tables))}")
        return [t for t in waiting if t in tables]

    def _further_keys(self, table: str) -> list[tuple[str, ...]]:
        spec, present = self.spec(table), set(self.base_schema(table).names)
        return [k for k in spec.unique if set(k) <= present and k != (spec.natural_key if set(spec.natural_key) <= present else ())]

    def _build_circle(self, tables: Sequence[str]) -> None:
        """Tables whose NOT NULL columns point at each other.

        Built once as if those columns could be null, which tells the group of copies each reference leads to. A row goes if a
        reference leads to none, or to one of which all rows go; the rest hold each other up. Then they are built without such rows.
        """
        trial = copy(self)
        trial.maps, trial.survivors, trial.refused, trial.entered, trial.narrow = dict(self.maps), {}, {}, {}, {}
        trial.staging = Staging(self.spark, self.staging.root)
        fks = {t: foreign_keys(t, self.spec(t).not_null) for t in tables}
        present = {t: self.base_schema(t).names for t in tables}
        trial.deferred = {t: tuple(c for c, r in fks[t].items() if r.target in tables and c in present[t]) for t in tables}
        together(trial._build_key, tables)

        members, wants = [], []
        for kind, t in enumerate(tables):
            group = trial.maps[t].df.select(*ROW, F.col(NEW_ID).alias(GROUP))
            rows = trial.entered[t].join(group, list(ROW)[::-1], "left").select(F.lit(kind).alias(KIND), *ROW, GROUP)
            rows = trial.staging.write(f"{t}_members", rows)
            members.append(rows)
            # Where an unknown reference is 0, nothing is refused for it.
            binding = [c for c in trial.deferred[t] if t not in fks[t][c].zero_in]
            found = remap(trial.union(t, binding).select(*ROW, *binding), t, trial.maps, binding, limit=self.limit, row=ROW)
            needs = [F.struct(F.lit(tables.index(fks[t][c].target)).alias(WANT_KIND), F.col(c).alias(WANT)) for c in binding]
            if needs:
                both = rows.join(found, list(ROW)[::-1]).select(KIND, *ROW, GROUP, F.explode(F.array(*needs)).alias("need"))
                wants.append(both.select(KIND, *ROW, GROUP, "need.*"))
        if wants:
            every = reduce(DataFrame.unionByName, members), reduce(DataFrame.unionByName, wants)
            gone = unsupported(*every, trial.staging, self.limit)
            trial.staging.drop("sizes", "wants", "emptied", *(f"{t}_{part}" for t in tables for part in ("members", "survivors", "map")))
            self.unsupported |= {t: gone.where(F.col(KIND) == kind).select(*ROW) for kind, t in enumerate(tables)}
        self.deferred |= trial.deferred
        self.narrow |= trial.narrow
        together(self._build_key, tables)
        for t in tables:
            self._refuse_in_circle(t)

    def _refuse_in_circle(self, table: str) -> None:
        """All rows a table's NOT NULL columns kept out, with those columns, now that the maps are there."""
        checked = [c for c in self.spec(table).not_null if c in self.base_schema(table).names]
        ids = [self.refused[table].select(*ROW)] if table in self.refused else []
        ids += [self.unsupported[table]] if table in self.unsupported else []
        if ids:
            rows = self.union(table, checked).select(*ROW, *checked).join(reduce(DataFrame.unionByName, ids), list(ROW)[::-1], "left_semi")
            self.refused[table] = remap(rows, table, self.maps, checked, limit=self.limit, row=ROW)

    def _build_key(self, table: str) -> None:
        spec, names = self.spec(table), self.base_schema(table).names
        present = set(names)
        # A key with a missing column identifies nothing.
        key = spec.natural_key if set(spec.natural_key) <= present else ()
        map_key = [c for c in spec.map_key if c in present]
        timed = spec.time_ordered and TIME in present
        renumber = has_surrogate(names)
        zipped = self.map_mode == "rank_zip" and {w.column for w in spec.weak_key} <= present
        weak = {f"_w{i}": w for i, w in enumerate(spec.weak_key if zipped else ())}

        checked = [c for c in spec.not_null if c in present and c not in self.deferred.get(table, ())]
        further = self._further_keys(table)
        needed = dict.fromkeys([*key, *(c for k in further for c in k), *checked, *map_key, *(w.column for w in weak.values())])
        if timed:
            needed[TIME] = None
        if not renumber:
            needed[ID] = None
        stage = None
        if table in self.narrow:
            narrow = self.narrow[table]
        else:
            self._check_ids(table)
            rows = self.union(table, needed)
            for name, part in weak.items():
                if part.parent:
                    rows = self._with_parent_part(rows, part, name)
            narrow = remap(rows, table, self.maps, needed, limit=self.limit)
            narrow = narrow.withColumns({n: F.col(w.column) for n, w in weak.items() if not w.parent})
            # Rows that are refused are a second output of the same written rows.
            if checked or table in self.deferred or not all(self.maps[r.target].fits(self.limit) for r in self._targets(table, needed)):
                narrow = self.staging.write(f"{table}_rows", narrow)
            else:
                stage = partial(self.staging.write, f"{table}_keyed")
            if table in self.deferred:
                self.narrow[table] = narrow

        entering = narrow.where(F.col(TIME).isNotNull()) if timed else narrow
        entering, refused = split_nulls(entering, checked)
        self._refuse(table, refused, checked)
        if table in self.deferred:
            self.entered[table] = entering.select(*ROW)
        if table in self.unsupported:
            entering = entering.join(self.unsupported[table], list(ROW)[::-1], "left_anti")
        first = [RANK, TIME, OLD_ID] if timed else [RANK, OLD_ID]
        kept = self._distinct(table, spec, entering, [k for k in (key, *further) if k], first, ROW)
        id_order = [TIME, RANK, OLD_ID] if timed else [RANK, OLD_ID]
        kept, n_kept = assign_ordered_ids(kept, id_order, self.staging, f"{table}_survivors", NEW_ID)
        if not renumber:
            kept = kept.withColumn(NEW_ID, F.col(ID))
        self.survivors[table] = Survivors(kept, [c for c in needed if c in present])

        if zipped:
            # A survivor whose parent has no new id cannot be found through it.
            seen = {n: F.when(F.col(w.column).isNotNull(), F.col(n)) for n, w in weak.items()}
            mapped = rank_zip_map(narrow, kept.withColumns(seen), list(weak), self.staging, table, first)
        else:
            mapped = strict_map(narrow, kept, n_kept, key, map_key, spec.key_casts, self.limit, stage)
        self.maps[table] = Sized.of(self.staging.write(f"{table}_map", mapped))
        # What only the map and the survivors were made from. Refused rows and tables built twice read the written rows again.
        self.staging.drop(f"{table}_keyed", f"{table}_zip_rows", f"{table}_zip_targets", f"{KEYS}/{table}")
        if not checked and table not in self.deferred:
            self.staging.drop(f"{table}_rows")

    def _distinct(
        self,
        table: str,
        spec: TableSpec,
        rows: DataFrame,
        keys: Sequence[Sequence[str]],
        order: Sequence[str],
        row: Sequence[str],
    ) -> DataFrame:
        """One row per key, for every key. `row` tells all rows apart, null parts of it too."""
        if len(keys) > 1:
            return distinct_on_all(rows, keys, order, row, self.staging, f"{KEYS}/{table}")
        return keyed_distinct(rows, keys[0], [F.col(c) for c in order], row, spec.key_casts) if keys else rows

    def _with_parent_part(self, rows: DataFrame, part: WeakKey, name: str) -> DataFrame:
        """Adds the parent's column inside the same snapshot, found by the old id."""
        with self._reading_parents:
            if (part.parent, part.parent_column) not in self.parents:
                read = self.union(part.parent, [part.parent_column])
                written = self.staging.write(f"{part.parent}_{part.parent_column}_parents", read)
                self.parents[part.parent, part.parent_column] = Sized.of(written)
        return lookup(
            rows,
            self.parents[part.parent, part.parent_column],
            {part.column: OLD_ID, SNAPSHOT: SNAPSHOT},
            {part.parent_column: name},
            spread=ROW,
            limit=self.limit,
        )

    # -- phase 2: whole rows -----------------------------------------------------------------

    def main_table(self, table: str) -> DataFrame:
        """Kept rows of a main table with all columns, under their new ids."""
        names = self.base_schema(table).names
        kept = self.survivors[table]
        rest = [c for c in names if c not in kept.columns and c != ID]
        own = kept.rows.select(*ROW, F.col(NEW_ID).alias(ID), *(c for c in kept.columns if c != ID))
        if rest:
            rows = self.union(table, rest).select(*ROW, *rest)
            rows = remap(rows, table, self.maps, rest, limit=self.limit, row=ROW)
            # (snapshot, old id) is unique on both sides (_check_ids), so no task gets more than its share.
            own = own.join(rows, list(ROW)[::-1], "inner")
        return own.select(*names)

    def minor_table(self, table: str) -> DataFrame:
        """All snapshots' rows of a minor table, remapped; one per key only where the store declares one.

        If its rows have ids that are renumbered, the columns that decide anything go first and the others are joined to them by
        (snapshot, old id). Any other table's ids are data, which may repeat or be missing: where rows have to be told apart,
        they are written first and go by their places.
        """
        spec, names = self.spec(table), self.base_schema(table).names
        sharing = self.sharing(table)
        if not sharing:
            return self.empty(table)
        renumber = has_surrogate(names)
        sure = renumber and all(ID in a.schema(table).names for _, a in sharing)
        columns = [c for c in names if not (renumber and c == ID)]
        keys = [k for k in spec.keys if set(k) <= set(columns)]
        checked = [c for c in spec.not_null if c in columns]
        top = FREQUENT.get(table) if FREQUENT.get(table) in columns else None
        whole = not (keys or checked or top)
        needed = columns
        if sure:
            deciding = {*foreign_keys(table, columns), *checked, *(c for k in keys for c in k)}
            deciding |= {top, "message_count"} if top else set()
            needed = [c for c in columns if c in deciding]
            self._check_ids(table)
        rows = self.union(table, needed)
        large = [r for r in self._targets(table, needed) if not self.maps[r.target].fits(self.limit)]
        row: tuple[str, ...] = ROW if sure else ()
        if not sure and (keys or len(large) > 1):
            rows, row = self.staging.write(f"{table}_placed", placed(rows)), (PLACE,)
        order = [RANK, OLD_ID] if sure else [RANK, *sorted(needed), *row]

        if renumber and whole:
            # No row goes, so ids are given on the plain scan and the sort repeats no join.
            rows, _ = assign_ordered_ids(rows, order, self.staging, f"{table}_minor", ID)
        rows = remap(rows, table, self.maps, needed, limit=self.limit, row=row)
        if not whole:
            if checked or large:
                rows = self.staging.write(f"{table}_remapped", rows)
            rows, refused = split_nulls(rows, checked)
            self._refuse(table, refused, checked)
            rows = self._distinct(table, spec, rows, keys, order, row)
            if top:
                rows = derive.most_frequent(rows, top, order)
            if renumber:
                rows, _ = assign_ordered_ids(rows, order, self.staging, f"{table}_minor", ID)
        rest = [c for c in columns if c not in needed]
        if rest:
            rows = rows.join(self.union(table, rest).select(*ROW, *rest), list(ROW)[::-1], "inner")
        return rows.select(*names)

    def _targets(self, table: str, columns: Sequence[str]) -> list[FkRule]:
        """Rules of the foreign keys among the columns whose map is there."""
        return [r for r in foreign_keys(table, columns).values() if r.target in self.maps]

    def _refuse(self, table: str, rows: DataFrame, checked: Sequence[str]) -> None:
        if checked:
            self.refused[table] = rows.select(SNAPSHOT, *(c for c in (OLD_ID,) if c in rows.columns), *checked)

    def rejected(self, table: str) -> DataFrame | None:
        """Rows a NOT NULL column kept out: their snapshot, old id and those columns, remapped.

        Known once the table's rows are settled: by `build_keys` for main tables, by `minor_table` for others.
        """
        return self.refused.get(table)

    def declared(self, table: str) -> Constraints:
        """What the merged table keeps to: the base's own constraints and those of its spec. Ids given here are sure."""
        if table == PROPS:
            return self.base.constraints(table)
        spec = self.spec(table)
        given = has_surrogate(self.base_schema(table).names)
        sure = given or self.base.constraints(table).sure_ids
        return Constraints(spec.not_null, spec.unique, spec.defaults, sure)

    def empty(self, table: str) -> DataFrame:
        return self.spark.createDataFrame([], self.base_schema(table))

    def props(self) -> DataFrame:
        """Properties come from the base alone."""
        df = self.base.read(PROPS)
        return derive.reset_index_state(df) if {"key", "value"} <= set(df.columns) else df

    def tables(self, store: Callable[[str, DataFrame], DataFrame]) -> dict[str, DataFrame]:
        """Phase 2 of every table; `store` gets each as soon as it is defined and returns what to read.

        If that is another frame, the table is taken to be written, and what it alone was made from is dropped: tables are made once then.
        Few tables are shuffled at a time, as each of them uses all cores, and their shuffle files lie on the disk together.
        """
        names = [*self.main, *self.minor, *([PROPS] if PROPS in self.base.tables() else [])]
        out: dict[str, DataFrame] = {}
        shuffling = BoundedSemaphore(SHUFFLED_AT_ONCE)

        def finish(table: str) -> None:
            with shuffling if self._shuffled(table) else nullcontext():
                made = self.finished(table, out)
                out[table] = store(table, made)
            if out[table] is not made:
                self._drop_parts(table)

        # Small ones first, so that none waits for a large one.
        together(finish, sorted((t for t in names if t != "chat"), key=self._shuffled))
        # Chats last: their state is read off the finished messages.
        together(finish, [t for t in names if t == "chat"])
        return {t: out[t] for t in names}

    def _shuffled(self, table: str) -> bool:
        """Whether maps of this table or of those it points at are too large for a broadcast."""
        known = self.base_schema(table).names if table != PROPS else ()
        maps = [self.maps[t] for t in {table, *(r.target for r in self._targets(table, known))} if t in self.maps]
        return not all(m.fits(self.limit) for m in maps)

    def _drop_parts(self, table: str) -> None:
        if table in self.main:
            self.staging.drop(f"{table}_survivors")
        else:
            self.staging.drop(f"{table}_minor", f"{table}_placed", f"{KEYS}/{table}")
            # Refused rows are read off these.
            if table not in self.refused:
                self.staging.drop(f"{table}_remapped")

    def finished(self, table: str, done: Mapping[str, DataFrame]) -> DataFrame:
        if table == PROPS:
            return self.props()
        if table == EMPTIED or (table in self.main and table not in self.survivors):
            return self.empty(table)
        if table not in self.main:
            return self.minor_table(table)
        df = self.main_table(table)
        if table == "message" and "sort_id" in df.columns:
            return derive.sort_by_id(df)
        return derive.refresh_chats(df, done["message"], self.stale) if table == "chat" and "message" in done else df

    def quarantine(self) -> dict[str, DataFrame]:
        found = {t: self.rejected(t) for t in [*self.main, *self.minor]}
        return {t: df for t, df in found.items() if df is not None}


def merge_archives(
    spark: SparkSession,
    snapshots: Sequence["str | Archive"],
    out: str | None = None,
    specs: Mapping[str, TableSpec] | None = None,
    *,
    map_mode: str = "strict",
    stale: str = "null",
    include_tables: Sequence[str] = (),
    broadcast_bytes: int = BROADCAST_BYTES,
    versioned: bool = False,
) -> MergeResult:
    """Merge snapshots; with `out`, also write the archive there. Snapshots are never written to.

    map_mode        "strict": references follow the row that stands for their natural key.
                    "rank_zip": looser keys, one to one; references to surplus copies are lost.
    stale           pointers of chats with nothing to show: "null" clears them, "keep" leaves them.
    include_tables  tables to merge although their name marks them as search index or view.
    broadcast_bytes  largest table that may be broadcast.
    versioned       publish by a pointer to a new version in `out`, which then needs an archive reader (`open_archive`).

    The result of a merge is itself a snapshot, so new snapshots can be merged onto it later.
    """
    if not snapshots:
        raise ValueError("give at least one snapshot")
    archives = [open_archive(spark, s) for s in snapshots]
    if out is not None:
        check_output(spark, out, [s for s in snapshots if isinstance(s, str)])
    staging = Staging(spark)
    try:
        return _merged(
            spark, archives, out, versioned, staging, specs or default_specs(), map_mode, stale, include_tables, broadcast_bytes
        )
    except BaseException:
        staging.drop()
        raise


def _merged(
    spark: SparkSession, archives: Sequence[Archive], out: str | None, versioned: bool, staging: Staging, specs: Mapping, *options
) -> MergeResult:
    merge = Merge(spark, archives, specs, staging, *options)
    merge.build_keys()
    if out is None:
        tables = merge.tables(lambda _, df: df)
        maps = {t: m.df for t, m in merge.maps.items()}
        return MergeResult(tables, maps, merge.quarantine(), merge.ranked, merge.notes, staging)

    with Publisher(spark, out, versioned) as publisher:
        stored = merge.tables(publisher.write)
        rejected = merge.quarantine()
        side = {f"{REJECTED}/{t}": df for t, df in rejected.items()}
        side.update({f"{MAPS}/{t}": m.df for t, m in merge.maps.items()})
        together(lambda name: publisher.write(name, side[name]), list(side))
        publisher.declare({t: merge.declared(t) for t in stored})
        publisher.publish()
    staging.drop()

    def published(name: str, like: DataFrame) -> DataFrame:
        return spark.read.schema(like.schema).parquet(f"{publisher.home}/{name}")

    return MergeResult(
        {t: published(t, df) for t, df in stored.items()},
        {t: published(f"{MAPS}/{t}", m.df) for t, m in merge.maps.items()},
        {t: published(f"{REJECTED}/{t}", df) for t, df in rejected.items()},
        merge.ranked,
        merge.notes,
    )
