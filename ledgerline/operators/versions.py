"""Late corrections between snapshots (SRC-09, PRJ-06, AG-28).

The publisher lands the whole archive again with records added, corrected and
withdrawn.  `difference` finds them by a row hash: only (hash, counts) is
shuffled, so an archive that did not change moves some 40 bytes a record and
writes nothing.  The difference is written before rows are looked up by it: its size
is then known to the planner, which broadcasts a small one and moves no row.  A large
one moves each record once: rows meet it by the hash alone, and what went and came is
written as it is found, so that `changes` and the versions read that and not all
records again.  `changes` pairs what went with what came under one id;
`VersionedRecords` folds a snapshot into records that hold from `valid_from` up
to, but not including, `valid_to` (null: still), so that any earlier state can be
read with `as_of`.  A record that did not change keeps its row.

Rows are a multiset: an id that occurs several times, or a row that occurs
several times, is compared by counts of equal rows; equal rows are summed in each
task first, so no id is hot.  Rows without id only come and go, they are not
paired.  Null differs from the empty string.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.sources.sinks import staged
from ledgerline.sources.store import Store, Table

ADDED, CHANGED, WITHDRAWN = "added", "changed", "withdrawn"
VALID = ["valid_from", "valid_to"]


#: 128 bits over the columns of a row, its key included, and over which of them are null.
HASH = ["row_hash", "row_hash_2"]


def row_hash(columns: list[str]) -> dict[str, Column]:
    parts = [F.col(c) for c in columns] + [F.col(c).isNull() for c in columns]
    return dict(zip(HASH, (F.xxhash64(*parts), F.xxhash64(F.lit("second"), *parts))))


#: Column names that the operators add.
RESERVED = {*HASH, "weight", "n_old", "n_new", "d_hash", "d_hash_2", "copy", "place", "d_key"}


def hashed(rows: DataFrame, ignore: tuple[str, ...] = ()) -> DataFrame:
    if clash := RESERVED & set(rows.columns):
        raise ValueError(f"columns with reserved names: {', '.join(sorted(clash))}")
    return rows.withColumns(row_hash([c for c in sorted(rows.columns) if c not in ignore]))


def difference(old: DataFrame, new: DataFrame, ignore: tuple[str, ...] = ()) -> DataFrame:
    """(row_hash, row_hash_2, n_old, n_new) of the rows that do not occur equally often."""
    sides = [hashed(df, ignore).select(*HASH, F.lit(a).alias("n_old"), F.lit(b).alias("n_new")) for df, a, b in ((old, 1, 0), (new, 0, 1))]
    return sides[0].unionByName(sides[1]).groupBy(*HASH).agg(F.sum("n_old").alias("n_old"), F.sum("n_new").alias("n_new")).filter("n_old <> n_new")


def _of(rows: DataFrame, differ: DataFrame, ignore: tuple[str, ...], how: str = "inner") -> DataFrame:
    """The rows that a difference names (inner), or all with what it says of them (left)."""
    d = differ.select(F.col("row_hash").alias("d_hash"), F.col("row_hash_2").alias("d_hash_2"), "n_old", "n_new")
    return hashed(rows, ignore).join(d, (F.col("row_hash") == F.col("d_hash")) & (F.col("row_hash_2") == F.col("d_hash_2")), how)


def _copies(named: DataFrame, more: str, less: str) -> DataFrame:
    """Of rows that a difference names, each different one as often as it is over."""
    return named.dropDuplicates(HASH).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col(more) - F.col(less))))


def signed_rows(old: DataFrame, new: DataFrame, key: str, ignore: tuple[str, ...] = ()) -> DataFrame:
    """The rows that went and came, each once with `weight`: how many more (or,
    negative, fewer) of it there are now."""
    _hashed_key(key, ignore)
    differ = staged(difference(old, new, ignore), "difference")
    weight = (F.col("n_new") - F.col("n_old")).alias("weight")
    gone = _of(old, differ.filter("n_old > n_new"), ignore).dropDuplicates(HASH)
    come = _of(new, differ.filter("n_new > n_old"), ignore).dropDuplicates(HASH)
    return gone.select(*old.columns, weight).unionByName(come.select(*old.columns, weight))


def _hashed_key(key: str, ignore: tuple[str, ...]) -> None:
    if key in ignore:
        raise ValueError(f"the key {key} cannot be ignored")


def _paired(went: DataFrame, come: DataFrame, key: str, ignore: tuple[str, ...]) -> DataFrame:
    """`changes` of the rows that went and those that came, each as often as it did."""
    def side(name: str, rows: DataFrame) -> DataFrame:
        shown = [c for c in rows.columns if c not in VALID]
        one = hashed(rows.select(*shown), ignore).select(F.col(key).alias(f"{name}_key"), F.concat_ws("-", *HASH).alias("hash"), F.struct(*shown).alias(name))
        # rows without key are placed by themselves
        under = Window.partitionBy(f"{name}_key", F.when(F.col(f"{name}_key").isNull(), F.col("hash"))).orderBy("hash")
        return one.withColumn(f"{name}_nth", F.row_number().over(under)).drop("hash")

    pairs = side("old", went).join(side("new", come), (F.col("old_key") == F.col("new_key")) & (F.col("old_nth") == F.col("new_nth")), "full_outer")
    kind = F.when(F.col("old").isNull(), ADDED).when(F.col("new").isNull(), WITHDRAWN).otherwise(CHANGED)
    return pairs.select(F.coalesce("old_key", "new_key").alias(key), kind.alias("change"), "old", "new")


def changes(old: DataFrame, new: DataFrame, key: str = "complaint_id", ignore: tuple[str, ...] = ()) -> DataFrame:
    """(key, change, old, new): added, changed and withdrawn rows with the row
    before and after as structs (null where there is none).  Of several under one
    id the n-th that went, by hash, is paired with the n-th that came."""
    ignore = (*ignore, *VALID)
    _hashed_key(key, ignore)
    differ = staged(difference(old, new, ignore), "difference")
    went = _copies(_of(old, differ.filter("n_old > n_new"), ignore), "n_old", "n_new").select(*old.columns)
    come = _copies(_of(new, differ.filter("n_new > n_old"), ignore), "n_new", "n_old").select(*new.columns)
    return _paired(went, come, key, ignore)


def changed_columns(changed: DataFrame) -> DataFrame:
    """key, change and columns: of a changed row the sorted names whose values differ."""
    names = sorted(f.name for f in changed.schema["new"].dataType.fields)
    differ = F.array(*[F.when(~F.col(f"old.{n}").eqNullSafe(F.col(f"new.{n}")), F.lit(n)) for n in names])
    rest = [c for c in changed.columns if c not in ("old", "new")]
    return changed.select(*rest, F.when(F.col("change") == CHANGED, F.array_compact(differ)).alias("columns"))


class VersionedRecords:
    """Versioned records in a store: part `open` holds the rows that are valid
    still, each snapshot's part those that it closed.  A snapshot rewrites the
    open part only if it changes something, and never a closed one."""

    OPEN = "open"

    def __init__(self, store: Store, name: str = "records", key: str = "complaint_id", ignore: tuple[str, ...] = ()):
        _hashed_key(key, ignore)
        self.store, self.name, self.key, self.ignore = store, name, key, (*ignore, *VALID)

    def _closed(self, table: Table | None) -> list[str]:
        return sorted(k for k in table.parts if k != self.OPEN) if table else []

    def apply_snapshot(self, rows: DataFrame, date: dt.date) -> DataFrame:
        """Fold a landed snapshot in and commit; returns its `changes`.  Snapshots come
        in order of their dates."""
        base, day = self.store.current(), F.lit(date).cast("date")
        tables = self.store.manifest(base)
        table = tables.get(self.name)
        if (last := max(self._closed(table), default="")) >= date.isoformat():
            raise ValueError(f"snapshot {date} is not after {last}")
        stamped = rows.withColumns({"valid_from": day, "valid_to": F.lit(None).cast("date")})
        if table is None:                        # nothing to compare with: all rows come
            table, went = self.store.write(stamped, self.OPEN), self.store.write(stamped.limit(0), date.isoformat())
            self.store.commit(base, tables | {self.name: table.with_parts(went.parts)})
            return _paired(self.store.frame(went), self.store.frame(table), self.key, self.ignore)
        schema, columns = stamped.schema.json(), stamped.columns
        frame = lambda folders: self.store.frame(Table(schema, {"": folders}))
        before = self.store.frame(table, [self.OPEN])
        differ = self.store.frame(self.store.write(difference(before, rows, self.ignore)))
        still, went, come = table.parts[self.OPEN], [], []
        if differ.limit(1).count():
            # of rows equal in hash the earliest go; where all of them go, or all come, none has to be told from another
            place = F.when(F.col("n_old").isNull(), "still").when(F.col("n_new") == 0, "went").otherwise("some go")
            old = self.store.write(_of(before, differ.filter("n_old > n_new"), self.ignore, "left").select(*columns, "n_old", "n_new", place.alias("place")), by="place", gather=False)
            still, went = old.parts.get("still", []), old.parts.get("went", [])
            if some := old.parts.get("some go"):
                equal = Window.partitionBy(*HASH).orderBy("valid_from")
                counted = self.store.frame(Table(old.schema, {"": some})).drop("place")
                goes = F.when(F.col("nth") <= F.col("n_old") - F.col("n_new"), "went").otherwise("still")
                told = hashed(counted.drop("n_old", "n_new"), self.ignore).join(differ, HASH).withColumn("nth", F.row_number().over(equal))
                told = self.store.write(told.select(*columns, goes.alias("place")), by="place", gather=False)
                still, went = still + told.parts.get("still", []), went + told.parts.get("went", [])
            place = F.when(F.col("n_old") == 0, "come").otherwise("some come")
            new = self.store.write(_of(stamped, differ.filter("n_new > n_old"), self.ignore).select(*columns, place.alias("place")), by="place", gather=False)
            come = new.parts.get("come", [])
            if some := new.parts.get("some come"):
                come = come + self.store.write(_copies(_of(frame(some), differ, self.ignore), "n_new", "n_old").select(*columns), "").parts[""]
        past = self.store.write(frame(went).withColumn("valid_to", day), date.isoformat())
        self.store.commit(base, tables | {self.name: Table(schema, table.parts | {self.OPEN: [*still, *come]} | past.parts)})
        return _paired(self.store.frame(past), frame(come), self.key, self.ignore)

    def as_of(self, date: dt.date, version: int | None = None) -> DataFrame:
        """The records as a reader of that day saw them.  Parts that were closed by
        then are not read."""
        version = self.store.current() if version is None else version
        table = self.store.manifest(version)[self.name]
        rows = self.store.frame(table, [self.OPEN, *(k for k in self._closed(table) if k > date.isoformat())])
        return rows.filter((F.col("valid_from") <= F.lit(date)) & (F.col("valid_to").isNull() | (F.col("valid_to") > F.lit(date)))).drop(*VALID)
