"""Layouts for point lookups and joins without a shuffle (PRJ-16, SRC-10, JN-03,
JN-05, JN-06).

`write_ranged` sorts a table by its key over files with disjoint key ranges, gives
the row groups Bloom filters on the key, and writes beside it the range of every
file, itself a small sorted table.  `lookup` reads those ranges, then only the files
whose range holds the key, and in them Parquet skips the row groups whose
statistics or filter exclude it.

`write_bucketed` hashes a table by its key into a fixed number of sorted bucket
files, as a catalog table over files in the shared folder.  Tables bucketed alike
join on the key with neither exchange nor sort.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import scratch_path
from ledgerline.sources.store import Store, Table

#: Bytes of a row group in a ranged table: what a lookup decodes at least.
ROW_GROUP = 8 << 20
RANGES = "_ranges"


def write_ranged(store: Store, df: DataFrame, key: str, files: int | None = None, row_group: int = ROW_GROUP) -> tuple[Table, Table]:
    """(table, its ranges): range-partitioned by `key` and sorted, nulls first.  `files`:
    how many; by default adaptive execution sizes them."""
    ordered = df.repartitionByRange(files, key) if files else df.repartitionByRange(key)
    options = {"parquet.block.size": str(row_group), f"parquet.bloom.filter.enabled#{key}": "true",
               "parquet.page.size": str(min(row_group, 1 << 20))}
    table = store.write(ordered.sortWithinPartitions(key), writer=lambda w: w.options(**options))
    read = store.frame(table).select(F.col("_metadata.file_path").alias("file"), F.col(key).alias("key"))
    ranges = read.groupBy("file").agg(F.min("key").alias("least"), F.max("key").alias("most"), F.count_if(F.col("key").isNull()).alias("nulls"),
                                      F.count(F.lit(1)).alias("n"))
    return table, store.write(ranges.select(F.element_at(F.split("file", "/"), -1).alias("file"), "least", "most", "nulls", "n").sort("least"))


def lookup(store: Store, name: str, key: str, value, version: int | None = None) -> DataFrame:
    """The rows of a ranged table (`name`, and `name` + RANGES) with this key."""
    tables = store.manifest(store.current() if version is None else version)
    table, ranges = tables[name], store.frame(tables[name + RANGES])
    (folder,) = (p for parts in table.parts.values() for p in parts)
    held = ranges.filter((F.col("least") <= F.lit(value)) & (F.col("most") >= F.lit(value))).select("file").collect()     # files whose ranges meet at the key
    part = Table(table.schema, {"": [f"{folder}/{r['file']}" for r in held]})
    return store.frame(part).filter(F.col(key) == F.lit(value))


def write_bucketed(df: DataFrame, key: str, buckets: int, name: str = "bucketed", placed: bool = False, tables: list[str] | None = None) -> DataFrame:
    """The rows as a catalog table of `buckets` sorted bucket files by `key`, read
    back.  `placed`: the rows come narrowly from a table bucketed alike, so every
    task holds whole buckets already and nothing is shuffled.  `tables`: a list of the
    caller's that gets the table's name, for `drop_bucketed`."""
    spark, table = df.sparkSession, f"{name}_{uuid.uuid4().hex}"
    rows = df if placed else df.repartition(buckets, key)
    rows.write.bucketBy(buckets, key).sortBy(key).option("path", scratch_path(spark, name)).format("parquet").saveAsTable(table)
    (_TABLES if tables is None else tables).append(table)
    return spark.table(table)


_TABLES: list[str] = []


def drop_bucketed(spark: SparkSession, tables: list[str] | None = None) -> int:
    """Forget the catalog entries that this process made, or those of a caller's list;
    the files go with the scratch folders, and frames made of them can still be read."""
    tables = _TABLES if tables is None else tables
    n = len(tables)
    while tables:
        spark.sql(f"DROP TABLE IF EXISTS {tables.pop()}")
    return n
