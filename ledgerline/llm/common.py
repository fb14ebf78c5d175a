"""Helpers shared by the operators: staging in the cluster's shared folder and
the byte-level word rule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import scratch_path

#: A word: a run of anything but space and U+0009..U+000D.  `bytes.split()`
#: splits on exactly these bytes, and UTF-8 continuation bytes are never among them.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder that `spark.checkpoint.dir` names."""
    return scratch_path(spark, f"llm-{name}")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared folder and read back: cuts the lineage, so a lost
    executor costs one file read, and fixes the rows for every later use."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_key(text: Column) -> Column:
    """A hash that, beside the id, tells a row's text from others under that id."""
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def apply_verdicts(docs: DataFrame, verdicts: DataFrame, id_col: str, key: Column) -> DataFrame:
    """docs without the rows that `verdicts` (id, key, one) names by id and text
    key: where `one` is false none of them stays, where it is true one does.  Rows
    it does not name stay.  Ids may be null or repeated."""
    named = verdicts.select(F.col("id").alias("__id"), F.col("key").alias("__key"), F.col("one").alias("__one"))
    joined = docs.join(named, docs[id_col].cast("long").eqNullSafe(named["__id"]) & (key == named["__key"]), "left")
    single = joined.filter(F.col("__one").isNull())
    one = joined.filter("__one").dropDuplicates(["__id", "__key"])
    return single.unionByName(one).select(*[F.col(f"`{c}`") for c in docs.columns])
