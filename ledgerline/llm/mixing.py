"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Targets: sources ranked by code point (null last) weigh 1, 2, 3, repeating, and
share the budget by weight; a target stops at `max_epochs` times its source's
size and the excess is shared again until none is above.  Each source takes
every document once for each whole epoch in its target; the rest of the target
is a weighted sample without replacement: a document's key is -ln(u) / quality,
u a hash of seed and id, and documents are taken in key order until the
budget is met.  The document on the budget's edge gives its leading words, so
a source's taken words are its target rounded down; `mixed_documents` takes it
whole or not at all instead, and `source_report` gives both distances.

Order inside a source is never sorted whole: keys fall in monotone buckets of
equal width in log(key), sizes are summed by source and bucket, the running sum
names the one bucket where the budget ends, and only that bucket's documents are
ordered.  log(key) = log(-ln u) - log(weight), so a weight only moves a document
along the buckets: whatever the weights, a bucket holds less than a two-thousandth
of documents of one weight, and a source with a third of all rows never meets in
one task.

Quality weight (default): 1 less five times the share of marks `#*$%&|<>!`
among the characters, 0.05 at least.

Defined cases: null text has size 0; a null source is a source of its own; a
null id draws by its text; sources without words have target 0; ties of key
are broken by id, then size, and rows equal in all of them are interchangeable;
repeated rows are documents of their own and share a draw.  Empty table, empty result.  Other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerline.llm.common import WORD, stage, text_key

#: BUCKETS: for each doubling of the key.
CYCLE, MAX_EPOCHS, BUCKETS, SEED = 3, 3, 1024, "mix-1"
#: Copies of one row that are made at once.
CHUNK = 1024
#: No bucket: before all of them.
NONE = -(1 << 31)
MARKS = "#*$%&|<>!"


def default_quality(text: Column) -> Column:
    marks = F.length(text) - F.length(F.translate(text, MARKS, ""))
    return F.greatest(F.lit(0.05), F.lit(1.0) - F.lit(5.0) * marks / (F.length(text) + 1))


def _ranked(sources: DataFrame) -> DataFrame:
    """sources with `rank` (0, 1, ...) by code point, null last, without a one-task
    sort: the place inside the range partition plus the partitions before it."""
    placed = stage(sources.orderBy(F.asc_nulls_last("source")).withColumn("mid", F.monotonically_increasing_id()), "mix-order")
    part, place = F.shiftright("mid", 33), F.col("mid").bitwiseAND((1 << 33) - 1)
    before = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))       # a row for each partition
    before = before.select("part", (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("before"))
    return placed.withColumn("part", part).join(before, "part").withColumn("rank", F.col("before") + place).drop("part", "before", "mid")


def targets(sizes: DataFrame, cycle: int = CYCLE, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size) -> also weight and target.  Sharing again needs one
    small aggregate a round; a round that caps nothing more is the last."""
    ranked = stage(_ranked(sizes).select("source", "source_size", (1 + F.col("rank") % cycle).alias("weight")), "mix-weights")
    cap = max_epochs * F.col("source_size")
    rest, shares, capped = None, None, -1
    while True:
        # capped: its share of what is left would exceed its cap
        over = F.lit(False) if rest is None else F.col("weight") * rest > cap * shares
        row = ranked.agg(F.sum("source_size").alias("total"),
                         F.coalesce(F.sum(F.when(over, cap)), F.lit(0)).alias("held"),
                         F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0)).alias("shares"),
                         F.count(F.when(over, 1)).alias("capped")).first()
        if row["capped"] == capped or not row["shares"]:
            break
        rest, shares, capped = row["total"] - row["held"], row["shares"], row["capped"]
    if rest is None:
        return ranked.withColumn("target", F.lit(0.0))
    over = F.col("weight") * rest > cap * shares
    share = (F.col("weight") * rest).cast("double") / F.lit(shares).cast("double")
    return ranked.withColumn("target", F.when(over, cap.cast("double")).otherwise(share))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        quality: Column | None = None, seed: str = SEED, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """doc_id, source, size, source_size, target, taken: one row per input row."""
    mixed = _mixed(docs, id_col, text_col, source_col, quality, seed, max_epochs)
    return mixed.select(F.col("id").alias("doc_id"), "source", "size", "source_size", "target", "taken")


def _mixed(docs: DataFrame, id_col: str, text_col: str, source_col: str, quality: Column | None, seed: str, max_epochs: int) -> DataFrame:
    """`mix` with id and text_key."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    name = F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("text "), text_key(text).cast("string")))
    draw = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), name)), 1, 13), 16, 10).cast("long")
    weight = default_quality(text) if quality is None else quality
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_key(text).alias("text_key"), F.col(source_col).cast("string").alias("source"),
                       F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
                       (-F.log((draw + 1) / F.lit(float(1 << 52))) / weight).alias("key"))
    # key 0 (u = 1) comes before all buckets
    bucket = F.when(F.col("key") > 0, F.floor(BUCKETS * F.log2("key")).cast("int")).otherwise(F.lit(NONE + 1))
    rows = stage(rows.withColumn("bucket", bucket), "mix-rows")
    planned = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), max_epochs=max_epochs)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    planned = stage(planned.withColumn("epochs", epochs)
                    .withColumn("budget", F.floor("target").cast("long") - F.col("epochs") * F.col("source_size")), "mix-plan")

    # The bucket where each source's budget ends: the last one that starts below it.
    summed = rows.groupBy("source", "bucket").agg(F.sum("size").alias("n"))
    run = W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = summed.withColumn("before", F.coalesce(F.sum("n").over(run), F.lit(0)))
    same = starts["source"].eqNullSafe(planned["source"])
    edges = (starts.join(planned, same).filter(F.col("before") < F.col("budget"))
             .groupBy(planned["source"].alias("edge_source")).agg(F.max_by(F.struct("bucket", "before"), "bucket").alias("edge")))
    plan = stage(planned.join(edges, planned["source"].eqNullSafe(edges["edge_source"]), "left")
                 .select(F.col("source").alias("plan_source"), "source_size", "target", "epochs", "budget",
                         F.coalesce("edge.bucket", F.lit(NONE)).alias("edge"), F.coalesce("edge.before", F.lit(0)).alias("edge_before")), "mix-edges")

    at = rows.join(plan, rows["source"].eqNullSafe(plan["plan_source"]))
    off = at.filter("bucket <> edge").withColumn("part", F.when(F.col("bucket") < F.col("edge"), F.col("size")).otherwise(0))
    order = W.partitionBy("source").orderBy("key", "id", "size", "text_key").rowsBetween(W.unboundedPreceding, -1)
    left = F.col("budget") - F.col("edge_before") - F.coalesce(F.sum("size").over(order), F.lit(0))
    on = at.filter("bucket = edge").withColumn("part", F.greatest(F.lit(0), F.least(F.col("size"), left)))
    return off.unionByName(on).select("id", "text_key", "source", "size", "source_size", "target",
                                      (F.col("epochs") * F.col("size") + F.col("part")).cast("long").alias("taken"))


def _copies(taken: Column, size: Column) -> Column:
    """How often a document comes whole: the one on a source's edge if half of it
    fits the budget, else not at all."""
    rest = taken % size
    return F.when(size > 0, F.floor(taken / size) + F.when(2 * rest >= size, 1).otherwise(0)).otherwise(0).cast("long")


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = SEED) -> DataFrame:
    """The mix as whole documents with their own columns, each as often as it is
    taken; none is cut (`source_report` says how far a source is from its target).
    Rows that share id, source and text are interchangeable: their copies are all
    made from one of them.  A row without words is never taken."""
    copies = (_mixed(docs, id_col, text_col, source_col, None, seed, MAX_EPOCHS).withColumn("n", _copies(F.col("taken"), F.col("size"))).filter("n > 0")
              .groupBy(F.col("id").alias("__id"), F.col("text_key").alias("__key"), F.col("source").alias("__source"))
              .agg(F.sum("n").alias("__copies"), F.count(F.lit(1)).alias("__rows")))
    joined = docs.join(copies, docs[id_col].cast("long").eqNullSafe(F.col("__id")) & (text_key(docs[text_col]) == F.col("__key"))
                       & docs[source_col].cast("string").eqNullSafe(F.col("__source")))
    each = joined.filter("__rows = 1").withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies"))))
    # repeated rows: one of them makes all copies, in chunks that are dealt out
    shared = (joined.filter("__rows > 1").dropDuplicates(["__id", "__key", "__source"])
              .withColumn("__chunk", F.explode(F.sequence(F.lit(0), F.floor((F.col("__copies") - 1) / CHUNK))))
              .repartition("__chunk", "__key")
              .withColumn("__copy", F.explode(F.sequence(F.col("__chunk") * CHUNK + 1, F.least(F.col("__copies"), (F.col("__chunk") + 1) * CHUNK)))))
    return each.drop("__copy").unionByName(shared.drop("__chunk", "__copy")).select(*[F.col(f"`{c}`") for c in docs.columns])
def source_report(mixed: DataFrame) -> DataFrame:
    """`mix` rows -> source, target, taken, whole_taken (words) and documents (of
    `mixed_documents`): one row per source."""
    n = _copies(F.col("taken"), F.col("size"))
    return mixed.groupBy("source").agg(F.max("target").alias("target"), F.sum("taken").alias("taken"),
                                       F.sum(n * F.col("size")).alias("whole_taken"), F.sum(n).alias("documents"))


SQL = """
WITH RECURSIVE rows_ AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
         -ln((('0x' || substr(md5('mix-1:' || doc_id), 1, 13))::BIGINT + 1) / 4503599627370496.0::DOUBLE)
         / greatest(0.05::DOUBLE, 1.0::DOUBLE - 5.0::DOUBLE * (length(coalesce(text, '')) - length(translate(coalesce(text, ''), '#*$%&|<>!', '')))
                    / (length(coalesce(text, '')) + 1)) AS key
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight
  FROM rows_ GROUP BY source),
shares AS (
  SELECT 0 AS round, sum(source_size)::BIGINT AS rest, sum(weight)::BIGINT AS shares, 0::BIGINT AS capped FROM sources
  UNION ALL
  SELECT round + 1, n.rest, n.shares, n.capped
  FROM (SELECT s.round, s.capped AS was,
               (sum(source_size) - sum(CASE WHEN weight * s.rest > 3 * source_size * s.shares THEN 3 * source_size ELSE 0 END))::BIGINT AS rest,
               sum(CASE WHEN weight * s.rest > 3 * source_size * s.shares THEN 0 ELSE weight END)::BIGINT AS shares,
               count(*) FILTER (weight * s.rest > 3 * source_size * s.shares) AS capped
        FROM shares s, sources GROUP BY s.round, s.capped) n
  WHERE n.capped > was),
last AS (SELECT * FROM shares ORDER BY round DESC LIMIT 1),
planned AS (
  SELECT source, source_size, CASE WHEN weight * rest > 3 * source_size * shares THEN (3 * source_size)::DOUBLE
                                   ELSE (weight * rest)::DOUBLE / shares::DOUBLE END AS target
  FROM sources, last),
sampled AS (
  SELECT r.doc_id, r.size, p.source_size, p.target,
         CASE WHEN p.source_size > 0 THEN floor(p.target / p.source_size)::BIGINT ELSE 0 END AS epochs,
         coalesce(sum(r.size) OVER (PARTITION BY r.source ORDER BY key, r.doc_id, r.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM rows_ r JOIN planned p ON r.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       (epochs * size + greatest(0, least(size, floor(target)::BIGINT - epochs * source_size - before)))::BIGINT AS taken
FROM sampled
"""
