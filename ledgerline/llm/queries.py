"""The subpackage's queries: name -> (builder(spark, sf_dir), DuckDB SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import chat_threads, exact_dedup, mixing, packing, quality_classifier, quality_rules, simhash, substring_dedup, token_counts, url_filter, warc, whitening, word_runs
from ledgerline.llm.common import scratch, stage, table


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.piece_digests(packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path, min_bytes=0)
    return warc.check_revisits(stage(warc.read_archives(spark, path).drop("payload", "url"), "warc-records"))


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = url_filter.train(url_filter.labelled_urls(spark))
    return url_filter.judge(table(spark, sf_dir, "pages"), model)


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("fired")


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).drop("source")


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_dedup(table(spark, sf_dir, "documents"), size=35, with_text=False)


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_threads.linked(table(spark, sf_dir, "conversations"))


def op10_chat_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_threads.conversations(op10_chat_formatting(spark, sf_dir))


def quoting_messages(messages: DataFrame) -> DataFrame:
    """The given messages as replies, by rule: two of three quote the message before
    whole, and one of those a nested quotation of the first line of the one before that."""
    key, quoted = ["conv_id", "turn"], lambda text, mark: F.concat(F.lit(mark), F.replace(text, F.lit("\n"), F.lit("\n" + mark)))
    text = F.coalesce(F.col("text"), F.lit(""))
    before = messages.select("conv_id", (F.col("turn") + 1).alias("turn"), text.alias("before"))
    earlier = messages.select("conv_id", (F.col("turn") + 2).alias("turn"), F.substring_index(text, "\n", 1).alias("earlier"))
    joined = messages.join(before, key, "left").join(earlier, key, "left")
    parts = [F.when(F.col("turn") % 3 == 2, quoted(F.col("earlier"), "> > ")), F.when(F.col("turn") % 3 > 0, quoted(F.col("before"), "> ")), text]
    return joined.select("conv_id", "turn", "role", F.concat_ws("\n", *parts).alias("text"))


def op10_quoting_threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_threads.linked(quoting_messages(table(spark, sf_dir, "conversations")))


QUOTING_SQL = chat_threads.SQL.replace("WITH RECURSIVE ", """WITH RECURSIVE replies AS (
  SELECT m.conv_id, m.turn, m.role, concat_ws(chr(10),
    CASE WHEN m.turn % 3 = 2 THEN '> > ' || string_split(coalesce(e.text, ''), chr(10))[1] END,
    CASE WHEN m.turn % 3 > 0 THEN '> ' || array_to_string(string_split(coalesce(b.text, ''), chr(10)), chr(10) || '> ') END, coalesce(m.text, '')) AS text
  FROM conversations m LEFT JOIN conversations b ON b.conv_id = m.conv_id AND b.turn + 1 = m.turn
  LEFT JOIN conversations e ON e.conv_id = m.conv_id AND e.turn + 2 = m.turn),
""", 1).replace("FROM conversations)", "FROM replies)", 1)


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=1024)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = word_runs.planted(table(spark, sf_dir, "documents"))
    return word_runs.digests(word_runs.word_runs(docs, min_length=24, min_exponent=3))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A deviation beyond a long is null in `deviation`; `deviation_exact` has it.
    white = whitening.whiten(table(spark, sf_dir, "embeddings"), count=8, scale=1024)
    return white.withColumnRenamed("deviation", "deviation_exact").withColumn("deviation", F.col("deviation_exact").try_cast("long"))


QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {
    "op1_simhash_near_dedup": (op1_simhash_near_dedup, None),
    "op2_packing": (op2_packing, None),
    "op3_warc": (op3_warc, None),
    "op4_url_filters": (op4_url_filters, None),
    "op5_quality_rules": (op5_quality_rules, quality_rules.SQL),
    "op6_exact_dedup": (op6_exact_dedup, exact_dedup.SQL),
    "op7_mixing": (op7_mixing, mixing.SQL),
    "op8_substring_dedup": (op8_substring_dedup, substring_dedup.SQL),
    "op9_quality_classifier": (op9_quality_classifier, None),
    "op10_chat_formatting": (op10_chat_formatting, chat_threads.SQL),
    "op10_chat_conversations": (op10_chat_conversations, chat_threads.CONVERSATIONS_SQL),
    "op10_quoting_threads": (op10_quoting_threads, QUOTING_SQL),
    "op11_token_counts": (op11_token_counts, None),
    "op12_periodic_runs": (op12_periodic_runs, None),
    "op13_embedding_whitening": (op13_embedding_whitening, None),
}
