"""Incremental landing with Structured Streaming.

The reference is batch-only; what streams naturally is the landing: new
CSV chunks arrive in a folder and must be parsed, stamped with lineage and
conformed.  Those steps (SRC-01..03, PRJ-01..08) are stateless row
transformations, so the batch operators run unchanged on a streaming
DataFrame.  The file sink + checkpoint give exactly-once output across
restarts and executor loss.  Trend windows are not streamed: they are
calendar-RANGE windows over the whole history, which Structured Streaming
does not support; rebuild them in batch from the landed table.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerline import fixed
from ledgerline.operators import conform
from ledgerline.params import Params
from ledgerline.sources.raw import CORRUPT, HEADER_SCHEMA_WITH_CORRUPT, with_lineage


def stream_raw(spark: SparkSession, landing_dir: str, max_files_per_trigger: int = 64) -> DataFrame:
    """readStream of landed CSV chunks under the raw contract; a chunk whose
    header differs from the contract stops the stream."""
    parsed = (spark.readStream.schema(HEADER_SCHEMA_WITH_CORRUPT)
            .option("header", True).option("enforceSchema", False).option("multiLine", True)
            .option("quote", '"').option("escape", '"')
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
            .option("maxFilesPerTrigger", max_files_per_trigger)
            .csv(landing_dir))
    return parsed.select(*[F.col(f"`{h}`").alias(n) for n, h in fixed.RAW_COLUMNS], CORRUPT, "_metadata")


def staged_stream(raw_stream: DataFrame, p: Params) -> DataFrame:
    """Accepted rows -> staging + completeness (stateless)."""
    ok = raw_stream.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
    return conform.with_completeness(conform.stage(ok, p))


def rejected_stream(raw_stream: DataFrame) -> DataFrame:
    """Rows the parser could not fit to the contract, as `raw.rejects`, with their load run."""
    return raw_stream.filter(F.col(CORRUPT).isNotNull()).select(
        F.col("source_file_name").alias("file"), F.col(CORRUPT).alias("raw_line"), "complaint_id", "load_run_id")


def start_rejects(spark: SparkSession, landing_dir: str, out_dir: str, checkpoint: str, p: Params,
                  source_url: str, retrieved_at: dt.datetime, run_id: str, available_now: bool = True) -> StreamingQuery:
    """The second sink of the landing: rejects, so that every landed row is in one of the two tables."""
    raw = with_lineage(stream_raw(spark, landing_dir), source_url, retrieved_at, p.snapshot_date, run_id)
    w = (rejected_stream(raw).writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint).option("path", out_dir))
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")).start()


def start_landing(spark: SparkSession, landing_dir: str, out_dir: str, checkpoint: str, p: Params,
                  source_url: str, retrieved_at: dt.datetime, run_id: str,
                  available_now: bool = True) -> StreamingQuery:
    """Land new chunks into a parquet staging table (append, exactly-once)."""
    raw = with_lineage(stream_raw(spark, landing_dir), source_url, retrieved_at, p.snapshot_date, run_id)
    w = (staged_stream(raw, p).writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint).option("path", out_dir))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
