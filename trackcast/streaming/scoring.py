"""Request scoring as a Structured Streaming query (S9 + L1 + L5 on a stream).

The original scorer reads ``artist;title`` lines from a console until EOF and
answers them one Spark job per request.  Here requests are text files that
land in a folder; each micro-batch is parsed (bad lines dropped), left-joined
to the per-level match statistics (a static, pre-aggregated table written
once to the checkpoint folder: stream-static joins, no state), run through
the forest, and appended to a Parquet sink.  The sink and the query
checkpoint make the output exactly-once across restarts and lost executors.

AQE does not re-plan inside micro-batches, so a batch's size is bounded with
``max_files_per_trigger``; the statistics table is broadcast by its stored
size when small, otherwise joined by shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.lookup import global_values, resolve_with_statistics
from ..plans.scoring import score_resolved
from ..sources.delimited import parse_requests


def request_stream(spark: SparkSession, folder: str, sep: str = ";",
                   max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    lines = reader.load(folder)
    return parse_requests(lines, sep).withColumn("received_at", F.current_timestamp())


def fallback_row(stats: DataFrame, averages: DataFrame | None = None) -> Column:
    """The global fallback as literals (one row of four numbers)."""
    row = global_values(stats, averages).first()
    if row is None:
        raise ValueError("no fallback: the match statistics come from an empty feature table, "
                         "and no averages are given")
    return F.struct(*[F.lit(row[c]).alias(c) for c in row.asDict()])


def score_stream(requests: DataFrame, stats: DataFrame, fallback: Column, model) -> DataFrame:
    return score_resolved(resolve_with_statistics(requests, stats, fallback), model)


def start_scoring(spark: SparkSession, requests_folder: str, stats: DataFrame, model,
                  out_path: str, checkpoint: str,
                  averages: DataFrame | None = None, available_now: bool = False,
                  processing_time: str = "10 seconds",
                  max_files_per_trigger: int | None = None) -> StreamingQuery:
    """``stats``: written match statistics; ``checkpoint``: the query's own folder, the
    same on every start (another one would number its batches from 0 again, and the
    sink would take new requests for batches that it has)."""
    fallback = fallback_row(stats, averages)
    requests = request_stream(spark, requests_folder, max_files_per_trigger=max_files_per_trigger)
    scored = score_stream(requests, stats, fallback, model)
    writer = (scored.writeStream.format("parquet").outputMode("append")
              .option("path", out_path)
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime=processing_time)
    return writer.start()
