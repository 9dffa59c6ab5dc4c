"""Streaming ingestion of SAM text.

The reference has no streaming engine (one batch job). Parsing and the
primary-contig filter are stateless per line, so the same DataFrame
functions run unchanged on ``readStream.text``: new chunk files dropped into
a folder become parsed, filtered reads appended to a Parquet table. The
dictionary join is a stream-static broadcast join. Fault tolerance comes
from the query's checkpoint location (a shared folder on a cluster).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import filters
from ..sources import sam


def stream_reads(spark: SparkSession, folder: str, contigs: DataFrame,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame of parsed reads from SAM text files landing in ``folder``."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return sam.parse_sam_lines(reader.load(folder), contigs)


def stream_primary_reads(spark: SparkSession, folder: str, contigs: DataFrame) -> DataFrame:
    """Parsed reads kept for calling (mapped, chr1..chrY)."""
    return filters.keep_primary_contigs(stream_reads(spark, folder, contigs))


def start_ingest(reads: DataFrame, out_path: str, checkpoint: str, available_now: bool = True):
    """Append parsed reads to Parquet; ``available_now`` processes what is there and stops."""
    writer = (reads.writeStream.format("parquet").option("path", out_path)
              .option("checkpointLocation", checkpoint).outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()
