"""Transcripts that arrive as files: a stream of lines tagged by micro-batch, with progress."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sessionloom.operators.progress import STATUS
from sessionloom.operators.tagging import lexicon_hits


def line_stream(spark: SparkSession, folder: str, files_per_batch: int = 100) -> DataFrame:
    """Lines of text files as they arrive: (doc_id, line)."""
    raw = spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(folder)
    return raw.select(F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(?:\.[^.]*)?$", 1).alias("doc_id"), F.col("value").alias("line"))


def tag_stream(lines: DataFrame, lexicon: Sequence[tuple[str, str]], out: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Tags of arriving lines appended to Parquet; exactly once through the checkpoint."""
    tags = lexicon_hits(lines, lexicon)
    writer = tags.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="1 second")).start()


def marker_counts(lines: DataFrame, marker: str = "Processing:") -> DataFrame:
    """Running number of marker lines per file and the last position ``[x/y]`` reported."""
    progress = F.regexp_extract("line", r"PROGRESS: \[(\d+)/\d+\]", 1)
    return lines.groupBy("doc_id").agg(F.count_if(F.col("line").contains(marker)).alias("markers"), F.max(F.when(progress != "", progress.cast("long"))).alias("progress"))


def status_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Status records as files of them arrive; a file written again under a new name brings new records."""
    return spark.readStream.schema(STATUS).json(folder)


def watch_status(records: DataFrame, out: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """The latest record of each job, kept as a table that each micro-batch renews.

    The state is one record per job; a record older than the one held changes nothing.
    """
    latest = records.where("job is not null").groupBy("job").agg(F.max_by(F.struct("phase", "percent", "eta", "stamp"), "stamp").alias("r")).select("job", "r.*")

    def renew(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite").parquet(out)

    writer = latest.writeStream.outputMode("complete").option("checkpointLocation", checkpoint).foreachBatch(renew)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="1 second")).start()
