"""Table access, the shared scratch folder and the size checks that guard every broadcast."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows and bytes of text a broadcast side may have at most; beyond either the callers shuffle instead.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 64 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table ``name`` of the folder ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``.

    Where that is unset a temporary folder is made, but only for a local session, whose executors are the driver; on a
    cluster the setting is required.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    if not context.getCheckpointDir():
        if not re.match(r"local(\[|$)", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="sessionloom-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage of ``df`` by a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only if ``df`` is counted to have at most ``limit`` rows of at most ``BROADCAST_BYTES`` in all.

    Otherwise the join is left to the planner. Columns of fixed width count 8 bytes.
    """
    size = reduce(lambda a, b: a + b, (F.coalesce(F.octet_length(f"`{c}`"), F.lit(0)) if kind in ("string", "binary") else F.lit(8) for c, kind in df.dtypes))
    counted = df.limit(limit + 1).agg(F.count("*").alias("n"), F.coalesce(F.sum(size), F.lit(0)).alias("size")).first()
    return F.broadcast(df) if counted["n"] <= limit and counted["size"] <= BROADCAST_BYTES else df


def spread(df: DataFrame, *columns: str) -> DataFrame:
    """Repartition ``df`` ahead of costly work per row, which the size of the data alone would leave to one task."""
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    return df.repartition(parts, *columns) if columns else df.repartition(parts)


def number_rows(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` with the position of each row in ``order``, from 1, without gathering the rows in one task.

    A range-partitioned sort numbers the rows of each partition; only the partitions' counts are brought together.
    """
    marked = cut(df.orderBy(*order).withColumn("__id", F.monotonically_increasing_id()))
    part = F.shiftright("__id", 33).alias("__part")
    before = F.coalesce(F.sum("count").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = marked.groupBy(part).count().select("__part", before.alias("__before"))
    numbered = marked.withColumn("__part", F.shiftright("__id", 33)).join(F.broadcast(offsets), "__part")
    local = F.col("__id") - F.shiftleft(F.col("__part"), 33)
    return numbered.withColumn(name, (F.col("__before") + local + 1).cast("long")).drop("__id", "__part", "__before")
