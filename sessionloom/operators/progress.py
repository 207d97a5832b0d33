"""Progress of long jobs: weighted stages, time left, the status record and its readers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionloom.functions.scalars import hhmmss, time_left

STATUS = "job string, phase string, done long, total long, seconds double, percent double, eta string, stamp timestamp"


def running_share(events: DataFrame, job: str, order: str, share: str) -> DataFrame:
    """``events`` with ``shown``: the highest share reported so far, held between 0 and 1."""
    view = Window.partitionBy(job).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return events.withColumn("shown", F.max(F.least(F.greatest(F.col(share), F.lit(0.0)), F.lit(1.0))).over(view))


def weighted_progress(stages: DataFrame, job: str, stage: str, share: str, weights: Mapping[str, float]) -> DataFrame:
    """Per job the share done over all stages by their weights; a stage without a report counts as not begun."""
    total = sum(weights.values())
    weight = F.create_map(*(F.lit(x) for name, w in weights.items() for x in (name, float(w))))
    best = stages.groupBy(job, stage).agg(F.max(F.least(F.greatest(F.col(share), F.lit(0.0)), F.lit(1.0))).alias("__share"))
    return best.groupBy(job).agg(F.coalesce(F.sum(F.col("__share") * weight[F.col(stage)] / total), F.lit(0.0)).alias("progress"))


def status_rows(reports: DataFrame) -> DataFrame:
    """Status records of reports (job, phase, done, total, seconds, stamp): percentage and time left, for ``write_json``."""
    percent = F.when(F.col("total") > 0, F.least(F.greatest(100.0 * F.col("done") / F.col("total"), F.lit(0.0)), F.lit(100.0))).otherwise(0.0)
    return reports.select("job", "phase", "done", "total", "seconds", percent.alias("percent"), hhmmss(time_left(F.col("done"), F.col("total"), F.col("seconds"))).alias("eta"), "stamp")


def latest_status(records: DataFrame, now: Column, stale: float = 5.0) -> DataFrame:
    """Per job its last record, and whether that is more than ``stale`` seconds old at ``now``."""
    last = records.where("job is not null").groupBy("job").agg(F.max_by(F.struct("phase", "done", "total", "percent", "eta", "stamp"), "stamp").alias("r")).select("job", "r.*")
    age = now.cast("double") - F.col("stamp").cast("double")
    return last.withColumn("stale", F.coalesce(age > stale, F.lit(True)))


def stage_markers(lines: DataFrame, key: str = "doc_id") -> DataFrame:
    """Per document and stage the furthest "PROGRESS: [x/y] stage" that its lines report."""
    pattern = r"PROGRESS: \[(\d+)/(\d+)\]\s*(.*)$"
    at, of = (F.regexp_extract("line", pattern, i).try_cast("long") for i in (1, 2))
    found = lines.where(F.col("line").rlike(pattern)).select(key, F.trim(F.regexp_extract("line", pattern, 3)).alias("stage"), at.alias("done"), of.alias("total"))
    return found.groupBy(key, "stage").agg(F.max("done").alias("done"), F.max("total").alias("total"))
