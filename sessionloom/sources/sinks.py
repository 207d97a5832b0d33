"""Sinks: cleaned texts, mappings, tags, summaries and gazetteer tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionloom import __version__
from sessionloom.operators.gazetteer import TABLES, typed
from sessionloom.operators.lines import join_lines


def write_texts(lines: DataFrame, path: str, key: str = "doc_id", folders: int = 1_000) -> None:
    """One row of Parquet per document (key, text), in at most ``folders`` folders by the hash of the key.

    A file per document doesn't scale; ``export_text`` gives the lines of one document.
    """
    texts = join_lines(lines, key).withColumn("part", F.pmod(F.xxhash64(key), F.lit(folders)))
    texts.repartition("part").write.mode("overwrite").partitionBy("part").parquet(path)


def export_text(spark: SparkSession, path: str, doc, out: str, key: str = "doc_id", folders: int = 1_000) -> None:
    """One document of ``write_texts`` as a text file; only its folder is read."""
    part = F.pmod(F.xxhash64(F.lit(doc)), F.lit(folders))
    spark.read.parquet(path).where((F.col("part") == part) & (F.col(key) == F.lit(doc))).select("text").coalesce(1).write.mode("overwrite").text(out)


def write_tags(tags: DataFrame, path: str) -> None:
    """Tags as CSV in order of category and line: a range partitioning, no single task."""
    named = tags.select(F.col("category").alias("Tag_Category"), F.col("line_no").alias("Line_Number"), F.col("matched").alias("Matched_Text"), F.col("context").alias("Context"))
    named.orderBy("Tag_Category", "Line_Number").write.mode("overwrite").csv(path, header=True, quoteAll=True)


def write_json(rows: DataFrame, path: str) -> None:
    """Rows as JSON lines: mappings, grades, summaries, status."""
    rows.write.mode("overwrite").json(path)


def mapping_rows(codes: DataFrame, variants: DataFrame, citations: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per document: a map per kind, name variants by canonical name, the citation table, counts and version.

    ``codes`` (key, kind, surface, code), ``variants`` (key, canonical, surface), ``citations`` (key, citation, ts,
    speaker).
    """
    kinds = {"persons": "person", "organizations": "organization", "locations": "location", "tribes": "tribe"}
    entry = lambda kind: F.map_from_entries(F.array_sort(F.collect_set(F.when(F.col("kind") == kind, F.struct("surface", "code")))))
    maps = codes.groupBy(key).agg(*(entry(kind).alias(name) for name, kind in kinds.items()), F.count("*").alias("surfaces"))
    named = variants.groupBy(key, "canonical").agg(F.array_sort(F.collect_set("surface")).alias("surfaces"))
    named = named.groupBy(key).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("canonical", "surfaces")))).alias("name_variants"))
    cited = citations.groupBy(key).agg(F.map_from_entries(F.array_sort(F.collect_set(F.struct("citation", F.struct(F.coalesce("ts", F.lit("N/A")).alias("timestamp"), F.col("speaker").alias("speaker_role")))))).alias("citations"))
    return maps.join(named, key, "left").join(cited, key, "left").withColumn("version", F.lit(__version__))


def write_gazetteer(tables: Mapping[str, DataFrame], path: str) -> None:
    """The lookup tables as Parquet in their columns and types, one folder each; other tables as they are."""
    for name, df in tables.items():
        (typed(df, name) if name in TABLES else df).write.mode("overwrite").parquet(f"{path}/{name}")


def write_matrix(df: DataFrame, path: str, title: Sequence[str] = ()) -> None:
    """A matrix as one CSV file for people, after optional title lines; the caller keeps it small."""
    rows = df.select(F.to_csv(F.struct(*(F.col(f"`{c}`").cast("string") for c in df.columns))).alias("value"))
    head = [",".join(title)] * bool(title) + [",".join(df.columns)]
    spark = df.sparkSession
    spark.createDataFrame([(h,) for h in head], "value string").coalesce(1).union(rows.coalesce(1)).coalesce(1).write.mode("overwrite").text(path)
