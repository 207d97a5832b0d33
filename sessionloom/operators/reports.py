"""What reports are made of: typed blocks of text, shown quotes, highlights, totals of runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def text_blocks(lines: DataFrame, key: str = "doc_id") -> DataFrame:
    """Non-blank lines with their ``block``; the first rule that fits decides.

    subsection ("1.2 Title"), section ("1. Title"), heading (capitals only), bullet (a list mark first), body.
    """
    line = F.trim("line")
    block = (
        F.when(line.rlike(r"^[0-9]+\.[0-9]+\.? +[^ ]"), "subsection")
        .when(line.rlike(r"^[0-9]+\. +[^ ]"), "section")
        .when((F.length(line) > 3) & (line == F.upper(line)) & line.rlike("[A-Z]"), "heading")
        .when(line.rlike(r"^[-*\u2022] "), "bullet")
        .otherwise("body")
    )
    return lines.where(line != "").select(key, "line_no", block.alias("block"), line.alias("line"))


def shown_quote(quote: Column) -> Column:
    """A quote for print: three points become an ellipsis."""
    return F.replace(quote, F.lit("..."), F.lit("\u2026"))


def position_note(interview: Column, excerpt: Column, position: Column) -> Column:
    """Where a quote stands, for its caption; an unknown place is left out."""
    at = F.when(position.isNotNull(), F.format_string(", character %d", position)).otherwise("")
    return F.concat(interview, F.format_string(", excerpt %d", excerpt), at)


def highlight(value: Column, classes: Sequence[tuple[str, Sequence[str]]]) -> Column:
    """The first class one of whose marks the value holds, "plain" if none does."""
    out = None
    for name, marks in classes:
        hit = F.lower(value).rlike("|".join(rf"\Q{m.lower()}\E" for m in marks))
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return F.lit("plain") if out is None else out.otherwise("plain")


def in_order(df: DataFrame, column: str, order: Sequence[str], *more: str) -> DataFrame:
    """Rows with ``position`` in a fixed order of one column's values, then by further columns; other values come last."""
    place = F.array_position(F.array(*(F.lit(x) for x in order)), F.coalesce(F.col(column), F.lit("")))
    place = F.when(place > 0, place).otherwise(len(order) + 1)
    return df.withColumn("position", F.row_number().over(Window.partitionBy(*(c for c in more[:1])).orderBy(place, column, *more[1:])).cast("long"))


def entity_counts(codes: DataFrame, key: str = "doc_id") -> DataFrame:
    """Per document: persons by distinct code, other kinds by distinct surface."""
    of = lambda kind, column: F.countDistinct(F.when(F.col("kind") == kind, F.col(column)))
    return codes.groupBy(key).agg(of("person", "code").alias("persons"), of("organization", "surface").alias("organizations"), of("location", "surface").alias("locations"), of("tribe", "surface").alias("tribes"))


def run_totals(summaries: DataFrame) -> DataFrame:
    """One row over all documents: how many, how many hold a person, and the sums of the counts."""
    return summaries.agg(F.count("*").alias("documents"), F.count_if(F.col("persons") > 0).alias("with_persons"), *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("persons", "organizations", "locations", "tribes", "tags")))


def last_line(lines: DataFrame, key: str = "doc_id") -> DataFrame:
    """The last non-blank line of each document."""
    return lines.where(F.trim("line") != "").groupBy(key).agg(F.max("line_no").alias("line_no"), F.max_by("line", "line_no").alias("line"))


def first_found(candidates: DataFrame, key: str, order: str, found: Column) -> DataFrame:
    """Of each key's candidates the first in order for which ``found`` holds; keys without one give no row."""
    row = F.min_by(F.struct(*[c for c in candidates.columns if c != key]), order).alias("__row")
    return candidates.where(found).groupBy(key).agg(row).select(key, "__row.*")


def best_scored(rows: DataFrame, key: str, score: str, *ties: str) -> DataFrame:
    """The row of the highest score of each key; ties go to the least of the further columns."""
    view = Window.partitionBy(key).orderBy(F.desc(score), *ties)
    return rows.withColumn("__rank", F.row_number().over(view)).where("__rank = 1").drop("__rank")


def join_by_stem(raw: DataFrame, cleaned: DataFrame, mapping: DataFrame, tags: DataFrame, path: str = "path") -> DataFrame:
    """Files of one transcript side by side: raw and cleaned are needed, mapping and tags may be missing.

    The stem is the file's name without folder, extension and the ending that tells its kind.
    """
    def by_stem(df: DataFrame, name: str, ending: str) -> DataFrame:
        stem = F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.[^.]*$", "")
        return df.select(F.regexp_replace(stem, ending + "$", "").alias("stem"), F.col(path).alias(name))

    out = by_stem(raw, "raw_path", "").join(by_stem(cleaned, "cleaned_path", "_deidentified"), "stem")
    return out.join(by_stem(mapping, "mapping_path", "_mapping"), "stem", "left").join(by_stem(tags, "tags_path", "_tags"), "stem", "left")
