"""Keyword coverage of survey questions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def question_hits(texts: DataFrame, key: str, text: str, questions: Mapping[str, Sequence[str]]) -> DataFrame:
    """(key, question, hits): how many keywords of each question occur in the text as substrings."""
    low = F.lower(F.coalesce(F.col(text), F.lit("")))
    rows = [F.struct(F.lit(q).alias("question"), sum((low.contains(k).cast("long") for k in keywords), F.lit(0).cast("long")).alias("hits")) for q, keywords in questions.items()]
    return texts.select(key, F.explode(F.array(*rows)).alias("q")).select(key, "q.*")


def coverage_level(hits, high: int = 3, medium: int = 1, low: str = "NONE"):
    """HIGH, MEDIUM or the lowest level by the number of hits."""
    return F.when(hits >= high, "HIGH").when(hits >= medium, "MEDIUM").otherwise(low)


@dataclass(frozen=True)
class Rule:
    """Least hits for HIGH and for MEDIUM, the lowest level, and keywords one of which alone makes a question HIGH."""

    high: int = 3
    medium: int = 1
    low: str = "NONE"
    decisive: tuple[str, ...] = ()


def rule_levels(texts: DataFrame, key: str, text: str, questions: Mapping[str, Sequence[str]], rules: Mapping[str, Rule]) -> DataFrame:
    """(key, question, hits, level): each question's level by its own rule, ``Rule()`` where it has none."""
    low = F.lower(F.coalesce(F.col(text), F.lit("")))
    rows = []
    for question, keywords in questions.items():
        rule = rules.get(question, Rule())
        hits = sum((low.contains(k).cast("long") for k in keywords), F.lit(0).cast("long"))
        decisive = reduce(lambda a, b: a | b, (low.contains(k) for k in rule.decisive), F.lit(False))
        level = F.when(decisive, "HIGH").otherwise(coverage_level(hits, rule.high, rule.medium, rule.low))
        rows.append(F.struct(F.lit(question).alias("question"), hits.alias("hits"), level.alias("level")))
    return texts.select(key, F.explode(F.array(*rows)).alias("q")).select(key, "q.*")


def level_table(levels: DataFrame, row: str, column: str, names: Sequence[str]) -> DataFrame:
    """Question by interview: the best level of each cell."""
    rank = F.when(F.col("level") == "HIGH", 2).when(F.col("level") == "MEDIUM", 1).otherwise(0)
    best = levels.groupBy(row).pivot(column, list(names)).agg(F.max(rank))
    sign = lambda c: F.when(F.col(f"`{c}`") == 2, "HIGH").when(F.col(f"`{c}`") == 1, "MEDIUM").otherwise("NONE").alias(c)
    return best.select(row, *(sign(n) for n in names))


def level_rates(levels: DataFrame, row: str) -> DataFrame:
    """Per question the number of each level and the share covered."""
    out = levels.groupBy(row).agg(F.count_if(F.col("level") == "HIGH").alias("high"), F.count_if(F.col("level") == "MEDIUM").alias("medium"), F.count("*").alias("total"))
    return out.withColumn("coverage", F.when(F.col("total") > 0, (F.col("high") + F.col("medium")) / F.col("total")))
