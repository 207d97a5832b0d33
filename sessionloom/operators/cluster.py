"""Greedy clusters of name variants in order of appearance, within a document."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from sessionloom.operators.components import components
from sessionloom.session import cut, spread


def similarity(a: str, b: str) -> float:
    """Ratcliff/Obershelp similarity, letter case aside."""
    return SequenceMatcher(None, a.lower(), b.lower()).ratio()


# Weights of first name, last name and whole, the likeness of first names from which they count, and the
# least similarity of one cluster where the first names are equal, where the context is shared, and otherwise.
FIRST_WEIGHT, LAST_WEIGHT, WHOLE_WEIGHT, LIKE_FIRST = 0.4, 0.4, 0.2, 0.7
SAME_FIRST, SAME_CONTEXT, NOTHING_SHARED = 0.50, 0.55, 0.75


def name_similarity(a: str, b: str) -> float:
    """Similarity of names; parts count apart where both have two words and like first names."""
    whole = similarity(a, b)
    x, y = a.split(), b.split()
    if len(x) > 1 and len(y) > 1 and (first := similarity(x[0], y[0])) >= LIKE_FIRST:
        return max(whole, FIRST_WEIGHT * first + LAST_WEIGHT * similarity(x[-1], y[-1]) + WHOLE_WEIGHT * whole)
    return whole


def similar_names(name: str, others: list[str], least: float = 0.75) -> list[str]:
    """Names at least so similar."""
    return [o for o in others if similarity(name, o) >= least]


@pandas_udf(T.DoubleType())
def similarity_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([similarity(x, y) if isinstance(x, str) and isinstance(y, str) else None for x, y in zip(a, b, strict=True)], dtype="float64")


def threshold(a: str, b: str, shared_context: bool = False) -> float:
    """The least similarity for one cluster: lower where the first of two words are equal or the context is shared."""
    x, y = a.lower().split(), b.lower().split()
    if len(x) > 1 and len(y) > 1 and x[0] == y[0]:
        return SAME_FIRST
    return SAME_CONTEXT if shared_context else NOTHING_SHARED


def greedy_clusters(names: list[str]) -> list[int]:
    """The cluster of each name: the earlier one with the most similar member, if similar enough, else a new one."""
    clusters: list[list[str]] = []
    out = []
    for name in names:
        best, at = 0.0, -1
        for i, members in enumerate(clusters):
            for member in members:
                s = name_similarity(name, member)
                if s > best and s >= threshold(name, member):
                    best, at = s, i
        if at < 0:
            at = len(clusters)
            clusters.append([])
        clusters[at].append(name)
        out.append(at)
    return out


@pandas_udf(T.BooleanType())
def linked_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([name_similarity(x, y) >= threshold(x, y) for x, y in zip(a, b, strict=True)], dtype="bool")


def cluster_names(names: DataFrame, key: str, name: str, order: str) -> DataFrame:
    """(key, cluster, name, n, canonical): names of a document clustered in order of first appearance.

    The canonical name is the most frequent, the earliest of those tied. Names are compared if a word of one begins
    with the same two letters as a word of the other. As only similar names can fall into one cluster, the greedy rule
    runs within the components of the similar ones, so no task holds a document's names. ``cluster`` is the place of
    the cluster's first name in the order of its component, behind the component's number. NULL names are left out;
    names that differ in nothing are one.
    """
    distinct = names.where(F.col(name).isNotNull()).groupBy(F.col(key).alias("key"), F.col(name).alias("name")).agg(F.count("*").alias("n"), F.min(order).alias("first"))
    distinct = cut(distinct.withColumn("node", F.xxhash64("key", "name")))
    heads = F.array_distinct(F.transform(F.filter(F.split(F.lower(F.trim("name")), r"\s+"), lambda w: w != ""), lambda w: F.left(w, F.lit(2))))
    keyed = distinct.select("key", "node", "name", F.explode(heads).alias("head"))
    keyed = keyed.withColumn("size", F.count("*").over(Window.partitionBy("key", "head"))).where("size > 1").drop("size")
    a, b = keyed.withColumnsRenamed({"node": "a", "name": "x"}), keyed.withColumnsRenamed({"node": "b", "name": "y"})
    short = 2 * F.least(F.length("x"), F.length("y")) >= SAME_FIRST * (F.length("x") + F.length("y"))
    pairs = a.join(b, ["key", "head"]).where((F.col("a") < F.col("b")) & short).select("a", "b", "x", "y").distinct()
    label = components(spread(pairs, "a").where(linked_udf("x", "y")).select("a", "b"))
    grouped = distinct.join(label, "node", "left").withColumn("component", F.coalesce("component", "node"))
    alone = grouped.where(F.col("component") == F.col("node")).join(label.select("component").distinct(), "component", "left_anti")
    together = grouped.join(label.select("component").distinct(), "component", "left_semi")
    key_type = names.schema[key].dataType.simpleString()

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["first", "name"], ignore_index=True)
        group["place"] = greedy_clusters(group["name"].tolist())
        return group[["key", "component", "place", "name", "n", "first"]]

    schema = f"key {key_type}, component long, place long, name string, n long, first {distinct.schema['first'].dataType.simpleString()}"
    clustered = together.groupBy("key", "component").applyInPandas(run, schema).unionByName(alone.select("key", "component", F.lit(0).cast("long").alias("place"), "name", "n", "first"))
    clustered = cut(clustered.withColumn("cluster", F.concat_ws("-", "component", "place")))
    best = clustered.withColumn("rank", F.row_number().over(Window.partitionBy("key", "cluster").orderBy(F.desc("n"), "first", "name"))).where("rank = 1")
    out = clustered.join(best.select("key", "cluster", F.col("name").alias("canonical")), ["key", "cluster"])
    return out.select(F.col("key").alias(key), "cluster", F.col("name").alias(name), "n", "canonical")


def cluster_sizes(clusters: DataFrame, key: str) -> DataFrame:
    """Per document its clusters and the variants beside their canonical names."""
    return clusters.groupBy(key).agg(F.countDistinct("cluster").alias("clusters"), F.count_if(F.col("canonical").isNotNull()).alias("names")).withColumn("variants", F.col("names") - F.col("clusters"))
