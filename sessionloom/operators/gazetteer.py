"""Gazetteers: union of sources, first-wins deduplication, ranks, insert-if-absent and lookups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionloom.functions.scalars import split_terms
from sessionloom.session import broadcast_if_small, number_rows

#: Columns and unique keys of the six lookup tables.
TABLES = {
    "native_american_names": (["first_name", "last_name", "gender", "tribe_origin", "source"], ["first_name", "last_name"], ["first_name"]),
    "place_names": (["name", "type", "state", "tribal_affiliation", "source"], ["name", "type", "state"], ["name", "type"]),
    "ambiguous_names": (["name", "is_primarily_place", "context_hints", "source"], ["name"], ["name"]),
    "tribal_place_names": (["name", "type", "tribe", "state", "source"], ["name", "type", "tribe"], ["name", "type"]),
    "common_first_names": (["name", "frequency_rank", "source"], ["name"], ["name"]),
    "common_last_names": (["name", "frequency_rank", "source"], ["name"], ["name"]),
}


def place_records(df: DataFrame, name: str, kind: str, tribe: str, state: str, source: str) -> DataFrame:
    """Rows in the five columns of a place record; a missing kind is ``unknown``."""
    return df.select(F.col(name).alias("name"), F.coalesce(F.col(kind), F.lit("unknown")).alias("type"), F.col(tribe).alias("tribe"), F.col(state).alias("state"), F.col(source).alias("source"))


def union_sources(sources: Sequence[DataFrame]) -> DataFrame:
    """All rows of the sources with ``source_no``, their place in the sequence; an earlier one is preferred."""
    return reduce(DataFrame.unionByName, [df.withColumn("source_no", F.lit(i)) for i, df in enumerate(sources)])


def first_wins(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Of rows equal in ``keys`` (letter case aside, NULLs equal) the one that comes first in ``order``.

    The smallest row is found by aggregation, which combines before the shuffle, so a key that holds a third of all
    rows is reduced in place.
    """
    wanted = [F.lower(k).alias(f"__{k}") if dict(df.dtypes)[k] == "string" else F.col(k).alias(f"__{k}") for k in keys]
    row = F.min_by(F.struct(*df.columns), F.struct(*order)).alias("__row")
    return df.groupBy(*wanted).agg(row).select("__row.*")


def frequency_rank(df: DataFrame, name: str, count: str) -> DataFrame:
    """(name, total, frequency_rank) by falling total; ties go to the name that comes first."""
    totals = df.groupBy(name).agg(F.sum(count).alias("total"))
    return number_rows(totals, [F.desc("total"), F.col(name)], "frequency_rank")


def top_ranked(df: DataFrame, name: str, count: str, most: int = 200) -> DataFrame:
    """The ``most`` most frequent names: a top-k, not a full sort."""
    return df.groupBy(name).agg(F.sum(count).alias("total")).orderBy(F.desc("total"), name).limit(most)


def insert_if_absent(existing: DataFrame, new: DataFrame, keys: Sequence[str], required: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(inserted, rejected): new rows whose key isn't there yet, one per key; rows that lack a required value."""
    missing = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in required])
    fresh = new.where(~missing).dropDuplicates(list(keys)).alias("n")
    same = reduce(lambda a, b: a & b, [F.col(f"n.{k}").eqNullSafe(F.col(f"e.{k}")) for k in keys])
    return fresh.join(existing.select(*keys).distinct().alias("e"), same, "left_anti"), new.where(missing)


def with_flag(df: DataFrame, value, lookup: DataFrame, column: str, flag: str, ignore_case: bool = False) -> DataFrame:
    """``df`` with a boolean ``flag``: whether ``value`` is in ``lookup[column]``."""
    known = lookup.select((F.lower(column) if ignore_case else F.col(column)).alias("__known")).where("__known is not null").distinct()
    key = F.lower(value) if ignore_case else value
    joined = df.withColumn("__key", key).join(broadcast_if_small(known), F.col("__key") == F.col("__known"), "left")
    return joined.withColumn(flag, F.col("__known").isNotNull()).drop("__key", "__known")


def tribe_terms(columns: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    """Distinct lower-case terms of the columns and their parts of three letters or more."""
    values = reduce(DataFrame.unionByName, [df.select(F.lower(F.trim(c)).alias("term")) for df, c in columns]).where("term is not null and term <> ''").distinct()
    parts = values.select(F.explode(split_terms(F.col("term"))).alias("term")).where(F.length("term") >= 3)
    return values.unionByName(parts).distinct()


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows by table, 0 for empty ones, and their total as table NULL; every table is counted before the union."""
    counted = reduce(DataFrame.unionByName, [df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows") for name, df in tables.items()])
    return counted.rollup("table_name").agg(F.sum("n_rows").alias("n_rows"))


def flatten_places(df: DataFrame, name: str, states: str, key: str) -> DataFrame:
    """(key, place, state): each record's names crossed with its locations; a NULL state takes the record's first one."""
    places = df.select(key, F.explode_outer(name).alias("place"), states)
    rows = places.select(key, "place", F.posexplode_outer(states).alias("pos", "state"))
    first = F.first("state", ignorenulls=True).over(Window.partitionBy(key).orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return rows.select(key, "place", F.coalesce("state", first).alias("state"))


# Last words of a reservation's or community's name, names of states that may end it.
HOLDINGS = ("Reservation", "Rancheria", "Pueblo", "Colony", "Community", "Village")


def places_in_name(name: Column, states: Sequence[str] = ()) -> Column:
    """Places that the name of a nation states: what comes before a word of ``HOLDINGS``, "of the X", and a last state.

    Distinct, in that order; a name without any gives an empty array.
    """
    capital = r"(?:[A-Z][\w'-]*(?: [A-Z][\w'-]*)*)"
    held = F.regexp_extract_all(name, F.lit(rf"({capital}) (?:{'|'.join(HOLDINGS)})(?:[^\w]|$)"), F.lit(1))
    river = F.regexp_extract_all(name, F.lit(rf" of (?:the )?({capital})"), F.lit(1))
    last = F.regexp_extract(name, r", (" + "|".join(states) + r")$", 1) if states else F.lit("")
    found = F.array_distinct(F.concat(held, river, F.when(last != "", F.array(last)).otherwise(F.array().cast("array<string>"))))
    return F.coalesce(found, F.array().cast("array<string>"))


def typed(df: DataFrame, name: str) -> DataFrame:
    """``df`` in the columns and types of a lookup table; missing columns are NULL."""
    kinds = {"is_primarily_place": "boolean", "context_hints": "array<string>", "frequency_rank": "long"}
    columns, _, _ = TABLES[name]
    return df.select(*((F.col(c) if c in df.columns else F.lit(None)).cast(kinds.get(c, "string")).alias(c) for c in columns))


def build_table(name: str, sources: Sequence[DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(table, rejected): the rows of the sources in the columns of lookup table ``name``, one per key.

    Keys ignore letter case and treat NULLs as equal; the earlier source wins, in it the first row by its values. Rows
    that lack a required column are rejected with their source.
    """
    columns, keys, required = TABLES[name]
    merged = union_sources([typed(df, name) for df in sources])
    missing = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in required])
    kept = first_wins(merged.where(~missing), keys, ["source_no", *(c for c in columns if c != "context_hints")])
    return kept.select(*columns), merged.where(missing).select(*columns)


def first_filled(sources: Sequence[DataFrame]) -> DataFrame:
    """The first of the sources that has a row; the last one if none has."""
    return next((df for df in sources[:-1] if not df.isEmpty()), sources[-1])


def build_gazetteer(names: Sequence[DataFrame], places: Sequence[DataFrame], tribal: Sequence[DataFrame], ambiguous: Sequence[DataFrame], first_names: Sequence[DataFrame], last_names: Sequence[DataFrame], tribes: Sequence[tuple[DataFrame, str]]) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """(tables, rejects): the six lookup tables and the terms of nations, each from its sources in order of preference.

    Sources are read once. The common names are those of the first source that has any; names of nations, which are no
    person's, go to ``tribes`` rather than being lost.
    """
    sources = {"native_american_names": names, "place_names": places, "ambiguous_names": ambiguous, "tribal_place_names": tribal, "common_first_names": [first_filled(first_names)], "common_last_names": [first_filled(last_names)]}
    built = {name: build_table(name, frames) for name, frames in sources.items()}
    tables = {name: table for name, (table, _) in built.items()} | {"tribes": tribe_terms(tribes)}
    return tables, {name: rejected for name, (_, rejected) in built.items()}


def with_totals(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows by table and their total, as ``table_counts``."""
    return table_counts(dict(tables))


def frequent_and_native(top: DataFrame, native: DataFrame, name: str) -> DataFrame:
    """The first names of both lists one after the other, with repeats."""
    return top.select(F.col(name).alias("name")).unionAll(native.select(F.col(name).alias("name")))
