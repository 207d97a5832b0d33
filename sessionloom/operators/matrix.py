"""Evidence, matrices, patches and citations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sessionloom.functions.scalars import value_class


def latest(df: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """Of rows with the same key the one with the latest version; ties go to the greatest row."""
    rest = [c for c in df.columns if c not in (*keys, version)]
    row = F.max(F.struct(version, *rest)).alias("__row")
    return df.groupBy(*keys).agg(row).select(*keys, *(F.col(f"__row.{c}").alias(c) for c in (*rest, version)))


def pivot_values(df: DataFrame, rows: str, columns: str, value: str, names: Sequence[str]) -> DataFrame:
    """One row per ``rows`` with a column per name of ``columns``; the largest value stands where there are several."""
    return df.groupBy(rows).pivot(columns, list(names)).agg(F.max(value))


def distinct_names(df: DataFrame, columns: str, most: int = 1_000) -> list[str]:
    """All values of ``columns`` in order, for a pivot that leaves none out; more than ``most`` or a NULL are refused."""
    names = [r[0] for r in df.select(columns).distinct().limit(most + 1).collect()]
    if len(names) > most:
        raise ValueError(f"{columns} has more than {most} values, too many for columns")
    if None in names:
        raise ValueError(f"{columns} is NULL in some rows, which have no column")
    return sorted(names)


def unpivot_values(df: DataFrame, keys: Sequence[str], columns: Sequence[str], name: str, value: str) -> DataFrame:
    """The wide table as (keys, name, value)."""
    return df.unpivot(list(keys), list(columns), name, value)


def all_missing(columns: Sequence[str]):
    """Whether every column is missing: NULL, '', -1 or Not reported."""
    return F.forall(F.array(*(F.trim(F.col(c).cast("string")) for c in columns)), lambda x: F.coalesce(x.isin("", "-1", "Not reported"), F.lit(True)))


def patch_cells(cells: DataFrame, patch: DataFrame, keys: Sequence[str], policy: str) -> DataFrame:
    """``cells`` (keys, value) with ``patch`` (keys, new_value) applied; patches without a cell are ignored.

    ``policy``: "always", "if_different" (the same result, with ``patched`` only where the value changed) or
    "if_missing".
    """
    joined = cells.join(patch.select(*keys, "new_value"), list(keys), "left")
    value = F.col("value")
    missing = value.isNull() | F.trim(value).isin("", "-1", "Not reported")
    wanted = {"always": F.lit(True), "if_different": ~value.eqNullSafe(F.col("new_value")), "if_missing": missing}[policy]
    patched = F.col("new_value").isNotNull() & wanted
    return joined.select(*[c for c in cells.columns if c != "value"], F.when(patched, F.col("new_value")).otherwise(value).alias("value"), patched.alias("patched"))


def cite_cells(cells: DataFrame, specific: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Cells with their specific citation, else the generic one of their class of value."""
    kind = value_class(F.col("value"))
    generic = F.when(kind == "missing", "not stated in the interview").when(kind == "yes_no", "stated in the interview").when(kind == "number", "counted in the interview").otherwise("summarised from the interview")
    return cells.join(specific.select(*keys, "citation"), list(keys), "left").withColumn("citation", F.coalesce("citation", generic))


def first_line_with(lines: DataFrame, terms: Sequence[str], key: str) -> DataFrame:
    """The first line of each document that holds one of the terms, letter case aside; "inferred" if none does."""
    hit = F.lit(False)
    for term in terms:
        hit = hit | F.lower("line").contains(term.lower())
    out = lines.groupBy(key).agg(F.min(F.when(hit, F.col("line_no"))).alias("line_no"))
    return out.withColumn("citation", F.coalesce(F.concat(F.lit("line "), F.col("line_no").cast("string")), F.lit("inferred")))


def fill_category(df: DataFrame, group: str, order: str, column: str) -> DataFrame:
    """``column`` filled down from the last row that states it."""
    view = Window.partitionBy(group).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(column, F.last(F.when(F.trim(column) != "", F.col(column)), ignorenulls=True).over(view))


def banner_rows(df: DataFrame, group: str, order: str, column: str) -> DataFrame:
    """Rows at which ``column`` changes: where a report puts a banner."""
    before = F.lag(column).over(Window.partitionBy(group).orderBy(order))
    return df.withColumn("__before", before).where(~F.col(column).eqNullSafe(F.col("__before"))).select(group, order, column)


def without_columns(df: DataFrame, positions: Sequence[int]) -> DataFrame:
    """The table without the columns at these places, from 0; places it hasn't are ignored."""
    return df.select(*(f"`{c}`" for i, c in enumerate(df.columns) if i not in positions))


def value_columns(df: DataFrame, ids: Sequence[str]) -> list[str]:
    """The columns that aren't identifiers, in their order."""
    return [c for c in df.columns if c not in ids]


def filtered_matrix(df: DataFrame, values: Sequence[str], category: str, order: Sequence[str], banner: str = "Not reported by any") -> DataFrame:
    """The matrix with the rows that state something first, then a banner row, then those that state nothing.

    ``section`` is 0, 1 or 2 in that order; within it the rows keep ``order``. There is no banner if no row is empty.
    """
    marked = df.withColumn("section", F.when(all_missing(values), 2).otherwise(0))
    head = marked.where("section = 2").limit(1).select(*(F.lit(banner if c == category else None).cast(t).alias(c) for c, t in df.dtypes), F.lit(1).alias("section"))
    return marked.unionByName(head).orderBy("section", *order)


def interleave(df: DataFrame, keys: Sequence[str], columns: Sequence[str], suffix: str = " (Citation)") -> DataFrame:
    """Columns with their citation column before each."""
    return df.select(*keys, *(c for name in columns for c in (f"`{name}{suffix}`", f"`{name}`")))
