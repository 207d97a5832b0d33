"""Differences between copies of one dataset.

Every row is hashed by its key into a bucket of bounded size. Within a bucket the distinct keys of all copies get
shared ordinals; each copy's presence is a compressed bitmap over those ordinals. AND-NOT of two bitmaps yields the
rows one side lacks; the ordinals of their intersection put the columns of both sides in the same order, and the
columns are compared as whole Arrow vectors.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionloom.functions.bitmaps import and_not, from_ordinals, intersection, to_ordinals

#: Values that stand for "missing".
MISSING = ("", "-1", "Not reported")
_EDGES = r"^[\s\p{Z}\x{85}]+|[\s\p{Z}\x{85}]+$"
_NUMBER = r"^[+-]?(\d{1,3}(,\d{3})+|\d+)(\.\d*)?$"


def canonical_value(value: Column) -> Column:
    """One spelling for values that count as equal: trimmed, numbers in plain decimal form, missing ones NULL.

    Letter case and inner white space are part of the value; ``1,200``, ``1200`` and ``1200.0`` are one number.
    """
    text = F.regexp_replace(value.cast("string"), _EDGES, "")
    number = F.regexp_replace(text, "[,+]", "")
    number = F.regexp_replace(number, r"^(-?)0+(?=\d)", "$1")
    number = F.regexp_replace(number, r"(\.\d*?)0+$", "$1")
    number = F.regexp_replace(number, r"\.$", "")
    number = F.when(number == "-0", F.lit("0")).otherwise(number)
    text = F.when(text.rlike(_NUMBER), number).otherwise(text)
    return F.when(text.isin(*MISSING), F.lit(None).cast("string")).otherwise(text)


def without_item_number(value: Column) -> Column:
    """The text without a leading item number and its point or bracket."""
    return F.regexp_replace(value, r"^[\s\p{Z}]*\(?\d+[.)]+(?=[\s\p{Z}]|\D)", "")


def diff_copies(
    base: DataFrame,
    copies: Mapping[str, DataFrame],
    keys: Sequence[str],
    fields: Mapping[str, Sequence[str]],
    version: str,
    prepare: Mapping[tuple[str, str], object] | None = None,
    bucket_rows: int = 20_000,
) -> DataFrame:
    """Rows that one side lacks and fields whose values differ, for each copy against ``base``.

    ``fields`` names per copy the fields to compare; ``prepare`` maps ``(copy, field)`` to a function on the column
    applied before comparison. Of rows with the same key the one with the latest ``version`` stands; rows tied on it
    are decided by their values, the greatest first, so the result does not depend on the order of the rows. A NULL
    version is the oldest, a NULL key part equals NULL, empty tables give rows missing on their side, columns other
    than those named are not read. Result: ``copy_name``, the keys, ``field_name``, ``diff_kind``, ``base_value`` and
    ``copy_value`` (canonical values, NULL where missing).

    ``bucket_rows`` bounds the rows sent to one task's batch; the number of buckets follows the counted input.
    """
    prepare = prepare or {}
    names = list(copies)
    every = list(dict.fromkeys(f for name in names for f in fields[name]))
    sides = [("", base), *copies.items()]
    key_names = [f"__k{i}" for i in range(len(keys))]
    value_names = [f"__v{i}" for i in range(len(every))]

    def side(number: int, name: str, df: DataFrame) -> DataFrame:
        own = every if not name else fields[name]
        values = [
            canonical_value(prepare.get((name, f), lambda c: c)(F.col(f"`{f}`"))).alias(v) if f in own else F.lit(None).cast("string").alias(v)
            for f, v in zip(every, value_names, strict=True)
        ]
        return df.select(
            F.lit(number).cast("int").alias("__side"),
            *(F.col(f"`{k}`").alias(n) for k, n in zip(keys, key_names, strict=True)),
            F.col(f"`{version}`").alias("__version"),
            *values,
        )

    rows = side(0, *sides[0])
    for number, (name, df) in enumerate(sides[1:], 1):
        rows = rows.unionByName(side(number, name, df))
    buckets = max(1, -(-sum(df.count() for _, df in sides) // bucket_rows))

    latest = (
        rows.groupBy(*key_names, "__side")
        .agg(F.max(F.struct("__version", *value_names)).alias("__row"))
        .select("__side", *key_names, *(F.col(f"__row.{v}").alias(v) for v in value_names))
        .withColumn("__bucket", F.pmod(F.xxhash64(*key_names), F.lit(buckets)))
        .withColumn("__ord", F.dense_rank().over(Window.partitionBy("__bucket").orderBy(*key_names)) - 1)
    )
    key_types = [latest.schema[n].dataType for n in key_names]
    out_schema = T.StructType(
        [
            T.StructField("copy_name", T.StringType()),
            *(T.StructField(k, t) for k, t in zip(keys, key_types, strict=True)),
            *(T.StructField(n, T.StringType()) for n in ("field_name", "diff_kind", "base_value", "copy_value")),
        ]
    )
    compared = {name: [(f, value_names[every.index(f)]) for f in fields[name]] for name in names}
    out_names = out_schema.names
    return latest.groupBy("__bucket").applyInArrow(
        lambda bucket: _compare_bucket(bucket, names, key_names, compared, out_names), out_schema
    )


def _compare_bucket(bucket: pa.Table, names: Iterable[str], key_names: list[str], compared: dict, out_names: list[str]) -> pa.Table:
    bucket = bucket.combine_chunks()
    sides = bucket["__side"].to_numpy()
    ordinals = bucket["__ord"].to_numpy().astype(np.int64)
    size = int(ordinals.max()) + 1 if ordinals.size else 0

    def presence(number: int) -> tuple[dict, np.ndarray]:
        rows = np.flatnonzero(sides == number)
        at = np.full(size, -1, dtype=np.int64)
        at[ordinals[rows]] = rows
        return from_ordinals(ordinals[rows]), at

    base_bits, base_at = presence(0)
    parts: list[pa.Table] = []

    def emit(name: str, rows: np.ndarray, field: str, kind: str, old: pa.Array | None = None, new: pa.Array | None = None) -> None:
        if not rows.size:
            return
        taken = bucket.take(pa.array(rows))
        empty = pa.nulls(rows.size, pa.string())
        columns = [pa.array([name] * rows.size, pa.string()), *(taken[k] for k in key_names)]
        columns += [pa.array([field] * rows.size, pa.string()), pa.array([kind] * rows.size, pa.string())]
        parts.append(pa.table([*columns, empty if old is None else old, empty if new is None else new], names=out_names))

    for number, name in enumerate(names, 1):
        copy_bits, copy_at = presence(number)
        emit(name, base_at[to_ordinals(and_not(base_bits, copy_bits))], "*", "missing_in_copy")
        emit(name, copy_at[to_ordinals(and_not(copy_bits, base_bits))], "*", "missing_in_base")
        both = to_ordinals(intersection(base_bits, copy_bits))
        left, right = base_at[both], copy_at[both]
        for field, column in compared[name]:
            old, new = (bucket[column].take(pa.array(rows)) for rows in (left, right))
            same = pc.fill_null(pc.equal(old, new), False)
            same = pc.or_(same, pc.and_(pc.is_null(old), pc.is_null(new)))
            changed = np.flatnonzero(~np.asarray(same))
            emit(name, left[changed], field, "changed", old.take(pa.array(changed)), new.take(pa.array(changed)))
    if parts:
        return pa.concat_tables([p.combine_chunks() for p in parts], promote_options="permissive")
    types = [pa.string(), *(bucket.schema.field(k).type for k in key_names), *[pa.string()] * 4]
    return pa.table([pa.nulls(0, t) for t in types], names=out_names)
