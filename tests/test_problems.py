"""Differences of copies and multi-value fields: methods, edge cases, brute force."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from sessionloom.functions.bitmaps import and_not, from_ordinals, intersection, to_ordinals
from sessionloom.operators.copydiff import diff_copies, without_item_number
from sessionloom.operators.multivalue import explode_values, tokenize

SCHEMA = "k1 long, k2 string, a string, b string, at timestamp, field_name string, copy_name string"


def frame(spark, rows):
    from datetime import datetime

    return spark.createDataFrame([(*r[:4], None if r[4] is None else datetime(2024, 1, r[4]), "x", "y") for r in rows], SCHEMA)


def differences(spark, base, copy, **more):
    out = diff_copies(frame(spark, base), {"c": frame(spark, copy)}, ["k1", "k2"], {"c": ["a", "b"]}, "at", **more)
    return {tuple(r)[1:] for r in out.select("copy_name", "k1", "k2", "field_name", "diff_kind").collect()}


@settings(max_examples=60, deadline=None)
@given(st.sets(st.integers(0, 200_000)), st.sets(st.integers(0, 200_000)))
def test_bitmaps_agree_with_sets(a, b):
    x, y = from_ordinals(np.array(sorted(a), dtype=int)), from_ordinals(np.array(sorted(b), dtype=int))
    assert set(to_ordinals(and_not(x, y)).tolist()) == a - b
    assert set(to_ordinals(intersection(x, y)).tolist()) == a & b


def test_bitmap_runs_are_small():
    full = from_ordinals(np.arange(65_536))
    assert sum(len(p) for _, p in full.values()) == 4


def test_equal_values_and_changes(spark):
    base = [(1, "m", "1,200", " Yes", 1), (1, "n", None, "-1", 1), (2, "m", "x", "y", 1), (3, "m", "05", "1.50", 1)]
    copy = [(1, "m", "1200.0", "Yes ", 1), (1, "n", "Not reported", "", 1), (2, "m", "X", "y ", 1), (3, "m", "5", "1.5", 1)]
    assert differences(spark, base, copy) == {(2, "m", "a", "changed")}


def test_edges_of_any_white_space(spark):
    base = [(1, "m", "\u00a0Yes", "x", 1), (2, "m", "\tNo\u2003", "\u0085-1", 1), (3, "m", "\u00e9", "a\u00a0b", 1), (4, "m", " ", "(1)", 1)]
    copy = [(1, "m", "Yes", "x\n", 1), (2, "m", "No", None, 1), (3, "m", "\u00e9 ", "a b", 1), (4, "m", "", "(1) ", 1)]
    assert differences(spark, base, copy) == {(3, "m", "b", "changed")}


def test_missing_rows_nulls_ties_and_repeats(spark):
    base = [(1, "m", "old", "b", 1), (1, "m", "new", "b", 2), (None, None, "a", "b", 1), (2, "m", "a", "b", None), (2, "m", "a", "b", None), (4, "m", "p", "b", 1), (4, "m", "q", "b", 1)]
    copy = [(1, "m", "new", "b", 1), (None, None, "a", "c", 1), (3, "m", "a", "b", 1), (4, "m", "q", "b", 1)]
    assert differences(spark, base, copy, bucket_rows=2) == {(None, None, "b", "changed"), (2, "m", "*", "missing_in_copy"), (3, "m", "*", "missing_in_base")}


def test_empty_tables(spark):
    row = [(1, "m", "a", "b", 1)]
    assert differences(spark, [], []) == set()
    assert differences(spark, row, []) == {(1, "m", "*", "missing_in_copy")}
    assert differences(spark, [], row) == {(1, "m", "*", "missing_in_base")}


def test_long_values_and_hot_key(spark):
    base = [(1, "m", "x" * 200_000, "b", 1)] + [(7, "hot", str(i), "b", 1) for i in range(500)]
    copy = [(1, "m", "x" * 199_999 + "y", "b", 1), (7, "hot", "99", "b", 1)]
    assert differences(spark, base, copy) == {(1, "m", "a", "changed")}


def test_item_numbers(spark):
    rows = spark.createDataFrame([("6.  In which year?",), ("18) How many?",), ("3 kinds of soup",), ("1.5 acres",)], "q string")
    got = [r[0].strip() for r in rows.select(without_item_number(rows.q).alias("q")).collect()]
    assert got[:3] == ["In which year?", "How many?", "3 kinds of soup"]


def test_tokenizer_cases():
    assert tokenize(None) == tokenize("") == tokenize(" ; , ") == []
    assert tokenize("0=No;;1=Yes;") == ["0=No", "1=Yes"]
    assert tokenize('"elder ""auntie"" rule" / land base\nsold out;web page') == ['elder "auntie" rule', "land base", "sold out", "web page"]
    assert tokenize('["so-called \\"dry\\" year","and/or share"]') == ['so-called "dry" year', "and/or share"]
    assert tokenize("elders' council, women's circle,'pay; wages'") == ["elders' council", "women's circle", "pay; wages"]
    assert tokenize("* -1\r\n* 0..100\n- “2=Yes, partly”") == ["-1", "0..100", "2=Yes, partly"]
    assert tokenize("1 · 4 · 12 · 52 or stated") == ["1", "4", "12", "52 or stated"]
    assert tokenize("a (b, c), d") == ["a (b, c)", "d"]
    assert tokenize("'open, never closed") == ["'open", "never closed"]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="ab ,;|\"'/\\-", min_size=1, max_size=12).map(str.strip).filter(bool), min_size=1, max_size=6))
def test_quoted_values_round_trip(values):
    text = ", ".join('"' + v.replace("\\", "\\\\").replace('"', '""') + '"' for v in values)
    assert tokenize(text) == values


def test_explode_values_edge_cases(spark):
    rows = [(1, "a;b;a", None, "x"), (1, "a;b;a", None, "x"), (2, "", " ", "y"), (3, "v," * 50_000, "z", None)]
    df = spark.createDataFrame(rows, "id long, f string, g string, item string")
    got = explode_values(df, "id", ["f", "g"]).collect()
    assert [(r.pos, r.item) for r in got if r.id == 1 and r.field_name == "f"] == [(1, "a"), (2, "b"), (3, "a")] * 2
    assert sum(r.id == 3 and r.field_name == "f" for r in got) == 50_000
    assert not [r for r in got if r.id == 2]
    assert explode_values(df.limit(0), "id", ["f"]).count() == 0
