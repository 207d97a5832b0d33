"""Fields that hold several values: a quote-aware finite-state tokenizer, one row per value with its position.

States: ``GAP`` (before a value), ``BARE`` (inside an unquoted value), ``QUOTED`` (inside quotes), ``AFTER`` (behind a
closing quote). The machine tracks the open quote, backslash escapes, doubled quotes and the nesting depth of
brackets; only delimiters outside quotes and at the list's own depth end a value.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Delimiters, quotes (opening: closing), list marks at the start of a line, brackets.
DELIMITERS = frozenset(",;|\n\r\t·")
QUOTES = {'"': '"', "'": "'", "“": "”", "‘": "’", "«": "»", "„": "“"}
LIST_MARKS = frozenset("*•-–▪◦‣")
BRACKETS = {"[": "]", "(": ")", "{": "}"}


def _blank(c: str) -> bool:
    return c.isspace() and c not in "\n\r\t"


def _ends_quote(text: str, i: int, depth: int) -> bool:
    """Whether what follows position ``i`` ends a value, so that a quote at ``i`` closes it."""
    j = i + 1
    while j < len(text) and _blank(text[j]):
        j += 1
    if j == len(text) or text[j] in DELIMITERS:
        return True
    if text[j] == "/" and j > i + 1:
        return j + 1 == len(text) or text[j + 1].isspace()
    return depth > 0 and text[j] in "])}"


def tokenize(text: str | None) -> list[str]:
    """The values of ``text`` in the order written; NULL and blank texts hold none.

    Quotes open only where a value begins, so an apostrophe inside a word is an ordinary character. A slash parts
    values only with a blank on both sides. One pair of square brackets around the whole text is the list's own;
    other brackets nest and shelter the delimiters inside them. An unclosed quote or bracket is an ordinary character.
    """
    if text is None:
        return []
    body, depth = text.strip(), 0
    if body[:1] == "[" and body[-1:] == "]":
        body, depth = body[1:-1], 1
    values: list[str] = []
    buffer: list[str] = []
    state, quote, nesting, line_start = "GAP", "", 0, True
    i, size = 0, len(body)
    last = {c: body.rfind(c) for c in BRACKETS.values()}
    closers: dict[str, int] = {}

    def emit() -> None:
        value = "".join(buffer).strip()
        if value:
            values.append(value)
        buffer.clear()

    while i < size:
        c = body[i]
        if state == "GAP":
            if c in "\n\r":
                line_start = True
            elif c in DELIMITERS or c.isspace():
                pass
            elif line_start and c in LIST_MARKS and i + 1 < size and _blank(body[i + 1]):
                line_start = False
            elif c == "/" and (i == 0 or body[i - 1].isspace()) and (i + 1 == size or body[i + 1].isspace()):
                pass
            elif c in QUOTES and _last_closer(body, QUOTES[c], depth, closers) > i and _closing(body, i, depth) > 0:
                state, quote, line_start = "QUOTED", QUOTES[c], False
            else:
                state, line_start = "BARE", False
                continue
        elif state == "QUOTED":
            if c == "\\" and i + 1 < size and body[i + 1] in ("\\", quote, '"', "'"):
                buffer.append(body[i + 1])
                i += 1
            elif c == quote and i + 1 < size and body[i + 1] == quote:
                buffer.append(c)
                i += 1
            elif c == quote and _ends_quote(body, i, depth):
                emit()
                state = "AFTER"
            else:
                buffer.append(c)
        else:
            slash = c == "/" and (i + 1 == size or body[i + 1].isspace()) and body[i - 1].isspace()
            if nesting == 0 and (c in DELIMITERS or slash):
                emit()
                state, line_start = "GAP", c in "\n\r"
            elif c == "\\" and i + 1 < size and (body[i + 1] in DELIMITERS or body[i + 1] in QUOTES):
                buffer.append(body[i + 1])
                i += 1
            else:
                if c in BRACKETS and last[BRACKETS[c]] > i:
                    nesting += 1
                elif nesting and c in "])}":
                    nesting -= 1
                buffer.append(c)
        i += 1
    emit()
    return values


def _last_closer(text: str, quote: str, depth: int, known: dict[str, int]) -> int:
    """The last position at which ``quote`` could close a value, -1 if there is none; found once per text."""
    if quote not in known:
        at = text.rfind(quote)
        while at >= 0 and not _ends_quote(text, at, depth):
            at = text.rfind(quote, 0, at)
        known[quote] = at
    return known[quote]


def _closing(text: str, i: int, depth: int) -> int:
    """The position of the quote that closes the one at ``i``, or -1."""
    quote, j, size = QUOTES[text[i]], i + 1, len(text)
    while j < size:
        if text[j] == "\\":
            j += 2
            continue
        if text[j] == quote:
            if j + 1 < size and text[j + 1] == quote:
                j += 2
                continue
            if _ends_quote(text, j, depth):
                return j
        j += 1
    return -1


def explode_values(df: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """One row per value of each of ``fields``: ``key``, ``field_name``, ``pos`` (from 1), ``item``.

    NULL and blank fields give no rows; repeated values and repeated rows are kept; columns other than those named are
    not read. The tokenizer runs on Arrow batches, once per distinct text of a batch.
    """
    schema = f"`{key}` {df.schema[key].dataType.simpleString()}, field_name string, pos int, item string"
    long = df.select(F.col(f"`{key}`"), F.explode(F.array(*(F.struct(F.lit(f).alias("field_name"), F.col(f"`{f}`").alias("text")) for f in fields))).alias("f"))
    long = long.select(f"`{key}`", "f.field_name", "f.text").where(F.col("text").isNotNull())

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            items = batch["text"].map({t: tokenize(t) for t in batch["text"].unique()})
            out = batch[[key, "field_name"]].assign(item=items).explode("item")
            out = out[out["item"].notna()]
            out.insert(2, "pos", out.groupby(level=0).cumcount().astype("int32") + 1)
            yield out[[key, "field_name", "pos", "item"]]

    return long.mapInPandas(split, schema)
