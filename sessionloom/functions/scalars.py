"""Scalar functions as Column expressions; all run inside the JVM."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Least share of the points for each letter grade, best first.
GRADES = [(0.93, "A"), (0.90, "A-"), (0.87, "B+"), (0.83, "B"), (0.80, "B-"), (0.77, "C+"), (0.73, "C"), (0.70, "C-"), (0.67, "D+"), (0.60, "D")]


def base26(index: Column) -> Column:
    """Bijective base-26 label of a 0-based index: 0 is A, 25 Z, 26 AA, with as many letters as it needs; NULL for negative ones."""
    n = index.cast("long")
    out, start = F.when(n < 0, None), 0
    for size in range(1, 15):  # the greatest long has 14 letters
        rest = n - F.lit(start)
        label = F.concat(*(F.chr(F.lit(65) + F.call_function("div", rest, F.lit(26**k)) % 26) for k in reversed(range(size))))
        start += 26**size
        out = out.when(n < start, label) if size < 14 else out.when(n.isNotNull(), label)
    return out


def person_code(index: Column) -> Column:
    """``#`` and the base-26 label."""
    return F.concat(F.lit("#"), base26(index))


def hhmmss(seconds: Column, missing: str = "??:??:??") -> Column:
    """Seconds as HH:MM:SS; negative ones count as 0, NULL gives ``missing``."""
    s = F.greatest(F.floor(seconds), F.lit(0))
    text = F.format_string("%02d:%02d:%02d", F.floor(s / 3600), F.floor(s / 60) % 60, s % 60)
    return F.when(seconds.isNull(), F.lit(missing)).otherwise(text)


def letter_grade(share: Column) -> Column:
    """Letter grade of a share of the points; F below the last bound, NULL for NULL."""
    out = F.when(share.isNull(), None)
    for least, grade in GRADES:
        out = out.when(share >= least, grade)
    return out.otherwise("F")


def ratio(part: Column, whole: Column, otherwise: float | None = None) -> Column:
    """``part / whole``, ``otherwise`` where the whole is zero."""
    return F.when(whole != 0, part / whole).otherwise(F.lit(otherwise).cast("double"))


def clamp(value: Column, low: float, high: float) -> Column:
    """The value held between two bounds."""
    return F.least(F.greatest(value, F.lit(low)), F.lit(high))


def shorten(text: Column, longest: int = 60) -> Column:
    """Text cut for display with three points when longer than ``longest``."""
    return F.when(F.length(text) > longest, F.concat(F.substring(text, 1, longest - 3), F.lit("..."))).otherwise(text)


def title_case(text: Column) -> Column:
    """Title case with single blanks."""
    return F.initcap(F.regexp_replace(F.trim(text), r"\s+", " "))


def whole_word(keyword: str) -> str:
    """Pattern of a keyword as a whole word: blanks in phrases are elastic, signs are literal, case is ignored.

    Boundaries are ASCII, so SQL engines without Unicode word boundaries give the same counts.
    """
    parts = [r"\Q" + p + r"\E" if not p.isalnum() else p for p in keyword.split()]
    left = r"(?<![A-Za-z0-9_])" if keyword[:1].isalnum() else ""
    right = r"(?![A-Za-z0-9_])" if keyword[-1:].isalnum() else ""
    return "(?i)" + left + r"\s+".join(parts) + right


def amount(text: Column) -> Column:
    """A number written with separators and a currency sign, NULL if it can't be read."""
    return F.try_to_number(F.regexp_replace(text, "[$,]", ""), F.lit("999999999999999.99")).cast("double")


def quote_position(text: Column, quote: Column) -> Column:
    """0-based position of a quote in a text, -1 when absent."""
    return F.position(quote, text) - 1


def split_terms(text: Column) -> Column:
    """Parts of a compound term, split at / , ; & and the word "and"."""
    return F.transform(F.split(text, r"\s*[/,;&]\s*|\s+and\s+"), lambda x: F.trim(x))


def cache_key(url: Column) -> Column:
    """First 24 hexadecimal digits of the SHA-256 of a URL."""
    return F.substring(F.sha2(url, 256), 1, 24)


def value_class(value: Column) -> Column:
    """Class of an answer for its citation: missing, yes_no, number or text."""
    v = F.trim(value)
    return F.when(v.isNull() | v.isin("", "-1", "Not reported"), "missing").when(v.isin("Yes", "No"), "yes_no").when(v.rlike(r"^[0-9]+$"), "number").otherwise("text")


def table_score(columns: Mapping[str, Column], rules: Sequence[tuple[str, str, float]]) -> Column:
    """Sum of the points of a table of rules (column, pattern, points) whose pattern the column's text holds.

    Letter case is ignored; a NULL text meets no rule.
    """
    points = (F.when(columns[name].rlike("(?i)" + pattern), F.lit(float(n))).otherwise(0.0) for name, pattern, n in rules)
    return reduce(lambda a, b: a + b, points, F.lit(0.0))


def time_left(done: Column, total: Column, seconds: Column) -> Column:
    """Seconds that the rest takes at the rate so far; NULL while nothing is done, 0 once all is."""
    return F.when(done > 0, F.greatest(total - done, F.lit(0)) * seconds / done)


def version_of(line: Column, prefix: str) -> Column:
    """The version a manifest line states for the file name that begins with ``prefix``; NULL for other lines."""
    found = F.regexp_extract(line, r"^\Q" + prefix + r"\E\S*_v(\d+(?:\.\d+)*)", 1)
    return F.when(found != "", found)


def file_name(text: Column) -> Column:
    """A text as the name of a file: other characters than letters, digits, point and hyphen become one underscore."""
    return F.trim(F.regexp_replace(text, r"[^A-Za-z0-9.-]+", "_"), F.lit("_"))


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    """``part`` of ``whole`` in per cent with so many digits, as text; "-" where the whole is zero."""
    return F.when(whole != 0, F.format_string(f"%.{digits}f%%", (100 * part / whole).cast("double"))).otherwise("-")


def as_json(*columns: str) -> Column:
    """The columns as a JSON object; NULL ones are left out."""
    return F.to_json(F.struct(*columns))
