"""Codes for entities and their replacement in text."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionloom.functions.scalars import person_code
from sessionloom.session import broadcast_if_small, cut

# Amounts of money and years.
MONEY = (r"(?i)\$[0-9,]+(?:\s*(?:million|thousand|billion))?", r"(?i)[0-9,]+\s*(?:million|thousand|billion)\s+dollars?")
YEAR = r"(?<![A-Za-z0-9_])(19|20)[0-9]{2}(?![A-Za-z0-9_])"


def assign_codes(counts: DataFrame, group: str, name: str = "name", count: str = "n") -> DataFrame:
    """Person codes by falling count, then by the name without and with letter case."""
    w = Window.partitionBy(group).orderBy(F.desc(count), F.lower(name), name)
    return counts.withColumn("code", person_code(F.row_number().over(w) - 1))


def numbered_codes(entities: DataFrame, group: str, prefix: str | Column, *order: str) -> DataFrame:
    """``Organization_1`` and so on within a group, in the given order."""
    label = F.lit(prefix) if isinstance(prefix, str) else prefix
    w = Window.partitionBy(group, label).orderBy(*order)
    return entities.withColumn("code", F.concat_ws("_", label, F.row_number().over(w).cast("string")))


def unique_first_names(names: DataFrame, group: str, name: str = "name", code: str = "code") -> DataFrame:
    """First names that belong to one code only within their group."""
    first = names.withColumn("first_name", F.element_at(F.split(name, " "), 1))
    return first.groupBy(group, "first_name").agg(F.countDistinct(code).alias("codes"), F.min(code).alias("code")).where("codes = 1").select(group, "first_name", "code")


def mask_money(text: Column) -> Column:
    """Amounts of money as [Financial_Amount]."""
    for pattern in MONEY:
        text = F.regexp_replace(text, pattern, "[Financial_Amount]")
    return text


def mask_years(text: Column) -> Column:
    """Years from 1900 to 2099 as [Year]."""
    return F.regexp_replace(text, YEAR, "[Year]")


def mark_ambiguous(text: Column, words: Sequence[str], policy: str = "mark_all") -> Column:
    """Capitalised ambiguous words in brackets, unless they stand in brackets already.

    ``policy``: "mark_all", or "pos_based" for words used as a name only: behind a title, or before a capitalised word or
    a verb of speech.
    """
    word = r"(?<!\[)\b(" + "|".join(words) + r")\b(?!\])"
    if policy == "mark_all":
        return F.regexp_replace(text, word, "[$1]")
    text = F.regexp_replace(text, r"\b((?:Mr|Mrs|Ms|Dr|Elder|Chief)\.? )" + word, "$1[$2]")
    return F.regexp_replace(text, word + r"(?= (?:\p{Lu}\p{Ll}|said|says|asked|told|explained)[^ ]*)", "[$1]")


def fix_terms(line: Column, triggers: Sequence[str], corrections: Mapping[str, str]) -> Column:
    """Terms corrected on lines that hold one of the trigger words; other lines stay."""
    fixed = line
    for wrong, right in corrections.items():
        fixed = F.regexp_replace(fixed, r"(?i)\b\Q" + wrong + r"\E\b", right.replace("\\", r"\\").replace("$", r"\$"))
    return F.when(F.lower(line).rlike("|".join(rf"\Q{t.lower()}\E" for t in triggers)), fixed).otherwise(line)


def collapse_codes(text: Column) -> Column:
    """Repeats of one code as a single one."""
    return F.regexp_replace(text, r"(#[A-Z]+)(?:\s+\1)+(?![A-Za-z0-9_])", "$1")


def drop_stray_codes(text: Column) -> Column:
    """A code before a greeting at the beginning of a line is dropped."""
    return F.regexp_replace(text, r"(?m)^#[A-Z]+\s+(?=(?:Hello|Hi|Thanks|Good (?:morning|afternoon))\b)", "")


#: Rows that a task takes at once: keys of few rows share a task, a key of more is split.
CHUNK_ROWS = 2_000


def replace_mapped(texts: DataFrame, mapping: DataFrame, key: str = "doc_id", first_names: bool = False, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Texts with the surfaces of their document's mapping (key, surface, code, and kind or none) replaced, longest first.

    A surface is replaced as a whole word, letter case aside, but not inside square brackets; codes are never matched
    again. With a column ``kind`` the kinds are replaced one after the other in the order of ``KIND_ORDER``; with
    ``first_names`` first names of one person's code are replaced in their contexts behind persons. Of equal surfaces of
    a kind the least code stands. Documents without a mapping or a key and NULL texts stay as they are.

    Rows and mappings meet in groups of about ``chunk_rows`` rows: several small keys, or one chunk of a key of more
    rows, each chunk with the key's mapping. A key of more names than that has chunks of as many rows as names, so that
    copies of the mapping never outgrow the rows. The names of a session and a chunk of its rows bound what a task holds.
    """
    kind = F.col("kind") if "kind" in mapping.columns else F.lit("person")
    key_of = F.coalesce(F.col(key).cast("string"), F.lit("\0"))
    pairs = mapping.where("surface is not null and surface <> '' and code is not null").where(F.col(key).isNotNull()).groupBy(key_of.alias("__key"), kind.alias("kind"), "surface").agg(F.min("code").alias("code"))
    counts = cut(texts.groupBy(key_of.alias("__key")).count())
    total = counts.agg(F.sum("count")).first()[0] or 0
    groups = max(-(-total // chunk_rows), int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    named = pairs.groupBy("__key").agg(F.count("*").alias("names"))
    at_once = F.greatest(F.lit(chunk_rows), F.coalesce("names", F.lit(0)))
    hot = counts.where(F.col("count") > chunk_rows).join(named, "__key", "left").select("__key", F.ceil(F.col("count") / at_once).cast("int").alias("__chunks"))
    hot = broadcast_if_small(cut(hot))

    def grouped(df: DataFrame, chunk: Column) -> DataFrame:
        out = df.join(hot, "__key", "left").withColumn("__chunk", chunk)
        group = F.when(F.col("__chunks").isNull(), F.pmod(F.xxhash64("__key"), F.lit(groups))).otherwise(F.xxhash64("__key", "__chunk"))
        return out.withColumn("__group", group).drop("__chunks", "__chunk")

    chunks = F.coalesce("__chunks", F.lit(1))
    rows = grouped(texts.withColumn("__key", key_of), F.pmod(F.xxhash64(*texts.columns), chunks).cast("int"))
    pairs = grouped(pairs, F.explode(F.sequence(F.lit(0), chunks - 1)))
    names = texts.schema.names

    def run(rows: pd.DataFrame, pairs: pd.DataFrame) -> pd.DataFrame:
        steps: dict[str, list[Replacer]] = {}
        order = {k: i for i, k in enumerate(KIND_ORDER)}
        for k, own in pairs.groupby("__key"):
            kinds = sorted(own["kind"].unique(), key=lambda x: (order.get(x, len(order)), x))
            steps[k] = [Replacer(dict(zip(part["surface"], part["code"], strict=True)), first_names and x == "person") for x in kinds for part in [own[own["kind"] == x]]]
        out = []
        for k, text in zip(rows["__key"], rows["text"], strict=True):
            for step in steps.get(k, ()) if isinstance(text, str) else ():
                text = step.replace(text)
            out.append(text)
        return rows.assign(text=pd.Series(out, index=rows.index, dtype=object))[names]

    return rows.groupBy("__group").cogroup(pairs.groupBy("__group")).applyInPandas(run, texts.schema)


#: The order in which kinds of entities are replaced.
KIND_ORDER = ("person", "organization", "location", "tribe")
_TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]|_")


class Replacer:
    """One pass of longest-first replacement; only surfaces whose rarest word a text holds are looked for in it.

    No letter may stand beside a surface, nor a digit beside one that begins or ends in a digit.
    """

    def __init__(self, mapping: Mapping[str, str], first_names: bool = False) -> None:
        self.codes = {k.lower(): v for k, v in sorted(mapping.items(), reverse=True)}
        self.by_word: dict[str, list[str]] = {}
        words = {surface: set(_TOKEN.findall(surface)) for surface in self.codes}
        counts = Counter(w for own in words.values() for w in own)
        for surface, own in words.items():
            self.by_word.setdefault(min(own, key=lambda w: (counts[w], w), default=""), []).append(surface)
        self.patterns: dict[tuple[str, ...], re.Pattern] = {}
        self.first: dict[str, str] = {}
        if first_names:
            owners: dict[str, set[str]] = {}
            for name, code in mapping.items():
                if len(words := name.split()) > 1 and len(words[0]) > 2:
                    owners.setdefault(words[0], set()).add(code)
            self.first = {name: next(iter(own)) for name, own in owners.items() if len(own) == 1}

    def replace(self, text: str) -> str:
        words = set(_TOKEN.findall(text.lower()))
        present = sorted({s for w in words & self.by_word.keys() for s in self.by_word[w]} | set(self.by_word.get("", ())), key=lambda s: (-len(s), s))
        if present:
            pattern = self.patterns.get(tuple(present))
            if pattern is None:
                if len(self.patterns) > 4_096:
                    self.patterns.clear()
                alternatives = "|".join((r"(?<!\d)" if s[0].isdigit() else "") + re.escape(s) + (r"(?!\d)" if s[-1].isdigit() else "") for s in present)
                pattern = re.compile(rf"\[[^\[\]]*\]|(?<![^\W\d_])(?:{alternatives})(?![^\W\d_])", re.I)
                self.patterns[tuple(present)] = pattern
            text = pattern.sub(lambda m: m[0] if m[0].startswith("[") else self.codes.get(m[0].lower(), m[0]), text)
        return replace_first_names(text, self.first) if self.first else text


def replace_names(text: str | None, mapping: Mapping[str, str]) -> str | None:
    """One pass of longest-first replacement over a text."""
    return Replacer(mapping).replace(text) if text and mapping else text


# What stands behind a first name that begins a sentence.
VERBS = "said|says|asked|told|explained|mentioned|thinks|wants|works|is|was|has|had"


def replace_first_names(text: str, codes: Mapping[str, str]) -> str:
    """Bare first names as codes where the context shows a person: behind a comma, colon or "and", or as the subject.

    A name in square brackets or followed by another capitalised word stays.
    """
    present = sorted((n for n in codes if n in text), key=lambda n: (-len(n), n))
    if not present:
        return text
    name = "(" + "|".join(map(re.escape, present)) + r")(?![\w\]])(?!\s+[A-Z][a-z])"
    for pattern in (rf"(?<=[,:]\s){name}", rf"(?:(?<=^)|(?<=[.!?]\s)|(?<=\n)){name}(?=\s+(?:{VERBS})\b)", rf"(?<=\band\s){name}"):
        text = re.sub(pattern, lambda m: codes[m[1]], text)
    return text


def correct_words(text: str | None, corrections: Mapping[str, str]) -> str | None:
    """Misspellings corrected in a single pass, longest first; a replacement is never corrected again."""
    return replace_names(text, {k: v for k, v in corrections.items() if k.lower() != v.lower()})


def assign_by_containment(residual: DataFrame, mapping: DataFrame, key: str = "doc_id") -> DataFrame:
    """Surfaces left in a text (key, surface) with the code of a mapped surface that contains them or lies in them.

    The longest such surface decides, the first by spelling of those tied; where there is none a new code follows the
    document's last one, in the order of the surfaces.
    """
    left = residual.select(key, "surface").distinct()
    known = mapping.select(key, F.col("surface").alias("__known"), "code")
    low = F.lower("surface"), F.lower("__known")
    found = left.join(known, key).where(F.contains(*low) | F.contains(low[1], low[0]))
    best = found.groupBy(key, "surface").agg(F.min_by("code", F.struct(-F.length("__known"), "__known")).alias("code"))
    used = mapping.groupBy(key).agg(F.countDistinct("code").alias("__used"))
    new = left.join(best, [key, "surface"], "left_anti").join(used, key, "left")
    number = F.coalesce("__used", F.lit(0)) + F.row_number().over(Window.partitionBy(key).orderBy("surface")) - 1
    return best.unionByName(new.withColumn("code", person_code(number)).select(key, "surface", "code"))


def first_seen_code(names: DataFrame, group: str, name: str = "name", code: str = "code") -> DataFrame:
    """(group, first_name, code): each first name with the code of the longest full name that begins with it."""
    first = names.withColumn("first_name", F.element_at(F.split(name, " "), 1))
    return first.groupBy(group, "first_name").agg(F.min_by(code, F.struct(-F.length(name), F.col(name))).alias("code"))
