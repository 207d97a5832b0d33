"""Lines tagged against keyword lexicons, metrics, dialogue and context; every non-blank line gets a tag."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionloom.functions.scalars import whole_word
from sessionloom.operators.lines import by_line

# Counts of people and grants, and amounts in dollars.
METRICS = r"(?i)(?<![A-Za-z0-9_])([0-9]+)\s+(members?|employees?|partners?|grants?)(?![A-Za-z0-9_])"
DOLLARS = r"\$([0-9]+(?:,[0-9]+)*(?:\.[0-9]+)?)"


class Lexicon:
    """Keywords by category, found by their first word; a match counts unless its surroundings rule it out.

    ``negative`` patterns suppress a match in whose window of characters they occur, ``required`` ones a match in whose
    window they don't. Keywords are whole words (ASCII), blanks in phrases are elastic, letter case is ignored.
    """

    def __init__(self, lexicon: Sequence[tuple[str, str]], negative: Mapping[str, str] | None = None, required: Mapping[str, str] | None = None, window: int = 30, shown: int = 50) -> None:
        self.window, self.shown = window, shown
        self.by_word: dict[str, list[tuple[str, str, re.Pattern, re.Pattern | None, re.Pattern | None]]] = {}
        for category, keyword in lexicon:
            rules = (re.compile(table[keyword]) if table and keyword in table else None for table in (negative, required))
            pattern = re.compile(whole_word(keyword).replace(r"\Q", "").replace(r"\E", "") if keyword.replace(" ", "").isalnum() else _literal(keyword), re.A | re.I)
            first = _FIRST.search(keyword.lower())
            self.by_word.setdefault(first[0] if first else "", []).append((category, keyword, pattern, *rules))
        self.parts = re.compile(r"[a-z0-9]+|[^\sa-z0-9]")

    def find(self, line: str) -> list[tuple[str, str, int, str]]:
        """(category, keyword, matches that count, context of the first of them) of a line."""
        out = []
        words = set(self.parts.findall(line.lower()))
        words.add("")
        for word in words & self.by_word.keys():
            for category, keyword, pattern, negative, required in self.by_word[word]:
                hits, context = 0, ""
                for m in pattern.finditer(line):
                    view = line[max(0, m.start() - self.window) : m.end() + self.window]
                    if (negative and negative.search(view)) or (required and not required.search(view)):
                        continue
                    hits += 1
                    if hits == 1:
                        context = line[max(0, m.start() - self.shown) : m.end() + self.shown]
                if hits:
                    out.append((category, keyword, hits, context))
        return out


_FIRST = re.compile(r"[a-z0-9]+|[^\sa-z0-9]")


def _literal(keyword: str) -> str:
    left = r"(?<![A-Za-z0-9_])" if keyword[:1].isalnum() else ""
    right = r"(?![A-Za-z0-9_])" if keyword[-1:].isalnum() else ""
    return left + r"\s+".join(map(re.escape, keyword.split())) + right


def lexicon_hits(lines: DataFrame, lexicon: Sequence[tuple[str, str]], negative: Mapping[str, str] | None = None, required: Mapping[str, str] | None = None, window: int = 30, shown: int = 50) -> DataFrame:
    """``lines`` with ``category``, ``keyword``, ``hits`` and the ``context`` of the first one, a row per keyword found.

    Every match is judged by its own surroundings of ``window`` characters on either side: it doesn't count if the
    keyword's ``negative`` pattern occurs there, or its ``required`` one doesn't. The context shows ``shown`` characters
    on either side. One pass over Arrow batches, whatever the number of keywords; no join and no shuffle. NULL lines
    give no rows.
    """
    table = Lexicon(lexicon, negative, required, window, shown)
    columns = [f for f in lines.schema.fields if f.name not in ("category", "keyword", "hits", "context")]
    names = [f.name for f in columns]
    schema = T.StructType([*columns, T.StructField("category", T.StringType()), T.StructField("keyword", T.StringType()), T.StructField("hits", T.LongType()), T.StructField("context", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, found = [], []
            for i, line in enumerate(batch.column("line").to_pylist()):
                if line:
                    own = table.find(line)
                    at += [i] * len(own)
                    found += own
            own = batch.take(pa.array(at, pa.int64())).select(names)
            values = list(zip(*found, strict=True)) if found else [()] * 4
            arrays = [pa.array(v, t) for v, t in zip(values, (pa.string(), pa.string(), pa.int64(), pa.string()), strict=True)]
            yield pa.RecordBatch.from_arrays([*own.columns, *arrays], names=[*names, "category", "keyword", "hits", "context"])

    return lines.select(*(f"`{n}`" for n in names)).mapInArrow(run, schema)


def tag_counts(tags: DataFrame, category: str = "category") -> DataFrame:
    """Tags by category with their total as category NULL."""
    return tags.rollup(category).agg(F.count("*").alias("tags"))


def metric_tags(lines: DataFrame, least: float = 1000.0, key: str = "doc_id") -> DataFrame:
    """(key, line_no, metric, value) of counts of people and grants, and of dollar amounts from ``least`` on."""
    counts = lines.select(key, "line_no", F.explode(F.regexp_extract_all("line", F.lit(METRICS), F.lit(0))).alias("m"))
    noun = F.regexp_extract(F.lower("m"), r"(member|employee|partner|grant)", 1)
    counts = counts.select(key, "line_no", F.concat(F.lit("METRIC_"), F.initcap(noun)).alias("metric"), F.regexp_extract("m", r"([0-9]+)", 1).cast("double").alias("value"))
    dollars = lines.select(key, "line_no", F.explode(F.regexp_extract_all("line", F.lit(DOLLARS), F.lit(1))).alias("m"))
    dollars = dollars.select(key, "line_no", F.lit("METRIC_Dollar").alias("metric"), F.expr("try_cast(replace(m, ',', '') as double)").alias("value"))
    return counts.unionByName(dollars.where(F.col("value").isNull() | (F.col("value") >= least)))


def dialogue_tags(lines: DataFrame, metrics: DataFrame, key: str = "doc_id") -> DataFrame:
    """Dialogue kind of lines without a metric: a person code, a speaker letter or a verse mark at the beginning."""
    kind = F.when(F.col("line").rlike(r"^#[A-Z]+(?![A-Za-z0-9_])"), "code").when(F.col("line").rlike(r"^[A-Z]{1,3}\. "), "letter").when(F.col("line").rlike(r"^\[[A-Z]+\.[0-9]+\]"), "verse")
    tagged = lines.withColumn("dialogue", kind).where("dialogue is not null")
    return tagged.join(metrics.select(key, "line_no").distinct(), [key, "line_no"], "left_anti").select(key, "line_no", "dialogue")


def is_seed(line: Column) -> Column:
    """Whether a line seeds context: it states a metric (of ``METRICS``, or 1,000 dollars and more) or begins a dialogue."""
    dollars = F.transform(F.regexp_extract_all(line, F.lit(DOLLARS), F.lit(1)), lambda m: F.replace(m, F.lit(","), F.lit("")).try_cast("double"))
    dialogue = line.rlike(r"^#[A-Z]+(?![A-Za-z0-9_])|^[A-Z]{1,3}\. |^\[[A-Z]+\.[0-9]+\]")
    return line.rlike(METRICS) | F.exists(dollars, lambda v: F.coalesce(v >= 1000, F.lit(True))) | dialogue


def context_cascade(lines: DataFrame, seed: Column, reach: int = 2, key: str = "doc_id") -> DataFrame:
    """Non-blank lines that are context of a seed line: within ``reach`` lines, or linked to it by a chain of such lines.

    ``seed`` is a predicate of the line. Islands are runs of non-blank lines with gaps of at most ``reach``; a line is
    context if a seed of its island stands at most ``reach`` lines below it.
    """
    filled = lines.where(~F.col("line").rlike(r"^\s*$")).select(key, "line_no", F.coalesce(seed, F.lit(False)).cast("int").alias("seed"))
    gap = F.col("line_no") - F.lag("line_no").over(by_line(key))
    island = F.sum(F.when(gap > reach, 1).otherwise(0)).over(by_line(key).rowsBetween(Window.unboundedPreceding, 0))
    view = Window.partitionBy(key, "island").orderBy("line_no").rangeBetween(Window.unboundedPreceding, reach)
    marked = filled.withColumn("island", island).withColumn("near", F.max("seed").over(view))
    return marked.where("near = 1 and seed = 0").select(key, "line_no")


def general_tags(lines: DataFrame, tagged: DataFrame, key: str = "doc_id") -> DataFrame:
    """Non-blank lines that no tag covers."""
    return lines.where(~F.col("line").rlike(r"^\s*$")).join(tagged.select(key, "line_no").distinct(), [key, "line_no"], "left_anti").select(key, "line_no")


def coverage(taggable: DataFrame, tagged: DataFrame, key: str = "doc_id") -> DataFrame:
    """Per document the taggable lines, those tagged and their share, 1.0 where none is taggable."""
    flags = taggable.select(key, "line_no").join(tagged.select(key, "line_no").distinct().withColumn("hit", F.lit(1)), [key, "line_no"], "left")
    out = flags.groupBy(key).agg(F.count("*").alias("taggable"), F.count("hit").alias("tagged"))
    return out.withColumn("coverage", F.when(F.col("taggable") > 0, F.col("tagged") / F.col("taggable")).otherwise(1.0))


def all_tags(lines: DataFrame, categories: Sequence[tuple[str, str]], questions: Sequence[tuple[str, str]], terms: Sequence[str], negative: Mapping[str, str] | None = None, required: Mapping[str, str] | None = None, key: str = "doc_id") -> DataFrame:
    """Every tag of numbered lines: (key, line_no, tag, matched, context).

    Tags are CATEGORY_x and QUESTION_x of their lexicons (a question's keyword with a required context is left to its
    category), TERM, METRIC_x, DIALOGUE_x, CONTEXT for lines near a metric or dialogue and GENERAL for non-blank lines
    that have none, so that every non-blank line has a tag. Terms are matched without context rules. Lines are read
    from text that still holds its amounts.
    """
    required = required or {}
    entries = [(f"CATEGORY_{c}", k) for c, k in categories] + [(f"QUESTION_{q}", k) for q, k in questions if k not in required]
    rows = lines.select(key, "line_no", "line")
    pick = lambda df, tag, matched, context: df.select(key, "line_no", tag.alias("tag"), matched.alias("matched"), context.alias("context"))
    nothing = F.lit(None).cast("string")
    lexicon = lexicon_hits(rows, entries, negative, required)
    term = lexicon_hits(rows, [("TERM", t) for t in terms])
    metrics = metric_tags(rows, key=key)
    dialogue = dialogue_tags(rows, metrics, key)
    parts = [
        pick(lexicon, F.col("category"), F.col("keyword"), F.col("context")),
        pick(term, F.col("category"), F.col("keyword"), F.col("context")),
        pick(metrics, F.col("metric"), F.col("value").cast("string"), nothing),
        pick(dialogue, F.concat(F.lit("DIALOGUE_"), F.initcap("dialogue")), nothing, nothing),
        pick(context_cascade(rows, is_seed(F.col("line")), key=key), F.lit("CONTEXT"), nothing, nothing),
    ]
    tagged = reduce(DataFrame.unionByName, parts)
    return tagged.unionByName(pick(general_tags(rows, tagged, key), F.lit("GENERAL"), nothing, nothing))
