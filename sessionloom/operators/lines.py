"""Transcripts as numbered lines and timed segments, with speakers, verses and pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionloom.functions.scalars import base26

CLOCK = r"^[0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]+)?$"
ARROW = r"([0-9]{2}:[0-9]{2}:[0-9]{2}\.[0-9]{3})\s*-->\s*([0-9]{2}:[0-9]{2}:[0-9]{2}\.[0-9]{3})"


def split_lines(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, line_no from 1, line) of every text; a carriage return before the break is cut, blank lines stay.

    A NULL text has no lines, an empty one has one.
    """
    lines = documents.select(key, F.posexplode(F.split(F.col(text), "\r?\n")).alias("pos", "line"))
    return lines.select(key, (F.col("pos") + 1).cast("long").alias("line_no"), "line")


def split_any(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """As ``split_lines``, but every kind of line break ends a line (CR, VT, FF, NEL, U+2028, U+2029); a last empty line is none."""
    broken = F.regexp_replace(text, "\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]", "\n")
    parts = F.split(F.regexp_replace(broken, "\n$", ""), "\n")
    lines = documents.where(F.length(text) > 0).select(key, F.posexplode(parts).alias("pos", "line"))
    return lines.select(key, (F.col("pos") + 1).cast("long").alias("line_no"), "line")


def by_line(key: str = "doc_id") -> Window:
    return Window.partitionBy(key).orderBy("line_no")


def so_far(key: str = "doc_id") -> Window:
    return by_line(key).rowsBetween(Window.unboundedPreceding, 0)


def taggable_lines(lines: DataFrame, header: str, key: str = "doc_id") -> DataFrame:
    """Non-blank lines before the first one matching ``header``, without page numbers and rules of ten signs or more."""
    seen = F.max(F.col("line").rlike(header).cast("int")).over(so_far(key))
    kept = lines.withColumn("__seen", seen).where("__seen = 0").drop("__seen")
    return kept.where(~F.col("line").rlike(r"^\s*$") & ~F.col("line").rlike(r"^\s*Page [0-9]+\s*$") & ~F.col("line").rlike(r"^\s*[=-]{10,}\s*$"))


def clock_segments(lines: DataFrame, key: str = "doc_id") -> DataFrame:
    """Segments of a transcript with clock lines: (key, seg_idx, ts, speaker, text).

    A clock line opens a segment; empty ones are dropped; two speakers alternate over those kept; lines before the
    first clock belong to none.
    """
    trimmed = lines.withColumn("line", F.trim("line"))
    is_clock = F.col("line").rlike(CLOCK)
    marked = trimmed.withColumn("seg", F.sum(is_clock.cast("int")).over(so_far(key))).withColumn("ts", F.last(F.when(is_clock, F.col("line")), ignorenulls=True).over(so_far(key)))
    body = marked.where((F.col("seg") > 0) & ~is_clock & (F.col("line") != ""))
    ordered = F.array_sort(F.collect_list(F.struct("line_no", "line")))
    segments = body.groupBy(key, "seg").agg(F.min("ts").alias("ts"), F.array_join(F.transform(ordered, lambda x: x["line"]), " ").alias("text"))
    idx = F.row_number().over(Window.partitionBy(key).orderBy("seg"))
    return segments.select(key, idx.cast("long").alias("seg_idx"), F.substring("ts", 1, 8).alias("ts"), F.when(idx % 2 == 1, "Person_1").otherwise("Person_2").alias("speaker"), "text")


def cue_segments(lines: DataFrame, key: str = "doc_id") -> DataFrame:
    """Cues of a WEBVTT transcript: (key, seg_idx, ts, text); a cue's text ends at the next cue number, blank cues are dropped."""
    trimmed = lines.withColumn("line", F.trim("line"))
    follow = F.lead("line").over(by_line(key))
    arrow = F.col("line").rlike(ARROW)
    number = F.col("line").rlike(r"^[0-9]+$")
    marked = trimmed.withColumn("number", number & F.coalesce(follow.rlike(ARROW), F.lit(False))).withColumn("seg", F.sum(arrow.cast("int")).over(so_far(key)))
    marked = marked.withColumn("ts", F.last(F.when(arrow, F.regexp_extract("line", ARROW, 1)), ignorenulls=True).over(so_far(key)))
    body = marked.where((F.col("seg") > 0) & ~F.col("line").rlike(ARROW) & ~F.col("number") & (F.col("line") != ""))
    ordered = F.array_sort(F.collect_list(F.struct("line_no", "line")))
    cues = body.groupBy(key, "seg").agg(F.min("ts").alias("ts"), F.array_join(F.transform(ordered, lambda x: x["line"]), " ").alias("text"))
    return cues.select(key, F.row_number().over(Window.partitionBy(key).orderBy("seg")).cast("long").alias("seg_idx"), F.substring("ts", 1, 8).alias("ts"), "text")


def strip_cue_marks(text: Column) -> Column:
    """A WEBVTT text without header, cue numbers and times; three line breaks or more become two, ends are trimmed."""
    text = F.regexp_replace(text, "\r\n", "\n")
    for pattern in (r"(?m)^WEBVTT.*$", r"(?m)^[0-9]+[ \t]*$", r"(?m)^.*-->.*$", r"\.[0-9]{3}\s*-->\s*\.[0-9]{3}"):
        text = F.regexp_replace(text, pattern, "")
    return F.regexp_replace(F.regexp_replace(text, r"\n{3,}", "\n\n"), r"^\s+|\s+$", "")


def strip_clocks(text: Column) -> Column:
    """A text without inline HH:MM:SS."""
    return F.regexp_replace(text, r"(?<![A-Za-z0-9_])[0-9]{2}:[0-9]{2}:[0-9]{2}(?![A-Za-z0-9_])", "")


def speaker_lines(lines: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, line_no, speaker, body) of lines that begin with a speaker label: a code, or up to three words."""
    label = r"^(#[A-Z]+|[A-Z][A-Za-z_]*(?: [A-Za-z0-9]+){0,2}):\s+(.*)$"
    found = lines.where(F.col("line").rlike(label))
    return found.select(key, "line_no", F.regexp_extract("line", label, 1).alias("speaker"), F.regexp_extract("line", label, 2).alias("body"))


def cite(speakers: DataFrame, lines_per_page: int = 50, key: str = "doc_id") -> DataFrame:
    """Verses: the speaker's letter by order of names, the running verse of the speaker, the page and the citation."""
    content = F.row_number().over(by_line(key)) - 1
    letter = base26(F.dense_rank().over(Window.partitionBy(key).orderBy("speaker")) - 1)
    verse = F.row_number().over(Window.partitionBy(key, "speaker").orderBy("line_no"))
    out = speakers.withColumn("letter", letter).withColumn("verse", verse.cast("long")).withColumn("page", (F.floor(content / lines_per_page) + 1).cast("long"))
    return out.withColumn("citation", F.format_string("[%s.%d]", "letter", "verse"))


def attach_segments(verses: DataFrame, segments: DataFrame, key: str = "doc_id") -> DataFrame:
    """The k-th verse with the time of the k-th segment, NULL where there is none."""
    numbered = verses.withColumn("ordinal", F.row_number().over(by_line(key)).cast("long"))
    return numbered.join(segments.select(key, F.col("seg_idx").alias("ordinal"), "ts"), [key, "ordinal"], "left")


def reference_table(verses: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rendered reference rows of verses with a time: citation padded to 15, time to 12."""
    timed = verses.where("ts is not null")
    return timed.select(key, "citation", F.concat(F.rpad("citation", 15, " "), F.rpad("ts", 12, " "), F.col("speaker")).alias("row"))


def take_until(lines: DataFrame, delimiter: str, key: str = "doc_id") -> DataFrame:
    """Lines before the first one equal to ``delimiter``."""
    seen = F.max((F.col("line") == delimiter).cast("int")).over(so_far(key))
    return lines.withColumn("__seen", seen).where("__seen = 0").drop("__seen")


def beside_text(items: DataFrame, texts: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each text (key, text) once, with the array ``items`` of its rows of ``items``: so that no text is shuffled per item.

    Texts without items and items without a text give no row; a document's own items bound the array.
    """
    gathered = items.groupBy(key).agg(F.collect_list(F.struct(*(c for c in items.columns if c != key))).alias("items"))
    return texts.where(F.col(text).isNotNull()).select(key, F.col(text).alias("text")).join(gathered, key)


def join_lines(lines: DataFrame, key: str = "doc_id") -> DataFrame:
    """Lines put back to one text per document, in order."""
    ordered = F.array_sort(F.collect_list(F.struct("line_no", "line")))
    return lines.groupBy(key).agg(F.array_join(F.transform(ordered, lambda x: x["line"]), "\n").alias("text"))


def dialogue_lines(lines: DataFrame, labels: DataFrame | None = None, key: str = "doc_id") -> DataFrame:
    """Non-blank lines without those of digits only, each as "label: body".

    The label is the speaker's own, or what ``labels`` (key, speaker, label) gives for it; lines without a speaker are
    those of "Speaker".
    """
    label = r"^([A-Z][A-Za-z_]*(?: ?[A-Za-z0-9]+){0,2}):\s+(.*)$"
    kept = lines.where(~F.col("line").rlike(r"^\s*[0-9]*\s*$"))
    parted = kept.select(key, "line_no", F.nullif(F.regexp_extract("line", label, 1), F.lit("")).alias("speaker"), F.when(F.col("line").rlike(label), F.regexp_extract("line", label, 2)).otherwise(F.trim("line")).alias("body"))
    if labels is not None:
        parted = parted.join(labels.select(key, "speaker", "label"), [key, "speaker"], "left").withColumn("speaker", F.coalesce("label", "speaker")).drop("label")
    return parted.select(key, "line_no", F.concat(F.coalesce("speaker", F.lit("Speaker")), F.lit(": "), F.col("body")).alias("line"))


#: What stands in place of a reference table where no verse has a time.
NO_TIMES = "No times were recorded for this text."


def render_verses(verses: DataFrame, key: str = "doc_id") -> DataFrame:
    """Cited text: (key, position, line), a "Page N" line before each page's verses, then "[A.1] body" lines.

    The order within a document is (page, line_no); ``position`` runs from 1.
    """
    cited = verses.select(key, "page", F.col("line_no").alias("at"), F.concat_ws(" ", "citation", "body").alias("line"))
    heads = verses.groupBy(key, "page").agg((F.min("line_no") - 0.5).alias("at")).select(key, "page", "at", F.format_string("Page %d", "page").alias("line"))
    rows = cited.select(key, "page", F.col("at").cast("double").alias("at"), "line").unionByName(heads)
    return rows.select(key, F.row_number().over(Window.partitionBy(key).orderBy("page", "at")).cast("long").alias("position"), "line")


def full_reference_table(verses: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, position, row): the reference rows of each document, by letter and then verse, as text orders letters.

    A document none of whose verses has a time gets the one sentence that says so.
    """
    table = reference_table(verses, key).join(verses.select(key, "citation", "letter", "verse"), [key, "citation"])
    table = table.select(key, F.row_number().over(Window.partitionBy(key).orderBy("letter", "verse")).cast("long").alias("position"), "row")
    none = verses.groupBy(key).agg(F.count("ts").alias("timed")).where("timed = 0")
    return table.unionByName(none.select(key, F.lit(1).cast("long").alias("position"), F.lit(NO_TIMES).alias("row")))


def speakers(lines: DataFrame, key: str = "doc_id") -> DataFrame:
    """The distinct speaker labels of each document."""
    return speaker_lines(lines, key).select(key, "speaker").distinct()
