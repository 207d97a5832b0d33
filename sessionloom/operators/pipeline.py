"""Transcripts cleaned end to end: segments, entities, codes, redaction, citations, tags and a summary, as DataFrames.

Every stage is a table keyed by the document; nothing is gathered. The order of the rewrites is observable: corrected
words, ambiguous words, cue marks and clocks, persons (with bare first names in context), organisations, locations,
tribes, amounts, years, then repeats of codes.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionloom.operators import cluster, extract, lines, redact, reports, tagging
from sessionloom.session import cut


@dataclass(frozen=True)
class Lookups:
    """The gazetteer a run uses; an absent one is replaced by empty tables, so patterns alone decide."""

    first: DataFrame
    last: DataFrame
    tribal: DataFrame
    general: DataFrame
    ambiguous: DataFrame

    @staticmethod
    def none(spark) -> Lookups:
        empty = spark.createDataFrame([], "name string")
        return Lookups(empty, empty, empty, empty, spark.createDataFrame([], "name string, is_primarily_place boolean"))


@dataclass(frozen=True)
class Settings:
    """Word lists of a run: all of them are the caller's, none is built in."""

    categories: Sequence[tuple[str, str]] = ()
    questions: Sequence[tuple[str, str]] = ()
    terms: Sequence[str] = ()
    negative: Mapping[str, str] = field(default_factory=dict)
    required: Mapping[str, str] = field(default_factory=dict)
    masked: Sequence[str] = ()
    corrections: Mapping[str, str] = field(default_factory=dict)
    ambiguous_words: Sequence[str] = ()
    ambiguous_policy: str = "mark_all"
    lines_per_page: int = 50


@dataclass(frozen=True)
class Cleaned:
    """What a run makes: entities, their codes, name clusters, the text, verses, the cited lines, tags and the summary."""

    entities: DataFrame
    codes: DataFrame
    clusters: DataFrame
    texts: DataFrame
    verses: DataFrame
    cited: DataFrame
    tags: DataFrame
    summary: DataFrame


def code_entities(found: DataFrame, texts: DataFrame, key: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """(codes, clusters) of entities (key, kind, surface, pattern_rank) in their texts (key, text).

    Persons are clustered and coded by how often their cluster's names stand in the text, the most frequent first; the
    other kinds are numbered by first position, then by name.
    """
    times = lambda s: F.regexp_count("text", F.concat(F.lit(r"\Q"), s, F.lit(r"\E"))).cast("long")
    counted = F.transform("items", lambda e: F.struct(e["kind"].alias("kind"), e["surface"].alias("surface"), F.position(e["surface"], F.col("text")).alias("at"), times(e["surface"]).alias("n")))
    places = cut(lines.beside_text(found.select(key, "kind", "surface"), texts, key).select(key, F.explode(counted).alias("e")).select(key, "e.*"))
    people = places.where("kind = 'person'")
    clusters = cluster.cluster_names(people.withColumn("at", F.col("at").cast("long")), key, "surface", "at")
    sums = clusters.join(people.select(key, "surface", F.col("n").alias("times")), [key, "surface"]).groupBy(key, "cluster", "canonical").agg(F.sum("times").alias("n"))
    coded = redact.assign_codes(sums, key, "canonical").select(key, "cluster", "code")
    persons = clusters.join(coded, [key, "cluster"]).select(key, F.lit("person").alias("kind"), "surface", "code")
    others = redact.numbered_codes(places.where("kind <> 'person'"), key, F.initcap("kind"), "at", "surface").select(key, "kind", "surface", "code")
    return persons.unionByName(others), clusters


def clean_transcripts(documents: DataFrame, lookups: Lookups, settings: Settings | None = None, key: str = "doc_id", text: str = "text", recognized: DataFrame | None = None) -> Cleaned:
    """Clean transcripts (key, text) end to end; see ``Cleaned`` for what comes out.

    NULL texts stay NULL and have no entities, verses or tags. Tags and metrics are read from the lines before amounts
    and years are masked, so that they are found at all; line numbers are those of the cleaned text, which keeps its
    line breaks. Verses are the lines with a speaker label, timed by the segments of the raw text in order; a text
    without any speaker has one speaker, "Narrative", for its non-blank lines.
    """
    settings = settings or Settings()
    raw = documents.select(key, F.col(text).alias("text"))
    numbered = lines.split_lines(raw, key)
    segments = lines.cue_segments(numbered, key).select(key, "seg_idx", "ts")
    clocks = lines.clock_segments(numbered, key).select(key, "seg_idx", "ts").join(segments.select(key).distinct(), key, "left_anti")
    segments = segments.unionByName(clocks)

    bare = lines.strip_clocks(lines.strip_cue_marks(F.col("text")))
    body = cut(raw.select(key, bare.alias("text")))
    found = cut(extract.entities(body, lookups.first, lookups.last, lookups.tribal, lookups.general, lookups.ambiguous, key, "text", settings.masked, recognized))
    codes, clusters = code_entities(found, body, key)
    codes = cut(codes)

    marked = F.col("text")
    if settings.corrections:
        marked = redact.fix_terms(marked, [""], settings.corrections)
    if settings.ambiguous_words:
        marked = redact.mark_ambiguous(marked, settings.ambiguous_words, settings.ambiguous_policy)
    named = cut(redact.replace_mapped(body.select(key, marked.alias("text")), codes, key, first_names=True))
    masked = redact.mask_years(redact.mask_money(F.col("text")))
    texts = named.select(key, redact.drop_stray_codes(redact.collapse_codes(masked)).alias("text"))

    kept = lines.split_lines(texts, key)
    spoken = lines.speaker_lines(kept, key)
    silent = kept.where(F.trim("line") != "").join(spoken.select(key).distinct(), key, "left_anti")
    spoken = spoken.unionByName(silent.select(key, "line_no", F.lit("Narrative").alias("speaker"), F.col("line").alias("body")))
    verses = cut(lines.attach_segments(lines.cite(spoken, settings.lines_per_page, key), segments, key))
    cited = lines.render_verses(verses, key)

    tags = tagging.all_tags(lines.split_lines(named, key), settings.categories, settings.questions, settings.terms, settings.negative, settings.required, key)
    tags = cut(tags)
    counts = raw.select(key).join(reports.entity_counts(codes, key), key, "left").join(tags.groupBy(key).agg(F.count("*").alias("tags"), F.countDistinct("tag").alias("kinds_of_tag")), key, "left")
    summary = counts.join(verses.groupBy(key).agg(F.count("*").alias("verses"), F.max("page").alias("pages")), key, "left").na.fill(0)
    return Cleaned(found, codes, clusters, texts, verses, cited, tags, summary)
