"""Cleaned transcripts graded by a fixed rubric, and the history of grades."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionloom.functions.scalars import letter_grade
from sessionloom.operators.lines import beside_text

# The most points of each category.
POINTS = {"completeness": 25.0, "accuracy": 20.0, "formatting": 15.0, "citation": 15.0, "tag_completeness": 10.0, "tag_precision": 10.0, "matching": 5.0}
# What to do about a category that isn't graded A.
SUGGESTIONS = {
    "completeness": "Extend the gazetteer for the surfaces that remain.",
    "accuracy": "Review the surfaces that remain against the entities found.",
    "formatting": "Remove leftover times and headers and label the dialogue.",
    "citation": "Number speakers, verses and pages.",
    "tag_completeness": "Add keywords for the lines without a tag.",
    "tag_precision": "Correct the tags recorded as wrong.",
    "matching": "Link more variants of names.",
}


def residual_entities(entities: DataFrame, text: DataFrame, key: str = "doc_id") -> DataFrame:
    """Entities (key, kind, surface) that still stand in the cleaned text as whole words outside brackets.

    The join is on the document; a surface inside ``[...]`` or a time of day is no residue.
    """
    pattern = lambda s: F.concat(F.lit(r"(?i)(?<![A-Za-z0-9_\[])\Q"), s, F.lit(r"\E(?![A-Za-z0-9_\]])"))
    clock = lambda s: s.rlike(r"^[0-9]{2}:[0-9]{2}(:[0-9]{2})?(\.[0-9]+)?$")
    left = F.filter("items", lambda e: ~clock(e["surface"]) & F.regexp_like("text", pattern(e["surface"])))
    return beside_text(entities.select(key, "kind", "surface"), text, key).select(key, F.explode(left).alias("e")).select(key, "e.kind", "e.surface")


# Words near which a year tells of a founding.
FOUNDING = "(?:found|establish|start|began|charter|incorporat)"


def raw_entities(text: DataFrame, key: str = "doc_id") -> DataFrame:
    """What a raw text holds that its cleaned form mustn't: (key, kind, surface), distinct.

    Speaker labels of two words, amounts of money, and years within 30 characters of a word of founding.
    """
    t = F.col("text")
    label = F.regexp_extract_all(t, F.lit(r"(?m)^([A-Z][A-Za-z]* [A-Za-z0-9]+): "), F.lit(1))
    money = F.regexp_extract_all(t, F.lit(r"\$[0-9][0-9,]*"), F.lit(0))
    near = F.concat(F.regexp_extract_all(t, F.lit(rf"(?i){FOUNDING}[^\n]{{0,30}}?\b((?:19|20)[0-9]{{2}})\b"), F.lit(1)), F.regexp_extract_all(t, F.lit(rf"(?i)\b((?:19|20)[0-9]{{2}})\b[^\n]{{0,30}}?{FOUNDING}"), F.lit(1)))
    named = lambda kind, found: F.transform(found, lambda x: F.struct(F.lit(kind).alias("kind"), x.alias("surface")))
    found = F.concat(named("speaker", label), named("money", money), named("year", near))
    return text.select(key, F.explode(F.array_distinct(found)).alias("e")).select(key, "e.kind", "e.surface")


def still_there(entities: DataFrame, cleaned: DataFrame, key: str = "doc_id") -> DataFrame:
    """Entities (key, kind, surface) that stand in the cleaned text (key, text), whatever is around them."""
    left = F.filter("items", lambda e: F.contains("text", e["surface"]))
    return beside_text(entities.select(key, "kind", "surface"), cleaned, key).select(key, F.explode(left).alias("e")).select(key, "e.kind", "e.surface")


def code_nearby(text: Column, surface: Column, reach: int = 30) -> Column:
    """Whether every occurrence of ``surface`` stands within ``reach`` characters of a code (#A, Person_1, [A.1])."""
    code = r"(?:#[A-Z]+\b|\b(?:Person|Organization|Location|Tribe)_[0-9]+\b|\[[A-Z]+\.[0-9]+\])"
    quoted = F.concat(F.lit(r"\Q"), surface, F.lit(r"\E"))
    left = F.regexp_replace(text, F.concat(F.lit(code + rf".{{0,{reach}}}?"), quoted), F.lit(" "))
    left = F.regexp_replace(left, F.concat(quoted, F.lit(rf".{{0,{reach}}}?" + code)), F.lit(" "))
    return F.contains(text, surface) & ~F.contains(left, surface)


def residual_totals(entities: DataFrame, residual: DataFrame, key: str = "doc_id") -> DataFrame:
    """Per document its entities, those that remain, and their share."""
    total = entities.groupBy(key).agg(F.count("*").alias("entities"))
    left = residual.groupBy(key).agg(F.count("*").alias("residual"))
    out = total.join(left, key, "left").withColumn("residual", F.coalesce("residual", F.lit(0)))
    return out.withColumn("rate", F.col("residual") / F.col("entities"))


def citation_checks(verses: DataFrame, key: str = "doc_id") -> DataFrame:
    """Per document the speakers' letters, verses and pages cited, and whether a table of times can be made."""
    return verses.groupBy(key).agg(F.countDistinct("letter").alias("letters"), F.count("*").alias("verses"), F.countDistinct("page").alias("pages"), (F.count("ts") > 0).alias("has_table"))


def gather_checks(cleaned: DataFrame, totals: DataFrame, citations: DataFrame, covered: DataFrame, errors: DataFrame, variants: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per cleaned text with all that ``scores`` needs; what a document lacks counts as none of it.

    ``totals`` (entities, residual), ``citations`` (letters, verses, pages, has_table), ``covered`` (coverage), ``errors``
    (tag_errors) and ``variants`` (variants, NULL without a mapping) are joined by document.
    """
    out = format_checks(cleaned, key)
    for side, columns in ((totals, ["entities", "residual"]), (citations, ["letters", "verses", "pages", "has_table"]), (covered, ["coverage"]), (errors, ["tag_errors"]), (variants, ["variants"])):
        out = out.join(side.select(key, *columns), key, "left")
    return out.na.fill(0, ["entities", "residual", "letters", "verses", "pages", "tag_errors"]).na.fill(1.0, ["coverage"]).na.fill(False, ["has_table"])


def grade_report(graded: DataFrame, version: str, key: str = "doc_id") -> DataFrame:
    """One row per document: total, grade, and a map from category to its grade, points, most points and suggestions."""
    part = lambda name: F.struct(letter_grade(F.col(name) / POINTS[name]).alias("grade"), F.col(name).alias("score"), F.lit(POINTS[name]).alias("max_score"), F.when(F.col(name) < 0.93 * POINTS[name], F.array(F.lit(SUGGESTIONS[name]))).otherwise(F.array().cast("array<string>")).alias("suggestions"))
    categories = F.create_map(*(x for name in POINTS for x in (F.lit(name), part(name))))
    return graded.select(key, "total", "grade", categories.alias("categories"), F.lit(version).alias("grader_version"))


def top_suggestions(categories: DataFrame, most: int = 10) -> DataFrame:
    """The ``most`` suggestions that apply to the most documents."""
    advice = F.create_map(*(F.lit(x) for pair in SUGGESTIONS.items() for x in pair))
    return categories.where("grade <> 'A'").groupBy(advice[F.col("category")].alias("suggestion")).agg(F.count("*").alias("documents")).orderBy(F.desc("documents"), "suggestion").limit(most)


def all_graded_a(categories: DataFrame, group: str) -> DataFrame:
    """Per group whether it has grades and all of them are A or A-; groups come from the rows, so none is empty."""
    return categories.groupBy(group).agg(F.count("*").alias("grades"), F.coalesce(F.bool_and(F.col("grade").isin("A", "A-")), F.lit(False)).alias("all_a"))


def run_history(graded: DataFrame, iteration: str, most_iterations: int = 5) -> DataFrame:
    """Per iteration the mean total, the change, whether all grades are A or A-, and why the loop ends there, if it does.

    An iteration ends the loop if all of its grades are A or A-, if it is the second small change in a row, or if it is
    the ``most_iterations``-th.
    """
    means = graded.groupBy(iteration).agg(F.avg("total").alias("mean_total"), F.count("*").alias("documents"), F.bool_and(F.col("grade").isin("A", "A-")).alias("all_a"))
    marked = stop_rule(means, iteration, "mean_total").withColumn("number", F.row_number().over(Window.orderBy(iteration)))
    reason = F.when(F.col("all_a"), "all A").when(F.col("stop"), "no progress").when(F.col("number") >= most_iterations, "most iterations")
    return marked.withColumn("ends", reason).drop("number")


def format_checks(text: DataFrame, key: str = "doc_id") -> DataFrame:
    """Flags of a cleaned text: times, cue header, dialogue labels, citations, leftover marks."""
    t = F.col("text")
    return text.select(
        key,
        t.rlike(r"[0-9]{2}:[0-9]{2}:[0-9]{2}").alias("has_times"),
        t.rlike(r"^WEBVTT").alias("has_header"),
        t.rlike(r"(?m)^[A-Z][A-Za-z0-9 ]*: ").alias("has_dialogue"),
        F.regexp_count(t, F.lit(r"\[[A-Z]+\.[0-9]+\]")).cast("long").alias("citations"),
        F.regexp_count(t, F.lit(r"-->")).cast("long").alias("artifacts"),
    )


def scores(checks: DataFrame) -> DataFrame:
    """Points of the seven categories, their total and the letter grade.

    ``checks`` holds residual, entities, has_times, has_header, has_dialogue, artifacts, letters, verses, pages,
    has_table, coverage, tag_errors and variants (NULL without a mapping).
    """
    c = F.col
    n = lambda x: x.cast("double")
    graded = checks.select(
        "*",
        F.greatest(F.lit(0.0), 25.0 - n(c("residual"))).alias("completeness"),
        F.when(c("entities") > 0, 20.0 * F.greatest(F.lit(0.0), 1 - c("residual") / c("entities"))).otherwise(20.0).alias("accuracy"),
        F.greatest(F.lit(0.0), 15.0 - 4 * n(c("has_times").cast("int")) - 2 * n(c("has_header").cast("int")) - F.when(c("has_dialogue"), 0.0).otherwise(4.0) - F.least(F.lit(3.0), n(c("artifacts")))).alias("formatting"),
        (15.0 - F.when(c("letters") > 0, 0.0).otherwise(5.0) - F.when(c("verses") > 0, 0.0).otherwise(5.0) - F.when(c("pages") > 0, 0.0).otherwise(3.0) - F.when(c("has_table"), 0.0).otherwise(2.0)).alias("citation"),
        (10.0 * c("coverage")).alias("tag_completeness"),
        F.greatest(F.lit(0.0), 10.0 - n(c("tag_errors"))).alias("tag_precision"),
        F.when(c("variants").isNull(), 0.0).when(c("variants") >= 5, 5.0).otherwise(F.greatest(F.lit(1.0), n(c("variants")))).alias("matching"),
    )
    total = sum((c(name) for name in POINTS), F.lit(0.0))
    return graded.withColumn("total", total).withColumn("grade", letter_grade(F.col("total") / 100))


def category_grades(graded: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, category, score, max_score, grade) of every document and category."""
    names = F.array(*(F.struct(F.lit(n).alias("category"), F.col(n).alias("score"), F.lit(m).alias("max_score")) for n, m in POINTS.items()))
    rows = graded.select(key, F.explode(names).alias("c")).select(key, "c.*")
    return rows.withColumn("grade", letter_grade(F.col("score") / F.col("max_score")))


def priorities(categories: DataFrame) -> DataFrame:
    """Categories with grades below A: how many, their mean share, the suggestion; the weakest first."""
    weak = categories.where("grade <> 'A'").groupBy("category").agg(F.count("*").alias("documents"), F.avg(F.col("score") / F.col("max_score")).alias("mean_share"))
    advice = F.create_map(*(F.lit(x) for pair in SUGGESTIONS.items() for x in pair))
    return weak.withColumn("suggestion", advice[F.col("category")]).orderBy("mean_share", "category")


def stop_rule(history: DataFrame, order: str, score: str, least: float = 0.5, patience: int = 2, group: str | None = None) -> DataFrame:
    """``history`` with the change since the row before, the run of small changes and whether to stop."""
    by = Window.partitionBy(group) if group else Window.partitionBy(F.lit(0))
    w = by.orderBy(order)
    change = F.abs(F.col(score) - F.lag(score).over(w))
    marked = history.withColumn("change", change).withColumn("small", F.coalesce((F.col("change") < least).cast("int"), F.lit(0)))
    marked = marked.withColumn("__island", F.sum(1 - F.col("small")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    inner = (Window.partitionBy(group, "__island") if group else Window.partitionBy("__island")).orderBy(order)
    runs = F.sum("small").over(inner.rowsBetween(Window.unboundedPreceding, 0))
    return marked.withColumn("small_run", runs.cast("long")).withColumn("stop", F.col("small_run") >= patience).drop("__island", "small")
