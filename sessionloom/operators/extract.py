"""Entities found by patterns and accepted by gazetteer lookups."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionloom.functions.scalars import split_terms
from sessionloom.operators.gazetteer import with_flag
from sessionloom.session import broadcast_if_small, cut

# Words beside which names stand, and the last words of names, by kind of entity.
HONORIFICS = "Mr Mrs Ms Miss Dr Elder Chief Auntie Uncle".split()
SPEECH = "said says asked told explained answered added laughed joined brought drove".split()
ORGANIZATIONS = "Cooperative Coop Guild Alliance Association Trust Union Society Corporation Authority Agency Foundation Federation Services".split()
FEATURES = "River Island Creek Landing Harbor Falls Ridge Springs Junction Crossing Mountain Village Point".split()
NATIONS = "Nation Tribe Tribes Pueblo Band Rancheria".split()
_WORD = r"\p{Lu}[\p{L}'-]*\p{Ll}"


def _run(words: int, last: Sequence[str] = ()) -> str:
    """Pattern of up to ``words`` capitalised words, followed by one of ``last`` if given."""
    more = rf"(?: {_WORD}){{0,{words - 1}}}"
    return rf"{_WORD}{more}" + (" (?:" + "|".join(last) + ")" if last else "")


#: (kind, pattern, group of the surface), in order of preference.
PATTERNS = [
    ("person", rf"(?m)^({_run(3)}): ", 1),
    ("person", r"(?:" + "|".join(HONORIFICS) + rf")\.? ({_run(2)})", 1),
    ("person", rf"({_WORD} {_WORD}),? (?:" + "|".join(SPEECH) + r")(?:[^\p{L}]|$)", 1),
    ("organization", rf"({_run(4, ORGANIZATIONS)})(?:[^\p{{L}}]|$)", 1),
    ("location", rf"({_run(3)}), \p{{Lu}}{{2}}(?:[^\p{{L}}]|$)", 1),
    ("location", rf"({_run(3, FEATURES)})(?:[^\p{{L}}]|$)", 1),
    ("location", rf"({_WORD}) District(?:[^\p{{L}}]|$)", 1),
    ("tribe", rf"({_run(3, NATIONS)})(?:[^\p{{L}}]|$)", 1),
]
#: Least length of a surface by kind.
LEAST_LENGTH = {"person": 3, "organization": 10, "location": 3, "tribe": 4}


def mask_terms(text: Column, terms: Sequence[str], placeholder: str = "TERM_PLACEHOLDER") -> Column:
    """Terms that look like names replaced before extraction."""
    for term in terms:
        text = F.regexp_replace(text, r"(?i)\b\Q" + term + r"\E\b", placeholder)
    return text


def candidates(texts: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, kind, surface, pattern_rank): every distinct surface of a document, by the first pattern that finds it.

    Surfaces are put to single blanks; those shorter than their kind's least length are left out; NULL texts have none.
    """

    def tagged(rank: int, kind: str, pattern: str, group: int) -> Column:
        surface = lambda s: F.struct(F.lit(kind).alias("kind"), F.regexp_replace(s, r"\s+", " ").alias("surface"), F.lit(rank).alias("pattern_rank"))
        return F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), surface)

    found = [tagged(rank, *pattern) for rank, pattern in enumerate(PATTERNS)]
    rows = texts.select(key, F.explode(F.flatten(F.array(*found))).alias("f")).select(key, "f.*")
    least = F.create_map(*(F.lit(x) for pair in LEAST_LENGTH.items() for x in pair))
    return rows.where(F.length("surface") >= least[F.col("kind")]).groupBy(key, "kind", "surface").agg(F.min("pattern_rank").cast("long").alias("pattern_rank"))


def is_tribe_term(value: Column, terms: DataFrame, df: DataFrame, flag: str = "tribe_term") -> DataFrame:
    """``df`` with ``flag``: whether the whole value or one of its parts (split at / , ; & and "and") is a known term."""
    key = F.monotonically_increasing_id().alias("__row")
    rows = cut(df.select("*", key, value.alias("__value")))
    parts = rows.select("__row", F.explode(F.array_distinct(F.array_append(split_terms(F.lower("__value")), F.lower(F.trim("__value"))))).alias("term"))
    hits = parts.join(broadcast_if_small(terms.select("term").distinct()), "term", "left_semi").select("__row").distinct().withColumn(flag, F.lit(True))
    return rows.join(hits, "__row", "left").withColumn(flag, F.coalesce(flag, F.lit(False))).drop("__row", "__value")


# Words that show that a recognised person, organisation or place is none.
NO_PERSON = "coop cooperative grant board council market river creek village nation tribe band harvest program office school".split()
INTRODUCERS = "i am|this is|name is|named|called|met|with".split("|")


def accept_recognized(found: DataFrame, texts: DataFrame, key: str = "doc_id", text: str = "text", places: Sequence[str] = ()) -> DataFrame:
    """Entities of a recognizer (key, start, end, label, surface) that are accepted, as (key, kind, surface, start).

    Persons: no clock time, no word of ``NO_PERSON``, and a single word only within 40 characters of an introducing
    phrase. Organisations: two words and more than five letters, not a person's or place's word alone. Locations: two
    capitalised words only if they end in a feature word or are listed in ``places``.
    """
    rows = found.join(texts.select(key, F.col(text).alias("__text")), key)
    low, words = F.lower("surface"), F.size(F.split(F.trim("surface"), r"\s+"))
    before = F.lower(F.substring("__text", F.greatest(F.col("start") - 40, F.lit(0)) + 1, F.least(F.col("start"), F.lit(40))))
    listed = lambda names: low.rlike(r"(?:^|[^a-z])(?:" + "|".join(names) + r")(?:[^a-z]|$)")
    clock = F.col("surface").rlike(r"^[0-9]{2}:[0-9]{2}(:[0-9]{2})?(\.[0-9]+)?$")
    person = (F.col("label") == "PERSON") & ~clock & ~listed(NO_PERSON) & ((words > 1) | before.rlike("(?:" + "|".join(INTRODUCERS) + r")\s+$"))
    organization = (F.col("label") == "ORG") & (words > 1) & (F.length("surface") > 5)
    feature = listed([w.lower() for w in FEATURES]) | low.isin(*[p.lower() for p in places]) if places else listed([w.lower() for w in FEATURES])
    location = F.col("label").isin("GPE", "LOC") & ((words != 2) | feature | ~F.col("surface").rlike(r"^\p{Lu}\p{L}+ \p{Lu}\p{L}+$"))
    kind = F.when(person, "person").when(organization, "organization").when(location, "location")
    return rows.withColumn("kind", kind).where("kind is not null").select(key, "kind", "surface", "start")


def merge_recognized(patterns: DataFrame, recognized: DataFrame, key: str = "doc_id") -> DataFrame:
    """Both sources of entities as (key, kind, surface, pattern_rank); a surface found by a pattern keeps its rank."""
    behind = recognized.select(key, "kind", "surface", F.lit(len(PATTERNS)).cast("long").alias("pattern_rank"))
    return patterns.select(key, "kind", "surface", "pattern_rank").unionByName(behind).groupBy(key, "kind", "surface").agg(F.min("pattern_rank").alias("pattern_rank"))


def entities(texts: DataFrame, first: DataFrame, last: DataFrame, tribal: DataFrame, general: DataFrame, ambiguous: DataFrame, key: str = "doc_id", text: str = "text", masked: Sequence[str] = (), recognized: DataFrame | None = None) -> DataFrame:
    """Accepted entities (key, kind, surface, pattern_rank) of texts.

    ``masked`` terms are hidden first; patterns (and a recognizer's accepted findings, if given) propose, the gazetteer
    accepts: persons by ``valid_names``, locations by ``valid_locations`` with the text as context; organisations and
    tribes stand as found. A surface that is a tribe is no location or organisation of the same document. Speaker
    labels (the first pattern) are persons without lookup if they have two words.
    """
    hidden = texts.select(key, mask_terms(F.col(text), masked).alias(text))
    proposed = candidates(hidden, key, text)
    if recognized is not None:
        proposed = merge_recognized(proposed, recognized, key)
    proposed = cut(proposed)  # read by every kind; far smaller than the texts
    people = valid_names(proposed.where("kind = 'person'"), first, last, "surface", STOP_WORDS)
    people = people.where(F.col("valid") | ((F.col("pattern_rank") == 0) & (F.size(F.split("surface", " ")) > 1))).drop("valid")
    places = proposed.where("kind = 'location'").withColumn("context", F.col("surface"))
    places = valid_locations(places, tribal, general, ambiguous, "surface").where("valid").drop("valid", "context")
    rest = proposed.where("kind in ('organization', 'tribe')")
    tribes = rest.where("kind = 'tribe'").select(key, "surface")
    others = rest.where("kind = 'organization'").unionByName(places.select(*rest.columns)).join(tribes, [key, "surface"], "left_anti")
    return people.select(*rest.columns).unionByName(rest.where("kind = 'tribe'")).unionByName(others.select(*rest.columns))


# Words that no name of a person holds.
STOP_WORDS = ["the", "and", "of", "for", "with", "our", "this", "that", "we", "they", "you", "it", "is", "was"]


def valid_names(names: DataFrame, first: DataFrame, last: DataFrame, name: str = "name", stop_words: Sequence[str] = ()) -> DataFrame:
    """``names`` with ``valid``: by the last word's presence among last names, else by form and the first word.

    Two letters at least; one word must be a known first name; two to four capitalised words without stop words pass.
    """
    tokens = F.split(F.trim(name), r"\s+")
    flagged = with_flag(names, F.element_at(tokens, -1), last, "name", "__last")
    flagged = with_flag(flagged, F.element_at(tokens, 1), first, "name", "__first")
    size = F.size(tokens)
    capital = F.forall(tokens, lambda t: t.rlike("^[A-Z]"))
    stopped = F.exists(tokens, lambda t: F.lower(t).isin(*stop_words)) if stop_words else F.lit(False)
    valid = F.when(F.length(name) < 2, False).when(F.col("__last"), True).when(size == 1, F.col("__first")).when(size > 4, False).otherwise(capital & ~stopped)
    return flagged.withColumn("valid", valid).drop("__first", "__last")


def valid_locations(places: DataFrame, tribal: DataFrame, general: DataFrame, ambiguous: DataFrame, name: str = "name", context: str = "context") -> DataFrame:
    """``places`` with ``valid``: known tribal or general places, else ambiguous names judged by their context."""
    flagged = with_flag(places, F.col(name), tribal, "name", "__tribal", ignore_case=True)
    flagged = with_flag(flagged, F.col(name), general, "name", "__general", ignore_case=True)
    known = ambiguous.select(F.col("name").alias("__name"), "is_primarily_place").dropDuplicates(["__name"])
    joined = flagged.join(known, F.col(name) == F.col("__name"), "left")
    place_word = F.col(context).rlike(r"(?i)\b(?:in|at|near|from|to|town|city|village|county)\s")
    speech = F.col(context).rlike(r"(?i)\b(?:said|says|asked|told|explained)\b")
    unsure = F.when(place_word, True).when(speech, False).otherwise(F.col("is_primarily_place"))
    valid = F.col("__tribal") | F.col("__general") | F.when(F.col("__name").isNotNull(), unsure).otherwise(F.col(name).rlike(r"^[A-Z][a-z]+(?: [A-Z][a-z]+)+$"))
    return joined.withColumn("valid", valid).drop("__tribal", "__general", "__name", "is_primarily_place")


def with_recognizer(texts: DataFrame, recognize: Callable[[str], list[tuple[int, int, str, str]]], key: str = "doc_id", text: str = "text") -> DataFrame:
    """Entities of a pluggable recognizer: (key, start, end, label, surface); texts are passed whole, NULL ones skipped."""
    schema = f"`{key}` {texts.schema[key].dataType.simpleString()}, start int, end int, label string, surface string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(k, *entity) for k, t in zip(batch[key], batch[text], strict=True) if t for entity in recognize(t)]
            yield pd.DataFrame(rows, columns=[key, "start", "end", "label", "surface"])

    return texts.select(key, text).mapInPandas(run, schema)
