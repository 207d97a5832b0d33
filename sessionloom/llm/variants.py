"""Variant spellings of names linked to one entity.

Rows are reduced to distinct parsed names within their group (the roll, gazette or session they come from). An index
of token suffixes, read from both ends of the token, brings names together. A suffix whose names all share a longer one
is discarded, since that holds the same pairs; a suffix or token that too many names share is refined by the other
fields (tribe or state, then the ends of the other part of the name). Pairs of a block whose letters can agree at all
are compared by the longest-common-subsequence ratio of their parts. Equal and misspelt names make components; initials,
nicknames, acronyms and shortened names join the only component of their group they fit.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionloom.llm.spelling import abbreviates, fold, lcs_ratio, sound, typing_errors, within, words
from sessionloom.session import cut, spread

# Titles, endings of nicknames, words of organisations, administrative units, number words, roman numerals.
TITLES = frozenset("mr mrs ms miss mx dr prof elder auntie aunty aunt uncle chief chairman chairwoman chair councilor councilman rev sister brother grandma grandpa".split())
NICK_ENDINGS = ("ie", "ey", "y", "o", "i", "")
BODIES = ("association", "alliance", "cooperative", "corporation", "foundation", "federation", "guild", "trust", "union", "society", "services", "council", "committee", "company")
UNITS = ("district", "chapter", "ward", "precinct", "parish", "zone", "sector", "region", "division", "township", "county", "section")
NUMBER_WORDS = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty".split()
ROMAN = "i ii iii iv v vi vii viii ix x xi xii xiii xiv xv xvi xvii xviii xix xx".split()
_NUMBERS = {w: str(n) for n, w in enumerate(NUMBER_WORDS, 1)} | {w: str(n) for n, w in enumerate(ROMAN, 1)}
_DOTTED = re.compile(r"\b(?:[^\W\d_]\.){2,}")


@dataclass(frozen=True)
class Kind:
    """How names of one kind are parsed and compared.

    ``parse`` turns (name, second name) into parts, ``compare`` two tuples of parts and whether their refining field is
    known and agrees into "same", "weak" (the first is a short form that may stand for the second) or None. ``rank``
    tells full names from short forms. ``scope`` gives what must be equal for any link, ``anchors`` the two parts of
    which each must be like one of the other name's.
    """

    parse: Callable[[str | None, str | None], tuple[str, ...]]
    compare: Callable[[tuple[str, ...], tuple[str, ...], bool], str | None]
    rank: Callable[[tuple[str, ...]], int]
    scope: Callable[[tuple[str, ...]], str]
    anchors: Callable[[tuple[str, ...]], tuple[str, str]]


def parse_person(first: str | None, last: str | None) -> tuple[str, ...]:
    """(first, last): titles and middle initials dropped, "Last, First" put in order, parted surnames joined.

    An initial is one letter; a missing part is ''.
    """
    if last is None and first and "," in first:
        last, first = first.split(",", 1)
    if last is not None:
        a, b = words(fold(first).replace("'", "")), words(fold(last).replace("'", ""))
        a = [t for t in a if t not in TITLES] or a
        if not b:
            return parse_person(first, None)
        if len(a) > 1:
            a = [t for t in a if len(t) > 1] or a[:1]
        return "".join(a), "".join(b)
    tokens = words(fold(first).replace("'", ""))
    tokens = [t for t in tokens if t not in TITLES] or tokens
    if len(tokens) < 2:
        return ("", tokens[0]) if tokens else ("", "")
    middle = [t for t in tokens[1:-1] if len(t) > 1]
    return tokens[0], "".join([*middle, tokens[-1]])


def typo(a: str, b: str) -> bool:
    """Whether two tokens are one token typed differently, by their longest-common-subsequence ratio."""
    if a == b:
        return True
    if len(a) < 4 or len(b) < 4 or max(lcs_ratio(a, b), lcs_ratio(sound(a), sound(b))) < 0.7:
        return False
    return typing_errors(a, b, 2 + (min(len(a), len(b)) >= 9)) is not None


#: Typing errors that two names may have in all, with something else that agrees (an equal part, tribe or state) and without.
MOST_ERRORS, ALONE_ERRORS = 4, 3


def nickname(short: str, full: str) -> bool:
    """Whether ``short`` is the start of ``full`` with a nickname's ending, or one initial of it."""
    if len(short) == 1:
        return full.startswith(short)
    if len(full) < 4 or len(short) >= len(full):
        return False
    for ending in NICK_ENDINGS:
        base = short[: len(short) - len(ending)] if ending else short
        if short.endswith(ending) and len(base) >= 2 + (not ending) and len(base) <= 4 and full.startswith(base):
            return True
    return False


def compare_person(a: tuple[str, ...], b: tuple[str, ...], agree: bool = False) -> str | None:
    """Same person, or ``a`` a short form of ``b``; swapped first and last names are tried too."""
    for x, y in ((a, b), (a, b[::-1])):
        if min(map(len, x)) > 1 and min(map(len, y)) > 1 and typo(x[0], y[0]) and typo(x[1], y[1]):
            errors = (typing_errors(x[0], y[0], 4) or 0) + (typing_errors(x[1], y[1], 4) or 0)
            if errors <= (MOST_ERRORS if agree or x[0] == y[0] or x[1] == y[1] else ALONE_ERRORS):
                return "same"
        if min(map(len, y)) < 1:
            continue
        if x[0] and len(x[0]) < len(y[0]) and nickname(x[0], y[0]) and len(x[1]) > 1 and typo(x[1], y[1]):
            return "weak"
        if len(x[1]) == 1 and len(x[0]) > 1 and len(y[1]) > 1 and y[1].startswith(x[1]) and typo(x[0], y[0]):
            return "weak"
    return None


def rank_person(parts: tuple[str, ...]) -> int:
    """0 for full names, 1 for nicknames, 2 for names with an initial: the order in which they find their entity."""
    if min(map(len, parts)) <= 1:
        return 2
    return 1 if len(parts[0]) <= 4 or (len(parts[0]) == 5 and parts[0].endswith(NICK_ENDINGS[:-1])) else 0


def parse_organization(name: str | None, _: str | None = None) -> tuple[str, ...]:
    """Words with the distinctive one first: "Guild of X" becomes "x guild"; abbreviated bodies are written out."""
    text = _DOTTED.sub(lambda m: m[0].replace(".", ""), name or "")
    folded = fold(text).replace("'", "").replace("co-op", "coop")
    tokens = words(folded)
    if tokens[:1] == ["the"] and len(tokens) > 1:
        tokens = tokens[1:]
    if "of" in tokens[1:-1]:
        at = tokens.index("of")
        tokens = tokens[at + 1 :] + tokens[:at]
    tokens = [t for t in tokens if t not in ("of", "and", "the")] or [""]
    return (tokens[0], *(next((w for w in BODIES if len(t) <= 5 and abbreviates(t, w)), t) for t in tokens[1:]))


def _kind_word(a: str, b: str) -> bool:
    return a == b or abbreviates(a, b) or abbreviates(b, a) or (min(len(a), len(b)) > 3 and lcs_ratio(a, b) >= 0.75)


def compare_organization(a: tuple[str, ...], b: tuple[str, ...], agree: bool = False) -> str | None:
    """Same organisation, or ``a`` an acronym or a shortened name of ``b``."""
    if len(a) == 1 and len(b) > 1:
        return "weak" if a[0] == "".join(t[0] for t in b) else None
    if len(a) < 2 or len(a) > len(b) or not typo(a[0], b[0]):
        return None
    if not all(_kind_word(x, y) for x, y in zip(a[1:], b[1:], strict=False)):
        return None
    return "same" if len(a) == len(b) else "weak"


def parse_district(name: str | None, _: str | None = None) -> tuple[str, ...]:
    """(distinctive words, kind of unit, number): any order, number as figure, word or roman numeral, "No." dropped."""
    tokens = [t for t in words(fold(name).replace("'", "")) if t not in ("of", "the", "no", "number", "nr")]
    unit, number, stem = "", "", []
    for token in tokens:
        figure = token if token.isdigit() else _NUMBERS.get(token, "")
        as_unit = next((u for u in UNITS if token == u or (len(token) <= 5 and len(token) > 1 and abbreviates(token, u))), "")
        as_unit = as_unit or next((u for u in UNITS if len(token) > 3 and within(token, u, 1 + (len(u) > 6))), "")
        if figure and not number:
            number = str(int(figure))
        elif as_unit and not unit:
            unit = as_unit
        else:
            stem.append(token)
    return "".join(stem), unit, number


def compare_district(a: tuple[str, ...], b: tuple[str, ...], agree: bool = False) -> str | None:
    """Same district if name, unit and number agree; a name without its unit may stand for one with it."""
    if a[2] != b[2] or not typo(a[0], b[0]):
        return None
    if a[1] == b[1]:
        return "same"
    return "weak" if not a[1] else None


PERSON = Kind(parse_person, compare_person, rank_person, lambda p: "", lambda p: (p[0], p[-1]))
ORGANIZATION = Kind(parse_organization, compare_organization, lambda p: 2 if len(p) == 1 else 1 if len(p) == 2 else 0, lambda p: "", lambda p: (p[0], ""))
DISTRICT = Kind(parse_district, compare_district, lambda p: 0 if p[1] else 1, lambda p: p[2], lambda p: (p[0], ""))
KINDS = {"person": PERSON, "organization": ORGANIZATION, "district": DISTRICT}

#: Bits of a sketch: letters of a token, letters of its sound, its length, its first letter.
LETTERS = (1 << 26) - 1


def sketch(token: str) -> int:
    """What of a token can be compared in a machine word: sets of letters, length, first letter."""
    raw = heard = 0
    for c in token:
        raw |= 1 << ord(c) % 26
    for c in sound(token):
        heard |= 1 << ord(c) % 26
    return raw | heard << 26 | min(len(token), 31) << 52 | (ord(token[0]) % 31 + 1 if token else 0) << 57


def _alike(a: Column, b: Column) -> Column:
    """Whether two sketches may be of tokens within three edits (below nine letters two) or of one and its short form.

    An edit changes at most two members of a set of letters, so no pair that ``typo`` or ``nickname`` accepts is lost.
    """
    size = lambda x: F.shiftright(x, 52).bitwiseAND(F.lit(31))
    parted = a.bitwiseXOR(b)
    letters = F.least(F.bit_count(parted.bitwiseAND(F.lit(LETTERS))), F.bit_count(parted.bitwiseAND(F.lit(LETTERS << 26))))
    short = F.least(size(a), size(b))
    return (letters <= F.when(short < 9, 4).otherwise(6)) | ((short <= 6) & (F.shiftright(a, 57) == F.shiftright(b, 57)))


def link_variants(rows: DataFrame, least_suffix: int = 4, common_block: int = 40) -> DataFrame:
    """Entities of ``rows`` (field, row_id, kind, group, name, second, refine): ``field``, ``row_id``, ``kind``, ``entity``.

    ``kind`` is a key of ``KINDS``; names are compared within their field, kind and group only. ``second`` is the last
    name where first and last names stand apart. ``refine`` is another field of the entity (a tribe, a state) or NULL;
    two different values of it exclude a link. NULL and blank names and NULL groups give no row; repeated rows are
    kept; rows of equal name, group and refine are one entity; a short form that fits several entities of its group
    stays alone. An empty table gives no rows.

    ``least_suffix`` is the shortest suffix indexed, ``common_block`` the number of distinct names of a group beyond
    which a block is refined: by ``refine``, which loses nothing, then by the first and by the last letters of the
    parts that must be alike. What is left is compared whole, however large.
    """
    named = rows.select("field", "row_id", "kind", "group", "name", "second", "refine")
    named = named.where("group is not null and (trim(coalesce(name, '')) <> '' or trim(coalesce(second, '')) <> '')")
    written = F.xxhash64(*(x for c in ("name", "second", "refine") for x in (F.col(c).isNull(), F.col(c))))
    named = named.withColumn("group", F.xxhash64("field", "kind", "group")).withColumn("surface", written)
    kept = ["kind", "group", "surface", "refine"]

    def parsed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            columns = (batch[c] for c in ("kind", "name", "second"))
            parts = [KINDS[kind].parse(*(None if pd.isna(x) else x for x in pair)) for kind, *pair in zip(*columns, strict=True)]
            kinds = [KINDS[kind] for kind in batch["kind"]]
            batch["parts"] = [list(p) for p in parts]
            batch["rank"] = [k.rank(p) for k, p in zip(kinds, parts, strict=True)]
            batch["scope"] = [k.scope(p) for k, p in zip(kinds, parts, strict=True)]
            anchors = [k.anchors(p) for k, p in zip(kinds, parts, strict=True)]
            batch["sketch"] = [[sketch(x) for x in pair] for pair in anchors]
            batch["head"] = ["".join(sorted(x[:1] for x in pair)) for pair in anchors]
            batch["tail"] = ["".join(sorted(x[-1:] for x in pair)) for pair in anchors]
            yield batch[[*kept, "parts", "rank", "scope", "sketch", "head", "tail"]]

    schema = "kind string, group long, surface long, refine string, parts array<string>, rank int, scope string, sketch array<long>, head string, tail string"
    surfaces = spread(named.select(*kept, "name", "second").distinct(), "group", "surface").mapInPandas(parsed, schema)
    surfaces = cut(surfaces.withColumn("refine", F.xxhash64(F.lower("refine")) * F.when(F.col("refine").isNotNull(), 1)).withColumn("node", F.xxhash64("group", "parts", F.coalesce("refine", F.lit(0)))))
    nodes = surfaces.drop("surface").dropDuplicates(["node"])

    relations = cut(_compare(nodes, _candidate_pairs(nodes, least_suffix, common_block)))
    # only nodes of a relation can change their entity; every other one is its own
    entity = _components(relations)
    for level, best in ((1, 0), (1, 1), (2, 1)):
        entity = _attach(entity, relations.where("relation = 'weak'"), level, best)
    known = surfaces.select("group", "surface", "node").join(entity, "node", "left").select("group", "surface", F.coalesce("entity", "node").alias("entity"))
    return named.join(known, ["group", "surface"]).select("field", "row_id", "kind", "entity")


def _attach(entity: DataFrame, weak: DataFrame, level: int, best: int) -> DataFrame:
    """Join the entities of short forms of rank ``level`` to the only entity they fit among names up to rank ``best``."""
    of = lambda side, name: entity.select(F.col("node").alias(side), F.col("entity").alias(name))
    fits = weak.where((F.col("a_rank") == level) & (F.col("b_rank") <= best)).select("a", "b").join(of("a", "entity"), "a").join(of("b", "target"), "b").where("target <> entity")
    fits = fits.groupBy("entity").agg(F.min("target").alias("target"), F.max("target").alias("other")).where("target = other").select("entity", "target")
    # two short forms may name each other: of such a chain only its last step stands
    chain = fits.join(fits.select(F.col("entity").alias("target"), F.col("target").alias("next")), "target", "left")
    chain = chain.where("next is null or next <> entity or entity > target")
    chain = chain.select("entity", F.when(F.col("next") == F.col("entity"), F.col("target")).otherwise(F.coalesce("next", "target")).alias("target"))
    return cut(entity.join(chain, "entity", "left").select("node", F.coalesce("target", "entity").alias("entity")))


#: Longer suffixes aren't indexed: names that share one share this one too.
LONGEST_SUFFIX = 48


def block_keys(nodes: DataFrame, kept: list[str], least: int) -> DataFrame:
    """Blocks of nodes (group, scope, kind, parts): ``kept``, block, the one letter longer block it lies in (NULL if none).

    Suffixes of the parts from ``least`` letters, read from either end; whole tokens of two letters or more; the
    acronym of an organisation. Lengths are exploded first, so that keys are made by generated code.
    """
    acronym = F.array_join(F.transform("parts", lambda p: F.left(p, F.lit(1))), "")
    spelled = F.when((F.col("kind") == "organization") & (F.size("parts") > 2), F.array_append("parts", acronym)).otherwise(F.col("parts"))
    parts = nodes.withColumn("inside", F.xxhash64("group", "scope")).select(*kept, "inside", F.explode(F.array_distinct(spelled)).alias("part"))
    size, n = F.length("part"), F.col("n")
    suffixes = F.sequence(F.lit(least), F.least(size, F.lit(LONGEST_SUFFIX)))
    sizes = F.when(size <= least, F.array(size)).when(size <= LONGEST_SUFFIX, suffixes).otherwise(F.array_append(suffixes, size))
    lengths = parts.where(size > 1).select(*kept, "inside", "part", F.explode(sizes).alias("n"))
    key = lambda mark, text: F.xxhash64("inside", F.lit(mark), text)
    whole = key("=", F.col("part"))
    longer = lambda mark, text: F.when(n + 1 == size, whole).when(n < LONGEST_SUFFIX, key(mark, text)).alias("longer")
    block = lambda x, y: F.struct(x.alias("block"), y)
    end = block(key("<", F.right("part", n)), longer("<", F.right("part", n + 1)))
    start = block(key(">", F.left("part", n)), longer(">", F.left("part", n + 1)))
    alone = block(whole, F.lit(None).cast("long").alias("longer"))
    found = F.when(n == size, F.array(alone)).otherwise(F.array(end, start))
    return lengths.select(*kept, F.explode(found).alias("k")).select(*kept, "k.block", "k.longer")


def _candidate_pairs(nodes: DataFrame, least: int, common: int) -> DataFrame:
    """Pairs (a, b) of nodes that share a block and whose sketches are alike."""
    own = ["node", "refine", "one", "two"]
    sketched = nodes.select("kind", "group", "scope", "parts", "node", "refine", F.col("sketch")[0].alias("one"), F.col("sketch")[1].alias("two"), F.hash("head").alias("head"), F.hash("tail").alias("tail"))
    index = block_keys(sketched, [*own, "head", "tail"], least)
    block = Window.partitionBy("block")
    sized = index.withColumn("size", F.count("*").over(block)).withColumn("least", F.min("longer").over(block)).withColumn("most", F.max("longer").over(block))
    sized = cut(sized.where("size > 1 and (longer is null or least <> most)").select(*own, "head", "tail", "block", "size"))
    plain = sized.where(F.col("size") <= common).select(*own, "block")

    # names that lack the refining field meet those of every value of it
    large = sized.where(F.col("size") > common).drop("size")
    values = large.where("refine is not null").select("block", F.col("refine").alias("value")).distinct()
    every = large.where("refine is null").join(values, "block").withColumn("fine", F.xxhash64("block", "value"))
    fine = large.withColumn("fine", F.xxhash64("block", F.coalesce("refine", F.lit(0)))).unionByName(every.drop("value"))
    fine = fine.withColumn("n", F.count("*").over(Window.partitionBy("fine"))).where("n > 1")
    two = F.array(F.xxhash64("fine", F.lit("<"), "head"), F.xxhash64("fine", F.lit(">"), "tail"))
    fine = fine.select(*own, F.explode(F.when(F.col("n") <= common, F.array("fine")).otherwise(two)).alias("block"))

    blocks = plain.unionByName(fine)
    a, b = (blocks.select("block", *(F.col(c).alias(f"{side}_{c}") for c in own)) for side in "ab")
    alike = lambda x, y: _alike(F.col(x), F.col(y))
    straight, swapped = alike("a_one", "b_one") & alike("a_two", "b_two"), alike("a_one", "b_two") & alike("a_two", "b_one")
    met = a.join(b, "block").where((F.col("a_node") < F.col("b_node")) & F.coalesce(F.col("a_refine") == F.col("b_refine"), F.lit(True)) & (straight | swapped))
    return met.select(F.col("a_node").alias("a"), F.col("b_node").alias("b")).distinct()


def _compare(nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """Relations of the candidate pairs; of a weak one ``a`` is the short form."""
    side = lambda name: nodes.select(F.col("node").alias(name), *(F.col(c).alias(f"{name}_{c}") for c in ("parts", "refine", "rank")))
    both = pairs.join(side("a"), "a").join(side("b").join(nodes.select(F.col("node").alias("b"), "kind"), "b"), "b")
    both = both.withColumn("agree", F.coalesce(F.col("a_refine") == F.col("b_refine"), F.lit(False))).drop("a_refine", "b_refine")

    def relate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for kind, a, b, pa, pb, ra, rb, agree in zip(*(batch[c] for c in ("kind", "a", "b", "a_parts", "b_parts", "a_rank", "b_rank", "agree")), strict=True):
                compare = KINDS[kind].compare
                pa, pb = tuple(pa), tuple(pb)
                forward = compare(pa, pb, agree)
                backward = None if forward == "same" else compare(pb, pa, agree)
                if "same" in (forward, backward):
                    out.append((a, b, ra, rb, "same"))
                    continue
                out += [(a, b, ra, rb, "weak")] * (forward == "weak") + [(b, a, rb, ra, "weak")] * (backward == "weak")
            yield pd.DataFrame(out, columns=["a", "b", "a_rank", "b_rank", "relation"])

    return spread(both, "a", "b").mapInPandas(relate, "a long, b long, a_rank int, b_rank int, relation string")


def _components(relations: DataFrame) -> DataFrame:
    """(node, entity) of the nodes of any relation: the least node of each component of "same" ones.

    Rounds of neighbour minima and pointer jumps until nothing changes, of which a component of n nodes needs at most
    about log n.
    """
    ends = relations.select("a", "b", "relation").unionByName(relations.select(F.col("b").alias("a"), F.col("a").alias("b"), "relation"))
    both = cut(ends.where("relation = 'same'").select("a", "b").distinct())
    label = cut(ends.select(F.col("a").alias("node")).distinct().withColumn("entity", F.col("node")))
    while True:
        near = both.join(label.select(F.col("node").alias("b"), "entity"), "b").groupBy(F.col("a").alias("node")).agg(F.min("entity").alias("near"))
        lower = label.join(near, "node", "left").select("node", "entity", F.least("entity", F.coalesce("near", "entity")).alias("low"))
        jump = lower.select(F.col("node").alias("low"), F.col("low").alias("jump"))
        step = cut(lower.join(jump, "low", "left").select("node", F.col("entity").alias("old"), F.least("low", F.coalesce("jump", "low")).alias("entity")))
        label = step.select("node", "entity")
        if step.where("old <> entity").isEmpty():
            return label


def entity_pairs(linked: DataFrame) -> DataFrame:
    """Pairs (field, id_a, id_b; id_a < id_b) of different rows of one entity: the expansion of results defined on pairs."""
    distinct = linked.select("field", "row_id", "entity").distinct()
    a, b = distinct.withColumnRenamed("row_id", "id_a"), distinct.withColumnRenamed("row_id", "id_b")
    return a.join(b, ["field", "entity"]).where("id_a < id_b").select("field", "id_a", "id_b")
