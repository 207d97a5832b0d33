"""Free-entered values mapped to the entries of a reference list.

Values are deduplicated and normalised; candidates come from an inverted index of character n-grams over the
reference list; they are scored by cosine with inverse-document-frequency weights; an exact check of the distinctive
words drops entries that share little but their kind of place ("... Creek"); of the others the best one is accepted
above a threshold and with a margin to the next. Values, entries, index and candidates are all distributed; the driver
holds the frequencies of hashed n-grams and the kinds of place only, both bounded whatever the size of the list.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import lru_cache
from math import log
from zlib import crc32

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sessionloom.llm.spelling import abbreviates, fold, typing_errors, within, words
from sessionloom.session import broadcast_if_small, cut, spread

# Words before or inside a value that say how it relates to the entry, not which one it is.
QUALIFIERS = frozenset("the near out by at in around outside from town city of member members enrolled mostly partly formerly area".split())


LINKS = QUALIFIERS | {"and"}


@dataclass(frozen=True)
class Entry:
    """A reference entry: its words, and of these the ones that other entries share."""

    ref_id: int
    tokens: tuple[str, ...]
    common: tuple[str, ...]

    @property
    def stem(self) -> list[str]:
        return [t for t in self.tokens if t not in self.common and t not in LINKS]


def normal_words(text: str | None) -> list[str]:
    """Folded words; bracketed remarks are dropped, "&" is "and"."""
    folded = fold(text).replace("&", " and ")
    depth, kept = 0, []
    for c in folded:
        depth += c in "(["
        if not depth:
            kept.append(c)
        depth -= c in ")]" and depth > 0
    plain = "".join(kept) if "".join(kept).strip() else folded
    return words(plain.replace("'", ""))


def grams(tokens: Sequence[str], size: int = 3) -> Counter:
    """Character n-grams of the words, marked at their ends, and one gram size shorter to bear typing errors."""
    out: Counter = Counter()
    for token in tokens:
        marked = f"^{token}$"
        for n in (size - 1, size):
            out.update(marked[i : i + n] for i in range(max(1, len(marked) - n + 1)))
    return out


@lru_cache(maxsize=1 << 16)
def _as_kind(token: str, kinds: frozenset[str]) -> frozenset[str]:
    """The kind words that ``token`` may stand for: itself, an abbreviation or a misspelling."""
    if token in kinds:
        return frozenset((token,))
    short = frozenset(k for k in kinds if abbreviates(token, k)) if len(token) <= 5 else frozenset()
    close = frozenset(k for k in kinds if len(token) > 3 and (within(token, k, 1 if len(k) < 6 else 2) or token == k + "s"))
    return short | close


def stem_tolerance(size: int) -> int:
    """Typing errors allowed in a distinctive part of so many letters."""
    return 0 if size < 4 else 1 if size < 6 else 2 if size < 12 else 3


def check(value: Sequence[str], entry: Entry, kinds: frozenset[str]) -> tuple[float, int] | None:
    """The distance of ``value`` from ``entry`` by their words, None if the entry can't be meant.

    Edits in the distinctive part count 1 each, words beside it 0.75 once; the second figure counts the entry's kinds
    of place that the value lacks. A kind of place the entry hasn't excludes it.
    """
    stem_words = entry.stem
    stem = "".join(stem_words)
    left: list[str] = []
    seen: list[frozenset[str]] = []
    for token in value:
        as_kind = _as_kind(token, kinds)
        if as_kind and not any(within(token, s, 2) for s in stem_words):
            seen.append(as_kind)
        elif token not in LINKS or token in stem_words:
            left.append(token)
    if not left:
        return None
    missing = 0
    for kind in entry.common:
        hit = next((s for s in seen if kind in s), None)
        if hit is None:
            missing += 1
        else:
            seen.remove(hit)
    if seen or (missing and missing < len(entry.common) and missing > len(entry.common) / 2):
        return None
    spelled = [("".join(left), 0.0), ("".join(reversed(left)), 0.0)]
    if len(left) > len(stem_words):
        size = len(stem_words)
        spelled += [("".join(left[i : i + size]), 0.75) for i in range(len(left) - size + 1)]
    limit = stem_tolerance(len(stem))
    fitting = [n + extra for text, extra in spelled for form in (stem, stem + "s") if (n := typing_errors(text, form, limit)) is not None]
    return (min(fitting), missing) if fitting else None


#: N-grams are counted by their hash in so many places, which bounds the frequencies the driver holds.
GRAM_PLACES = 1 << 20
#: N-grams are probed until the rest of them can make up no more than this part of the threshold: the more are probed,
#: the fewer entries are scored in vain. No entry is lost whatever it is.
PROBED = 2 / 3
#: A word is a kind of place if this share of the entries has it, and three of them at least.
KIND_SHARE, KIND_LEAST = 0.02, 3

@dataclass
class Weights:
    """What the workers know of the reference list, by kind: entries, frequency of hashed n-grams, kinds of place."""

    totals: dict[str, int]
    frequency: dict[str, dict[int, int]]
    kinds: dict[str, frozenset[str]]
    vectors: dict[tuple[str, str], tuple[dict[int, float], float]] = field(default_factory=dict)

    def vector(self, kind: str, norm: str) -> tuple[dict[int, float], float]:
        """Weights of the n-grams of a normal form by hash, and their norm; n-grams the list lacks weigh 1."""
        own = self.vectors.get((kind, norm))
        if own is None:
            if len(self.vectors) > 1 << 16:
                self.vectors.clear()
            total, frequency = self.totals.get(kind, 0), self.frequency.get(kind, {})
            tokens = norm.split(" ")
            counts: Counter = Counter()
            for gram, n in grams([t for t in tokens if t not in QUALIFIERS] or tokens).items():
                counts[_place(gram)] += n
            weights = {g: (1 + log(n)) * (log((2 + total) / (1 + frequency[g])) if g in frequency else 1.0) for g, n in counts.items()}
            own = self.vectors[(kind, norm)] = weights, sum(w * w for w in weights.values()) ** 0.5 or 1.0
        return own

    def cosine(self, kind: str, a: str, b: str) -> float:
        (x, m), (y, n) = self.vector(kind, a), self.vector(kind, b)
        return sum(w * y[g] for g, w in x.items() if g in y) / (m * n)


def _place(gram: str) -> int:
    return crc32(gram.encode()) % GRAM_PLACES


def map_to_canonical(values: DataFrame, reference: DataFrame, threshold: float = 0.3, margin: float = 0.1) -> DataFrame:
    """``values`` (kind, value, hint) mapped to ``reference`` (ref_id, kind, name, state): distinct kind, value, hint, ref_id.

    ``threshold`` is the least cosine of an accepted entry, ``margin`` its least lead over the next entry that the value
    may mean. Where two lie within the margin, ``hint`` (the state written beside the value, or NULL) decides if it
    fits one of them only, else the exact check does: the fewest typing errors, then the fewest kinds of place left
    out; if that leaves several, none is meant. ``ref_id`` is 0 where no entry is meant. NULL and blank values give
    ref_id 0, repeated values one row, an empty reference list 0 throughout; entries with NULL or blank names are never
    candidates, repeated entries count once.

    The n-grams of a value are looked up rarest first, and only until the rest of them could no longer reach the
    threshold, which loses no candidate. The index is broadcast only if it is counted to be small, otherwise joined by
    shuffle; the list may have any size.
    """
    entries = reference.where("trim(coalesce(name, '')) <> ''").select("ref_id", "kind", F.col("name").alias("value"), F.upper(F.trim("state")).alias("state")).distinct()
    entries = cut(entries.mapInPandas(_normalised("ref_id", "kind", "state"), "ref_id long, kind string, state string, norm string")).where("norm <> ''")
    weights = _weights(entries)
    index = entries.mapInPandas(_postings(weights, 0.0, "ref_id"), "kind string, ref_id long, gram int, weight double, rest double")

    normal = values.select("kind", "value", "hint").distinct()
    normal = cut(spread(normal, "value").mapInPandas(_normalised("kind", "value", "hint"), "kind string, value string, hint string, norm string").withColumn("form", F.xxhash64("kind", "norm")))
    forms = normal.where("norm <> ''").select("kind", "norm", "form").distinct()
    probes = spread(forms, "form").mapInPandas(_postings(weights, threshold * PROBED, "form"), "kind string, form long, gram int, weight double, rest double")
    shared = probes.alias("v").join(broadcast_if_small(index.select("kind", "gram", "ref_id", "weight")).alias("e"), ["kind", "gram"])
    reached = shared.groupBy("form", "ref_id").agg(F.sum(F.col("v.weight") * F.col("e.weight")).alias("dot"), F.max("rest").alias("rest"))
    found = reached.where(F.col("dot") + F.col("rest") >= threshold - 1e-9).select("form", "ref_id")
    paired = found.join(forms, "form").join(broadcast_if_small(entries.withColumnRenamed("norm", "entry")), ["kind", "ref_id"])

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for kind, form, norm, ref_id, entry, state in zip(*(batch[c] for c in ("kind", "form", "norm", "ref_id", "entry", "state")), strict=True):
                cosine = weights.cosine(kind, norm, entry)
                if cosine >= threshold:
                    kinds = weights.kinds.get(kind, frozenset())
                    distance = check(norm.split(" "), _entry(ref_id, entry, kinds), kinds)
                    if distance is not None:
                        out.append((kind, form, ref_id, state, cosine, *distance))
            yield pd.DataFrame(out, columns=["kind", "form", "ref_id", "state", "cosine", "edits", "missing"])

    meant = spread(paired, "form").mapInPandas(score, "kind string, form long, ref_id long, state string, cosine double, edits double, missing int")
    by_form = Window.partitionBy("kind", "form")
    order = F.struct("edits", "missing")
    close = meant.withColumn("best", F.max("cosine").over(by_form)).where(F.col("best") - F.col("cosine") < margin)
    close = cut(close.withColumn("preferred", order == F.min(order).over(by_form)))

    # of the entries within the margin of the best: one only, else the one of the hint's state, else the one the check prefers
    here = F.col("state") == F.upper(F.trim("hint"))
    pick = lambda wanted: F.when(F.count_if(wanted) == 1, F.min(F.when(wanted, F.col("ref_id"))))
    asked = normal.select("kind", "form", "hint").distinct().join(close, ["kind", "form"])
    chosen = asked.groupBy("kind", "form", "hint").agg(F.coalesce(pick(F.col("ref_id").isNotNull()), pick(here), pick(F.col("preferred"))).alias("ref_id"))
    every = [F.col("n.kind") == F.col("c.kind"), F.col("n.form") == F.col("c.form"), F.col("n.hint").eqNullSafe(F.col("c.hint"))]
    return normal.alias("n").join(chosen.alias("c"), every, "left").select("n.kind", "n.value", "n.hint", F.coalesce("c.ref_id", F.lit(0)).cast("long").alias("ref_id"))


def _weights(entries: DataFrame) -> Weights:
    totals = {r["kind"]: r["n"] for r in entries.where("kind is not null").groupBy("kind").agg(F.count("*").alias("n")).toLocalIterator()}

    def places(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [(k, g) for k, norm in zip(batch["kind"], batch["norm"], strict=True) for g in {_place(g) for g in grams(norm.split(" "))}]
            yield pd.DataFrame(out, columns=["kind", "gram"])

    frequency: dict[str, dict[int, int]] = {kind: {} for kind in totals}
    for r in entries.where("kind is not null").mapInPandas(places, "kind string, gram int").groupBy("kind", "gram").agg(F.count("*").alias("n")).toLocalIterator():
        frequency[r["kind"]][r["gram"]] = r["n"]
    words_of = entries.where("kind is not null").select("kind", "ref_id", "norm", F.explode(F.array_distinct(F.split("norm", " "))).alias("word"))
    limits = F.create_map(*(F.lit(x) for k, n in totals.items() for x in (k, max(float(KIND_LEAST), KIND_SHARE * n)))) if totals else F.create_map()
    # a word of at least that share of the entries: their words over the share bound how many there are
    counted = words_of.groupBy("kind", "word").agg(F.count("*").alias("n")).where(F.col("n") >= limits[F.col("kind")]) if totals else words_of.limit(0)
    kinds: dict[str, set[str]] = {kind: set() for kind in totals}
    for r in counted.toLocalIterator():
        if r["word"] not in QUALIFIERS:
            kinds[r["kind"]].add(r["word"])
    return Weights(totals, frequency, {k: frozenset(w) for k, w in kinds.items()})


@lru_cache(maxsize=1 << 16)
def _entry(ref_id: int, norm: str, kinds: frozenset[str]) -> Entry:
    tokens = tuple(norm.split(" "))
    return Entry(ref_id, tokens, tuple(t for t in tokens if t in kinds))


def _normalised(*columns: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            forms = {v: " ".join(normal_words(v)) for v in batch["value"].dropna().unique()}
            batch["norm"] = batch["value"].map(forms).fillna("")
            yield batch[[*columns, "norm"]]

    return run


def _postings(weights: Weights, threshold: float, key: str):
    """The n-grams of each normal form, its rarest first, up to where the rest can't reach ``threshold`` by itself."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for kind, norm, k in zip(batch["kind"], batch["norm"], batch[key], strict=True):
                vector, length = weights.vector(kind, norm)
                known = weights.frequency.get(kind, {})
                left = sum((w / length) ** 2 for g, w in vector.items() if g in known)
                own = []
                for g, w in sorted(((g, w / length) for g, w in vector.items() if g in known), key=lambda x: (-x[1], x[0])):
                    if left < threshold * threshold:
                        break
                    left -= w * w
                    own.append((g, w))
                rest = max(left, 0.0) ** 0.5
                out += [(kind, k, g, w, rest) for g, w in own]
            yield pd.DataFrame(out, columns=["kind", key, "gram", "weight", "rest"])

    return run


def assign_canonical(rows: DataFrame, reference: DataFrame) -> DataFrame:
    """``rows`` (field_name, row_id, kind, value, hint) with the ``ref_id`` each one means, 0 if none.

    Repeated rows are kept, NULL and blank values mean none, other columns aren't read.
    """
    rows = rows.select("field_name", "row_id", "kind", "value", "hint")
    mapping = map_to_canonical(rows, reference)
    small = broadcast_if_small(cut(mapping).withColumnRenamed("hint", "__hint").withColumnRenamed("kind", "__kind").withColumnRenamed("value", "__value"))
    same = (F.col("kind") == F.col("__kind")) & F.col("value").eqNullSafe(F.col("__value")) & F.col("hint").eqNullSafe(F.col("__hint"))
    return rows.join(small, same, "left").select("field_name", "row_id", F.coalesce("ref_id", F.lit(0)).cast("long").alias("ref_id"))
