"""Keyword-stuffed and link-list pages: lines labelled by a hidden Markov model, pages flagged by non-prose word share.

Each line is reduced to a few small features, a first-order hidden Markov model with the states prose, link list, tag
list and menu labels the lines of a page by its most probable path, and the page is flagged if lines of the other
states hold more than a given share of its words. The model's probabilities are counted on a bounded sample of lines
that plain rules can label; everything else covers all texts, whole.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import log

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STATES = ("prose", "record", "links", "tags", "menu", "stuffed")
#: The first states' lines count as prose: sentences, and the lines of a real record (agenda, word list, those present).
#: Tag lists have two states too: lists proper, and sentences stuffed with one keyword.
PROSE = 2
# Function words of English, Spanish and French.
FUNCTION_WORDS = frozenset(
    (
        "the a an and or but of to in on at for with from by as is are was were be been it its this that these those we you they he she i me my our your their his her them us who which when if so not no "
        "had has have do did does will would can could may what how than then there before after until because since while more some each every "
        "el la los las un una unos unas y o pero de del al en con por para como es son fue era ser lo su sus se que no si mi nos nuestra nuestro más hay cada cuando porque hasta sin sobre "
        "le les des du au aux et ou mais dans sur avec pour par ce cette ces son sa ses qui que ne pas nous vous ils elles il elle on est sont était a à leur plus chaque quand parce jusque sans"
    ).split()
)
# Words of offers and shopping pages (English, Spanish, French).
OFFER_WORDS = frozenset(
    "buy cheap best online shop sale discount wholesale reviews rated free shipping near sku qty cart stock oz price deal deals offer order "
    "comprar barato mejor oferta tienda descuento envío gratis reseñas mayoreo venta cerca "
    "acheter pas cher promo boutique livraison gratuite avis meilleur solde vente gros".split()
)
_CUE = re.compile(r"\s*(?:\d+|(?:\d{1,2}:)?\d{1,2}:\d{2}(?:[.,]\d+)?(?:\s*-->.*)?|WEBVTT.*|[-=_*#\s]*)\s*$")
_ITEM = re.compile(r"\s*(?:\d{1,3}[.)]\s|[^\W\d_][\w .'-]{0,40}:\s|\S+(?: \S+)? [-–=] )")
_SPACED = {c: " " for c in range(128) if not chr(c).isalnum() and chr(c) != "_"} | {ord(c): " " for c in "«»“”‘’…–—·•¿¡"}
#: Lines are put together to blocks of at least so many words, over which repetition is measured.
BLOCK_WORDS = 40


@dataclass(frozen=True)
class Model:
    """Log probabilities: first state, state to state, feature value by state."""

    start: tuple[float, ...]
    step: tuple[tuple[float, ...], ...]
    emit: tuple[tuple[tuple[float, ...], ...], ...]


def page_lines(text: str) -> Iterator[tuple[int, tuple[int, ...]]]:
    """(words, feature values) of each line that holds words; blank, numbered and timed lines are passed over.

    The last value is shared by the lines of a block: how much of it its most repeated content word holds.
    """
    block: list[tuple[int, tuple[int, ...]]] = []
    counts: Counter = Counter()
    total = 0
    for line in text.split("\n"):
        size = line.count(" ") + 1
        if size < 8 and (not line or _CUE.match(line)):
            continue
        low = line.lower()
        tokens = low.translate(_SPACED).split()
        pieces = len(tokens)
        if not pieces:
            continue
        function = sum(map(FUNCTION_WORDS.__contains__, tokens)) / pieces
        offers = sum(map(OFFER_WORDS.__contains__, tokens)) / pieces
        links = (low.count("://") + low.count("](") if ":" in line or "](" in line else 0) / size
        marks = (line.count("|") + line.count(" > ") + line.count("»") + line.count(" · ")) / size
        tags = line.count("#") / size if "#" in line else 0.0
        commas = line.count(",") / size
        kinds = set(tokens)
        item = _ITEM.match(line)
        end = line.rstrip()[-1:]
        block.append(
            (
                pieces,
                (
                    (links > 0) + (links > 0.08) + (links > 0.2),
                    (function > 0.02) + (function > 0.1) + (function > 0.2) + (function > 0.3),
                    (offers > 0.02) + (offers > 0.12) + (offers > 0.3),
                    (marks > 0) + (marks > 0.06) + (marks > 0.15),
                    (tags > 0) + (tags > 0.3),
                    (commas > 0) + (commas > 0.08) + (commas > 0.18),
                    (len(kinds) > 0.35 * pieces) + (len(kinds) > 0.6 * pieces) + (len(kinds) > 0.85 * pieces) if pieces > 7 else 4,
                    (size > 3) + (size > 8) + (size > 20),
                    4 if item and line[item.end() - 2] in ".)" else 2 * bool(item) + (end in ".?!" and line.lstrip()[:1].isupper()),
                ),
            )
        )
        counts.update(tokens[line[: item.end()].count(" ") or 1 :] if item and line[item.end() - 2] == ":" else tokens)
        total += pieces
        if total >= BLOCK_WORDS:
            yield from _close(block, counts, total)
            block, counts, total = [], Counter(), 0
    if block:
        yield from _close(block, counts, total)


def _close(block: list, counts: Counter, total: int) -> Iterator[tuple[int, tuple[int, ...]]]:
    most = 0
    floor = max(1, total // 25)
    for word, n in counts.items():
        if n > floor and n > most and word not in FUNCTION_WORDS and len(word) > 2 and not word.isdigit():
            most = n
    top = (most - 1) / max(total, 30) if most else 0.0
    level = (top > 0.07) + (top > 0.11) + (top > 0.16) + (top > 0.25)
    for pieces, values in block:
        yield pieces, (*values, level)


# Places of the features in a line's tuple.
LINK, FUNCTION, OFFER, MARK, TAG, COMMA, SAME, LONG, SENTENCE, TOP = range(10)


def seed_label(v: tuple[int, ...]) -> int | None:
    """The state of a line that plain rules can label, None for others."""
    if v[LINK] >= 2:
        return 2
    if v[TAG] == 2:
        return 3
    if v[MARK] >= 2 and v[FUNCTION] <= 1:
        return 4
    if v[TOP] >= 3 and v[FUNCTION] >= 2 and v[SENTENCE] in (1, 3):
        return 5
    if v[TOP] >= 3 or (v[OFFER] == 3 and v[FUNCTION] <= 3) or (v[OFFER] == 2 and v[COMMA] >= 2 and v[FUNCTION] <= 2):
        return 3
    if v[TOP] > 2 or v[LINK] or v[MARK] or v[TAG] or v[OFFER] > 1:
        return None
    if v[FUNCTION] >= 3 and v[SENTENCE] in (1, 3) and v[TOP] <= 1:
        return 0
    if v[OFFER] == 0 and (v[SENTENCE] >= 2 or (v[COMMA] >= 2 and v[FUNCTION] <= 1 and v[TOP] <= 1)):
        return 1
    return None


def fit(counts: dict[tuple[int, int, int], int]) -> Model:
    """The model from counts of (state, feature, value) and (state, -1, next state), with add-one smoothing."""
    emit, step = [], []
    for s in range(len(STATES)):
        total = sum(n for (state, feature, _), n in counts.items() if state == s and feature == LONG)
        emit.append(tuple(tuple(log((counts.get((s, f, value), 0) + 1) / (total + 5)) for value in range(5)) for f in range(10)))
        moves = [counts.get((s, -1, t), 0) + 1 for t in range(len(STATES))]
        step.append(tuple(log(m / sum(moves)) for m in moves))
    return Model(tuple(log(p) for p in (0.5, 0.3, 0.05, 0.05, 0.05, 0.05)), tuple(step), tuple(emit))


#: Weight of a line's features against the transitions: the features overlap, so they count less than independent ones.
FEATURE_WEIGHT = 0.5


class Labeller:
    """Most probable states of the lines of a page; emissions are kept by feature values, of which there are few."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.emissions: dict[tuple[int, ...], tuple[float, ...]] = {}
        stay = model.step[0][0]
        # an all-prose path can't be beaten where prose is likeliest in every line, to begin with and to follow prose
        self.shortcut = model.start[0] == max(model.start) and all(stay >= p for row in model.step for p in row)

    def emission(self, values: tuple[int, ...]) -> tuple[float, ...]:
        own = self.emissions.get(values)
        if own is None:
            tables = self.model.emit
            own = tuple(FEATURE_WEIGHT * sum(t[f][v] for f, v in enumerate(values)) for t in tables)
            self.emissions[values] = own
        return own

    def label(self, text: str) -> list[tuple[int, int]]:
        """(state, words) of each line that holds words."""
        lines = list(page_lines(text))
        own = [self.emission(values) for _, values in lines]
        if not lines or (self.shortcut and all(e[0] >= max(e) for e in own)):
            return [(0, pieces) for pieces, _ in lines]
        states = range(len(STATES))
        step = self.model.step
        score = [self.model.start[s] + own[0][s] for s in states]
        back: list[list[int]] = []
        for e in own[1:]:
            came = [max(states, key=lambda s: score[s] + step[s][t]) for t in states]
            score = [score[came[t]] + step[came[t]][t] + e[t] for t in states]
            back.append(came)
        path = [max(states, key=score.__getitem__)]
        for came in reversed(back):
            path.append(came[path[-1]])
        return [(state, pieces) for state, (pieces, _) in zip(reversed(path), lines, strict=True)]

    def non_prose_share(self, text: str | None) -> tuple[int, float]:
        """(words, share of them in lines that aren't prose); 0 for texts without words."""
        labelled = self.label(text) if text else []
        words = sum(n for _, n in labelled)
        return words, sum(n for s, n in labelled if s >= PROSE) / words if words else 0.0


def learn_lines(documents: DataFrame, key: str, text: str, most: int = 3_000) -> Model:
    """Fit the model on the lines of about ``most`` documents, chosen by the hash of their key."""
    total = documents.count()
    parts = max(1, -(-total // most))
    sample = documents.where(F.pmod(F.xxhash64(f"`{key}`"), F.lit(parts)) == 0).select(F.col(f"`{text}`").alias("text"))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()
        for batch in batches:
            for body in batch["text"].dropna():
                seen.update(count_lines(body))
        yield pd.DataFrame([(*key, n) for key, n in seen.items()], columns=["state", "feature", "value", "n"])

    rows = sample.mapInPandas(count, "state int, feature int, value int, n long").groupBy("state", "feature", "value").agg(F.sum("n").alias("n")).collect()
    return fit({(r["state"], r["feature"], r["value"]): r["n"] for r in rows})


def count_lines(text: str) -> Counter:
    """Counts for ``fit`` of the lines of a text that the rules can label."""
    seen: Counter = Counter()
    before = None
    for _, values in page_lines(text):
        state = seed_label(values)
        if state is None:
            continue
        seen.update((state, f, v) for f, v in enumerate(values))
        if before is not None:
            seen[(before, -1, state)] += 1
        before = state
    return seen


def label_pages(documents: DataFrame, key: str, text: str, model: Model, share: float = 0.5) -> DataFrame:
    """``key``, ``words``, ``non_prose_share`` and ``flagged`` of every document, whole texts.

    NULL, blank and wordless texts have share 0 and aren't flagged; repeated rows are kept; other columns aren't read.
    """
    schema = f"`{key}` {documents.schema[key].dataType.simpleString()}, words long, non_prose_share double, flagged boolean"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        labeller = Labeller(model)
        for batch in batches:
            done = [labeller.non_prose_share(None if pd.isna(t) else t) for t in batch[text]]
            yield pd.DataFrame({key: batch[key], "words": [w for w, _ in done], "non_prose_share": [s for _, s in done], "flagged": [s > share for _, s in done]})

    return documents.select(f"`{key}`", f"`{text}`").mapInPandas(run, schema)
