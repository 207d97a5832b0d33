"""Personal information in free text, found on deobfuscated text and mapped back to the source characters.

Transducers rewrite the text while keeping, for every character they emit, the span of source characters it stands
for: look-alike and full-width characters become plain ones, invisible ones vanish, spelled digits become figures,
at/dot disguises become ``@`` and ``.``. Identifiers are detected on the rewritten text; their spans are mapped back,
so surfaces and placeholders always refer to the text as it stands.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionloom.llm.confusables import _TO_LATIN, _plain, _script
from sessionloom.llm.spelling import within
from sessionloom.llm.variants import NICK_ENDINGS, TITLES

PLACEHOLDERS = {"email": "[EMAIL]", "phone": "[PHONE]", "identity_number": "[ID_NUMBER]", "street_address": "[ADDRESS]", "name": "[NAME]"}
# Spelled digits; kinds of street; words behind a name that make it an organisation or a place.
DIGITS = {"zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9"}
STREETS = "Street St Avenue Ave Road Rd Drive Dr Lane Ln Boulevard Blvd Court Ct Way Place Pl Circle Cir Terrace Ter Trail Trl Highway Hwy Parkway Pkwy Loop Square Sq Alley Crescent Row".split()
NOT_PERSON = frozenset(
    "fisheries farm farms foods food inc llc ltd co company corp corporation cooperative coop guild alliance association assn trust foundation union society school hall house center centre store shop market mill ranch orchard "
    "street st road rd avenue ave lane ln drive dr court ct way boulevard blvd bridge creek river lake falls ridge point harbor harbour landing village crossing junction springs mountain valley island bay park "
    "nation band tribe tribes pueblo rancheria community villages county district chapter ward precinct hill hills brothers sons".split()
)

_WORDS = "|".join(DIGITS)
_SPELLED = re.compile(rf"\b(?:{_WORDS})(?:[\s,.-]+(?:{_WORDS})){{4,}}\b", re.I)
_AT = r"(?:\s*[\(\[\{<]\s*at\s*[\)\]\}>]\s*|\s+at\s+|@)"
_BRACKETED_AT = re.compile(r"[\(\[\{<]\s*at\s*[\)\]\}>]")
_DOT = r"(?:\s*[\(\[\{<]\s*dot\s*[\)\]\}>]\s*|\s+dot\s+|\.)"
_DISGUISED = re.compile(rf"\b[A-Za-z0-9][\w+-]*(?:{_DOT}[\w+-]+)*({_AT})[A-Za-z0-9-]+(?:{_DOT}[A-Za-z0-9-]+)+", re.I)
_NO_HOST = re.compile(r"\b(?:the|an?|of|to|in|and)\b", re.I)
_DISGUISE = re.compile(r"\s*[\(\[\{<]\s*(at|dot)\s*[\)\]\}>]\s*|\s+(at|dot)\s+", re.I)
_EMAIL = re.compile(r"[A-Za-z0-9][A-Za-z0-9._%+-]*@(?:[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?\.)+[A-Za-z]{2,}")

_PHONE = re.compile(
    r"(?<![\w#$.,/@-])(?:"
    r"\+1[ .-]?\(?\d{3}\)?[ .-]?\d{3}[ .-]?\d{4}"
    r"|\+(?!1[ (.-])\d{1,3}[ .-]?\(?\d{1,4}\)?(?:[ .-]?\d{2,4}){2,4}"
    r"|(?:1[ .-]?)?(?:\(\d{3}\)\s?|\d{3}[ .-])\d{3}[ .-]\d{4}"
    r"|(?:1[ .-]?)?[2-9]\d{2}[2-9]\d{6}"
    r"|\d{3}[.-]\d{4}"
    r")(?:,?\s*(?:ext\.?|extension|x)\s*\d{1,6})?(?![\w/]|[-.,]\d|:\d)"
)
_NOT_PHONE = re.compile(r"(?:batch|order|serial|item|grant|invoice|lot|sku|ref|version|meter|no\.|nr\.|#)\s*#?$", re.I)
_SPELLED_PHONE = 7

_ID_CUE = re.compile(
    r"\b(?:SSN|soc(?:ial|\.)?\s*sec(?:urity|\.)?|social|passport|driver'?s?'?\s+licen[cs]e|licen[cs]e|DL|TIN|ITIN|EIN|tax(?:payer)?|enroll?(?:ment|ed)?|tribal|CIB|CDIB|national\s+id|identity|ID)\b",
    re.I,
)
_ID_GLUE = re.compile(r"(?:[\s,:;#]|\b(?:number|numbers|no\.?|num\.?|nr\.?|id|is|was|as|card|code|the|identification|roll)(?=[\s,:#.]|$)|(?<=\w)\.)*", re.I)
_ID_VALUE = re.compile(r"\d{3}[ .-]\d{2}[ .-]\d{4}(?!\w)|(?=[A-Z0-9./-]*\d)[A-Z0-9]+(?:[-/.][A-Z0-9]+)*(?!\w)")

_TYPE = "|".join(sorted(STREETS, key=len, reverse=True))
_UNIT = r"(?:,?\s*(?:Apt|Apartment|Suite|Ste|Unit|Room|Rm|Lot|Trlr|Bldg|#)\.?\s?#?\w+)?"
_ADDRESS = re.compile(
    r"(?<![\w$#.,/-])(?:"
    rf"(?P<house>\d{{1,6}}(?:-\d{{1,5}})?[A-Za-z]?)\s+(?:(?:N|S|E|W|NE|NW|SE|SW)\.?\s+|(?:North|South|East|West)\s+)?"
    rf"(?:(?:County|State|Indian|Service|Farm)\s+(?:Road|Rd|Route|Rte|Highway|Hwy)\.?\s+\d+[A-Za-z]?|(?:Route|Rte|Highway|Hwy)\.?\s+\d+|(?:[A-Z][\w']*\s+){{1,3}}(?:{_TYPE})\b(?P<dot>\.)?)"
    rf"{_UNIT}"
    r"|(?:P\.?\s?O\.?|Post\s+Office)\s+Box\s+\d+[A-Za-z]?"
    r"|(?:Rural\s+Route|RR)\s+\d+,?\s+Box\s+\d+[A-Za-z]?"
    r")"
)
_YEAR_BEFORE = re.compile(r"\b(?:in|since|by|until|of|from|before|after|during)\s+$", re.I)
_NAME_TOKEN = re.compile(r"[^\W\d_]+(?:['’-][^\W\d_]+)*\.?")


@dataclass(frozen=True)
class Span:
    kind: str
    start: int
    end: int


class NameLexicon:
    """First and last names with their shortened forms, learned from labelled rows; spelled as ``joined_name`` gives them.

    Names of less than four letters count as nicknames, which need a name beside them. Misspellings, nicknames and like
    words are measured against the ``established`` names only (all of them if None): a name seen once may itself be a
    misspelling, and counts where it stands as it was seen. Only the names travel to the workers; the index of near
    spellings (a hash and a number per letter left out) is made where it is first used.
    """

    def __init__(self, first: Sequence[str], last: Sequence[str], established: Sequence[str] | None = None) -> None:
        self.first, self.last = (frozenset(n for n in names if len(n) >= 4 and n not in NOT_PERSON) for names in (first, last))
        self.short = frozenset(n for names in (first, last) for n in names if 1 < len(n) < 4)
        known = self.first | self.last
        self.known = known if established is None else known & frozenset(established)
        self.starts = frozenset(name[:n] for name in self.first & self.known for n in (2, 3, 4) if len(name) > n)
        self.edges = frozenset(name[:3] for name in self.known) | frozenset(name[-4:] for name in self.known)
        self.roles: dict[str, str] = {}
        self.index: tuple[list[str], np.ndarray, np.ndarray] | None = None

    def __reduce__(self):
        return NameLexicon, (sorted(self.first | self.short), sorted(self.last), sorted(self.known))

    def near(self, word: str) -> bool:
        """Whether an established name lies within two edits of ``word`` and shares it or a one-letter deletion of it."""
        if self.index is None:
            names = sorted(self.known)
            pairs = [(hash(key), i) for i, name in enumerate(names) for key in _deletes(name)]
            hashes, ids = (np.array(x, dtype=np.int64) for x in zip(*pairs, strict=True)) if pairs else (np.zeros(0, dtype=np.int64),) * 2
            order = np.argsort(hashes, kind="stable")
            self.index = names, hashes[order], ids[order].astype(np.int32)
        names, hashes, ids = self.index
        keys = np.array([hash(k) for k in _deletes(word)], dtype=np.int64)
        spans = zip(np.searchsorted(hashes, keys, "left"), np.searchsorted(hashes, keys, "right"), strict=True)
        return any(within(word, names[i], 2) for low, high in spans for i in ids[low:high])

    def role(self, token: str) -> str:
        """F first, L last, B both, f misspelt name, N possible nickname, I initial, '' none of these."""
        role = self.roles.get(token)
        if role is None:
            if len(self.roles) > 1 << 17:
                self.roles.clear()
            role = self.roles[token] = self._role(token)
        return role

    def _role(self, token: str) -> str:
        word = token.rstrip(".")
        if len(word) == 1:
            return "I" if token.endswith(".") else ""
        joined = joined_name(re.sub("['’]s$", "", word))
        first, last = joined in self.first, joined in self.last
        if first or last:
            return "B" if first and last else "F" if first else "L"
        if len(joined) >= 6 and self.near(joined):
            return "f"
        if joined in self.short:
            return "N"
        if len(joined) <= 5 and any(joined.endswith(e) and 2 + (not e) <= len(joined) - len(e) <= 4 and joined[: len(joined) - len(e)] in self.starts for e in NICK_ENDINGS):
            return "N"
        return ""


def joined_name(word: str) -> str:
    """A name for comparison: no letter case, no accents, its parts joined over blanks, hyphens and apostrophes."""
    bare = "".join(c for c in unicodedata.normalize("NFD", word) if not unicodedata.combining(c))
    return "".join(c for c in bare.casefold() if c.isalpha())


def _deletes(word: str) -> set[str]:
    return {word, *(word[:i] + word[i + 1 :] for i in range(len(word)))} if len(word) >= 5 else {word}


class Text:
    """A text with, for each character, the span of source characters it stands for."""

    def __init__(self, source: str) -> None:
        self.source = source
        if source.isascii():
            self.value, self.starts, self.ends = source, range(len(source)), range(1, len(source) + 1)
            return
        value, starts, ends = [], [], []
        i, size = 0, len(source)
        while i < size:
            j = i + 1
            while j < size and unicodedata.combining(source[j]):
                j += 1
            plain = "".join(map(_plain, unicodedata.normalize("NFC", source[i:j])))
            for c in plain:
                value.append(c)
                starts.append(i)
                ends.append(j)
            i = j
        self.value, self.starts, self.ends = _one_script("".join(value)), starts, ends

    def rewrite(self, at: Sequence[tuple[int, int, str]]) -> None:
        """Replace the given spans of the value; each new character stands for the whole source span."""
        if not at:
            return
        value, starts, ends, last = [], [], [], 0
        for start, end, new in at:
            value.append(self.value[last:start])
            starts += self.starts[last:start]
            ends += self.ends[last:start]
            value.append(new)
            starts += [self.starts[start]] * len(new)
            ends += [self.ends[end - 1]] * len(new)
            last = end
        value.append(self.value[last:])
        starts += self.starts[last:]
        ends += self.ends[last:]
        self.value, self.starts, self.ends = "".join(value), starts, ends

    def span(self, kind: str, start: int, end: int) -> Span:
        return Span(kind, self.starts[start], self.ends[end - 1])


def _one_script(text: str) -> str:
    """Look-alikes of Latin letters as Latin ones in words that also hold Latin letters or figures."""

    def word(m: re.Match) -> str:
        token = m[0]
        if token.isascii() or not any(c.isascii() or _script(c) == "LATIN" for c in token):
            return token
        return "".join(_TO_LATIN.get(c, c) for c in token)

    return re.sub(r"[^\s,;:()<>\[\]]+", word, text)


def _deobfuscate(text: Text) -> list[tuple[int, int]]:
    """Rewrite spelled digits and at/dot disguises; spans of rewritten digits in the value."""
    lowered = text.value.lower()
    if "dot" in lowered or _BRACKETED_AT.search(lowered):
        at = []
        for m in _DISGUISED.finditer(text.value):
            marks = [d for d in _DISGUISE.finditer(m[0])]
            if not _NO_HOST.search(m[0], m.end(1) - m.start()) and any((d[1] or d[2]).lower() == "dot" for d in marks) or any("(" in d[0] or "[" in d[0] or "{" in d[0] or "<" in d[0] for d in marks):
                at += [(m.start() + d.start(), m.start() + d.end(), "@" if (d[1] or d[2]).lower() == "at" else ".") for d in marks]
        text.rewrite(at)
    runs = [m for m in _SPELLED.finditer(text.value)] if any(w in lowered for w in DIGITS) else []
    digits, shift, at = [], 0, []
    for m in runs:
        new = "".join(DIGITS[w] for w in re.findall(_WORDS, m[0].lower()))
        at.append((m.start(), m.end(), new))
        digits.append((m.start() + shift, m.start() + shift + len(new)))
        shift += len(new) - (m.end() - m.start())
    text.rewrite(at)
    return digits


def find_spans(source: str | None, lexicon: NameLexicon | None = None) -> list[Span]:
    """Spans of personal information in ``source``, in order and without overlaps.

    NULL and empty texts have none; texts of any length are searched whole.
    """
    if not source:
        return []
    text = Text(source)
    spelled = _deobfuscate(text)
    value = text.value
    taken = bytearray(len(value))
    found: list[Span] = []

    def take(kind: str, start: int, end: int) -> None:
        if end > start and not any(taken[start:end]):
            taken[start:end] = b"\x01" * (end - start)
            found.append(text.span(kind, start, end))

    if "@" in value:
        for m in _EMAIL.finditer(value):
            take("email", m.start(), m.end())
    if spelled or any(c.isdigit() for c in value):
        for start, end in _identity_numbers(value):
            take("identity_number", start, end)
        for start, end in _addresses(value):
            take("street_address", start, end)
        for m in _PHONE.finditer(value):
            if not _NOT_PHONE.search(value[max(0, m.start() - 12) : m.start()].rstrip(" ")):
                take("phone", m.start(), m.end())
        for start, end in spelled:
            if end - start >= _SPELLED_PHONE:
                take("phone", start, end)
    if lexicon is not None:
        for start, end in _names(value, taken, lexicon):
            take("name", start, end)
    return sorted(found, key=lambda s: s.start)


def _identity_numbers(value: str) -> Iterator[tuple[int, int]]:
    for cue in _ID_CUE.finditer(value):
        glue = _ID_GLUE.match(value, cue.end())
        number = _ID_VALUE.match(value, glue.end()) if glue.end() > cue.end() else None
        if number and sum(c.isdigit() for c in number[0]) >= 5:
            yield number.start(), number.end()


def _addresses(value: str) -> Iterator[tuple[int, int]]:
    for m in _ADDRESS.finditer(value):
        house = m.group("house")
        if house and re.fullmatch(r"(?:19|20)\d\d", house) and _YEAR_BEFORE.search(value[max(0, m.start() - 8) : m.start()]):
            continue
        end = m.end()
        if m.group("dot") and m.end("dot") == end:
            rest = value[end : end + 2]
            if not rest or (rest[0] not in ".,;:)" and not (rest[0].isspace() and rest[1:].islower())):
                end -= 1
        yield m.start(), end


def _names(value: str, taken: bytearray, lexicon: NameLexicon) -> Iterator[tuple[int, int]]:
    tokens = [m for m in _NAME_TOKEN.finditer(value) if m[0][0].isupper() and not taken[m.start()]]
    i = 0
    while i < len(tokens):
        roles: list[str] = []
        run: list[re.Match] = []
        while i < len(tokens) and len(run) < 4:
            token = tokens[i]
            gap = value[run[-1].end() : token.start()] if run else ""
            if run and gap not in (" ", ", ", " "):
                break
            role = lexicon.role(token[0])
            if run and gap == ", " and not (len(run) == 1 and roles[0] in "LB" and role and role in "FBN"):
                break
            if run and run[-1][0].endswith(".") and len(run[-1][0]) > 2:
                break
            if not role:
                break
            run.append(token)
            roles.append(role)
            i += 1
        if not run:
            i += 1
            continue
        if roles == ["I"]:
            continue
        start, end, beside = run[0].start(), run[-1].end(), False
        follow = _NAME_TOKEN.match(value, end + 1) if value[end : end + 1] == " " else None
        if follow and follow[0].rstrip(".").lower() in NOT_PERSON:
            continue
        if len(run) == 1 and follow and roles[0] in "FBf" and _like_name(follow[0], lexicon):
            after = _NAME_TOKEN.match(value, follow.end() + 1)
            if after and value[follow.end()] == " " and after[0].lower() in NOT_PERSON:
                continue
            end, beside = follow.end() - follow[0].endswith("."), True
        elif len(run) == 1 and roles[0] in "LBf":
            before = re.search(r"([A-Z][^\W\d_]+) $", value[max(0, start - 24) : start])
            if before and _like_name(before[1], lexicon):
                start, beside = start - len(before[0]), True
        strong, fuzzy = sum(r in "FLB" for r in roles), roles.count("f")
        if not strong and not (fuzzy >= 2 or (fuzzy and (beside or "I" in roles))):
            continue
        if not beside:
            if roles[-1] == "N" and len(run) > 1:
                run, roles = run[:-1], roles[:-1]
                end = run[-1].end()
            if value[end - 1] == "." and roles[-1] != "I":
                end -= 1
        if value[start:end].endswith(("'s", "’s")):
            end -= 2
        yield start, end


def _like_name(token: str, lexicon: NameLexicon) -> bool:
    """Whether an unknown capitalised word beside a name begins or ends as names do."""
    word = token.rstrip(".").casefold()
    return token[0].isupper() and len(word) >= 5 and word not in NOT_PERSON and (word[:3] in lexicon.edges or word[-4:] in lexicon.edges)


def learn_names(labelled: DataFrame, first: str, last: str, sample_rows: int = 250_000) -> NameLexicon:
    """A lexicon fitted on labelled rows: every first and last name of at most about ``sample_rows`` of them.

    All rows count while there are no more than that; beyond it a share of them is drawn by the hash of the names, so
    the collected lexicon holds at most two names per drawn row whatever the size of the table. Rows with a NULL or
    blank name teach nothing; names seen twice or more are established. A column may hold the other's names in some rows: a name counts as what it is in at least
    a third of its rows.
    """
    pairs = labelled.select(F.trim(f"`{first}`").alias("first"), F.trim(f"`{last}`").alias("last")).where("first <> '' and last <> ''")
    parts = max(1, -(-pairs.count() // sample_rows))
    drawn = pairs.where(F.pmod(F.xxhash64("first", "last"), F.lit(parts)) == 0)
    each = F.array(F.struct(F.col("first").alias("name"), F.lit(1).alias("is_first")), F.struct(F.col("last").alias("name"), F.lit(0).alias("is_first")))
    rows = drawn.select(F.explode(each).alias("n")).select("n.*").groupBy("name").agg(F.sum("is_first").alias("first"), F.count("*").alias("n")).collect()
    counts: dict[str, list[int]] = {}
    for r in rows:
        if name := joined_name(r["name"]):
            own = counts.setdefault(name, [0, 0])
            own[0] += r["first"]
            own[1] += r["n"] - r["first"]
    first, last = [n for n, (a, b) in counts.items() if 2 * a >= b], [n for n, (a, b) in counts.items() if 2 * b >= a]
    return NameLexicon(first, last, [n for n, (a, b) in counts.items() if a + b > 1])


def split_mentions(mentions: DataFrame, mention: str) -> DataFrame:
    """(first, last) of mentions of people, in either order ("First Last", "Last, First"), titles and middle names aside.

    NULL mentions and those of one word give no row.
    """
    bare = F.regexp_replace(F.trim(f"`{mention}`"), r"(?i)^(?:(?:" + "|".join(sorted(TITLES)) + r")\.?\s+)+", "")
    comma, tokens = F.split(bare, r"\s*,\s*"), F.split(bare, r"\s+")
    two = F.size(comma) == 2
    named = mentions.select(
        F.when(two, F.element_at(F.split(F.get(comma, 1), r"\s+"), 1)).otherwise(F.get(tokens, 0)).alias("first"),
        F.when(two, F.get(comma, 0)).when(F.size(tokens) > 1, F.element_at(tokens, -1)).alias("last"),
    )
    return named.where("first is not null and last is not null")


def redact(source: str | None, spans: Sequence[Span]) -> str | None:
    """The text with typed placeholders in place of the spans."""
    if source is None:
        return None
    out, last = [], 0
    for s in spans:
        out += [source[last : s.start], PLACEHOLDERS[s.kind]]
        last = s.end
    return "".join([*out, source[last:]])


def find_personal(rows: DataFrame, lexicon: NameLexicon | None) -> DataFrame:
    """``rows`` (field_name, row_id, text) with ``redacted`` and ``found`` (kind, surface, start), whole texts.

    NULL texts stay NULL with nothing found; repeated rows are kept; other columns are not read.
    """
    schema = f"field_name string, row_id {rows.schema['row_id'].dataType.simpleString()}, redacted string, found array<struct<kind:string,surface:string,start:int>>"

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            redacted, found = [], []
            for text in batch["text"]:
                text = None if pd.isna(text) else text
                spans = find_spans(text, lexicon)
                redacted.append(redact(text, spans))
                found.append([{"kind": s.kind, "surface": text[s.start : s.end], "start": s.start} for s in spans])
            yield pd.DataFrame({"field_name": batch["field_name"], "row_id": batch["row_id"], "redacted": redacted, "found": found})

    return rows.select("field_name", "row_id", "text").mapInPandas(search, schema)
