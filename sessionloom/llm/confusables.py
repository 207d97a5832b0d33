"""One consistent form for text that looks alike but differs in its characters.

Per token the resolved script sets of its letters are intersected: a letter may stand for its own script and for every
script that has a look-alike of it. The intersection tells single-script tokens, mixed-script confusables (only one
script fits all letters) and whole-script confusables (several fit) apart, and the token is spelled in the script
selected. Scripts that are rarely confused as a whole count where they stand beside Latin letters in one word; their
look-alikes are taken from the Unicode data of the session's JVM. Invisible characters, blanks, apostrophes, hyphens, digits and compatibility forms are normalised around it.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator, Mapping
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Look-alikes of Latin letters, script by script (public Unicode confusables data).
LOOKALIKES = {
    "CYRILLIC": dict(zip("АВЕЅІЈКМНОРСТУХаеіјорсухѕһԁԛԝҮүӏ", "ABESIJKMHOPCTYXaeijopcyxshdqwYyl", strict=True)),
    "GREEK": dict(zip("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧοναιγυρϲϳ", "ABEZHIKMNOPTYXovaiyupcj", strict=True)),
    "ARMENIAN": dict(zip("օոսհցյՕՍ", "onuhgjOU", strict=True)),
    "CHEROKEE": dict(zip("ᎪᎫᎬᎳᎷᎻᏃᏎᏒᏚᏞᏟᏢᏦᏴ", "AJEWMHZ4RSLCPKB", strict=True)),
}
# Irregular Latin letters that stand for ordinary ones.
LATIN_FORMS = {"ı": "i", "ȷ": "j", "ɡ": "g", "ɑ": "a", "ɩ": "i", "ⅼ": "l", "ʏ": "y", "ᴏ": "o", "ᴄ": "c", "ᴠ": "v", "ᴡ": "w", "ᴢ": "z", "ꜱ": "s"}
APOSTROPHES = frozenset("’‘ʼʻ‛′´ʹˈ＇ʽ՚ꞌ")
HYPHENS = frozenset("‐‑‒–—―−﹣－⁃˗")
INVISIBLE = frozenset("͏ᅟᅠ឴឵ㅤﾠ᠋᠌᠍᠎")

_TO_LATIN = {c: latin for pairs in LOOKALIKES.values() for c, latin in pairs.items()}
_FROM_LATIN = {script: {latin: c for c, latin in pairs.items()} for script, pairs in LOOKALIKES.items()}


@lru_cache(maxsize=65_536)
def _script(c: str) -> str:
    return unicodedata.name(c, "UNKNOWN").split(" ")[0]


@lru_cache(maxsize=65_536)
def _resolved(c: str) -> frozenset[str]:
    """The scripts in which the letter can be written without a visible change."""
    own = _script(c)
    scripts = {own}
    latin = c if own == "LATIN" else _TO_LATIN.get(c)
    if latin:
        scripts.add("LATIN")
        scripts.update(script for script, pairs in _FROM_LATIN.items() if latin in pairs)
    return frozenset(scripts)


@lru_cache(maxsize=65_536)
def _plain(c: str) -> str:
    """The ordinary form of one character, script aside; '' if it is invisible."""
    if c < "\x7f":
        return c if c >= " " else (" " if c.isspace() else "")
    if c in APOSTROPHES:
        return "'"
    if c in HYPHENS:
        return "-"
    category = unicodedata.category(c)
    if c in INVISIBLE or category in ("Cf", "Cc") or "VARIATION SELECTOR" in unicodedata.name(c, ""):
        return " " if c == "\x85" else ""
    if category in ("Zs", "Zl", "Zp") or c == "⠀":
        return " "
    if category == "Nd":
        return str(unicodedata.decimal(c))
    if c in LATIN_FORMS:
        return LATIN_FORMS[c]
    if category[0] == "L" or category == "Nl" or 0xFF01 <= ord(c) <= 0xFF5E:
        folded = unicodedata.normalize("NFKC", c)
        if all(x < "\x7f" or _script(x) == "LATIN" for x in folded):
            return folded
    return c


@lru_cache(maxsize=1)
def _letters() -> tuple[str, ...]:
    """Letters of all scripts but Latin that have no plain Latin form of their own."""
    every = (chr(c) for c in range(0xA1, 0x20000))
    return tuple(c for c in every if unicodedata.category(c)[0] == "L" and _script(c) != "LATIN" and _plain(c) == c)


def session_lookalikes(spark: SparkSession) -> dict[str, str]:
    """Letters of any other script that look like one ordinary Latin letter, by the Unicode confusables data of ICU.

    All letters go through ICU's skeleton in one call; those whose skeleton is that of a Latin letter look like it.
    Where the session gives no access to its JVM the fixed tables are all there is.
    """
    try:
        checker = spark._jvm.com.ibm.icu.text.SpoofChecker.Builder().build()
    except (AttributeError, TypeError):
        return dict(_TO_LATIN)
    latin: dict[str, list[str]] = {}
    for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz":
        latin.setdefault(checker.getSkeleton(c), []).append(c)
    letters = _letters()
    found = {}
    for c, skeleton in zip(letters, checker.getSkeleton("\n".join(letters)).split("\n"), strict=True):
        if forms := latin.get(skeleton):
            found[c] = next((x for x in forms if x.isupper() == c.isupper()), forms[0])
    return found | _TO_LATIN


def _spell(token: str, letters: list[str], fits: frozenset[str], latin_text: bool) -> str:
    """The token in the script that fits all its letters; unchanged if none does."""
    own = {_script(c) for c in letters}
    if len(own) == 1 and not (own != {"LATIN"} and "LATIN" in fits and latin_text):
        return token
    if "LATIN" in fits:
        return "".join(_TO_LATIN.get(c, c) for c in token)
    for script in sorted(fits):
        back = _FROM_LATIN.get(script, {})
        return "".join(back.get(c, c) if _script(c) == "LATIN" else c for c in token)
    return token


def clean_text(text: str | None, lookalikes: Mapping[str, str] | None = None) -> str | None:
    """The clean form; NULL stays NULL. Spelling and letter case are kept; the function is idempotent.

    ``lookalikes`` gives further letters their Latin look-alike, in words that hold Latin letters too. A word wholly in another script stays as it is unless every letter of it has a Latin look-alike and the text
    around it is Latin. A word whose letters fit no single script keeps them.
    """
    if text is None:
        return None
    spread = "".join(map(_plain, unicodedata.normalize("NFC", text)))
    tokens = unicodedata.normalize("NFD", spread).split()
    parsed = []
    for token in tokens:
        letters = [c for c in token if unicodedata.category(c)[0] == "L"]
        fits = frozenset.intersection(*map(_resolved, letters)) if letters else frozenset()
        if lookalikes and letters and not fits and any(_script(c) == "LATIN" for c in letters) and all(_script(c) == "LATIN" or c in lookalikes for c in letters):
            token = "".join(lookalikes.get(c, c) for c in token)
            letters = [c for c in token if unicodedata.category(c)[0] == "L"]
            fits = frozenset.intersection(*map(_resolved, letters))
        parsed.append((token, letters, fits))
    whole = [{_script(c) for c in letters} for _, letters, fits in parsed if letters and "LATIN" not in fits]
    latin = any("LATIN" in fits and (len(own := {_script(c) for c in letters}) > 1 or "LATIN" in own) for _, letters, fits in parsed)
    foreign = any(scripts != {"LATIN"} for scripts in whole)
    words = [_spell(token, letters, fits, latin and not foreign) if letters else token for token, letters, fits in parsed]
    return unicodedata.normalize("NFC", " ".join(words))


def suspicious(value: Column) -> Column:
    """Whether the value can differ from its clean form at all: anything but single-spaced printable ASCII."""
    return value.rlike(r"[^\x20-\x7e]|^ | $|  ")


def clean_dictionary(values: DataFrame, column: str) -> DataFrame:
    """Rows of ``values`` whose ``column`` isn't in clean form, with ``clean_text`` beside the other columns.

    NULL values give no row, an empty table gives none, repeated rows are kept, other columns pass through.
    """
    schema = values.drop("clean_text")
    out = schema.schema.add("clean_text", "string")
    lookalikes = session_lookalikes(values.sparkSession)

    def clean(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            forms = {v: clean_text(v, lookalikes) for v in batch[column].unique()}
            batch["clean_text"] = batch[column].map(forms)
            yield batch[batch["clean_text"] != batch[column]]

    return schema.where(suspicious(F.col(f"`{column}`"))).mapInPandas(clean, out)
