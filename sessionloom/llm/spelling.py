"""String helpers shared by the operators on names: folding, abbreviations, edit and subsequence measures."""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

from sessionloom.llm.confusables import clean_text

_CAMEL = re.compile(r"(?<=[a-z]{2})(?=[A-Z][a-z])")
_WORD = re.compile(r"[^\W_]+")


def fold(text: str | None) -> str:
    """Clean form, run-together words parted at inner capitals, no accents, no letter case."""
    if not text:
        return ""
    if text.isascii() and text.isprintable():  # clean but for its blanks
        return _CAMEL.sub(" ", " ".join(text.split())).lower()
    bare = "".join(c for c in unicodedata.normalize("NFD", clean_text(text)) if not unicodedata.combining(c))
    return unicodedata.normalize("NFC", _CAMEL.sub(" ", bare).casefold())


def words(text: str) -> list[str]:
    """Runs of letters and digits."""
    return _WORD.findall(text)


@lru_cache(maxsize=1 << 18)
def edits(a: str, b: str) -> int:
    """Optimal string alignment distance: insertions, deletions, substitutions, swaps of neighbours."""
    if a == b:
        return 0
    older: list[int] = []
    last = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i] + [0] * len(b)
        for j, y in enumerate(b, 1):
            row[j] = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                row[j] = min(row[j], older[j - 2] + 1)
        older, last = last, row
    return last[-1]


@lru_cache(maxsize=1 << 18)
def common_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, by bit-parallel dynamic programming."""
    mask = (1 << len(a)) - 1
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | (1 << i)
    state = mask
    for c in b:
        hit = state & where.get(c, 0)
        state = ((state + hit) | (state - hit)) & mask
    return len(a) - state.bit_count()


def lcs_ratio(a: str, b: str) -> float:
    """Twice the longest common subsequence over the total length."""
    return 2.0 * common_length(a, b) / (len(a) + len(b)) if a or b else 1.0


def within(a: str, b: str, limit: int) -> bool:
    """Whether ``edits`` is at most ``limit``; the common subsequence rules most pairs out before it is computed."""
    if a == b:
        return True
    size = max(len(a), len(b))
    return abs(len(a) - len(b)) <= limit and common_length(a, b) >= size - limit and edits(a, b) <= limit


# Spellings that sound or look alike, rewritten in this order.
ALIKE = [("qu", "kw"), ("x", "ks"), ("ck", "k"), ("ph", "f"), ("oo", "u"), ("rn", "m"), ("c", "k"), ("q", "k"), ("w", "v"), ("y", "i"), ("z", "s")]


@lru_cache(maxsize=1 << 17)
def sound(text: str) -> str:
    """Folded text with spellings that sound alike written alike."""
    for old, new in ALIKE:
        text = text.replace(old, new)
    return text


def typing_errors(a: str, b: str, limit: int) -> int | None:
    """The least edits between two words as typed or as they sound, None beyond ``limit``."""
    found = [edits(x, y) for x, y in ((a, b), (sound(a), sound(b))) if within(x, y, limit)]
    return min(found, default=None)


@lru_cache(maxsize=1 << 16)
def abbreviates(short: str, word: str) -> bool:
    """Whether ``short`` is a shortening of ``word``: same first letter (x for cross), its letters in order."""
    if word.startswith("cross") and short.startswith("x"):
        return word.endswith(short[1:])
    if len(short) >= len(word) or not short or short[0] != word[0]:
        return False
    rest = iter(word)
    return all(c in rest for c in short)
