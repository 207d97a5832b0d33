"""Compressed sets of ordinals: numpy containers of 2**16 ordinals, each stored in its smallest encoding.

A bitmap is a ``dict`` from the high bits of the ordinals to ``(kind, payload)``: ``"array"`` holds sorted
``uint16`` members, ``"bits"`` a packed bit string, ``"runs"`` start/length pairs. Set operations work container by
container, so a full or an empty stretch of ordinals costs a few bytes.
"""

from __future__ import annotations

import numpy as np

CONTAINER = 1 << 16
Bitmap = dict[int, tuple[str, bytes]]


def _encode(low: np.ndarray) -> tuple[str, bytes]:
    low = low.astype(np.int64)
    starts = np.flatnonzero(np.diff(low, prepend=-2) != 1)
    lengths = np.diff(np.append(starts, low.size))
    sizes = {"array": 2 * low.size, "bits": CONTAINER // 8, "runs": 4 * starts.size}
    kind = min(sizes, key=sizes.__getitem__)
    if kind == "array":
        return kind, low.astype(np.uint16).tobytes()
    if kind == "runs":
        return kind, np.stack([low[starts], lengths - 1], axis=1).astype(np.uint16).tobytes()
    mask = np.zeros(CONTAINER, dtype=bool)
    mask[low] = True
    return kind, np.packbits(mask).tobytes()


def _mask(container: tuple[str, bytes]) -> np.ndarray:
    kind, payload = container
    if kind == "bits":
        return np.unpackbits(np.frombuffer(payload, dtype=np.uint8)).astype(bool)
    mask = np.zeros(CONTAINER, dtype=bool)
    if kind == "array":
        mask[np.frombuffer(payload, dtype=np.uint16)] = True
    else:
        for start, extra in np.frombuffer(payload, dtype=np.uint16).reshape(-1, 2).astype(int):
            mask[start : start + extra + 1] = True
    return mask


def from_ordinals(ordinals: np.ndarray) -> Bitmap:
    """The bitmap of non-negative ordinals, in any order, repeats allowed."""
    ordinals = np.unique(np.asarray(ordinals, dtype=np.int64))
    high = ordinals >> 16
    return {int(h): _encode(ordinals[high == h] & (CONTAINER - 1)) for h in np.unique(high)}


def to_ordinals(bitmap: Bitmap) -> np.ndarray:
    """The members in ascending order."""
    parts = [np.flatnonzero(_mask(bitmap[h])) + h * CONTAINER for h in sorted(bitmap)]
    return np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64)


def _combine(a: Bitmap, b: Bitmap, keep_alone: bool, op) -> Bitmap:
    out: Bitmap = {}
    for high, container in a.items():
        if high not in b:
            if keep_alone:
                out[high] = container
            continue
        low = np.flatnonzero(op(_mask(container), _mask(b[high])))
        if low.size:
            out[high] = _encode(low)
    return out


def and_not(a: Bitmap, b: Bitmap) -> Bitmap:
    """Members of ``a`` that ``b`` lacks."""
    return _combine(a, b, True, lambda x, y: x & ~y)


def intersection(a: Bitmap, b: Bitmap) -> Bitmap:
    """Members of both."""
    return _combine(a, b, False, lambda x, y: x & y)
