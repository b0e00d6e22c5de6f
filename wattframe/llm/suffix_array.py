"""Suffix arrays by induced sorting, and common prefixes in text order, on numpy arrays."""

from __future__ import annotations

import numpy as np


def common_prefixes(text: np.ndarray, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """Bytes that the suffixes at ``a`` and ``b`` share, ``most`` at most."""
    padded = np.concatenate([text, np.zeros(most + 16, np.uint8)])
    words = np.ndarray(len(padded) - 7, "<u8", padded, strides=(1,))
    length = np.zeros(len(a), np.int64)
    limit = np.minimum(len(text) - np.maximum(a, b), most)
    active = np.arange(len(a))
    while len(active):
        at = length[active]
        apart = words[a[active] + at] ^ words[b[active] + at]
        low = apart & (~apart + np.uint64(1))
        equal = np.where(apart == 0, 8, np.bitwise_count(low - np.uint64(1)) // 8)
        length[active] = np.minimum(at + equal, limit[active])
        active = active[(equal == 8) & (length[active] < limit[active])]
    return length


def _smaller(s: np.ndarray) -> np.ndarray:
    """Which suffixes are smaller than the next one. The last value is a unique least one."""
    change = np.flatnonzero(s[:-1] != s[1:])
    following = change[np.searchsorted(change, np.arange(len(s) - 1))]
    return np.append(s[following] < s[following + 1], True)


def _deal(buckets: list[list[np.ndarray]], s: np.ndarray, found: list[np.ndarray]) -> None:
    """Appends positions to the buckets of their values, in order."""
    q = np.concatenate(found) if len(found) != 1 else found[0]
    if not len(q):
        return
    values = s[q]
    order = np.argsort(values, kind="stable")
    q, values = q[order], values[order]
    cuts = np.flatnonzero(values[1:] != values[:-1]) + 1
    starts = np.concatenate([[0], cuts])
    for value, piece in zip(values[starts].tolist(), np.split(q, cuts)):
        buckets[value].append(piece)


def _sweep(
    s: np.ndarray, takes: np.ndarray, values: range, own: list, after: list
) -> list[np.ndarray]:
    """One sweep of induced sorting.

    Visits the buckets in order; ``own`` gets the induced positions. In a bucket come first those
    induced so far, then what they induce in the same bucket, then ``after``."""
    done = []
    for value in values:
        found, kept, chunk = [], [], own[value]
        chunk = np.concatenate(chunk) if chunk else np.zeros(0, np.int64)
        while len(chunk):
            kept.append(chunk)
            q = chunk[chunk > 0] - 1
            q = q[takes[q]]
            same = s[q] == value
            found.append(q[~same])
            chunk = q[same]
        rest = after[value]
        q = rest[rest > 0] - 1
        found.append(q[takes[q]])
        _deal(own, s, found)
        done.append(np.concatenate(kept) if kept else np.zeros(0, np.int64))
    return done


def _induce(s: np.ndarray, smaller: np.ndarray, seeds: np.ndarray, width: int) -> np.ndarray:
    """Order of all suffixes from the order of those that begin leftmost-smaller substrings."""
    none = np.zeros(0, np.int64)
    by_value: list[list[np.ndarray]] = [[] for _ in range(width)]
    _deal(by_value, s, [seeds])
    tails = [np.concatenate(x) if x else none for x in by_value]
    own: list[list[np.ndarray]] = [[] for _ in range(width)]
    larger = _sweep(s, ~smaller, range(width), own, tails)
    own = [[] for _ in range(width)]
    backwards = range(width - 1, -1, -1)
    small = _sweep(s, smaller, backwards, own, [x[::-1] for x in larger])[::-1]
    order = [np.array([len(s) - 1])]
    for value in range(1, width):
        order += [larger[value], small[value][::-1]]
    return np.concatenate(order)


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Positions of ``text`` (bytes) ordered by their suffixes, exact to ``depth`` bytes.

    Suffixes are classified, the leftmost-smaller substrings sorted by induction and named, the
    order of the names' suffixes found by joining neighbouring names again and again (until all
    differ, or ``depth`` is covered), and the whole array induced from it in two linear sweeps.
    """
    if not len(text):
        return np.zeros(0, np.int64)
    s = np.append(text.astype(np.uint16) + 1, np.uint16(0))
    width = int(s.max()) + 1
    smaller = _smaller(s)
    starts = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    order = _induce(s, smaller, starts, width)
    begins = np.zeros(len(s), bool)
    begins[starts] = True
    ordered = order[begins[order]]
    # length of each substring, with the first byte of the next
    size = np.zeros(len(s), np.int64)
    size[starts] = np.diff(np.append(starts, len(s) - 1)) + 1
    a, b = ordered[:-1], ordered[1:]
    longest = int(size.max(initial=1))
    equal = (size[a] == size[b]) & (common_prefixes(text, a, b, longest) >= size[b])
    names = np.zeros(len(s), np.int64)
    names[ordered] = np.cumsum(np.append([1], ~equal)) if len(ordered) else names[:0]
    reduced, covered = names[starts], 1
    while len(reduced) and reduced.max() < len(reduced) and 2 * covered <= depth:
        following = np.append(reduced[covered:], np.zeros(min(covered, len(reduced)), np.int64))
        pairs = reduced * (len(reduced) + 1) + following[: len(reduced)]
        reduced = np.unique(pairs, return_inverse=True)[1] + 1
        covered *= 2
    seeds = starts[np.argsort(reduced, kind="stable")]
    return _induce(s, smaller, seeds, width)[1:]


def permuted_common_prefixes(text: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """For each position, in text order, the bytes shared with the suffix before it in ``order``."""
    before = np.zeros(len(text), np.int64)
    before[order[1:]] = order[:-1]
    shared = common_prefixes(text, np.arange(len(text)), before, most)
    shared[order[:1]] = 0
    return shared
