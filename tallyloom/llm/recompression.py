"""Names for runs and pairs of tokens that are the same wherever the same tokens stand."""

from __future__ import annotations

import numpy as np

OUTSIDE = 1 << 40  # reaches beyond the text, so that no window holds it


def mixed(x: np.ndarray, y: np.ndarray | int) -> np.ndarray:
    """A name for the two names x, y: 64 bits that depend on both and on their order."""
    x = (x ^ np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    x = (x + np.asarray(y, np.uint64)) * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(31))


def symbols(names: np.ndarray, text: np.ndarray, rounds: int):
    """Recompress the words of several texts: symbols with the words they need.

    `names` are the words' names, `text` the number of each word's text. First every maximal run of
    one word gets a name, then each round splits the names by a bit of theirs into left and right
    ones and replaces every left-right pair by its name. Returns name, first word, words, low, high:
    the symbol stands for `words` words from `first`, and any text that holds words low to high
    (exclusive) gets the same symbol there; low or high beyond the text means that it also needs
    the text's edge.
    """
    n = len(names)
    if not n:
        e = np.zeros(0, np.int64)
        return names, e, e, e, e
    new = np.concatenate([[True], (names[1:] != names[:-1]) | (text[1:] != text[:-1])])
    first = np.flatnonzero(new)
    end = np.append(first[1:], n)
    owner, name = text[first], names[first]
    size = end - first
    name = np.where(size > 1, mixed(name, size.astype(np.uint64)), name)
    edge = np.concatenate([[True], owner[1:] != owner[:-1], [True]])
    low = np.where(edge[:-1], -OUTSIDE, first - 1)
    high = np.where(edge[1:], OUTSIDE, end + 1)
    for turn in range(rounds):
        right = (mixed(name, turn + 1) & np.uint64(1)).astype(bool)
        within = owner[1:] == owner[:-1]
        joins = np.append(~right[:-1] & right[1:] & within, False)
        joined = np.concatenate([[False], joins[:-1]])
        alone = ~joins & ~joined
        before = np.concatenate([[-OUTSIDE], np.where(within, low[:-1], -OUTSIDE)])
        after = np.append(np.where(within, high[1:], OUTSIDE), OUTSIDE)
        # A left name stays alone because of what follows, a right one because of what precedes.
        low = np.where(alone & right, np.minimum(low, before), low)
        high = np.where(alone & ~right, np.maximum(high, after), high)
        follows = np.minimum(np.arange(len(name)) + 1, len(name) - 1)
        name = np.where(joins, mixed(name, name[follows]), name)
        high = np.where(joins, np.maximum(high, high[follows]), high)
        low = np.where(joins, np.minimum(low, low[follows]), low)
        size = np.where(joins, size + size[follows], size)
        keep = ~joined
        name, first, size, low, high, owner = (x[keep] for x in (name, first, size, low, high, owner))
    return name, first, size, low, high
