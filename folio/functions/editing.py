"""Edit distances of many pairs at once, by bit-parallel columns.

A column of the edit matrix is kept as two bits for each character of the pattern: where
it goes up and where it goes down (Myers 1999; words are chained by the step that
leaves the one below).  One step takes a character of all texts of a chunk, in all words at
once: a word is one character behind the one below, so what leaves that is known by then.
"""

from __future__ import annotations

import numpy as np

#: Words of state of a chunk of pairs.
CHUNK = 1 << 15
_U = np.uint64
_ONE, _TOP = np.uint64(1), np.uint64(63)


def codes(text: str) -> np.ndarray:
    """The code points of a text."""
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def edit_distances(patterns: list[np.ndarray], texts: list[np.ndarray], p: np.ndarray, t: np.ndarray) -> np.ndarray:
    """The edit distance of ``patterns[p[i]]`` and ``texts[t[i]]`` for every i; both are code points."""
    # a list may be much longer than what a few texts are compared with
    used, p = np.unique(p, return_inverse=True)
    patterns = [patterns[k] for k in used.tolist()]
    size_p, size_t = (np.array([len(x) for x in side], np.int64) for side in (patterns, texts))
    out = np.where(size_p[p] == 0, size_t[t], size_p[p]) if len(p) else np.zeros(0, np.int64)
    alphabet = np.unique(np.concatenate([*patterns, np.zeros(0, np.uint32)]))
    if not len(alphabet):
        return out
    at = {k: np.minimum(np.searchsorted(alphabet, texts[k]), len(alphabet) - 1) for k in np.unique(t).tolist()}
    classes = {k: np.where(alphabet[i] == texts[k], i + 1, 0) for k, i in at.items()}
    words = -(-size_p // 64)
    mine = np.flatnonzero((size_p[p] > 0) & (size_t[t] > 0))
    # those that take the most steps come first
    mine = mine[np.argsort(-(size_t[t[mine]] + words[p[mine]]), kind="stable")]
    state = np.cumsum(words[p[mine]])
    first = 0
    while first < len(mine):
        held = state[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(state, held + CHUNK, side="right")))
        chunk = mine[first:last]
        out[chunk] = _distances(patterns, classes, alphabet, p[chunk], t[chunk], size_p, size_t)
        first = last
    return out


def _masks(patterns: list[np.ndarray], alphabet: np.ndarray, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each word of the patterns, the places of each character of the alphabet, and none for others; the first word of each pattern."""
    words = -(-some // 64)
    start = np.cumsum(words) - words
    place = np.arange(some.sum()) - np.repeat(np.cumsum(some) - some, some)
    masks = np.zeros((words.sum(), len(alphabet) + 1), _U)
    letters = np.searchsorted(alphabet, np.concatenate(patterns)) + 1
    np.bitwise_or.at(masks, (np.repeat(start, some) + place // 64, letters), _ONE << (place % 64).astype(_U))
    return masks.ravel(), start


def _distances(patterns, classes, alphabet, p, t, size_p, size_t) -> np.ndarray:
    """The same for pairs sorted by the steps they take."""
    used, row = np.unique(p, return_inverse=True)
    masks, start = _masks([patterns[k] for k in used.tolist()], alphabet, size_p[used])
    n_words = -(-size_p[p] // 64)
    end = np.cumsum(n_words)  # words of state lie pair by pair
    pair = np.repeat(np.arange(len(p)), n_words)
    word = np.arange(end[-1]) - np.repeat(end - n_words, n_words)
    # a word reads nothing before its turn: texts stand between characters that no pattern has
    around = np.zeros(int(n_words.max()), np.int64)
    kept, where = np.unique(t, return_inverse=True)
    flat = np.concatenate([x for k in kept.tolist() for x in (around, classes[k])] + [around])
    begin = np.cumsum(size_t[kept] + len(around)) - size_t[kept]
    reads = begin[where][pair] - word
    base = (start[row][pair] + word) * (len(alphabet) + 1)
    up, down = np.full(len(pair), ~_U(0)), np.zeros(len(pair), _U)
    bottom, top = end - n_words, end - 1
    # the first row goes up by one with every character
    rise, fall = np.zeros(len(pair), _U), np.zeros(len(pair), _U)
    rise[bottom] = _ONE
    score, cell = size_p[p].copy(), np.empty(len(pair), np.int64)
    shift = ((size_p[p] - 1) % 64).astype(_U)
    steps = size_t[t] + n_words - 1
    reading = np.searchsorted(-steps, -np.arange(1, steps[0] + 1), side="right")
    for j, n in enumerate(reading.tolist()):
        b = end[n - 1]
        u, d, into, away = up[:b], down[:b], rise[:b], fall[:b]
        np.take(flat[j:], reads[:b], out=cell[:b], mode="clip")
        cell[:b] += base[:b]
        same = np.take(masks, cell[:b], mode="clip")
        vertical = same | d
        same |= away
        h_up = same & u
        h_up += u
        h_up ^= u
        h_up |= same
        h_down = u & h_up
        h_up |= u
        np.invert(h_up, out=h_up)
        h_up |= d
        last = top[:n]
        score[:n] += ((h_up[last] >> shift[:n]) & _ONE).astype(np.int64) - ((h_down[last] >> shift[:n]) & _ONE).astype(np.int64)
        next_rise, next_fall = h_up >> _TOP, h_down >> _TOP
        h_up <<= _ONE
        h_up |= into
        h_down <<= _ONE
        h_down |= away
        np.bitwise_and(h_up, vertical, out=d)
        vertical |= h_up
        np.invert(vertical, out=vertical)
        np.bitwise_or(h_down, vertical, out=u)
        # what leaves a word goes into the one above at its next step
        into[1:] = next_rise[:-1]
        away[1:] = next_fall[:-1]
        into[bottom[:n]] = _ONE
        away[bottom[:n]] = 0
    return score
