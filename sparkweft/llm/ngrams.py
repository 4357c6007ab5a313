"""Character n-grams of many texts at once, in numpy."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

#: Texts are worked on in runs of about this many characters, so memory stays bounded whatever the batch.
RUN_CHARS = 1 << 20


def runs(texts: Sequence[str], most: int = RUN_CHARS, many: int = 1 << 30) -> Iterator[tuple[int, int]]:
    """Slices of texts with about most characters and at most many texts; a longer text has a slice of its own."""
    first, total = 0, 0
    for at, text in enumerate(texts):
        if at > first and (total + len(text) > most or at - first >= many):
            yield first, at
            first, total = at, 0
        total += len(text)
    if len(texts) > first:
        yield first, len(texts)


def owners(lengths: Sequence[int]) -> np.ndarray:
    """For each position of the joined texts, the text's place."""
    return np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)


def character_sets(texts: Sequence[str], sizes: Sequence[int], bits: int, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Places of texts and the numbers of their distinct n-grams, in order; those of weight 0, if weights are given, are left out.

    An n-gram of lower-cased characters (a text has a blank before and after it) is numbered by a hash of its code points and size.
    """
    low = [f" {t.lower()} " for t in texts]
    points = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
    of, found = owners([len(t) for t in low]), [np.zeros(0, np.int64)]
    grown, at = points.copy(), 1
    for n in sorted(sizes):
        while at < n:
            grown = grown[: max(len(points) - at, 0)] * np.uint64(0x9E3779B97F4A7C15) + points[at:]
            at += 1
        mixed = (grown ^ (grown >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
        number = (mixed >> np.uint64(64 - bits)).astype(np.int64)
        take = of[: len(grown)] == of[at - 1 :] if len(grown) else np.zeros(0, bool)
        if weights is not None:
            take &= weights[number] != 0
        found.append((of[: len(grown)][take].astype(np.int64) << bits) | number[take])
    both = np.concatenate(found)
    both.sort()
    both = both[np.diff(both, prepend=-1) != 0]
    return (both >> bits).astype(np.int32), (both & ((1 << bits) - 1)).astype(np.int32)
