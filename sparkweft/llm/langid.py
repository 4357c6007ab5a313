"""Language identification by hyperdimensional profiles.

Every letter has a random vector of DIMENSIONS signs, drawn by its code point, so any letter of any script has one of its own and no
table of letters is kept. The vector of an n-gram of three letters binds, by multiplying, the letters' vectors
permuted by their place (rolled by 2, 1 and 0); a text's vector is the bundle, the sum over its n-grams. A language's
prototype bundles the n-grams of all its learned texts. A text goes to the language whose prototype has the largest
cosine with its vector.

Letters are lower-cased; anything else is a break between words, with a vector of its own, and runs of breaks count as one.

Vectors of texts are made in runs: the n-grams of a run are numbered from the commonest on, and their vectors, made STEP
at a time, are added up to the texts that have them, for common ones by a product of matrices, for rare ones pair by
pair. Both sums are whole numbers, exact up to 2**24 n-grams of a text. Memory is bounded by RUN_CHARS, RUN_TEXTS and STEP.

Fitting makes one vector for each language a run holds and adds up its components by language in the JVM. A text is learned if its
language is not null. The model holds DIMENSIONS numbers for each language, however many there are.

Defined results: a null text, or one without a letter, is `und` with score 0; without learned languages all
are; repeated rows come out alike; an empty table gives an empty result. A learned language whose texts hold no letter
is never predicted. Other columns stay, except those named like a result column, which are replaced. Ties go to the language
that comes first by code point.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

from .ngrams import owners, runs
from .shared import bounded, extended

DIMENSIONS = 2048
SEED = 7
#: Characters and texts that are worked on at once, and n-gram vectors that are held at once.
RUN_CHARS, RUN_TEXTS, STEP = 1 << 19, 512, 4096
#: A sum by matrices costs about this many times less for a pair of text and n-gram.
DENSE = 32
#: Languages whose sums a task holds before it passes them on.
HELD = 64
UNKNOWN = "und"


@cache
def _is_letter() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def trigrams(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of texts, their distinct n-grams (three code points of 21 bits, 0 for a break) and counts."""
    low = [f" {t.lower()} " for t in texts]
    points = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    of = owners([len(t) for t in low])
    code = np.where(_is_letter()[points], points, 0)
    start = np.empty(len(of), bool)
    start[:1], start[1:] = True, of[1:] != of[:-1]
    before = np.concatenate([[1], code[:-1]]) if len(code) else code
    keep = (code != 0) | (before != 0) | start
    of, code = of[keep], code[keep]
    gram = (code[:-2] << 42) | (code[1:-1] << 21) | code[2:]
    whole = (of[:-2] == of[2:]) & (gram != 0) if len(code) > 2 else np.zeros(0, bool)
    names, number = np.unique(gram[whole], return_inverse=True)
    both, counts = np.unique(of[:-2][whole].astype(np.int64) * max(len(names), 1) + number, return_counts=True)
    return (both // max(len(names), 1)).astype(np.int32), names[both % max(len(names), 1)] if len(names) else gram[:0], counts


def letter_vectors(points: np.ndarray) -> np.ndarray:
    """The signs of letters, from bits that a mixing function makes of code point and place."""
    words = points.astype(np.uint64)[:, None] * np.uint64(DIMENSIONS) + np.arange(DIMENSIONS // 64, dtype=np.uint64)
    words = (words + np.uint64(SEED)) * np.uint64(0x9E3779B97F4A7C15)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        words = (words ^ (words >> np.uint64(shift))) * np.uint64(factor)
    words ^= words >> np.uint64(31)
    return (np.unpackbits(words.view(np.uint8), axis=1).astype(np.int8) << 1) - 1


def gram_vectors(grams: np.ndarray) -> np.ndarray:
    """The bound vectors of n-grams."""
    points, place = np.unique(np.concatenate([grams >> 42, (grams >> 21) & 0x1FFFFF, grams & 0x1FFFFF]), return_inverse=True)
    letters = letter_vectors(points)
    first, second, third = np.split(place, 3)
    return np.roll(letters, 2, axis=1)[first] * np.roll(letters, 1, axis=1)[second] * letters[third]


def bundled(of: np.ndarray, gram: np.ndarray, n: np.ndarray, rows: int) -> np.ndarray:
    """A vector for each of so many rows: the sum of the vectors of its n-grams, n times each."""
    out = np.zeros((rows, DIMENSIONS), np.float64)
    names, number, common = np.unique(gram, return_inverse=True, return_counts=True)
    rank = np.empty(len(names), np.int64)
    rank[np.argsort(-common, kind="stable")] = np.arange(len(names))
    number = rank[number]
    order = np.lexsort((of, number // STEP))
    of, number, n = of[order], number[order], n[order].astype(np.float32)
    names = names[np.argsort(rank)]
    ends = np.searchsorted(number // STEP, np.arange(len(names) // STEP + 2))
    for i in range(0, len(names), STEP):
        a, b = ends[i // STEP], ends[i // STEP + 1]
        vectors = gram_vectors(names[i : i + STEP])
        if (b - a) * DENSE > rows * len(vectors):
            counts = np.zeros((rows, len(vectors)), np.float32)
            counts[of[a:b], number[a:b] - i] = n[a:b]
            out += counts @ vectors.astype(np.float32)
            continue
        for j in range(a, b, STEP):
            part = slice(j, min(j + STEP, b))
            first = np.flatnonzero(np.diff(of[part], prepend=-1))
            out[of[part][first]] += np.add.reduceat(vectors[number[part] - i] * n[part, None], first, axis=0)
    return out


@dataclass(frozen=True)
class Model:
    """Languages and their prototypes, of length 1 (0 for a language without letters)."""

    languages: list[str]
    prototypes: np.ndarray


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, place, n): the bundles of a task's languages, component by component."""
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        langs, texts = batch.column("lang").to_pylist(), batch.column("text").to_pylist()
        for a, b in runs(texts, RUN_CHARS, RUN_TEXTS):
            of, gram, n = trigrams(texts[a:b])
            names, which = np.unique(np.array(langs[a:b], object), return_inverse=True)
            vectors = bundled(*_merged(which[of], gram, n), len(names))
            for name, vector in zip(names, vectors.astype(np.int64), strict=True):
                sums[name] = sums.get(name, 0) + vector
            if len(sums) > HELD:
                yield _said(sums)
                sums = {}
    if sums:
        yield _said(sums)


def _said(sums: dict[str, np.ndarray]) -> pa.RecordBatch:
    place = pa.array(np.tile(np.arange(DIMENSIONS, dtype=np.int32), len(sums)))
    return pa.record_batch([pa.array(np.repeat(np.array(list(sums), object), DIMENSIONS), pa.string()), place, pa.array(np.concatenate(list(sums.values())))], names=["lang", "place", "n"])


def _merged(of: np.ndarray, gram: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts of equal (of, gram) added up."""
    order = np.lexsort((gram, of))
    of, gram, n = of[order], gram[order], n[order]
    first = np.flatnonzero((np.diff(of, prepend=-1) != 0) | (np.diff(gram, prepend=-1) != 0))
    return of[first], gram[first], np.add.reduceat(n, first) if len(first) else n


def fit(docs: DataFrame) -> Model:
    """Learns from all docs (text, lang) whose lang is not null."""
    learned = docs.select("lang", F.coalesce("text", F.lit("")).alias("text")).where("lang is not null")
    sums = bounded(learned).mapInArrow(_sums, "lang string, place int, n long").groupBy("lang", "place").agg(F.sum("n").alias("n"))
    # One row for each language and dimension, whatever the number of documents.
    found = sums.toArrow()
    languages, which = np.unique(np.array(found.column("lang").to_pylist(), object), return_inverse=True)
    prototypes = np.zeros((len(languages), DIMENSIONS))
    prototypes[which, found.column("place").to_numpy()] = found.column("n").to_numpy()
    prototypes /= np.maximum(np.linalg.norm(prototypes, axis=1, keepdims=True), 1)
    return Model([str(x) for x in languages], prototypes)


def predicted(texts: Sequence[str | None], model: Model) -> tuple[list[str], np.ndarray]:
    """Languages and cosines, cut to 0..1."""
    body = [t or "" for t in texts]
    lang, score = [UNKNOWN] * len(body), np.zeros(len(body))
    learned = model.prototypes.any(axis=1)
    if not learned.any():
        return lang, score
    for a, b in runs(body, RUN_CHARS, RUN_TEXTS):
        of, gram, n = trigrams(body[a:b])
        vectors = bundled(of, gram, n, b - a)
        cosine = np.where(learned, vectors @ model.prototypes.T / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1), -2)
        best = cosine.argmax(axis=1)
        for i in np.unique(of):
            lang[a + i] = model.languages[best[i]]
            score[a + i] = min(max(cosine[i, best[i]], 0.0), 1.0)
    return lang, score


def identify(docs: DataFrame, model: Model, *, text: str = "text", lang: str = "lang_pred", score: str = "lang_score") -> DataFrame:
    """Docs with the predicted language of every whole text, and its cosine."""

    def of(texts: list) -> list[pa.Array]:
        names, scores = predicted(texts, model)
        return [pa.array(names, pa.string()), pa.array(scores)]

    return extended(docs, text, [(lang, StringType()), (score, DoubleType())], of)
