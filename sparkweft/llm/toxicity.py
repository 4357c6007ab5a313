"""Toxicity by a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

A document is the set of the character n-grams (SIZES) of its lower-cased text, each numbered by a hash among 2**BITS. Fitting
takes a bounded sample of labelled rows: at most `per_class` of each label in the order of a hash of their ids, and of these the first
whose texts have `sample_chars` characters in all, half for each label. Over the sample every n-gram gets its log-count ratio,
toxic against clean, smoothed towards none and shrunk by z^2 / (z^2 + DOUBT^2) where it is z standard errors from 0. A logistic regression with an
L2 penalty is trained on presence times ratio, over all n-grams, by stochastic dual ascent. The intercept is moved
from the sample's share of toxic rows to that of all labelled rows. Scoring reads whole texts, in runs of bounded
memory; weight times ratio is one table.

Defined results: null text counts as empty; an empty text has the n-grams of blanks only; repeated rows
score alike; an empty table gives an empty result. Labels of null, or of a null doc_id, teach nothing, nor do those of a
doc_id labelled both ways; a label said twice counts once. Of several texts of one doc_id the first by code point is learned from. Without
labels of both kinds the model is the share of toxic rows (0.5 if there are none). Other columns
stay, except those named like a result column, which are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from .ngrams import character_sets, runs
from .shared import bounded, extended, written

BITS = 20
SIZES = (3, 4, 5)
#: Bounds of the sample: rows of each label, and characters in all.
PER_CLASS = 2048
SAMPLE_CHARS = 1 << 24
DOUBT = 5.0
RIDGE = 1e-4
ROUNDS = 30


@dataclass(frozen=True)
class Model:
    """The weight of each numbered n-gram (classifier weight times ratio), and the intercept."""

    weights: np.ndarray
    intercept: float


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, toxic, grams): the numbers of a text's n-grams, rising."""
    for batch in batches:
        texts = batch.column("text").to_pylist()
        for a, b in runs(texts):
            of, gram = character_sets(texts[a:b], SIZES, BITS)
            ends = np.searchsorted(of, np.arange(b - a + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("key").slice(a, b - a), batch.column("toxic").slice(a, b - a), pa.ListArray.from_arrays(pa.array(ends), pa.array(gram))], names=["key", "toxic", "grams"])


def log_count_ratios(clean: np.ndarray, toxic: np.ndarray, n_clean: int, n_toxic: int, doubt: float) -> np.ndarray:
    """For each n-gram, from the numbers of clean and toxic documents that have it. One that no document has gets 0."""
    share = n_toxic / (n_clean + n_toxic)
    ratio = np.log((toxic + 2 * share) / n_toxic) - np.log((clean + 2 * (1 - share)) / n_clean)
    square = ratio**2 / (1 / (toxic + 1) + 1 / (clean + 1))
    return (ratio * square / (square + doubt**2)).astype(np.float32)


def trained(rows: list[np.ndarray], label: np.ndarray, ratio: np.ndarray, ridge: float, rounds: int) -> tuple[np.ndarray, float]:
    """Weights and intercept of the logistic regression on presence times ratio, by steps on one row's dual variable at a time."""
    n, weights, intercept = len(rows), np.zeros(len(ratio)), 0.0
    sign, dual, draw = np.where(label == 1, 1.0, -1.0), np.zeros(n), np.random.default_rng(3)
    size = np.array([float((ratio[x].astype(np.float64) ** 2).sum()) + 1 for x in rows])
    for _ in range(rounds):
        moved = 0.0
        for i in draw.permutation(n):
            x = ratio[rows[i]]
            margin = sign[i] * (float(weights[rows[i]] @ x) + intercept)
            step = (1 / (1 + np.exp(min(margin, 60.0))) - dual[i]) / max(1.0, 0.25 + size[i] / (ridge * n))
            dual[i] += step
            move = step * sign[i] / (ridge * n)
            weights[rows[i]] += move * x
            intercept += move
            moved += abs(step)
        if moved < 1e-3 * n:
            break
    return weights, intercept


def fit(docs: DataFrame, labels: DataFrame, *, per_class: int = PER_CLASS, sample_chars: int = SAMPLE_CHARS, doubt: float = DOUBT, ridge: float = RIDGE, rounds: int = ROUNDS) -> Model:
    """Learns from labels (doc_id, toxic 0 or 1) of docs (doc_id, text). The driver sees the sample's n-grams only."""
    labels = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where("doc_id is not null and toxic in (0, 1)")
    labels = labels.groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most")).where("toxic = most").drop("most")
    labels = written(labels.withColumn("key", F.xxhash64("doc_id")), "toxic-labels")
    share = {r["toxic"]: r["n"] for r in labels.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    none, clean, toxic = np.zeros(1 << BITS, np.float32), share.get(0, 0), share.get(1, 0)
    if not clean or not toxic:
        p = (toxic + 0.5) / (clean + toxic + 1)
        return Model(none, float(np.log(p / (1 - p))))
    prior = float(np.log(toxic / clean))
    chosen = [labels.where(F.col("toxic") == y).orderBy("key", "doc_id").limit(per_class) for y in (0, 1)]
    ids = chosen[0].union(chosen[1])
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(written(ids, "toxic-ids")), "doc_id")  # at most 2 * per_class ids
    sample = written(rows.groupBy("doc_id", "key", "toxic").agg(F.min("text").alias("text")), "toxic-sample")
    kept, held = [], {0: 0, 1: 0}
    for r in sample.select("key", "toxic", F.length("text").alias("n")).orderBy("key").collect():  # at most 2 * per_class rows
        if held[r["toxic"]] == 0 or held[r["toxic"]] + r["n"] <= sample_chars // 2:
            kept.append(r["key"])
            held[r["toxic"]] += r["n"] + 1
    found = bounded(sample.where(F.col("key").isin(kept))).mapInArrow(_sets, "key long, toxic int, grams array<int>").toArrow()
    order = np.lexsort((found.column("key").to_numpy(), found.column("toxic").to_numpy()))
    label = found.column("toxic").to_numpy()[order]
    whole = found.column("grams").combine_chunks()
    flat, ends = whole.flatten().to_numpy(), np.concatenate([[0], np.cumsum(whole.value_lengths().to_numpy())])
    sets = [flat[ends[i] : ends[i + 1]] for i in order]
    n1 = int(label.sum())
    n0 = len(label) - n1
    if not n0 or not n1:
        return Model(none, prior)
    count = [np.zeros(1 << BITS, np.int64), np.zeros(1 << BITS, np.int64)]
    for own, y in zip(sets, label.tolist(), strict=True):
        count[y][own] += 1
    ratio = log_count_ratios(count[0], count[1], n0, n1, doubt)
    weights, intercept = trained(sets, label, ratio, ridge, rounds)
    return Model((weights * ratio).astype(np.float32), intercept + prior - float(np.log(n1 / n0)))


def score(docs: DataFrame, model: Model, *, text: str = "text", output: str = "score") -> DataFrame:
    """Docs with the score of every whole text."""

    def of(texts: list) -> list[pa.Array]:
        texts = [t or "" for t in texts]
        total = np.zeros(len(texts))
        for a, b in runs(texts):
            doc, gram = character_sets(texts[a:b], SIZES, BITS, model.weights)
            total[a:b] = np.bincount(doc, model.weights[gram], minlength=b - a)
        return [pa.array(_sigmoid(total + model.intercept))]

    return extended(docs, text, [(output, DoubleType())], of)
