"""Best-fit packing of tokenized documents into sequences of a fixed capacity, with large-item matching.

Only the lengths of pieces decide where they go, and there are at most `capacity` distinct lengths. So
packing works on the counts by length, on the driver, whatever the number of documents: it makes classes
of sequences that hold the same lengths, each class with a count. Pieces above one third of the capacity
are at most two to a sequence and are matched greedily, the longest with the longest that still fits;
the shorter ones, longest first, go to the tightest gap that takes them, or open new sequences.
Each step fills up a class or uses up a length, so there are a few thousand classes at most.

The n-th piece of a length then takes that length's n-th place. A piece's number among those of its
length needs no shuffle of pieces: tokenizing tasks number their own, and the sums of the tasks before
are added. Pieces are written before, so a lost executor cannot renumber them.

Tokens are those of the `tokenizers` library for the vocabulary file. Where the file's companion with ranks
(same name, ending .tiktoken) is there and the vocabulary has no normalizer and only plain added tokens, `tiktoken`
computes the same ids of every text faster, added tokens' strings included; otherwise `tokenizers` does.

Defined results: null text counts as empty and gives one piece, the end token; repeated rows are packed
each; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import bisect
import os
import zlib
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import bounded, small, written

CAPACITY = 2048
END = 0


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@cache
def encoder(path: str) -> Callable[[str], list[int]]:
    """The ids of a text, without special tokens added."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(path)
    plain = lambda text: slow.encode(text, add_special_tokens=False).ids
    ranks = path.removesuffix(".json") + ".tiktoken"
    added = slow.get_added_tokens_decoder()
    if not os.path.exists(ranks) or slow.normalizer is not None or any(t.single_word or t.lstrip or t.rstrip or t.normalized for t in added.values()):
        return plain
    import public_tokenizers
    import tiktoken

    with open(ranks, "rb") as lines:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    fast = tiktoken.Encoding(os.path.basename(path), pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={t.content: n for n, t in added.items()})
    return lambda text: fast.encode(text, allowed_special="all")


def cuts(length: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: all full but the first, which takes what is over."""
    first = length % capacity or capacity
    return [(0, min(first, length)), *((s, capacity) for s in range(first, length, capacity))]


def pieces(docs: DataFrame, *, capacity: int = CAPACITY, vocabulary: str | None = None, keep_ids: bool = False) -> DataFrame:
    """Rows (doc_id, piece, start, length, ids_crc32[, ids], task, nth); nth counts a task's earlier pieces of the length."""
    path = vocabulary or default_vocabulary()
    kind = docs.schema["doc_id"].dataType.simpleString()
    fields = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, " + "ids array<int>, " * keep_ids + "task int, nth long"

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, task = encoder(path), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            names, texts = batch.column("doc_id"), batch.column("text").to_pylist()
            row, cols, ids, held = [], ([], [], [], [], []), [], 0

            def out(row=None, cols=None, ids=None, names=names):
                piece, start, length, crc, nth = cols
                arrays = [names.take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                if keep_ids:
                    ends = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
                    arrays.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(ids), pa.int32())))
                arrays += [pa.array([task] * len(row), pa.int32()), pa.array(nth, pa.int64())]
                return pa.RecordBatch.from_arrays(arrays, names=[x.split()[0] for x in fields.split(", ")])

            for at, text in enumerate(texts):
                tokens = np.array([*encode(text or ""), END], "<u4")
                for n, (start, length) in enumerate(cuts(len(tokens), capacity)):
                    part = tokens[start : start + length]
                    row.append(at)
                    for c, v in zip(cols, (n, start, length, zlib.crc32(part.tobytes()), int(seen[length])), strict=True):
                        c.append(v)
                    seen[length] += 1
                    if keep_ids:
                        ids.append(part.astype(np.int32))
                    held += length
                if held > 1 << 20:
                    yield out(row, cols, ids)
                    row, cols, ids, held = [], ([], [], [], [], []), [], 0
            if row:
                yield out(row, cols, ids)

    return bounded(docs.select("doc_id", "text")).mapInArrow(go, fields)


def packing(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[tuple[int, int]]]]:
    """Classes (number of sequences, [(length, how many in a row)]) that hold counts[length] pieces of each length."""
    left = {n: c for n, c in counts.items() if c > 0}
    done: list[tuple[int, list[tuple[int, int]]]] = []
    gaps: list[int] = []  # the distinct gaps, rising
    open_: dict[int, list[tuple[int, list[tuple[int, int]]]]] = {}

    def put(gap: int, many: int, holds: list[tuple[int, int]]) -> None:
        if many and gap:
            if gap not in open_:
                bisect.insort(gaps, gap)
                open_[gap] = []
            open_[gap].append((many, holds))
        elif many:
            done.append((many, holds))

    large = sorted(n for n in left if 3 * n > capacity)
    while large:
        n = large[-1]
        fit = bisect.bisect_right(large, capacity - n) - 1
        if fit < 0:
            put(capacity - n, left.pop(n), [(n, 1)])
            large.pop()
            continue
        m = large[fit]
        if m == n:
            put(capacity - 2 * n, left[n] // 2, [(n, 2)])
            left[n] %= 2
            if left[n]:  # it is the longest left, and no shorter one is there to be preferred
                rest = large[:-1]
                if rest:
                    m = rest[-1]
                    put(capacity - n - m, 1, [(n, 1), (m, 1)])
                    left[m] -= 1
                    if not left[m]:
                        large.remove(m)
                        del left[m]
                else:
                    put(capacity - n, 1, [(n, 1)])
            del left[n]
            large.remove(n)
            continue
        pairs = min(left[n], left[m])
        put(capacity - n - m, pairs, [(n, 1), (m, 1)])
        for x in (n, m):
            left[x] -= pairs
            if not left[x]:
                large.remove(x)
                del left[x]
    for n in sorted(left, reverse=True):
        todo = left[n]
        while todo:
            at = bisect.bisect_left(gaps, n)
            gap = gaps[at] if at < len(gaps) else capacity
            each = gap // n
            if at < len(gaps):
                many, holds = open_[gap].pop()
                if not open_[gap]:
                    del open_[gap], gaps[at]
            else:
                many, holds = -(-todo // each), []
            full = min(many, todo // each)
            put(gap - each * n, full, [*holds, (n, each)])
            todo -= full * each
            if full < many:
                over = min(todo, each)
                if over:
                    put(gap - over * n, 1, [*holds, (n, over)])
                    todo -= over
                put(gap, many - full - bool(over), holds)
    return done + [x for g in gaps for x in open_[g]]


def places(classes: list[tuple[int, list[tuple[int, int]]]]) -> np.ndarray:
    """Rows (length, first number, number after the last, in a row, first sequence, offset): where the pieces of a length go, in order of number."""
    taken: dict[int, int] = {}
    out, sequence = [], 0
    for many, holds in classes:
        offset = 0
        for length, each in holds:
            first = taken.get(length, 0)
            taken[length] = first + many * each
            out.append((length, first, taken[length], each, sequence, offset))
            offset += length * each
        sequence += many
    return np.array(sorted(out), np.int64).reshape(-1, 6)


def packed(docs: DataFrame, *, capacity: int = CAPACITY, vocabulary: str | None = None, keep_ids: bool = False) -> DataFrame:
    """All pieces of docs (doc_id, text) with sequence_id and offset; with keep_ids, their token ids."""
    cut = written(pieces(docs, capacity=capacity, vocabulary=vocabulary, keep_ids=keep_ids), "pack-pieces")
    by_task = cut.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n"))
    ahead = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = by_task.select(F.col("task").alias("_task"), F.col("length").alias("_length"), F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("before"))
    counts = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most capacity rows
    table = places(packing(counts, capacity))
    runs = docs.sparkSession.createDataFrame(pa.table(dict(zip(("_len", "first", "until", "each", "sequence", "at"), table.T, strict=True))))
    numbered = cut.join(small(before, 32), (F.col("task") == F.col("_task")) & (F.col("length") == F.col("_length"))).withColumn("number", F.col("before") + F.col("nth")).drop("_task", "_length", "task", "nth", "before")
    # A few thousand runs, as capacity bounds them: a piece's run is the one of its length that its number lies in.
    found = numbered.join(F.broadcast(runs), (F.col("length") == F.col("_len")) & (F.col("number") >= F.col("first")) & (F.col("number") < F.col("until")))
    past = F.col("number") - F.col("first")
    kept = [c for c in numbered.columns if c != "number"]
    sequence, offset = F.col("sequence") + F.expr("(number - first) div each"), F.col("at") + past % F.col("each") * F.col("length")
    return found.select(*kept, sequence.alias("sequence_id"), offset.alias("offset"))
