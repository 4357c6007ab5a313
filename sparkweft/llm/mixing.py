"""Mixing sources to target weights by systematic sampling.

Every document of a source has the same expected number of copies, the source's target over its size.
Documents stand in a fixed order; the running sum of expected copies plus one offset per source crosses
integer boundaries, and a document is emitted once per boundary it crosses. The order is by hash bucket
and, inside a bucket, by size, so that neighbours have like sizes and the taken words stay near the target.

The running sum needs no task that sees a whole source: a source of n rows is dealt over about
sqrt(n) / 8 buckets; ranks inside a bucket and the counts of the buckets before it make the rank.

Only DataFrame functions run here.

Defined results: a null source is a source of its own and stands last; null and empty texts have size 0;
repeated rows count each; an empty table gives an empty result; other columns, whatever their names, are carried along by
`mixed`. Rows are repeated if they share doc_id, source and text; a null text is not the empty one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import WORD, free_prefix, own, small, written

WEIGHTS = (5, 2, 1)
MAX_REPEAT = 3
SEED = "mix"


def word_count(text: Column) -> Column:
    """Words of a text as long, 0 for null."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def _hex(text: Column, digits: int) -> Column:
    """The number that the first digits of the text's md5 spell; DuckDB gives the same."""
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("long")


def text_hash(text: Column) -> Column:
    """60 bits of a text; -1 for null."""
    return F.coalesce(_hex(text, 15), F.lit(-1).cast("long"))


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """(source, source_rows, source_size, target) from rows (source, size).

    Weights go round the sources in code-point order. Targets share the size of all rows by weight;
    none passes max_repeat times its source's size, and the excess goes to the others by weight.
    This levelling is solved in closed form over the sources by their cap per weight: the sources
    before the first that stays below its cap are capped, the rest share what is left.
    The windows here run over one row per source.
    """
    per = sizes.groupBy("source").agg(F.count(F.lit(1)).alias("source_rows"), F.sum("size").alias("source_size"))
    n = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    per = per.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (n % len(weights) + 1).cast("int")).cast("long"))
    per = per.withColumn("cap", F.col("source_size") * max_repeat)
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    every = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    per = per.select(
        "*",
        F.row_number().over(order).alias("at"),
        F.sum("source_size").over(every).alias("total"),
        F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("capped"),
        F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)).alias("weights"),
    )
    left, below = F.col("total") - F.col("capped"), F.col("weights")
    per = per.withColumn("stays", left * F.col("weight") <= F.col("cap") * below)
    first = F.struct("at", left.alias("left"), below.alias("share"))
    per = per.withColumn("first", F.min(F.when(F.col("stays"), first)).over(every))
    target = F.when(F.col("at") < F.col("first.at"), F.col("cap").cast("double")).otherwise(
        (F.col("first.left") * F.col("weight")).cast("double") / F.col("first.share")
    )
    return per.select("source", "source_rows", "source_size", target.alias("target"))


def _keyed(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source") -> list[Column]:
    return [
        F.col(doc_id).alias("doc_id"),
        F.col(source).alias("source"),
        word_count(F.col(text)).alias("size"),
        text_hash(F.col(text)).alias("text_hash"),
    ]


def sampling_plan(
    docs: DataFrame, *, weights: Sequence[int] = WEIGHTS, max_repeat: int = MAX_REPEAT, seed: str = SEED, text: str = "text", doc_id: str = "doc_id", source: str = "source"
) -> DataFrame:
    """One row per distinct (doc_id, source, text): size, rows (its repeated rows), before (rank of the rows
    before them), rate (expected copies), offset, source_size and target."""
    sizes = written(docs.select(*_keyed(docs, text, doc_id, source)), "mix-sizes")
    targets = small(source_targets(sizes, weights, max_repeat).withColumnRenamed("source", "of"), 64)
    rows = sizes.groupBy("doc_id", "source", "size", "text_hash").agg(F.count(F.lit(1)).alias("rows"))
    rows = rows.join(targets, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    buckets = F.ceil(F.sqrt(F.col("source_rows").cast("double")) / 8)
    # The text counts in the draw too, so that rows of one id, or of none, are dealt over all buckets of their source.
    draw = _hex(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("text_hash").cast("string")), 8)
    rows = written(rows.withColumn("bucket", draw % buckets), "mix-rows")
    # Each task's sums meet here: one row per source and bucket.
    counts = rows.groupBy("source", "bucket").agg(F.sum("rows").alias("bucket_rows"))
    ahead = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(F.col("source").alias("of"), F.col("bucket").alias("at"), F.coalesce(F.sum("bucket_rows").over(ahead), F.lit(0)).alias("ahead"))
    inside = Window.partitionBy("source", "bucket").orderBy("size", F.col("doc_id").asc_nulls_last(), "text_hash").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("upto", F.sum("rows").over(inside))
    rows = rows.join(small(counts, 64), F.col("source").eqNullSafe(F.col("of")) & (F.col("bucket") == F.col("at")))
    return rows.select(
        "doc_id", "source", "size", "text_hash", "rows", "source_size", "target",
        (F.col("ahead") + F.col("upto") - F.col("rows")).alias("before"),
        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)).alias("rate"),
        (_hex(F.concat(F.lit(f"{seed}:source:"), F.coalesce(F.col("source"), F.lit(""))), 4) / 65536.0).alias("offset"),
    )


def crossed(first: Column, last: Column, rate: Column, offset: Column) -> Column:
    """Integer boundaries between the running sums at two ranks."""
    return F.floor(last * rate + offset) - F.floor(first * rate + offset)


def sampled(plan: DataFrame) -> DataFrame:
    """The plan with a row for each input row and its number of copies."""
    rows = plan.withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
    first = F.col("before") + F.col("nth") - 1
    return rows.withColumn("copies", F.least(crossed(first, first + 1, F.col("rate"), F.col("offset")), F.ceil("rate")))


def mixed(docs: DataFrame, *, weights: Sequence[int] = WEIGHTS, max_repeat: int = MAX_REPEAT, seed: str = SEED) -> DataFrame:
    """The mix itself: docs' own columns, each document as often as the sample takes it.

    Repeated rows share their copies; of them, that whose JSON comes first stands for all.
    """
    p, columns = free_prefix(docs), own(docs)
    plan = sampling_plan(docs, weights=weights, max_repeat=max_repeat, seed=seed)
    total = crossed(F.col("before"), F.col("before") + F.col("rows"), F.col("rate"), F.col("offset"))
    total = F.least(total, F.col("rows") * F.ceil("rate"))
    plan = plan.select(*(F.col(c).alias(p + c) for c in ("doc_id", "source", "text_hash", "rows")), total.alias(p + "total")).where(F.col(p + "total") > 0)
    on = F.col("doc_id").eqNullSafe(F.col(p + "doc_id")) & F.col("source").eqNullSafe(F.col(p + "source")) & (text_hash(F.col("text")) == F.col(p + "text_hash"))
    both = docs.join(plan, on)
    single = both.where(F.col(p + "rows") == 1).select(*columns, p + "total")
    # Groups of repeated rows: one row of each, with the copies of all.
    row = F.struct(*columns)
    several = both.where(F.col(p + "rows") > 1).groupBy(p + "doc_id", p + "source", p + "text_hash").agg(F.min_by(row, F.to_json(row)).alias(p + "row"), F.first(p + "total").alias(p + "total"))
    several = several.select(f"{p}row.*", p + "total")
    return single.union(several).withColumn(p + "nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col(p + "total")))).select(*columns)
