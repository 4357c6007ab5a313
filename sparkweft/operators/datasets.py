"""Labelled samples: ids, conflicts, distributions, pairs and pair-preserving splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.samples import good_bad
from ..tables import written


def dataset_type(columns: Sequence[str]) -> str:
    """By the columns that are there: juliet before secvaleval before unknown."""
    if {"testcases_name", "whole_program_body"} & set(columns):
        return "juliet"
    return "secvaleval" if {"func_body", "hash"} & set(columns) else "unknown"


def sample_id(kind: str, idx: Column, columns: Sequence[str]) -> Column:
    """The id of a sample of a dataset type, given its running number or own idx."""
    text = idx.cast("string")
    if kind == "juliet":
        name = F.coalesce(F.col("testcases_name").cast("string"), F.lit("None")) if "testcases_name" in columns else F.concat(F.lit("unknown_"), text)
        path = F.col("program_path") if "program_path" in columns else F.lit("")
        return F.concat(name, F.lit("_"), good_bad(path))
    if kind == "secvaleval":
        return F.concat(text, F.lit("_"), F.coalesce(F.col("hash").cast("string"), F.lit("None")) if "hash" in columns else F.lit("unknown"))
    return F.concat(F.lit("unknown_"), text)


def normalised(samples: DataFrame, dataset_name: str, order: Sequence[str] = ("file", "row_index")) -> DataFrame:
    """Samples of either schema in one: the defaults stand where a column is missing, not where a value is null.

    samples: any columns, with `split`, and with the columns of order where there is no idx of its own: idx then is
    the row's number inside its split.
    """
    have = samples.columns
    out = samples.withColumn("dataset_name", F.lit(dataset_name)).withColumn("dataset_type", F.lit(dataset_type(have)))
    if "func_body" not in have and "whole_program_body" in have:
        out = out.withColumn("func_body", F.col("whole_program_body")).withColumn("func_name", F.col("testcases_name") if "testcases_name" in have else F.lit("unknown"))
    for name, value in (("func_body", ""), ("func_name", "unknown"), ("hash", ""), ("program_path", ""), ("is_vulnerable", False)):
        if name not in out.columns:
            out = out.withColumn(name, F.lit(value))
    if "idx" not in have:
        # The number inside the split is the place in (split, order) less the split's first place: no task numbers a whole split.
        placed = ranked(out, [F.col("split"), *(F.col(c) for c in order)], "_place")
        firsts = placed.groupBy(F.col("split").alias("_split")).agg(F.min("_place").alias("_first"))  # a row a split
        out = placed.join(F.broadcast(firsts), F.col("split").eqNullSafe(F.col("_split"))).withColumn("idx", F.col("_place") - F.col("_first")).drop("_place", "_first", "_split")
    kind = dataset_type(have)
    return out.withColumn("sample_id", sample_id(kind, F.col("idx"), [*have, "hash"] if kind == "secvaleval" else have))


def numbered(df: DataFrame, groups: Sequence[str], order: Sequence[Column]) -> Column:
    """A row's number inside its group, from 0."""
    return (F.row_number().over(Window.partitionBy(*groups).orderBy(*order)) - 1).cast("long")


def conflicts(samples: DataFrame, order: Sequence[Column]) -> DataFrame:
    """(sample_id, positions) of ids that occur twice or more; positions count all samples in order.

    Positions are taken of the conflicting samples alone: a sample's is the number of samples before it, summed
    over ranges of the order and inside its range.
    """
    place = ranked(samples, order, "position")
    many = samples.groupBy("sample_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("sample_id")
    return place.join(many, "sample_id", "left_semi").groupBy("sample_id").agg(F.sort_array(F.collect_list("position")).alias("positions"))


def ranked(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """df with its rows' places in a total order, from 0, without a task that sees all rows.

    Rows are dealt into sorted ranges; a row's place is its number in its range plus the sizes of the ranges
    before. Ties are broken by all columns' hash, so equal rows alone can change places.
    """
    keys = [*order, F.xxhash64(*[F.col(c) for c in df.columns])]
    ranges = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_range", F.spark_partition_id()).withColumn("_id", F.monotonically_increasing_id())
    ranges = written(ranges.withColumn("_in", F.col("_id") - F.shiftleft(F.col("_range").cast("long"), 33)).drop("_id"), "ranges")  # both uses see one set of ranges, whatever executors are lost
    sizes = ranges.groupBy("_range").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.select("_range", F.coalesce(F.sum("n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))  # a row a range
    return ranges.join(F.broadcast(before), "_range").withColumn(name, F.col("_before") + F.col("_in")).drop("_range", "_in", "_before")


def first_samples(samples: DataFrame, splits: Sequence[str], most: int | None, order: Sequence[str] = ("idx",)) -> DataFrame:
    """The samples of the splits in the given order, at most so many in all; 0 or None for no limit."""
    place = F.array_position(F.array(*map(F.lit, splits)), F.col("split"))
    chosen = samples.where(F.col("split").isin(list(splits)))
    if not most:
        return chosen
    return ranked(chosen, [place, *map(F.col, order)], "_place").where(F.col("_place") < most).drop("_place")


def first_of_id(samples: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Samples with `again`: true for all but the first of an id, which a run skips."""
    return samples.withColumn("again", F.row_number().over(Window.partitionBy("sample_id").orderBy(*order)) > 1)


def with_label(samples: DataFrame, label: str, column: str = "cwe_list") -> DataFrame:
    """The samples that carry a label."""
    return samples.where(F.array_contains(column, label))


def label_distribution(samples: DataFrame) -> DataFrame:
    """(CWE_ID, num_functions), most first."""
    return samples.select(F.explode("cwe_list").alias("CWE_ID")).groupBy("CWE_ID").agg(F.count(F.lit(1)).alias("num_functions")).orderBy(F.desc("num_functions"), "CWE_ID")


def project_distribution(samples: DataFrame) -> DataFrame:
    """(project, num_functions, CWE_ID), most first inside a label."""
    each = samples.select("project", F.explode("cwe_list").alias("CWE_ID")).groupBy("CWE_ID", "project").agg(F.count(F.lit(1)).alias("num_functions"))
    return each.select("project", "num_functions", "CWE_ID").orderBy("CWE_ID", F.desc("num_functions"), "project")


def uniques(samples: DataFrame) -> DataFrame:
    """(CWE_ID, unique_projects, unique_repositories) by label, and `ALL` for all together."""
    each = samples.select("project", F.explode("cwe_list").alias("CWE_ID"))
    n = F.countDistinct("project")
    rolled = each.rollup("CWE_ID").agg(F.grouping_id().alias("g"), n.alias("unique_projects"), n.alias("unique_repositories"))
    return rolled.select(F.when(F.col("g") == 1, "ALL").otherwise(F.col("CWE_ID")).alias("CWE_ID"), "unique_projects", "unique_repositories")


def subset_summary(samples: DataFrame, labels: Sequence[str]) -> DataFrame:
    """(CWE_ID, total) for the named labels."""
    return samples.select(F.explode("cwe_list").alias("CWE_ID")).where(F.col("CWE_ID").isin(list(labels))).groupBy("CWE_ID").agg(F.count(F.lit(1)).alias("total"))


def function_groups(samples: DataFrame) -> DataFrame:
    """Samples with `group` and `kind`: a vulnerable function and its fix are a pair, any other sample is single.

    A pair is a row whose fixed_func_idx names another row; its group is the smaller idx of the two.
    """
    fixes = samples.select(F.col("idx").alias("_idx")).distinct()
    refers = samples.where(F.col("fixed_func_idx").isNotNull() & (F.col("fixed_func_idx") != F.col("idx"))).select("idx", "fixed_func_idx").join(fixes, F.col("fixed_func_idx") == F.col("_idx"), "left_semi")
    both = refers.select("idx", F.least("idx", "fixed_func_idx").alias("group")).union(refers.select(F.col("fixed_func_idx").alias("idx"), F.least("idx", "fixed_func_idx").alias("group")))
    pairs = both.groupBy("idx").agg(F.min("group").alias("_group"))
    out = samples.join(pairs, "idx", "left")
    return out.withColumn("group", F.coalesce("_group", "idx")).withColumn("kind", F.when(F.col("_group").isNotNull(), "pair").otherwise("single")).drop("_group")


def test_case_groups(samples: DataFrame) -> DataFrame:
    """Samples with `group`: the variants of one test case."""
    return samples.withColumn("group", F.col("testcases_name"))


def pair_split(samples: DataFrame, ratios: Sequence[float] = (0.70, 0.15), seed: str = "42") -> DataFrame:
    """Samples (with `group`) with `split`: groups stay together, train and validation take the floor of their ratio of groups.

    Groups go by md5 of seed and name, so the split doesn't depend on partitions. A group's place in this order is
    counted over buckets of the hash and inside its bucket; no task orders all groups.
    """
    groups = samples.select(F.col("group").alias("_g")).distinct()
    return samples.join(_cut(groups, ratios, seed), F.col("group") == F.col("_g")).drop("_g")


def _cut(groups: DataFrame, ratios: Sequence[float], seed: str) -> DataFrame:
    rank = F.md5(F.concat(F.lit(f"{seed}|"), F.col("_g").cast("string")))
    keyed = groups.withColumn("_h", rank).withColumn("_b", F.substring("_h", 1, 3))
    sizes = keyed.groupBy("_b").agg(F.count(F.lit(1)).alias("n"))  # 4096 rows at most
    ahead = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(F.col("_b").alias("_bucket"), F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("_before"), F.sum("n").over(Window.partitionBy()).alias("_n"))
    place = keyed.join(F.broadcast(sizes), F.col("_b") == F.col("_bucket")).withColumn("_at", F.col("_before") + F.row_number().over(Window.partitionBy("_b").orderBy("_h", "_g")) - 1)
    train, validation = (F.floor(F.col("_n") * F.lit(r)) for r in ratios)
    split = F.when(F.col("_at") < train, "train").when(F.col("_at") < train + validation, "validation").otherwise("test")
    return place.select("_g", split.alias("split"))


def grouped_split(samples: DataFrame, ratios: Sequence[float] = (0.7, 0.1), seed: str = "42") -> DataFrame:
    """As pair_split for samples with `group` and `kind`: pairs and singles are cut each for themselves, so both keep the ratios."""
    out = None
    for kind in ("pair", "single"):
        part = pair_split(samples.where(F.col("kind") == kind), ratios, seed)
        out = part if out is None else out.unionByName(part)
    return out


def split_summary(samples: DataFrame) -> DataFrame:
    """(CWE_ID, total, train, validation, test, num_pair_groups, num_single_groups) of samples (CWE_ID, split, group, kind)."""
    part = lambda s: F.count_if(F.col("split") == s).alias(s)
    kinds = lambda k: F.countDistinct(F.when(F.col("kind") == k, F.col("group"))).alias(f"num_{k}_groups")
    return samples.groupBy("CWE_ID").agg(F.count(F.lit(1)).alias("total"), part("train"), part("validation"), part("test"), kinds("pair"), kinds("single"))
