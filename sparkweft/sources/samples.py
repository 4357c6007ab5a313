"""Datasets of labelled samples: <dataset>/split/<name>/*.arrow or *.parquet."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .arrow_files import read_arrow

log = logging.getLogger(__name__)


def _listed(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, folders with a slash; none if it isn't there. Listed by the file system that Spark uses."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(folder):
        return []
    return sorted(s.getPath().getName() + "/" * s.isDirectory() for s in system.listStatus(folder))


def splits(spark: SparkSession, dataset: str) -> list[str]:
    """The splits of a dataset by name; `train` if it has no folder of splits."""
    found = _listed(spark, dataset)
    return [x[:-1] for x in _listed(spark, f"{dataset}/split") if x.endswith("/")] if "split/" in found else ["train"]


def read_split(spark: SparkSession, dataset: str, split: str) -> DataFrame | None:
    """The samples of a split with file and row_index, or None with a warning if it is missing or empty."""
    folder = f"{dataset}/split/{split}"
    names = _listed(spark, folder)
    if any(n.endswith(".arrow") for n in names):
        return read_arrow(spark, folder).withColumn("split", F.lit(split))
    if any(n.endswith(".parquet") for n in names):
        rows = spark.read.parquet(f"{folder}/*.parquet")
        return rows.select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row_index")).withColumn("split", F.lit(split))
    log.warning("no data for split %s in %s", split, folder)
    return None


def read_dataset(spark: SparkSession, dataset: str, names: Sequence[str]) -> DataFrame | None:
    """The named splits one after the other; repeated names repeat their rows. None if there is nothing."""
    out = None
    for name in names:
        part = read_split(spark, dataset, name)
        if part is not None:
            out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out
