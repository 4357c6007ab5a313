"""Graph documents as they arrive in a folder: each micro-batch goes through the same operators as a batch run.

Parsing and the subgraphs work on each document by itself, so a stream needs no state and no watermark; what a
batch makes is appended once, by the query's checkpoint.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import graph, parse, render


def arriving(spark: SparkSession, folder: str, pattern: str = "*.dot", files: int = 1000) -> DataFrame:
    """A stream of (graph_id, dot), a row a file; at most so many files a batch."""
    rows = spark.readStream.format("text").schema("value string").option("wholetext", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).option("maxFilesPerTrigger", files).load(folder)
    return rows.select(F.col("_metadata.file_path").alias("graph_id"), F.col("value").alias("dot"))


def edge_stream(documents: DataFrame, types: Sequence[str] | None = None) -> DataFrame:
    """Edges of streamed documents, as a stream."""
    return parse.edges(documents, types)


def process_arriving(documents: DataFrame, output: str, checkpoint: str, types: Sequence[str] = graph.TYPES, once: bool = False) -> StreamingQuery:
    """Appends the subgraphs, and those of user-defined methods, of arriving documents to output/subgraphs and output/filtered.

    Rows carry their batch, and a batch that is run again replaces what it wrote before. With once, what is there is
    worked off and the query ends.
    """

    def batch(rows: DataFrame, number: int) -> None:
        rows = rows.persist()
        edges, nodes, _ = graph.subgraph(rows, types)
        sub = render.subgraph_text(rows, edges, nodes, types).persist()
        defined, kept, _ = graph.user_subgraph(sub)
        for name, frame in (("subgraphs", sub), ("filtered", render.user_subgraph_text(sub, kept, defined))):
            frame.write.mode("overwrite").parquet(f"{output}/{name}/batch={number}")
        sub.unpersist()
        rows.unpersist()

    writer = documents.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
