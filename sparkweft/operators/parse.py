"""Documents (graph_id, dot) to edges and nodes.

Edges: (graph_id, ord, src, dst, etype, line). Nodes: (graph_id, ord, node_id, raw). ord is the place in the
document; nothing relies on the order of a frame. Edge lines count wherever they stand, also inside the
text of a node.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dot as D
from ..functions.text import lines_of, stripped


def edges(documents: DataFrame, types: Sequence[str] | None = None) -> DataFrame:
    """All edges, or those of the given types; line is the line as it stands."""
    lines = documents.select("graph_id", F.posexplode(F.split(lines_of(F.col("dot")), "\n", -1)).alias("ord", "line"))
    found = lines.where(F.contains("line", F.lit("->"))).withColumn("_s", stripped(F.col("line"))).where(F.col("_s").rlike(D.EDGE))
    part = lambda n: F.regexp_extract("_s", D.EDGE, n)
    out = found.select("graph_id", "ord", part(1).alias("src"), part(2).alias("dst"), part(3).alias("etype"), "line")
    return out.where(F.col("etype").isin(list(types))) if types is not None else out


def nodes(documents: DataFrame) -> DataFrame:
    """All node blocks, repeated ids included; nothing inside a block opens another."""
    blocks = F.regexp_extract_all(lines_of(F.col("dot")), F.lit(D.NODE), F.lit(0))
    return documents.select("graph_id", F.posexplode(blocks).alias("ord", "raw")).select("graph_id", "ord", F.regexp_extract("raw", D.NODE_ID, 1).alias("node_id"), "raw")


def last_definitions(found: DataFrame) -> DataFrame:
    """One row a node id: the last block that defines it."""
    last = F.row_number().over(Window.partitionBy("graph_id", "node_id").orderBy(F.desc("ord")))
    return found.withColumn("_n", last).where("_n = 1").drop("_n")


def outside_edges(documents: DataFrame) -> DataFrame:
    """Edges with their attribute text, from lines outside node blocks only: (graph_id, ord, src, dst, attributes)."""
    rest = F.regexp_replace(lines_of(F.col("dot")), D.NODE, "")
    lines = documents.select("graph_id", F.posexplode(F.split(rest, "\n", -1)).alias("ord", "line")).withColumn("_s", stripped(F.col("line")))
    part = lambda n: F.regexp_extract("_s", D.EDGE_ATTRIBUTES, n)
    return lines.where(F.col("_s").rlike(D.EDGE_ATTRIBUTES)).select("graph_id", "ord", part(1).alias("src"), part(2).alias("dst"), part(3).alias("attributes"))


def target_nodes(documents: DataFrame, targets: DataFrame) -> DataFrame:
    """Node blocks of wanted ids, where blocks of other ids are not skipped: a wanted id that opens inside one of them counts.

    targets: (graph_id, node_id). Scans text by Arrow batches, as what it skips depends on the ids.
    """
    import re

    opens = re.compile(r'\s*"([^"\n]+)"\s*\[')
    wanted = targets.groupBy(F.col("graph_id").alias("_g")).agg(F.collect_set("node_id").alias("wanted"))
    both = documents.join(wanted, F.col("graph_id") == F.col("_g")).select("graph_id", lines_of(F.col("dot")).alias("dot"), "wanted")
    kind = documents.schema["graph_id"].dataType.simpleString()

    def scan(text: str, ids: set[str]) -> Iterator[tuple[str, str]]:
        lines = iter(text.split("\n"))
        for line in lines:
            opened = opens.match(line)
            if opened and opened[1] in ids:
                block = [line]
                while not block[-1].rstrip().endswith('"];') and (more := next(lines, None)) is not None:
                    block.append(more)
                yield opened[1], "\n".join(block)

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for at, (text, ids) in enumerate(zip(batch.column("dot").to_pylist(), batch.column("wanted").to_pylist(), strict=True)):
                rows += [(at, n, node, raw) for n, (node, raw) in enumerate(scan(text, set(ids)))]
            graphs = batch.column("graph_id").take(pa.array([r[0] for r in rows], pa.int64()))
            yield pa.RecordBatch.from_arrays([graphs, pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.string()), pa.array([r[3] for r in rows], pa.string())], names=["graph_id", "ord", "node_id", "raw"])

    return both.mapInArrow(go, f"graph_id {kind}, ord int, node_id string, raw string")


def method_nodes(found: DataFrame, strict_names: bool = False) -> DataFrame:
    """The last definitions with the attributes of methods, and user_method."""
    out = last_definitions(found).select("*", *D.method_attributes(F.col("raw"), strict_names))
    names = ("label", "is_external", "name", "full_name", "filename", "ast_parent_full_name")
    return out.withColumn("user_method", D.is_user_method(*(F.col(n) for n in names)))


def attributes(raw: Column) -> Column:
    """A block's attributes for rendering, as array of (k, v); null if the block has none in brackets."""
    return F.when(raw.rlike(D.NODE_ATTRIBUTES), D.pairs(F.regexp_extract(raw, D.NODE_ATTRIBUTES, 1)))
