"""Edge-type subgraphs, reachability, and the subgraph of user-defined methods."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..tables import written
from . import parse

TYPES = ("CALL", "CFG")
#: Graphs up to so many edges are closed by a scan of one row, beyond it by joins.
ROW_EDGES = 200_000


def endpoints(found: DataFrame) -> DataFrame:
    """Distinct (graph_id, node_id) at either end of edges."""
    return found.select("graph_id", F.explode(F.array("src", "dst")).alias("node_id")).distinct()


def subgraph(documents: DataFrame, types: Sequence[str] = TYPES, exact: bool = False, keep: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Edges of the types, the definitions of their endpoints, and the endpoints without one.

    exact reads definitions as a scan that does not skip the blocks of other nodes. keep writes edges and definitions
    to the shared folder, so that each text is parsed once however often they are used.
    """
    once = written if keep else lambda df, _: df
    kept = once(parse.edges(documents, types), "parsed-edges")
    ends = endpoints(kept)
    found = parse.target_nodes(documents, ends) if exact else parse.nodes(documents).join(ends, ["graph_id", "node_id"], "left_semi")
    found = once(found, "parsed-nodes")
    missing = ends.join(found, ["graph_id", "node_id"], "left_anti")
    return kept, found, missing


def _folded(seeds: Column, links: Column) -> Column:
    """The closure of seeds: as many rounds as there are links suffice."""
    links, start = F.coalesce(links, F.array().cast("array<struct<src:string,dst:string>>")), F.array_distinct(seeds)
    step = lambda acc: F.array_union(acc, F.transform(F.filter(links, lambda e: F.array_contains(acc, e["src"])), lambda e: e["dst"]))
    rounds = F.when(F.size(links) > 0, F.sequence(F.lit(1), F.greatest(F.size(links), F.lit(1)))).otherwise(F.array().cast("array<int>"))
    # A round that adds nothing means that none will.
    grown = F.aggregate(
        rounds,
        F.struct(start.alias("at"), F.lit(False).alias("done")),
        lambda acc, _: F.when(acc["done"], acc).otherwise(
            F.transform(F.array(step(acc["at"])), lambda new: F.struct(new.alias("at"), (F.size(new) == F.size(acc["at"])).alias("done")))[0]
        ),
    )
    return grown["at"]


def _by_row(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        graphs, out = [], []
        for at, (seeds, links) in enumerate(zip(batch.column("seeds").to_pylist(), batch.column("links").to_pylist(), strict=True)):
            after: dict[str, list[str]] = {}
            for e in links or ():
                after.setdefault(e["src"], []).append(e["dst"])
            seen, ahead = set(seeds), list(seeds)
            while ahead:
                for x in after.pop(ahead.pop(), ()):
                    if x not in seen:
                        seen.add(x)
                        ahead.append(x)
            graphs += [at] * len(seen)
            out += seen
        yield pa.RecordBatch.from_arrays([batch.column("graph_id").take(pa.array(graphs, pa.int64())), pa.array(out, pa.string())], names=["graph_id", "node_id"])


def _by_joins(seeds: DataFrame, links: DataFrame) -> DataFrame:
    """Frontier by frontier; each round is written to the shared folder, so a lost executor costs one round at most."""
    links, front = written(links.distinct(), "closure-links"), written(seeds.distinct(), "closure-front")
    seen = front
    while not front.isEmpty():
        on = (F.col("f.graph_id") == F.col("e.graph_id")) & (F.col("f.node_id") == F.col("e.src"))
        new = front.alias("f").join(links.alias("e"), on).select("e.graph_id", F.col("e.dst").alias("node_id")).distinct()
        front = written(new.join(seen, ["graph_id", "node_id"], "left_anti"), "closure-front")
        seen = seen.unionByName(front)
    return seen


def reachable(seeds: DataFrame, found: DataFrame, strategy: str = "auto") -> DataFrame:
    """(graph_id, node_id): the seeds (graph_id, node_id) and all that edges (graph_id, src, dst) lead to from them; safe with cycles.

    fold: an expression over a graph's links. row: a scan of one row a graph. joins: rounds of joins, for graphs
    of any size. auto takes for each graph what its number of edges calls for.
    """
    links = found.select("graph_id", "src", "dst")
    if strategy == "joins":
        return _by_joins(seeds.select("graph_id", "node_id"), links)
    if strategy == "auto":
        sizes = links.groupBy("graph_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > ROW_EDGES).select("graph_id")
        if not sizes.isEmpty():
            huge = _by_joins(seeds.join(sizes, "graph_id", "left_semi").select("graph_id", "node_id"), links.join(sizes, "graph_id", "left_semi"))
            return huge.unionByName(_grouped(seeds.join(sizes, "graph_id", "left_anti"), links.join(sizes, "graph_id", "left_anti"), strategy))
    return _grouped(seeds, links, strategy)


def _grouped(seeds: DataFrame, links: DataFrame, strategy: str) -> DataFrame:
    """Closures of graphs that fit a row. Seeds and links of a graph meet in one aggregation, so there is one shuffle."""
    starts = seeds.select("graph_id", F.col("node_id").alias("seed"), F.lit(None).cast("struct<src:string,dst:string>").alias("link"))
    steps = links.select("graph_id", F.lit(None).cast("string").alias("seed"), F.struct("src", "dst").alias("link"))
    rows = starts.unionByName(steps).groupBy("graph_id").agg(F.collect_list("seed").alias("seeds"), F.collect_list("link").alias("links")).where(F.size("seeds") > 0)
    kind = seeds.schema["graph_id"].dataType.simpleString()
    fold = lambda df: df.select("graph_id", F.explode(_folded(F.col("seeds"), F.col("links"))).alias("node_id"))
    scan = lambda df: df.mapInArrow(_by_row, f"graph_id {kind}, node_id string")
    if strategy == "fold":
        return fold(rows)
    return scan(rows)


def user_methods(documents: DataFrame, strict_names: bool = False) -> DataFrame:
    """(graph_id, node_id) of the methods that the program defines."""
    return parse.method_nodes(parse.nodes(documents), strict_names).where("user_method").select("graph_id", "node_id")


def user_subgraph(documents: DataFrame, strategy: str = "auto", strict_names: bool = False, tables: tuple[DataFrame, DataFrame] | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """User-defined methods and all that control flow reaches from them: definitions, edges, and what is kept without a definition.

    Kept are control-flow edges between kept nodes, and calls from kept nodes to user-defined methods.
    tables: the documents' edges and last definitions with the attributes of methods, where they are parsed already.
    """
    # Each text is parsed once; what follows reads tables.
    if tables is None:
        every = written(parse.edges(documents, ["CFG", "CALL"]), "parsed-edges")
        found = written(parse.method_nodes(parse.nodes(documents), strict_names).select("graph_id", "ord", "node_id", "raw", "user_method"), "parsed-nodes")
    else:
        every, found = tables[0], tables[1].select("graph_id", "ord", "node_id", "raw", "user_method")
    flow, calls = every.where("etype = 'CFG'"), every.where("etype = 'CALL'")
    methods = found.where("user_method").select("graph_id", "node_id")
    kept = written(reachable(methods, flow, strategy), "reachable")
    source = lambda df: df.withColumnRenamed("node_id", "src")
    target = lambda df: df.withColumnRenamed("node_id", "dst")
    flow = flow.join(source(kept), ["graph_id", "src"], "left_semi").join(target(kept), ["graph_id", "dst"], "left_semi")
    calls = calls.join(source(kept), ["graph_id", "src"], "left_semi").join(target(methods), ["graph_id", "dst"], "left_semi")
    defined = found.drop("user_method").join(kept, ["graph_id", "node_id"], "left_semi")
    missing = kept.join(defined, ["graph_id", "node_id"], "left_anti")
    return defined, flow.unionByName(calls), missing
