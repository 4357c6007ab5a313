"""Steps on a graph inside its row give what the steps over relations do, and deal no row out."""

import pytest
from oracle import DATA
from test_checks import TEXT

from sparkweft.operators import graph, local, render, verify
from sparkweft.plans import order_graphs, queries
from pyspark.sql import functions as F

ODD = [
    None, "", "digraph {", TEXT.replace("\n", "\r\n"), TEXT.replace('"4"', '"1"'), TEXT.replace('IS_EXTERNAL="false"', 'IS_EXTERNAL="TRUE"', 1), TEXT.replace('"];', '"] ;'),
    TEXT.replace('  "1" ->', ' \x1c"1"\u2003->'), TEXT.replace('  "3" [', '\u3000"3"\x85['), TEXT.replace('"2" -> "1"', '"2" -> "9"'), TEXT + '  "7" [label="METHOD" NAME="é" FILENAME="b.c"\n  "7" -> "2" [label="CFG" x];\n', TEXT.replace("f(x)", 'f("x")'),
    TEXT.replace('"3" -> ', '"3"->').replace('[label="CFG" ];', '[label="AST" label="CFG" ]; // label="x" ];'), TEXT.replace('FILENAME="a.c"', 'FILENAME="<empty>"', 1), TEXT.replace('NAME="main"', 'NAME="<clinit>"', 1),
]


def _sorted(df):
    return sorted(map(repr, df.collect()))


def test_like_relations(spark):
    docs = spark.createDataFrame(list(enumerate(ODD)), "graph_id long, dot string")
    edges, nodes, _ = graph.subgraph(docs)
    sub = render.subgraph_text(docs, edges, nodes)
    made = local.subgraph_text(docs)
    assert _sorted(made) == _sorted(sub)
    nodes, edges, _ = graph.user_subgraph(sub)
    filtered = render.user_subgraph_text(sub, edges, nodes)
    ours = local.user_subgraph_text(made)
    assert _sorted(ours.select("graph_id", F.col("filtered").alias("dot"))) == _sorted(filtered)
    assert _sorted(local.user_nodes(made)) == _sorted(nodes.select("graph_id", "node_id"))
    checks = verify.verify_subgraph(docs, sub).unionByName(verify.verify_user_subgraph(sub, filtered))
    assert _sorted(local.verify_made(docs)) == _sorted(checks)


def test_checks_of_other_texts(spark):
    """Every text against every other: all faults are named alike."""
    docs = spark.createDataFrame([(i * 100 + j, a, b) for i, a in enumerate(ODD) for j, b in enumerate(ODD)], "graph_id long, dot string, filtered string")
    other = docs.select("graph_id", F.col("filtered").alias("dot"))
    assert _sorted(local.verify_user_subgraph(docs)) == _sorted(verify.verify_user_subgraph(docs.select("graph_id", "dot"), other))
    ours = local._checks(docs, ["dot", "filtered"], local.subgraph_checks)
    assert _sorted(ours) == _sorted(verify.verify_subgraph(docs.select("graph_id", "dot"), other))


@pytest.mark.parametrize("name", ["udm_nodes", "node_sort", "edge_order", "verify_udm_identification", "verify_udm_reachability", "verify_udm_edges", "verify_udm_integrity", "verify_overall", "verify_clean"])
def test_lines_are_dealt_once(spark, name, monkeypatch):
    """Nothing is written, and line items cross the network once."""
    wrote = []
    monkeypatch.setattr(queries, "written", lambda df, what: wrote.append(what) or df)
    df = queries.QUERIES[name](spark, DATA)
    plan = df._jdf.queryExecution().sparkPlan().toString()
    exchanges = df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(")
    assert not wrote and "SortMergeJoin" not in plan.split("graph_id")[0] and exchanges <= 3  # line items, orders, and a graph's checks


def test_lines_of_no_supplier(spark, tmp_path):
    """They keep their number, as before."""
    for t in ("orders", "supplier", "nation"):
        spark.read.parquet(f"{DATA}/{t}.parquet").write.parquet(str(tmp_path / f"{t}.parquet"))
    lines = spark.read.parquet(f"{DATA}/lineitem.parquet").where("l_orderkey = 5 or l_orderkey = 7")
    lines.withColumn("l_suppkey", F.when(F.col("l_linenumber") == 1, -1).otherwise(F.col("l_suppkey"))).write.parquet(str(tmp_path / "lineitem.parquet"))
    text = "".join(r.dot or "" for r in order_graphs.documents(spark, str(tmp_path)).where("graph_id in (5, 7)").collect())
    assert "S-1" not in text and '"M5"' in text
