"""Named queries over the test tables, and DuckDB SQL for each. Every query runs over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dot as D
from ..functions import samples as S
from ..functions.text import dot_escaped, html_escaped, path_parts
from ..operators import datasets, graph, local, manifest, parse, profile, render, report, verify
from ..tables import written
from .order_graphs import SQL as G
from .order_graphs import documents as order_documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, over_graphs: bool = True):
    """Registers a function as a query under its name, with its SQL."""

    def put(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = (G if over_graphs else "") + sql
        return f

    return put


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Graph documents, written once: what reads them is the engine's own work."""
    return written(order_documents(spark, sf_dir), "order-graphs")


def subgraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    edges, nodes, _ = graph.subgraph(docs, keep=True)
    return written(render.subgraph_text(docs, edges, nodes), "order-subgraphs")


# Flagship.


@query("SELECT o_orderkey AS graph_id, (SELECT count(*) FROM sub_reach r WHERE r.g = o_orderkey) AS nodes, (SELECT count(*) FROM user_edge e WHERE e.g = o_orderkey AND t = 'CFG') AS cfg_edges, (SELECT count(*) FROM user_edge e WHERE e.g = o_orderkey AND t = 'CALL') AS call_edges FROM orders")
def udm_counts(spark, sf_dir):
    """Per graph: nodes and edges of the subgraph of user-defined methods, taken of the edge-type subgraph's text."""
    docs = subgraphs(spark, sf_dir)
    nodes, edges, _ = graph.user_subgraph(docs)
    n = nodes.groupBy("graph_id").agg(F.count(F.lit(1)).alias("nodes"))
    e = edges.groupBy("graph_id").agg(F.count_if(F.col("etype") == "CFG").alias("cfg_edges"), F.count_if(F.col("etype") == "CALL").alias("call_edges"))
    return docs.select("graph_id").join(n, "graph_id", "left").join(e, "graph_id", "left").na.fill(0)


# Text to relations.


@query("SELECT g AS graph_id, src, dst, t AS etype FROM edge")
def dot_edges(spark, sf_dir):
    return parse.edges(documents(spark, sf_dir)).select("graph_id", "src", "dst", "etype")


@query("SELECT g AS graph_id, id AS node_id FROM node")
def dot_nodes(spark, sf_dir):
    return parse.nodes(documents(spark, sf_dir)).select("graph_id", "node_id")


@query("SELECT g AS graph_id, id AS node_id, label, external AS is_external, name, full_name, file AS filename FROM node")
def dot_attrs(spark, sf_dir):
    return parse.method_nodes(parse.nodes(documents(spark, sf_dir))).select("graph_id", "node_id", "label", "is_external", "name", "full_name", "filename")


@query("SELECT g AS graph_id, id AS node_id, k, v FROM (SELECT g, id, unnest(CASE WHEN label = 'CALL' THEN ['label', 'NAME'] WHEN id LIKE 'M%' THEN ['label', 'NAME', 'FULL_NAME', 'FILENAME', 'IS_EXTERNAL', 'AST_PARENT_FULL_NAME'] ELSE ['label', 'NAME', 'FULL_NAME', 'FILENAME', 'IS_EXTERNAL'] END) AS k, unnest(CASE WHEN label = 'CALL' THEN [label, name] WHEN id LIKE 'M%' THEN [label, name, full_name, file, external, 'orders'] ELSE [label, name, full_name, file, external] END) AS v FROM node)")
def dot_pairs(spark, sf_dir):
    """Generic attributes, but for the code of calls."""
    found = parse.nodes(documents(spark, sf_dir)).select("graph_id", "node_id", F.explode(parse.attributes(F.col("raw"))).alias("p"))
    return found.select("graph_id", "node_id", "p.k", "p.v").where("k <> 'CODE'")


@query("SELECT g AS graph_id, src, dst, t AS label FROM edge")
def dot_outside_edges(spark, sf_dir):
    return render.html_edges(documents(spark, sf_dir)).select("graph_id", "src", "dst", "label")


@query("SELECT n.g AS graph_id, n.id AS node_id FROM sub_node n")
def dot_target_nodes(spark, sf_dir):
    """Definitions by the scan that knows its targets."""
    docs = documents(spark, sf_dir)
    return parse.target_nodes(docs, graph.endpoints(parse.edges(docs, graph.TYPES))).select("graph_id", "node_id")


# Counts.


@query("SELECT g AS graph_id, t AS etype, count(*) AS n FROM edge GROUP BY ALL")
def edge_type_counts(spark, sf_dir):
    return parse.edges(documents(spark, sf_dir)).groupBy("graph_id", "etype").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT o_orderkey AS graph_id, (SELECT count(*) FROM edge WHERE g = o_orderkey AND t = 'CFG')::INT AS cfg_edges, ((SELECT count(*) FROM edge WHERE g = o_orderkey AND t = 'CALL') + (SELECT count(*) FROM li WHERE g = o_orderkey))::INT AS call_edges FROM orders")
def edge_marker_counts(spark, sf_dir):
    """Markers in the text: nodes that begin with the label CALL count as calls too."""
    return documents(spark, sf_dir).select("graph_id", manifest.debug_info(F.col("dot")).alias("d")).select("graph_id", "d.cfg_edges", "d.call_edges")


@query("SELECT g AS graph_id, count(*) FILTER (label = 'METHOD') AS methods, count(*) FILTER (EXISTS (SELECT 1 FROM udm u WHERE u.g = node.g AND u.id = node.id)) AS user_methods FROM node GROUP BY g")
def method_counts(spark, sf_dir):
    found = parse.method_nodes(parse.nodes(documents(spark, sf_dir)))
    return found.groupBy("graph_id").agg(F.count_if(F.col("label") == "METHOD").alias("methods"), F.count_if("user_method").alias("user_methods"))


# Subgraphs.


@query("SELECT g AS graph_id, src, dst, t AS etype FROM sub_edge")
def subgraph_edges(spark, sf_dir):
    return graph.subgraph(documents(spark, sf_dir))[0].select("graph_id", "src", "dst", "etype")


@query("SELECT g AS graph_id, id AS node_id FROM sub_node")
def subgraph_nodes(spark, sf_dir):
    return graph.subgraph(documents(spark, sf_dir))[1].select("graph_id", "node_id")


def _lossy(docs: DataFrame) -> DataFrame:
    """Documents whose supplier methods have lost their definitions."""
    return docs.withColumn("dot", F.regexp_replace("dot", r'(?m)^  "S\d+" \[label="METHOD".*\n', ""))


@query("SELECT g AS graph_id, count(DISTINCT dst) AS missing, array_to_string(list_sort(list(DISTINCT dst))[1:5], ',') AS examples FROM edge WHERE t = 'CALL' GROUP BY g")
def subgraph_missing(spark, sf_dir):
    """Endpoints without a definition, and the first five."""
    missing = graph.subgraph(_lossy(documents(spark, sf_dir)))[2]
    return missing.groupBy("graph_id").agg(F.count(F.lit(1)).alias("missing"), F.array_join(F.slice(F.sort_array(F.collect_list("node_id")), 1, 5), ",").alias("examples"))


@query("SELECT g AS graph_id, src, dst, t AS etype FROM edge WHERE t = 'AST'")
def subgraph_other_types(spark, sf_dir):
    return graph.subgraph(documents(spark, sf_dir), ["AST"])[0].select("graph_id", "src", "dst", "etype")


@query("SELECT g AS graph_id, id AS node_id FROM udm")
def udm_methods(spark, sf_dir):
    return graph.user_methods(documents(spark, sf_dir))


@query("SELECT g AS graph_id, id AS node_id FROM reach")
def cfg_reachable(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return graph.reachable(graph.user_methods(docs), parse.edges(docs, ["CFG"]))


@query("SELECT g AS graph_id, id AS node_id FROM reach")
def cfg_reachable_fold(spark, sf_dir):
    """The closure as one expression a graph."""
    docs = documents(spark, sf_dir)
    return graph.reachable(graph.user_methods(docs), parse.edges(docs, ["CFG"]), "fold")


@query("SELECT g AS graph_id, id AS node_id FROM reach")
def cfg_reachable_joins(spark, sf_dir):
    """The closure by rounds of joins, as for graphs of any size."""
    docs = documents(spark, sf_dir)
    return graph.reachable(graph.user_methods(docs), parse.edges(docs, ["CFG"]), "joins")


def _filtered(spark, sf_dir, once=False):
    """(graph_id, dot, filtered): subgraphs and their filtered documents, graph by graph in one pass over the orders."""
    return local.user_subgraph_text(local.subgraph_text(order_documents(spark, sf_dir, once)))


@query("SELECT r.g AS graph_id, r.id AS node_id FROM sub_reach r")
def udm_nodes(spark, sf_dir):
    return local.user_nodes(local.subgraph_text(order_documents(spark, sf_dir, once=True)))


@query("SELECT g AS graph_id, src, dst, t AS etype FROM user_edge")
def udm_edges(spark, sf_dir):
    return graph.user_subgraph(subgraphs(spark, sf_dir))[1].select("graph_id", "src", "dst", "etype")


@query("SELECT g AS graph_id, id AS node_id, row_number() OVER (PARTITION BY g ORDER BY id) - 1 AS place FROM sub_reach")
def node_sort(spark, sf_dir):
    """Nodes stand in the filtered document by id as text."""
    found = parse.nodes(_filtered(spark, sf_dir, once=True).select("graph_id", F.col("filtered").alias("dot")))
    return found.select("graph_id", "node_id", F.col("ord").cast("long").alias("place"))


@query("SELECT g AS graph_id, t AS etype, count(*) AS n, CASE t WHEN 'CFG' THEN 0 ELSE (SELECT count(*) FROM user_edge x WHERE x.g = e.g AND x.t = 'CFG') END AS first_place FROM user_edge e GROUP BY g, t")
def edge_order(spark, sf_dir):
    """Control flow stands before calls in the filtered document."""
    return local.edge_places(_filtered(spark, sf_dir, once=True).select("graph_id", F.col("filtered").alias("dot")))


# Checks, over subgraphs with seeded faults: one kind of fault by order key.


def _faulty(docs: DataFrame) -> DataFrame:
    """Subgraph documents, by graph_id mod 5: whole; first control-flow edge gone; a node added; a node's text changed; a foreign edge type."""
    own = F.col("graph_id").cast("string")
    after = lambda text: F.regexp_replace("dot", r"\}\n\z", text)
    fault = (
        F.when(F.col("graph_id") % 5 == 1, F.regexp_replace("dot", F.concat(F.lit('(?m)^  "M'), own, F.lit('" -> .*CFG.*\n')), F.lit("")))
        .when(F.col("graph_id") % 5 == 2, F.concat(after(""), F.lit('  "X1" [label="CALL" NAME="x"];\n}\n')))
        .when(F.col("graph_id") % 5 == 3, F.replace("dot", F.lit('CODE="supply('), F.lit('CODE="supplied(')))
        .when(F.col("graph_id") % 5 == 4, F.concat(after(""), F.lit('  "M'), own, F.lit('" -> "M'), own, F.lit('" [label="REF" ];\n}\n')))
    )
    return docs.withColumn("dot", F.coalesce(fault, F.col("dot")))


def _pair(spark, sf_dir):
    docs = documents(spark, sf_dir)
    edges, nodes, _ = graph.subgraph(docs, keep=True)
    return docs, written(_faulty(render.subgraph_text(docs, edges, nodes)), "order-subgraphs")


_LINES = "(SELECT count(*) FROM li WHERE g = o_orderkey)"


@query(f"SELECT o_orderkey AS graph_id, NOT ((o_orderkey % 5 = 1 AND {_LINES} > 0) OR o_orderkey % 5 = 4) AS passed, CASE WHEN o_orderkey % 5 = 1 AND {_LINES} > 0 THEN 2 WHEN o_orderkey % 5 = 4 THEN 2 ELSE 0 END AS issues FROM orders")
def verify_edges(spark, sf_dir):
    """Edge check: passed, and how many issues it names."""
    return verify.subgraph_edges(*_pair(spark, sf_dir)).select("graph_id", "passed", F.size("issues").alias("issues"))


@query("SELECT o_orderkey AS graph_id, o_orderkey % 5 <> 2 AS passed FROM orders")
def verify_nodes(spark, sf_dir):
    return verify.subgraph_nodes(*_pair(spark, sf_dir)).select("graph_id", "passed")


@query(f"SELECT o_orderkey AS graph_id, NOT (o_orderkey % 5 = 3 AND {_LINES} > 0) AS passed FROM orders")
def verify_attrs(spark, sf_dir):
    return verify.subgraph_attributes(*_pair(spark, sf_dir)).select("graph_id", "passed")


def _user_pair(spark, sf_dir):
    """Subgraphs and their filtered documents, by graph_id mod 4: whole; a node lost; an external method added; a call to a node that is no method."""
    own, dot = F.col("graph_id").cast("string"), F.col("filtered")
    fault = (
        F.when(F.col("graph_id") % 4 == 1, F.regexp_replace(dot, F.concat(F.lit('(?m)^ *"M'), own, F.lit(r'" \[.*\n')), F.lit("")))
        .when(F.col("graph_id") % 4 == 2, F.regexp_replace(dot, r"\}\n\z", '  "X1" [label="METHOD" NAME="x" IS_EXTERNAL="true"];\n}\n'))
        .when(F.col("graph_id") % 4 == 3, F.concat(F.regexp_replace(dot, r"\}\n\z", ""), F.lit('  "M'), own, F.lit('" -> "X2" [label="CALL" ];\n}\n')))
    )
    return _filtered(spark, sf_dir).withColumn("filtered", F.coalesce(fault, dot))


def _user_check(spark, sf_dir, category):
    return local.verify_user_subgraph(_user_pair(spark, sf_dir)).where(F.col("category") == category).select("graph_id", "passed")


_HAS = "EXISTS (SELECT 1 FROM li WHERE g = o_orderkey)"


@query(f"SELECT o_orderkey AS graph_id, NOT ((o_orderkey % 4 = 1 AND {_HAS}) OR o_orderkey % 4 = 2) AS passed FROM orders")
def verify_udm_identification(spark, sf_dir):
    return _user_check(spark, sf_dir, "udf_identification")


@query(f"SELECT o_orderkey AS graph_id, NOT ((o_orderkey % 4 = 1 AND {_HAS}) OR o_orderkey % 4 = 2) AS passed FROM orders")
def verify_udm_reachability(spark, sf_dir):
    return _user_check(spark, sf_dir, "cfg_reachability")


@query(f"SELECT o_orderkey AS graph_id, NOT ((o_orderkey % 4 = 1 AND {_HAS}) OR o_orderkey % 4 = 3) AS passed FROM orders")
def verify_udm_edges(spark, sf_dir):
    return _user_check(spark, sf_dir, "edge_filtering")


@query("SELECT o_orderkey AS graph_id, o_orderkey % 4 <> 2 AS passed FROM orders")
def verify_udm_integrity(spark, sf_dir):
    return _user_check(spark, sf_dir, "node_integrity")


@query(f"SELECT o_orderkey AS graph_id, NOT ((o_orderkey % 4 = 1 AND {_HAS}) OR o_orderkey % 4 IN (2, 3)) AS passed FROM orders")
def verify_overall(spark, sf_dir):
    """All checks of the filtered documents together."""
    return verify.overall(local.verify_user_subgraph(_user_pair(spark, sf_dir)))


@query("SELECT o_orderkey AS graph_id, true AS passed FROM orders")
def verify_clean(spark, sf_dir):
    """Documents as the engine makes them pass all checks of both kinds."""
    return verify.overall(local.verify_made(order_documents(spark, sf_dir)))


# Schema profile. A file is an order; its node types are METHOD and CALL.


def _profile(spark, sf_dir):
    return written(profile.file_profile(profile.node_keys(documents(spark, sf_dir), name="graph_id")), "order-profile")


_P = ", keyed AS (SELECT g::VARCHAR AS f, id, label AS t, unnest(CASE WHEN label = 'CALL' THEN ['CODE', 'NAME'] WHEN id LIKE 'M%' THEN ['AST_PARENT_FULL_NAME', 'FILENAME', 'FULL_NAME', 'IS_EXTERNAL', 'NAME'] ELSE ['FILENAME', 'FULL_NAME', 'IS_EXTERNAL', 'NAME'] END) AS k FROM node), per AS (SELECT f, t, count(DISTINCT id) AS n FROM keyed GROUP BY ALL), held AS (SELECT f, t, k, count(*) AS c FROM keyed GROUP BY ALL), anyk AS (SELECT f, t, k FROM held), allk AS (SELECT h.f, h.t, h.k FROM held h JOIN per p ON p.f = h.f AND p.t = h.t WHERE h.c = p.n), tf AS (SELECT t, count(*) AS nf FROM per GROUP BY t) "


@query(_P + "SELECT f AS file, t AS node_type, string_agg(k, ',' ORDER BY k) AS keys FROM anyk GROUP BY ALL")
def profile_any(spark, sf_dir):
    return _profile(spark, sf_dir).select("file", "node_type", F.array_join("any", ",").alias("keys"))


@query(_P + "SELECT f AS file, t AS node_type, string_agg(k, ',' ORDER BY k) AS keys FROM allk GROUP BY ALL")
def profile_all(spark, sf_dir):
    return _profile(spark, sf_dir).select("file", "node_type", F.array_join("all", ",").alias("keys"))


@query(_P + "SELECT t AS node_type, nf AS files, nf = (SELECT count(DISTINCT f) FROM per) AS in_all FROM tf")
def types_presence(spark, sf_dir):
    """Node types, in how many files, and whether in all: the intersection and its complement."""
    return profile.present(_profile(spark, sf_dir))


@query(_P + "SELECT t AS node_type, k AS key, count(*) AS files, count(*) = any_value(nf) AS in_all FROM anyk JOIN tf USING (t) GROUP BY t, k")
def props_lenient(spark, sf_dir):
    return profile.properties(_profile(spark, sf_dir), "any")


@query(_P + "SELECT t AS node_type, k AS key, count(*) AS files, count(*) = any_value(nf) AS in_all FROM allk JOIN tf USING (t) GROUP BY t, k")
def props_strict(spark, sf_dir):
    return profile.properties(_profile(spark, sf_dir), "all")


@query(_P + "SELECT k AS key, count(DISTINCT t) AS types, count(DISTINCT t) = (SELECT count(*) FROM tf) AS in_all FROM anyk GROUP BY k")
def props_cross_types(spark, sf_dir):
    return profile.across_types(_profile(spark, sf_dir), "any")


@query(_P + ", strict AS (SELECT t, k FROM allk JOIN tf USING (t) GROUP BY t, k HAVING count(*) = any_value(nf)) SELECT k AS key, count(*) AS types, count(*) = (SELECT count(*) FROM tf) AS in_all FROM strict GROUP BY k")
def props_cross_types_strict(spark, sf_dir):
    return profile.across_types(_profile(spark, sf_dir), "all")


@query(_P + "SELECT k AS key, string_agg(DISTINCT t, ',' ORDER BY t) AS node_types FROM anyk GROUP BY k")
def props_coverage(spark, sf_dir):
    return profile.coverage(_profile(spark, sf_dir)).select("key", F.array_join("node_types", ",").alias("node_types"))


@query(_P + "SELECT t AS node_type, count(*) AS files, md5(string_agg(f, ',' ORDER BY f)) AS present_in FROM per GROUP BY t")
def presence_lists(spark, sf_dir):
    """The files of a type in order of text, as a digest."""
    lists = profile.presence_lists(_profile(spark, sf_dir))
    return lists.select("node_type", F.size("present_in").cast("long").alias("files"), F.md5(F.array_join("present_in", ",")).alias("present_in"))


@query("SELECT e.k AS node_type, max((o_orderstatus = 'F' AND has)::INT) AS \"F\", max((o_orderstatus = 'O' AND has)::INT) AS \"O\", max((o_orderstatus = 'P' AND has)::INT) AS \"P\" FROM (SELECT 'METHOD' AS k, o_orderstatus, true AS has FROM orders UNION ALL SELECT 'CALL', o_orderstatus, EXISTS (SELECT 1 FROM li WHERE g = o_orderkey) FROM orders) e GROUP BY e.k")
def presence_matrix(spark, sf_dir):
    """Types by file, where a file takes all orders of a status."""
    status = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_orderkey").alias("graph_id"), F.col("o_orderstatus").alias("file"))
    keys = profile.node_keys(documents(spark, sf_dir).join(status, "graph_id"))
    return profile.presence_matrix(profile.file_profile(keys), ["F", "O", "P"])


def _list_sql(what: str, when: str = "true") -> str:
    """A JSON list of distinct texts, sorted, as an aggregate."""
    return f"""'[' || coalesce(string_agg(DISTINCT '"' || {what} || '"', ',' ORDER BY '"' || {what} || '"') FILTER ({when}), '') || ']'"""


def _view_sql(of: str, suffix: str) -> str:
    """The JSON object of a type's keys over its files."""
    keys = f"(SELECT k, count(*) = any_value(nf) AS whole FROM {of} JOIN tf USING (t) WHERE t = x.t GROUP BY k)"
    part = lambda name, when: f"""'"{name}{suffix}":' || (SELECT {_list_sql("k", when)} FROM {keys})"""
    return "'{' || " + part("intersection", "whole") + " || ',' || " + part("non_intersection", "NOT whole") + " || ',' || " + part("union", "true") + " || '}'"


def _cross_sql(of: str, suffix: str) -> str:
    """The JSON object of keys over types, without its end."""
    keys = f"(SELECT k, count(DISTINCT t) = (SELECT count(*) FROM tf) AS whole FROM {of} GROUP BY k)"
    part = lambda name, when: f"""'"{name}_across_types{suffix}":' || (SELECT {_list_sql("k", when)} FROM {keys})"""
    return "'{' || " + part("intersection", "whole") + " || ',' || " + part("union", "true") + " || ',' || " + part("non_intersection", "NOT whole")


_HEAD = f"""'{{"generated_at_utc":"","root":"orders","pattern":"{profile.PATTERN}",' || """
_REPORT = (
    _P + ", strict AS (SELECT t, k FROM allk JOIN tf USING (t) GROUP BY t, k HAVING count(*) = any_value(nf)), fl AS (SELECT DISTINCT f FROM per), total AS (SELECT count(*) AS n FROM fl)"
    + ", lists AS (SELECT t, " + _list_sql("f") + " AS fs, any_value(nf) = (SELECT n FROM total) AS whole FROM per JOIN tf USING (t) GROUP BY t)"
    + ", cells AS (SELECT t, string_agg('\"' || fl.f || '\":' || CASE WHEN per.f IS NULL THEN 0 ELSE 1 END, ',' ORDER BY fl.f) AS cs FROM (SELECT t, f FROM tf, fl) fl LEFT JOIN per USING (t, f) GROUP BY t)"
    + ", sets AS (SELECT f, t, " + _list_sql("k") + " AS a, " + _list_sql("k", "w") + " AS l FROM (SELECT a.f, a.t, a.k, l.k IS NOT NULL AS w FROM anyk a LEFT JOIN allk l USING (f, t, k)) GROUP BY f, t)"
    + ", byf AS (SELECT t, string_agg('\"' || f || '\":{\"any\":' || a || ',\"all\":' || l || '}', ',' ORDER BY f) AS bs FROM sets GROUP BY t)"
    + " SELECT 'node_types' AS name, " + _HEAD + "'\"files\":' || (SELECT " + _list_sql("f") + " FROM fl) || ',\"intersectional_types\":' || (SELECT " + _list_sql("t", "whole") + " FROM lists)"
    + " || ',\"non_intersectional_types\":[' || coalesce((SELECT string_agg('{\"type\":\"' || t || '\",\"present_in\":' || fs || '}', ',' ORDER BY t) FROM lists WHERE NOT whole), '') || '],\"presence_matrix\":{' || (SELECT string_agg('\"' || t || '\":{' || cs || '}', ',' ORDER BY t) FROM cells) || '}}' AS value"
    + " UNION ALL SELECT 'properties_by_type', " + _HEAD + "'\"types\":{' || (SELECT string_agg('\"' || x.t || '\":{\"files_present_in\":' || x.fs || ',\"lenient\":' || " + _view_sql("anyk", "") + " || ',\"strict\":' || " + _view_sql("allk", "_all_nodes") + " || ',\"by_file\":{' || bs || '}}', ',' ORDER BY x.t) FROM lists x JOIN byf USING (t)) || '}}'"
    + " UNION ALL SELECT 'properties_cross_types', " + _HEAD + "'\"lenient\":' || " + _cross_sql("anyk", "") + " || ',\"coverage\":{' || (SELECT string_agg('\"' || k || '\":' || ts, ',' ORDER BY k) FROM (SELECT k, " + _list_sql("t") + " AS ts FROM anyk GROUP BY k)) || '}},\"strict\":' || " + _cross_sql("strict", "_all_nodes") + " || '}}'"
    + " UNION ALL SELECT 'properties_global', " + _HEAD + "'\"global_property_union\":' || (SELECT " + _list_sql("k") + " FROM anyk) || '}'"
)


@query(_REPORT)
def schema_report(spark, sf_dir):
    """The four report documents."""
    files = written(report.files_in_rows(order_documents(spark, sf_dir, once=True), name="graph_id"), "order-files")
    return report.rows(report.pieces(files, "orders"))


# Samples: documents are function bodies, sources projects, languages labels.


def _bodies(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    n = F.col("doc_id") % 5
    body = F.concat(F.when(n == 0, "#include  <x.h>\n").when(n == 1, "std::x\n").when(n == 2, "#include<x.h>\n").otherwise(""), "text", F.when(n == 3, "\n").otherwise(""))
    path = F.when(n == 0, "").when(n == 1, F.concat(F.lit("a/Good/"), "doc_id", F.lit(".c"))).when(n == 2, F.concat(F.lit("a\\Bad\\"), "doc_id", F.lit(".cpp"))).when(n == 3, F.concat(F.lit("a/x_good_"), "doc_id", F.lit(".cc"))).otherwise("a/x.h")
    return docs.select(F.col("doc_id").alias("idx"), F.concat(F.lit("split"), (F.col("doc_id") % 3).cast("string")).alias("split"), body.alias("func_body"), path.alias("program_path"), F.md5("text").alias("hash"), F.concat(F.lit("case_"), F.floor(F.col("doc_id") / 2).cast("string")).alias("testcases_name"), F.col("source").alias("project"), F.array(F.upper("lang"), F.concat(F.lit("CWE-"), (F.col("doc_id") % 7).cast("string"))).alias("cwe_list"), (F.col("doc_id") % 2 == 0).alias("is_vulnerable"))


_B = "WITH b AS (SELECT doc_id AS idx, 'split' || (doc_id % 3) AS split, CASE doc_id % 5 WHEN 0 THEN '#include  <x.h>' || chr(10) WHEN 1 THEN 'std::x' || chr(10) WHEN 2 THEN '#include<x.h>' || chr(10) ELSE '' END || text || CASE doc_id % 5 WHEN 3 THEN chr(10) ELSE '' END AS body, CASE doc_id % 5 WHEN 0 THEN '' WHEN 1 THEN 'a/Good/' || doc_id || '.c' WHEN 2 THEN 'a\\Bad\\' || doc_id || '.cpp' WHEN 3 THEN 'a/x_good_' || doc_id || '.cc' ELSE 'a/x.h' END AS path, md5(text) AS hash, 'case_' || (doc_id // 2) AS tc, source AS project, [upper(lang), 'CWE-' || (doc_id % 7)] AS cwe, doc_id % 2 = 0 AS vul FROM documents) "


@query(_B + "SELECT idx, CASE idx % 5 WHEN 0 THEN 'unknown' WHEN 1 THEN 'good' WHEN 2 THEN 'bad' WHEN 3 THEN 'good' ELSE 'mixed' END AS variant FROM b", False)
def good_bad(spark, sf_dir):
    return _bodies(spark, sf_dir).select("idx", S.good_bad(F.col("program_path")).alias("variant"))


@query(_B + "SELECT idx, CASE WHEN path = '' THEN CASE WHEN contains(body, '::') THEN 'cpp' ELSE 'c' END WHEN path LIKE '%.cpp' OR path LIKE '%.cc' THEN 'cpp' ELSE 'c' END AS extension FROM b", False)
def tu_ext(spark, sf_dir):
    return _bodies(spark, sf_dir).select("idx", S.unit_extension(F.col("func_body"), F.col("program_path")).alias("extension"))


@query(_B + "SELECT idx, md5(CASE WHEN regexp_matches(body, '#include\\s*[<\"]') THEN body ELSE '#include <stdint.h>' || chr(10) || '#include <stddef.h>' || chr(10) || chr(10) || body END || CASE WHEN suffix(body, chr(10)) THEN '' ELSE chr(10) END) AS unit FROM b", False)
def tu_wrap(spark, sf_dir):
    """Translation units, as a digest."""
    return _bodies(spark, sf_dir).select("idx", F.md5(S.unit_text(F.col("func_body"))).alias("unit"))


@query(_B + "SELECT idx, split, row_number() OVER (PARTITION BY split ORDER BY idx) - 1 AS own, 'd' AS dataset_name, 'secvaleval' AS dataset_type, (row_number() OVER (PARTITION BY split ORDER BY idx) - 1) || '_' || hash AS sample_id FROM b", False)
def sample_norm(spark, sf_dir):
    """Samples without an idx of their own get their number inside the split."""
    rows = _bodies(spark, sf_dir).select(F.col("idx").alias("row_index"), F.lit("f").alias("file"), "split", "func_body", "hash")
    return datasets.normalised(rows, "d").select(F.col("row_index").alias("idx"), "split", F.col("idx").alias("own"), "dataset_name", "dataset_type", "sample_id")


@query(_B + "SELECT idx, tc || '_' || CASE idx % 5 WHEN 0 THEN 'unknown' WHEN 1 THEN 'good' WHEN 2 THEN 'bad' WHEN 3 THEN 'good' ELSE 'mixed' END AS juliet_id, idx || '_' || hash AS secvaleval_id, substr(hash, 1, 12) AS prefix FROM b", False)
def sample_ids(spark, sf_dir):
    rows, idx = _bodies(spark, sf_dir), F.col("idx")
    return rows.select("idx", datasets.sample_id("juliet", idx, rows.columns).alias("juliet_id"), datasets.sample_id("secvaleval", idx, rows.columns).alias("secvaleval_id"), S.hash_prefix(F.col("hash")).alias("prefix"))


@query(_B + ", p AS (SELECT project || '_' || (idx % 100) AS sample_id, row_number() OVER (ORDER BY idx) - 1 AS place FROM b) SELECT sample_id, array_to_string(list_sort(list(place)), ',') AS positions FROM p GROUP BY sample_id HAVING count(*) > 1", False)
def sample_conflicts(spark, sf_dir):
    rows = _bodies(spark, sf_dir).select("idx", F.concat("project", F.lit("_"), (F.col("idx") % 100).cast("string")).alias("sample_id"))
    return datasets.conflicts(rows, [F.col("idx")]).select("sample_id", F.array_join("positions", ",").alias("positions"))


@query(_B + "SELECT idx, split FROM b WHERE split IN ('split2', 'split0') ORDER BY split = 'split0', idx LIMIT (SELECT count(*) // 2 FROM b)", False)
def limit_ordered(spark, sf_dir):
    """The first samples in the order of splits asked for; the limit is the feature."""
    rows = _bodies(spark, sf_dir)
    return datasets.first_samples(rows, ["split2", "split0"], rows.count() // 2).select("idx", "split")


@query(_B + "SELECT unnest(cwe) AS \"CWE_ID\", count(*) AS num_functions FROM b GROUP BY 1", False)
def cwe_distribution(spark, sf_dir):
    return datasets.label_distribution(_bodies(spark, sf_dir))


@query(_B + ", e AS (SELECT project, unnest(cwe) AS c FROM b) SELECT project, count(*) AS num_functions, c AS \"CWE_ID\" FROM e GROUP BY project, c", False)
def project_distribution(spark, sf_dir):
    return datasets.project_distribution(_bodies(spark, sf_dir))


@query(_B + ", e AS (SELECT project, unnest(cwe) AS c FROM b) SELECT coalesce(c, 'ALL') AS \"CWE_ID\", count(DISTINCT project) AS unique_projects, count(DISTINCT project) AS unique_repositories FROM e GROUP BY ROLLUP (c)", False)
def uniques_rollup(spark, sf_dir):
    return datasets.uniques(_bodies(spark, sf_dir))


@query(_B + ", e AS (SELECT unnest(cwe) AS c FROM b) SELECT c AS \"CWE_ID\", count(*) AS total FROM e WHERE c IN ('CWE-1', 'CWE-2') GROUP BY c", False)
def subset_summary(spark, sf_dir):
    return datasets.subset_summary(_bodies(spark, sf_dir), ["CWE-1", "CWE-2"])


@query(_B + "SELECT idx FROM b WHERE list_contains(cwe, 'CWE-3')", False)
def with_label(spark, sf_dir):
    return datasets.with_label(_bodies(spark, sf_dir), "CWE-3").select("idx")


def _functions(spark, sf_dir):
    """Two of three samples with even numbers are fixed by the next one, where that is there."""
    rows = _bodies(spark, sf_dir)
    return rows.withColumn("fixed_func_idx", F.when((F.col("idx") % 2 == 0) & (F.col("idx") % 3 != 0), F.col("idx") + 1))


_F = _B + ", r AS (SELECT b.idx, b.idx + 1 AS fix FROM b WHERE b.idx % 2 = 0 AND b.idx % 3 <> 0 AND EXISTS (SELECT 1 FROM b x WHERE x.idx = b.idx + 1)), pr AS (SELECT idx, idx AS grp FROM r UNION ALL SELECT fix, idx FROM r), gr AS (SELECT b.*, coalesce(pr.grp, b.idx) AS grp, CASE WHEN pr.grp IS NULL THEN 'single' ELSE 'pair' END AS kind FROM b LEFT JOIN pr ON pr.idx = b.idx) "


@query(_F + "SELECT idx, grp AS \"group\", kind FROM gr", False)
def pair_groups(spark, sf_dir):
    return datasets.function_groups(_functions(spark, sf_dir)).select("idx", "group", "kind")


def _split_sql(of: str, train: float, validation: float) -> str:
    return f"(SELECT grp, CASE WHEN place < floor(n * {train}::DOUBLE) THEN 'train' WHEN place < floor(n * {train}::DOUBLE) + floor(n * {validation}::DOUBLE) THEN 'validation' ELSE 'test' END AS split FROM (SELECT grp, row_number() OVER (ORDER BY md5('42|' || grp), grp) - 1 AS place, count(*) OVER () AS n FROM (SELECT DISTINCT grp FROM {of})))"


@query(_B + ", t AS (SELECT *, tc AS grp FROM b) SELECT t.idx, t.grp AS \"group\", s.split FROM t JOIN " + _split_sql("t", 0.70, 0.15) + " s USING (grp)", False)
def pair_split(spark, sf_dir):
    rows = datasets.test_case_groups(_bodies(spark, sf_dir).drop("split"))
    return datasets.pair_split(rows).select("idx", "group", "split")


@query(_F + ", sp AS (SELECT gr.*, s.split AS sp FROM gr JOIN " + _split_sql("gr WHERE kind = 'pair'", 0.7, 0.1) + " s USING (grp) WHERE kind = 'pair' UNION ALL SELECT gr.*, s.split FROM gr JOIN " + _split_sql("gr WHERE kind = 'single'", 0.7, 0.1) + " s USING (grp) WHERE kind = 'single'), e AS (SELECT sp, grp, kind, unnest(cwe) AS c FROM sp) SELECT c AS \"CWE_ID\", count(*) AS total, count(*) FILTER (sp = 'train') AS train, count(*) FILTER (sp = 'validation') AS validation, count(*) FILTER (sp = 'test') AS test, count(DISTINCT grp) FILTER (kind = 'pair') AS num_pair_groups, count(DISTINCT grp) FILTER (kind = 'single') AS num_single_groups FROM e GROUP BY c", False)
def split_summary(spark, sf_dir):
    rows = datasets.grouped_split(datasets.function_groups(_functions(spark, sf_dir).drop("split")))
    return datasets.split_summary(rows.withColumn("CWE_ID", F.explode("cwe_list")))


@query(_B + "SELECT path, row_number() OVER (ORDER BY string_split(path, '/')) - 1 AS place FROM (SELECT DISTINCT path FROM b)", False)
def path_order(spark, sf_dir):
    """Paths in order of their components."""
    rows = _bodies(spark, sf_dir).select(F.col("program_path").alias("path")).distinct()
    return datasets.ranked(rows, [path_parts(F.col("path"))], "place").select("path", "place")


# Results of a run: graphs are samples, every seventh was seen before, small orders left no graph.


def _results(spark, sf_dir):
    docs = documents(spark, sf_dir)
    o = F.col("graph_id")
    rows = docs.select(F.concat(F.lit("s"), o.cast("string")).alias("sample_id"), F.lit("test").alias("split"), o.cast("string").alias("idx"), F.substring(F.md5(o.cast("string")), 1, 12).alias("hash"), (o % 2 == 0).alias("is_vulnerable"), manifest.outcome(o % 7 == 0, F.when(o % 11 != 0, F.lit(5000)), F.col("dot")).alias("r"))
    folder = F.concat(F.lit("out/d/test/"), F.col("sample_id"))
    return rows.select("*", "r.*", manifest.artifact_paths(folder, F.col("r.stage"), F.lit("c")).alias("artifacts")).drop("r")


_R = ", r AS (SELECT o_orderkey AS o, CASE WHEN o_orderkey % 7 = 0 THEN 'skipped_exists' WHEN o_orderkey % 11 = 0 THEN 'failed' ELSE 'completed' END AS status, CASE WHEN o_orderkey % 7 = 0 THEN 'final_check' WHEN o_orderkey % 11 = 0 THEN 'joern_cpg' ELSE 'udf_complete' END AS stage FROM orders) "


@query(_R + "SELECT 's' || o AS sample_id, status, stage, o % 2 = 0 AS is_vulnerable FROM r")
def run_results(spark, sf_dir):
    return _results(spark, sf_dir).select("sample_id", "status", "stage", "is_vulnerable")


@query(_R + "SELECT count(*) AS total_samples, count(*) FILTER (status = 'completed') AS completed, count(*) FILTER (status = 'failed') AS failed, count(*) FILTER (status LIKE 'skipped%') AS skipped, count(*) FILTER (status = 'completed') / count(*) AS success_rate FROM r")
def run_summary(spark, sf_dir):
    return manifest.run_summary(_results(spark, sf_dir))


@query(_R + "SELECT 's' || o AS sample_id, 'test' AS split, o::VARCHAR AS idx, substr(md5(o::VARCHAR), 1, 12) AS hash, '' AS func_name, (o % 2 = 0)::VARCHAR AS is_vulnerable, status, stage, '' AS verification_passed, '' AS udf_verification_passed, '' AS duration, CASE status WHEN 'completed' THEN '' WHEN 'failed' THEN 'Joern CPG generation failed - file missing or too small (0 bytes)' ELSE 'Final artifacts already exist' END AS error_message, '' AS start_time, '' AS end_time, CASE status WHEN 'completed' THEN 'out/d/test/s' || o || '/joern/cpg.bin' ELSE '' END AS artifact_cpg, CASE status WHEN 'completed' THEN 'out/d/test/s' || o || '/joern/dot_files/all/export.dot' ELSE '' END AS artifact_dot, 'out/d/test/s' || o || '/metadata.json' AS artifact_metadata, CASE status WHEN 'completed' THEN 'out/d/test/s' || o || '/subgraphs/CFG_CALL_original.dot' ELSE '' END AS artifact_subgraph, CASE status WHEN 'skipped_exists' THEN '' ELSE 'out/d/test/s' || o || '/src/unit.c' END AS artifact_translation_unit, CASE status WHEN 'completed' THEN 'out/d/test/s' || o || '/udf/CFG_CALL_original_udf_filtered.dot' ELSE '' END AS artifact_udf_filtered, CASE status WHEN 'completed' THEN 'out/d/test/s' || o || '/udf/udf_verification.json' ELSE '' END AS artifact_udf_verification, CASE status WHEN 'completed' THEN 'out/d/test/s' || o || '/verify/verification.json' ELSE '' END AS artifact_verification FROM r")
def manifest_wide(spark, sf_dir):
    return manifest.manifest(_results(spark, sf_dir))


@query(
    _B + "SELECT idx || '_' || hash AS sample_id, to_json({'dataset_info': {'dataset_name': 'd', 'split': split, 'index': idx, 'sample_id': idx || '_' || hash, 'dataset_type': 'secvaleval'}, 'vulnerability_info': {'is_vulnerable': vul, 'cve_list': []::VARCHAR[], 'cwe_list': cwe}, 'processing_info': {'timestamp': '2024-01-01T00:00:00.000000', 'pipeline_version': '1.2'}, 'sample_data': {'func_name': 'unknown', 'filepath': '', 'hash': hash, 'project': project, 'commit_id': '', 'commit_message': '', 'changed_lines': '', 'changed_statements': '', 'fixed_func_idx': '', 'context': '', 'code_field': 'func_body'}, 'complete_sample': {'idx': idx, 'split': split, 'func_body': body, 'program_path': path, 'hash': hash, 'project': project, 'cwe_list': cwe, 'is_vulnerable': vul, 'dataset_name': 'd', 'dataset_type': 'secvaleval', 'func_name': 'unknown', 'sample_id': idx || '_' || hash}})::VARCHAR AS metadata FROM b",
    False,
)
def metadata_json(spark, sf_dir):
    rows = datasets.normalised(_bodies(spark, sf_dir).drop("testcases_name"), "d")
    return manifest.metadata(rows, "secvaleval", F.lit("2024-01-01 00:00:00").cast("timestamp"))


@query(_R + "SELECT count(*) AS total_samples, count(*) FILTER (status = 'completed') AS completed, count(*) FILTER (status <> 'completed') AS failed, count(*) FILTER (status = 'completed') / count(*) * 100 AS success_rate FROM r")
def rendering_summary(spark, sf_dir):
    rows = _results(spark, sf_dir).select(F.when(F.col("status") == "completed", 4).otherwise(0).alias("generated_count"))
    return manifest.rendering_summary(rows)


# Rendering.

_LABEL = """'<<TABLE BORDER="0" CELLBORDER="1" CELLSPACING="0" CELLPADDING="4"><TR><TD COLSPAN="2" BGCOLOR="lightblue" ALIGN="CENTER"><B>ID: ' || id || '</B></TD></TR><TR><TD COLSPAN="2" BGCOLOR="lightgray" ALIGN="CENTER"><B>' || label || '</B></TD></TR>' || """


def _row_sql(key: str, value: str) -> str:
    return f"""'<TR><TD ALIGN="LEFT"><B>{key}</B></TD><TD ALIGN="LEFT">' || replace(replace({value}, '<', '&lt;'), '>', '&gt;') || '</TD></TR>'"""


@query(
    "SELECT g AS graph_id, id AS node_id, " + _LABEL + "CASE WHEN label = 'CALL' THEN '<TR><TD ALIGN=\"LEFT\"><B>CODE</B></TD><TD ALIGN=\"LEFT\">supply(<BR/>  ' || (SELECT q FROM li WHERE li.g = node.g AND 'C' || li.g || '_' || li.r = id) || ')</TD></TR>' || " + _row_sql("NAME", "name")
    + " ELSE CASE WHEN id LIKE 'M%' THEN " + _row_sql("AST_PARENT_FULL_NAME", "'orders'") + " ELSE '' END || " + " || ".join(_row_sql(k, v) for k, v in (("FILENAME", "file"), ("FULL_NAME", "full_name"), ("IS_EXTERNAL", "external"), ("NAME", "name"))) + " END || '</TABLE>>' AS label, CASE label WHEN 'CALL' THEN '#CCCCFF' ELSE '#FFCCCC' END AS color FROM node"
)
def html_label(spark, sf_dir):
    return render.html_nodes(documents(spark, sf_dir)).select("graph_id", "node_id", "label", "color")


@query("SELECT event_id, replace(event_type, '_', '\\|') || '\\n' || 'user=' || user_id || ', kind=' || substr(ltrim(substr(props, 2), '\"'), 1, 30) AS label FROM events", False)
def html_edge_label(spark, sf_dir):
    """Labels of edges made of events: a label and three more attributes, of which two are shown."""
    rows = spark.read.parquet(f"{sf_dir}/events.parquet")
    pair = lambda k, v: F.struct(F.lit(k).alias("k"), v.cast("string").alias("v"))
    made = F.array(pair("user", F.col("user_id")), pair("Label", F.lit("x")), pair("kind", F.expr("substring(props, 2)")), pair("label", F.replace("event_type", F.lit("_"), F.lit("|"))), pair("value", F.col("value")))
    return rows.select("event_id", F.replace(F.replace(F.replace(render.edge_label(made), F.lit('\\"'), F.lit('"')), F.lit("\\{"), F.lit("{")), F.lit("\\}"), F.lit("}")).alias("label"))


@query("SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN '#FFCCCC' WHEN 1 THEN '#D2B4DE' WHEN 2 THEN '#FAFAFA' ELSE '#F5F5F5' END AS color FROM part", False)
def node_color(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/part.parquet")
    kind = F.when(F.col("p_size") % 4 == 0, "METHOD").when(F.col("p_size") % 4 == 1, "CONTROL_STRUCTURE").when(F.col("p_size") % 4 == 2, "MODIFIER").otherwise("SOMETHING")
    return rows.select("p_partkey", render.node_color(kind).alias("color"))


@query("SELECT page_id, md5(replace(replace(replace(replace(replace(replace(replace(replace(html, chr(13), ''), chr(10), ' '), '\"', '\\\"'), '{', '\\{'), '}', '\\}'), '<', '\\<'), '>', '\\>'), '|', '\\|')) AS escaped FROM pages", False)
def dot_sanitize(spark, sf_dir):
    """Page texts for quoted labels, as a digest."""
    rows = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return rows.select("page_id", F.md5(dot_escaped(F.col("html"))).alias("escaped"))


@query("SELECT page_id, md5(replace(replace(replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#x27;')) AS escaped FROM pages", False)
def html_escape(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return rows.select("page_id", F.md5(html_escaped(F.col("html"))).alias("escaped"))


def _html_document_sql() -> str:
    """Node and edge lines in the order of the text: the method, calls by line, suppliers by their first line; flow, back, calls, tree, each by line."""
    label = ORACLES["html_label"].removeprefix(G)
    edge = lambda n, a, b, kind, when="true": f"SELECT g, {n} AS part, r, '\n  \"' || {a} || '\" -> \"' || {b} || '\" [label=\"{kind}\"];' AS line FROM li WHERE {when}"
    call = "'C' || g || '_' || r"
    parts = [edge(0, f"CASE WHEN r = 1 THEN 'M' || g ELSE 'C' || g || '_' || (r - 1) END", call, "CFG"), edge(1, call, "'C' || g || '_1'", "CFG", "back"), edge(2, call, "'S' || s", "CALL"), edge(3, "'M' || g", call, "AST")]
    place = "CASE WHEN node_id LIKE 'M%' THEN 0 WHEN node_id LIKE 'C%' THEN 1 ELSE 2 END, CASE WHEN node_id LIKE 'C%' THEN split_part(node_id, '_', 2)::INT WHEN node_id LIKE 'S%' THEN (SELECT min(r) FROM li WHERE li.g = graph_id AND 'S' || li.s = node_id) ELSE 0 END"
    return (
        f", labels AS ({label}), lines AS (SELECT graph_id, {place.replace(', CASE', ' AS p1, CASE', 1)} AS p2, '\n  \"' || node_id || '\" [label=' || label || ', fillcolor=\"' || color || '\", style=\"filled\"];' AS line FROM labels)"
        f", blocks AS (SELECT graph_id, string_agg(line, '' ORDER BY p1, p2) AS t FROM lines GROUP BY graph_id), ends AS (SELECT g, string_agg(line, '' ORDER BY part, r) AS t FROM ({' UNION ALL '.join(parts)}) GROUP BY g)"
        " SELECT blocks.graph_id, 'digraph html_orders {\n  rankdir=LR;\n  node [shape=plain];\n  edge [fontname=\"Arial\", fontsize=9];\n' || blocks.t || '\n' || coalesce(ends.t, '') || '\n}' AS dot FROM blocks LEFT JOIN ends ON ends.g = blocks.graph_id"
    ).replace("\n", "' || chr(10) || '")


@query(_html_document_sql())
def html_document(spark, sf_dir):
    """Whole documents with HTML-table labels."""
    return render.html_text(documents(spark, sf_dir), "orders")


@query("SELECT o_orderkey AS graph_id, true AS dot, (SELECT count(*) FROM sub_node WHERE g = o_orderkey) AS nodes, (SELECT count(*) FROM sub_edge WHERE g = o_orderkey) AS edges FROM orders")
def subgraph_header(spark, sf_dir):
    """What the header of a subgraph's document states."""
    rows = subgraphs(spark, sf_dir)
    said = lambda n: F.regexp_extract("dot", r"// Nodes: (\d+), Edges: (\d+)", n).cast("long")
    return rows.select("graph_id", D.looks_like_dot(F.col("dot")).alias("dot"), said(1).alias("nodes"), said(2).alias("edges"))
