"""Parsers on small documents, one for each oddity that decides equality."""

from sparkweft.functions import dot as D
from sparkweft.operators import graph, parse, profile, render
from pyspark.sql import functions as F


def docs(spark, *texts):
    return spark.createDataFrame([(f"g{i}", t) for i, t in enumerate(texts)], "graph_id string, dot string")


def edges(spark, text):
    return [tuple(r) for r in parse.edges(docs(spark, text)).orderBy("ord").select("src", "dst", "etype", "line").collect()]


def nodes(spark, text):
    return [tuple(r) for r in parse.nodes(docs(spark, text)).orderBy("ord").select("node_id", "raw").collect()]


def test_last_label_counts_and_text_may_follow(spark):
    assert [e[2] for e in edges(spark, '  "1" -> "2" [label="A" x label="CFG" y="z"]; // more')] == ["CFG"]
    assert edges(spark, '"1" -> "2" [label="CFG"]') == []


def test_edge_inside_a_node(spark):
    text = '"1" [label="CALL" CODE="\n"2" -> "3" [label="CFG" ];\nx"];\n"4" [label="X"];'
    assert [e[:3] for e in edges(spark, text)] == [("2", "3", "CFG")]
    assert [n[0] for n in nodes(spark, text)] == ["1", "4"]
    assert parse.outside_edges(docs(spark, text)).count() == 0


def test_node_like_line_inside_a_block(spark):
    text = '"1" [label="CALL" CODE="\n"2" [x\n"];\n"3" [label="Y"];'
    assert [n[0] for n in nodes(spark, text)] == ["1", "3"]
    found = lambda *ids: [r.node_id for r in parse.target_nodes(docs(spark, text), spark.createDataFrame([("g0", i) for i in ids], "graph_id string, node_id string")).orderBy("ord").collect()]
    assert found("2", "3") == ["2", "3"]
    assert found("1", "2", "3") == ["1", "3"]


def test_unterminated_and_empty(spark):
    assert nodes(spark, '"1" [label="A"];\n"2" [label="B"\nrest') == [("1", '"1" [label="A"];'), ("2", '"2" [label="B"\nrest')]
    assert nodes(spark, "") == [] and edges(spark, "") == []
    null = spark.createDataFrame([("g", None)], "graph_id string, dot string")
    assert parse.nodes(null).count() == 0 and parse.edges(null).count() == 0


def test_line_ends_and_blanks(spark):
    assert [e[:2] for e in edges(spark, ' "1" -> "2" [label="CFG"];\r\n\t"2" -> "3" [label="CFG"];\r"3" -> "4 " [label="CFG"];')] == [("1", "2"), ("2", "3"), ("3", "4 ")]


def test_names_by_leftmost_key(spark):
    raw = spark.createDataFrame([('"1" [AST_PARENT_FULL_NAME="p" NAME="n" FULL_NAME="f"];',)], "raw string")
    assert tuple(raw.select(*D.method_attributes(F.col("raw"))).select("name", "full_name").first()) == ("p", "p")
    assert tuple(raw.select(*D.method_attributes(F.col("raw"), True)).select("name", "full_name").first()) == ("n", "f")


def test_user_methods(spark):
    method = lambda n, more: f'"{n}" [label="METHOD" NAME="n" FULL_NAME="f" FILENAME="a.c" {more} X=""];\n'
    text = method(1, "") + method(2, 'IS_EXTERNAL="TRUE"') + method(3, 'AST_PARENT_FULL_NAME="a<includes>b"') + '"4" [label="METHOD" NAME="<operator>.add" FILENAME="a.c"];\n' + '"5" [label="METHOD" NAME="<global>" FILENAME="a.c"];\n'
    text += '"6" [label="METHOD" NAME="x" FILENAME="<empty>"];\n"7" [label="METHOD" NAME="x"];\n"8" [label="CALL" NAME="x" FILENAME="a.c"];\n"9" [label="METHOD" NAME="a\\"b" FILENAME="a.c"];'
    assert sorted(r.node_id for r in graph.user_methods(docs(spark, text)).collect()) == ["1", "9"]


def test_repeated_ids(spark):
    text = '"1" [label="A" X="1"];\n"1" [label="B" X="2"];'
    assert [n[0] for n in nodes(spark, text)] == ["1", "1"]
    assert [r.label for r in parse.method_nodes(parse.nodes(docs(spark, text))).collect()] == ["B"]


def test_running_pairs_and_cut_attributes(spark):
    one = lambda c: docs(spark, '"1" [label="METHOD" NAME="main" X="y"];').select(c).first()[0]
    assert [tuple(x) for x in one(D.running_pairs(F.col("dot")))] == [("label", 'METHOD" NAME="main" X="y')]
    cut = docs(spark, '"1" [label="CALL" CODE="a[i];" LINE="3"];').select(parse.attributes(F.col("dot"))).first()[0]
    assert [tuple(x) for x in cut] == [("label", "CALL"), ("CODE", '"a[i')]
    pairs = docs(spark, 'a="1\\" b=2 c="" a="3"').select(D.pairs(F.col("dot"))).first()[0]
    assert [tuple(x) for x in pairs] == [("a", "3"), ("b", "2"), ("c", "")]


def test_markers_count_nodes_too(spark):
    text = '"1" [label="CALL" X="1"];\n"1" -> "2" [label="CALL" ];\n"1" -> "3" [x="" label="CALL"];'
    assert docs(spark, text).select(D.marker_count(F.col("dot"), "CALL")).first()[0] == 2


def test_closure_strategies_agree(spark):
    links = spark.createDataFrame([("g", "1", "2"), ("g", "2", "3"), ("g", "3", "1"), ("g", "3", "4"), ("g", "9", "9"), ("h", "a", "b"), ("i", "x", "y")], "graph_id string, src string, dst string")
    seeds = spark.createDataFrame([("g", "1"), ("h", "a"), ("j", "z")], "graph_id string, node_id string")
    want = {("g", "1"), ("g", "2"), ("g", "3"), ("g", "4"), ("h", "a"), ("h", "b"), ("j", "z")}
    for strategy in ("auto", "fold", "joins"):
        got = [tuple(r) for r in graph.reachable(seeds, links, strategy).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_subgraph_documents(spark):
    text = 'digraph g {\n  "1" [label="A"];\n  "2" [label="B"\n x="y"];\n  "3" [label="C"];\n  "1" -> "2" [label="CFG" ];\n  "1" -> "9" [label="CALL" ];\n  "1" -> "3" [label="AST" ];\n}\n'
    found, kept, missing = graph.subgraph(docs(spark, text))
    assert [r.node_id for r in missing.collect()] == ["9"]
    made = render.subgraph_text(docs(spark, text), found, kept).first().dot
    assert made == (
        "digraph subgraph_CALL_CFG {\n  // Direct extraction from original DOT file\n  // Edge types: CALL, CFG\n  // Nodes: 2, Edges: 2\n\n"
        '  // Node definitions\n    "1" [label="A"];\n    "2" [label="B"\n x="y"];\n\n  // Edge definitions\n  "1" -> "2" [label="CFG" ];\n  "1" -> "9" [label="CALL" ];\n}\n'
    )


def test_exact_targets_repeat_and_subgraph_modes_agree(spark):
    text = '"1" [label="A"];\n"1" [label="B"];\n"1" -> "1" [label="CFG" ];\n'
    for exact in (False, True):
        assert graph.subgraph(docs(spark, text), exact=exact)[1].count() == 2


def test_schema_scanner():
    scan = lambda text: list(profile.scanned(text))
    assert scan('"1" [label="A" X="a\\"b;" Y=3];\n') == [{"label": "A", "X": 'a"b;', "Y": "3"}]
    assert scan('"1" [label="A" CODE="p->x"];\n"2" [label="B"\n CODE="p->x\n];" Z="1"\n];\n"3" [label="C"') == [{"label": "B", "CODE": "p->x\n];", "Z": "1"}]
    assert scan('"1" -> "2" [label="CFG"];') == []
    # A start line loses its line end, so a backslash there meets the next line's quote; on later lines it escapes the line end.
    assert scan('"1" [label="A" X="tail\\\n" Y="2"] ;') == [{"label": "A", "X": 'tail" Y='}]
    assert scan('"1" [label="A"\n X="tail\\\n" Y="2"] ;') == [{"label": "A", "X": "tail\n", "Y": "2"}]
    assert profile.attribute_pairs('a = "x\\ty" , b=c,d 9="z" e') == {"a": "x\ty", "b": "c"}


def test_type_without_keys_counts(spark):
    made = profile.file_profile(profile.node_keys(docs(spark, '"1" [label="A"];\n"2" [label="B" X="1"];', '"1" [label="A" Y="1"];'), name="graph_id"))
    assert {(r.file, r.node_type): (r["any"], r["all"]) for r in made.collect()} == {("g0", "A"): ([], []), ("g0", "B"): (["X"], ["X"]), ("g1", "A"): (["Y"], ["Y"])}
    assert [tuple(r) for r in profile.properties(made, "any").orderBy("node_type").collect()] == [("A", "Y", 1, False), ("B", "X", 1, True)]
    assert not any(r.in_all for r in profile.across_types(made, "any").collect())


def test_html(spark):
    text = '"1" [label="METHOD" B="x<y" a="1\\n2"];\n"1" -> "2" [label="CFG" z="1" y="2" x="3"];\n"2" -> "3" [k="v|w"];'
    made = render.html_text(docs(spark, text), "n").first().dot
    assert 'fillcolor="#FFCCCC"' in made and "x&lt;y" in made and "1<BR/>2" in made
    assert '"1" -> "2" [label="CFG\\nz=1, y=2"];' in made and '"2" -> "3" [label="EDGE\\nk=v\\|w"];' in made
    long = docs(spark, '"1" [label="A" X="' + "&" * 60 + '"];')
    assert ("&amp;" * 20)[:97] + "..." in render.html_nodes(long).first().label
