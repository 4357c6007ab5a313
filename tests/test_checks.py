"""Checks pass on what the engine makes and fail on seeded faults; runs from files to tables; partitions don't matter."""

import json

import pyarrow as pa
import pytest

from sparkweft.operators import datasets, graph, manifest, render, verify
from sparkweft.plans import pipeline
from sparkweft.sources import documents, external, samples
from sparkweft.streaming import arriving
from pyspark.sql import functions as F

TEXT = """digraph g {
  "1" [label="METHOD" NAME="main" FULL_NAME="main" FILENAME="a.c" IS_EXTERNAL="false"];
  "2" [label="CALL" NAME="f"
 CODE="f(x)"];
  "3" [label="METHOD" NAME="f" FULL_NAME="f" FILENAME="a.c" IS_EXTERNAL="false"];
  "4" [label="METHOD" NAME="puts" FULL_NAME="puts" FILENAME="<includes>" IS_EXTERNAL="true"];
  "5" [label="LITERAL" X="1"];
  "1" -> "2" [label="CFG" ];
  "2" -> "1" [label="CFG" ];
  "2" -> "3" [label="CALL" ];
  "2" -> "4" [label="CALL" ];
  "1" -> "5" [label="AST" ];
}
"""


@pytest.fixture
def made(spark):
    docs = spark.createDataFrame([("a", TEXT), ("b", TEXT.replace('"4"', '"40"'))], "graph_id string, dot string")
    edges, nodes, _ = graph.subgraph(docs)
    sub = render.subgraph_text(docs, edges, nodes)
    nodes, edges, _ = graph.user_subgraph(sub)
    return docs, sub, render.user_subgraph_text(sub, edges, nodes)


def passed(checks):
    return {r.category: r.passed for r in checks.where("graph_id = 'a'").collect()}


def test_whole(made):
    docs, sub, filtered = made
    assert all(passed(verify.verify_subgraph(docs, sub)).values())
    assert all(passed(verify.verify_user_subgraph(sub, filtered)).values())
    assert '"4"' not in filtered.where("graph_id = 'a'").first().dot
    assert all(passed(verify.user_completeness(sub, filtered)).values())


@pytest.mark.parametrize(
    ("old", "new", "fails"),
    [
        ('  "1" -> "2" [label="CFG" ];\n', "", {"edges"}),
        ('"1" -> "2" [label="CFG" ];', '"1" -> "2" [label="REF" ];', {"edges"}),
        ('"2" -> "3" [label="CALL" ];', '"2" -> "3" [label="CALL" ];\n  "2" -> "3" [label="CALL" ];', {"edges"}),
        ('"3" [label="METHOD"', '"33" [label="METHOD"', {"nodes"}),
        ('NAME="f"\n', 'NAME="g"\n', {"attributes"}),
    ],
)
def test_subgraph_faults(made, old, new, fails):
    docs, sub, _ = made
    checks = passed(verify.verify_subgraph(docs, sub.withColumn("dot", F.replace("dot", F.lit(old), F.lit(new)))))
    assert {k for k, v in checks.items() if not v} == fails


@pytest.mark.parametrize(
    ("old", "new", "fails"),
    [
        ('"3" [label="METHOD"', '"3" [label="METHODS"', {"udf_identification", "node_integrity"}),
        ('  "1" -> "2" [label="CFG" ];\n', '  "1" -> "8" [label="CFG" ];\n', {"edge_filtering"}),
        ('CODE="f(x)"', 'CODE="f(y)"', {"node_integrity"}),
        ("\n\n  // Edge", '\n  "9" [label="CALL" ];"];\n\n  // Edge', {"cfg_reachability", "node_integrity"}),
        ('"2" -> "3" [label="CALL" ];', '"2" -> "4" [label="CALL" ];', {"edge_filtering"}),
    ],
)
def test_filter_faults(made, old, new, fails):
    _, sub, filtered = made
    checks = passed(verify.verify_user_subgraph(sub, filtered.withColumn("dot", F.replace("dot", F.lit(old), F.lit(new)))))
    assert {k for k, v in checks.items() if not v} == fails


def test_report_and_difference(spark, made):
    _, sub, filtered = made
    counts = sub.select("graph_id", F.lit(4).alias("original_nodes"))
    report = json.loads(verify.report(verify.verify_user_subgraph(sub, filtered), counts).first().report)
    assert report["overall_passed"] and report["counts"] == {"original_nodes": 4} and len(report["verification_results"]) == 4
    rows = spark.createDataFrame([("abcd", "abxd"), ("ab", "abc")], "a string, b string")
    assert [r.d and r.d.position for r in rows.select(verify.first_difference(F.col("a"), F.col("b")).alias("d")).collect()] == [2, None]


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_partitions_do_not_matter(spark, made, parts):
    docs, sub, _ = made
    again = docs.repartition(parts)
    edges, nodes, _ = graph.subgraph(again)
    assert sorted(map(tuple, render.subgraph_text(again, edges, nodes).collect())) == sorted(map(tuple, sub.collect()))


def _dataset(folder):
    for split, first in (("train", 0), ("test", 10)):
        (folder / "split" / split).mkdir(parents=True)
        for n in range(2):
            table = pa.table({"testcases_name": [f"case{first + n}"] * 2, "program_path": ["a/good/x.c", "a/bad/x.cpp"], "whole_program_body": ["int f;", "#include <a>\n"], "is_vulnerable": [False, True]})
            with pa.OSFile(str(folder / "split" / split / f"{n}.arrow"), "wb") as f, pa.ipc.new_stream(f, table.schema) as out:
                out.write_table(table)
    (folder / "split" / "test" / "zz.arrow").write_bytes(b"not arrow")


def test_run(spark, tmp_path):
    _dataset(tmp_path / "juliet")
    name = str(tmp_path / "juliet")
    assert samples.splits(spark, name) == ["test", "train"] and samples.splits(spark, str(tmp_path)) == ["train"]
    assert samples.read_split(spark, name, "none") is None
    rows = datasets.normalised(samples.read_dataset(spark, name, ["test"]), "juliet")
    assert [r.sample_id for r in rows.orderBy("idx").collect()] == ["case10_good", "case10_bad", "case11_good", "case11_bad"]
    docs = spark.createDataFrame([("case10_good", TEXT), ("case10_bad", "x" * 200), ("case11_good", TEXT)], "graph_id string, dot string")
    summary = pipeline.run(spark, name, docs, str(tmp_path / "out"))
    assert (summary["total_samples"], summary["completed"], summary["failed"]) == (4, 2, 2)
    results = {r.sample_id: r for r in spark.read.parquet(str(tmp_path / "out/juliet/results")).collect()}
    assert results["case10_good"].verification_passed and results["case10_good"].udf_verification_passed
    assert (results["case10_bad"].status, results["case10_bad"].stage) == ("failed", "joern_dot")
    assert results["case11_bad"].stage == "joern_cpg" and set(results["case11_bad"].artifacts) == {"metadata", "translation_unit"}
    wide = spark.read.option("header", "true").csv(str(tmp_path / "out/juliet/MANIFEST.csv"))
    assert wide.columns == [*manifest.COLUMNS, *(f"artifact_{k}" for k in sorted(manifest.ARTIFACTS))]
    assert pipeline.run(spark, name, docs, str(tmp_path / "out"), ["none"]) == {"status": "no_samples"}
    metadata = json.loads(spark.read.parquet(str(tmp_path / "out/juliet/metadata")).where("sample_id = 'case10_bad'").first().metadata)
    assert metadata["dataset_info"]["dataset_type"] == "juliet" and metadata["sample_data"]["program_path"] == "a/bad/x.cpp"


def test_artifact_tree_and_report(spark, tmp_path):
    for n in ("a", "a-b"):
        for part in ("udf/CFG_CALL_original_udf_filtered.dot", "subgraphs/CFG_CALL_original.dot"):
            path = tmp_path / "d" / "test" / n / part
            path.parent.mkdir(parents=True)
            path.write_text(TEXT)
    done = tmp_path / "d/test/a/html"
    done.mkdir()
    for n in range(4):
        (done / f"{n}.png").write_text("x")
    assert [r.sample_dir.rpartition("/")[2] for r in documents.renderable(spark, str(tmp_path), "d").collect()] == ["a-b"]
    docs = documents.read_documents(spark, str(tmp_path))
    assert {r.graph_id for r in docs.collect()} == {f"d/test/{n}/udf/CFG_CALL_original_udf_filtered.dot" for n in ("a", "a-b")}
    pipeline.schema_report(docs, str(tmp_path / "report"))
    kinds = json.loads(spark.read.text(str(tmp_path / "report/node_types.json")).first()[0])
    assert kinds["intersectional_types"] == ["CALL", "LITERAL", "METHOD"] and kinds["non_intersectional_types"] == []
    cross = json.loads(spark.read.text(str(tmp_path / "report/properties_cross_types.json")).first()[0])
    assert cross["lenient"]["coverage"]["CODE"] == ["CALL"] and "NAME" in cross["lenient"]["union_across_types"]


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.dot").write_text(TEXT)
    for n in range(2):
        arriving.process_arriving(arriving.arriving(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "state"), once=True).awaitTermination()
        (tmp_path / "in/b.dot").write_text(TEXT)
    assert spark.read.parquet(str(tmp_path / "out/filtered")).count() == 2


def test_tools(spark):
    rows = spark.createDataFrame([("a", "x"), ("b", None)], "k string, c string")
    copy = external.Tool(("cp", "{input}", "{output}"), ".txt", ".txt", tries=1)
    assert {r.k: (r.output and bytes(r.output), r.error) for r in external.run_tool(rows, "k", "c", copy).collect()} == {"a": (b"x", ""), "b": (None, "output missing or too small")}
    with pytest.raises(external.ToolMissing):
        external.Tool(("no-such-program",), "", "").checked()


def test_graphml(spark, tmp_path):
    (tmp_path / "g.xml").write_text('<graphml><graph><node id="1"><data key="labelV">METHOD</data><data key="NAME">f</data></node><node id="2"><data key="labelV">CALL</data></node><edge source="1" target="2"><data key="labelE">CFG</data></edge></graph></graphml>')
    nodes, edges = documents.read_graphml(spark, str(tmp_path / "g.xml"))
    assert sorted((r.node_id, r.label) for r in nodes.collect()) == [("1", "METHOD"), ("2", "CALL")]
    assert [(r.src, r.dst, r.label) for r in edges.collect()] == [("1", "2", "CFG")]


def test_short_documents(made):
    docs, sub, _ = made
    at = lambda name: F.concat(F.col("graph_id"), F.lit(name))
    short = json.loads(verify.verification(verify.verify_subgraph(docs, sub), at("/a"), at("/b")).where("graph_id = 'a'").first().verification)
    assert short == {"passed": True, "timestamp": 0.0, "original_dot": "a/a", "extracted_dot": "a/b", "edge_types": ["CALL", "CFG"]}
    assert json.loads(verify.failed_report(docs, F.lit("bad"), at("/a"), at("/b")).first().report)["error"] == "bad"


def test_splits_keep_groups(spark):
    for pairs, sizes in ((2455, (3436, 736, 738)), (562, (786, 168, 170))):
        rows = spark.range(2 * pairs).select(F.concat(F.lit("t"), F.floor(F.col("id") / 2).cast("string")).alias("testcases_name"))
        made = datasets.pair_split(datasets.test_case_groups(rows))
        got = {r["split"]: r["count"] for r in made.groupBy("split").count().collect()}
        assert (got["train"], got["validation"], got["test"]) == sizes
        assert made.select("group", "split").distinct().count() == pairs


def test_first_of_id(spark):
    rows = spark.createDataFrame([("x", 0), ("x", 1), ("y", 2)], "sample_id string, idx long")
    assert [r.again for r in datasets.first_of_id(rows, [F.col("idx")]).orderBy("idx").collect()] == [False, True, False]


def test_command_line(tmp_path, spark):
    from sparkweft import cli

    (tmp_path / "g.dot").write_text(TEXT)
    assert cli.main(["subgraph", str(tmp_path / "g.dot"), str(tmp_path)]) == 0
    sub = str(tmp_path / "CALL_CFG_g.dot")
    assert cli.main(["verify-subgraph", str(tmp_path / "g.dot"), sub]) == 0
    assert cli.main(["filter", sub, str(tmp_path)]) == 0
    assert cli.main(["verify-filter", sub, str(tmp_path / "CALL_CFG_g_udf_filtered.dot"), "--output-report", str(tmp_path / "r.json")]) == 0
    assert json.loads((tmp_path / "r.json").read_text())["overall_passed"]
    assert cli.main(["verify-subgraph", sub, str(tmp_path / "g.dot")]) == 1
    assert cli.main(["html", sub, str(tmp_path)]) == 0
