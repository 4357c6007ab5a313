"""What a run leaves as files: every path that the manifest names opens and holds what it should; rendering by samples; datasets and GraphML written and read again."""

import csv
import json
import os
import stat

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_checks import TEXT, _dataset

from sparkweft import cli
from sparkweft.operators import datasets
from sparkweft.plans import pipeline
from sparkweft.sources import documents, external, files, samples


def _manifest(folder):
    rows = []
    for name in sorted(os.listdir(folder)):
        if name.endswith(".csv"):
            with open(folder / name, newline="") as f:
                rows += list(csv.DictReader(f))
    return rows


def test_every_manifest_path_opens(spark, tmp_path):
    _dataset(tmp_path / "juliet")
    out = tmp_path / "out"
    (out / "juliet").mkdir(parents=True)
    (out / "juliet" / "stale").write_text("x")
    docs = spark.createDataFrame([("case10_good", TEXT, bytearray(b"g" * 1500)), ("case10_bad", "x" * 200, bytearray(b"b" * 1500)), ("case11_good", TEXT, bytearray(b"c"))], "graph_id string, dot string, cpg binary").withColumn("cpg_bytes", F.length("cpg"))
    pipeline.run(spark, str(tmp_path / "juliet"), docs, str(out), ["test", "test"])
    assert not (out / "juliet" / "stale").exists()
    rows = _manifest(out / "juliet" / "MANIFEST.csv")
    assert len(rows) == 8 and sum(r["status"] == "skipped_exists" for r in rows) == 4
    paths = {(r["sample_id"], k.removeprefix("artifact_")): r[k] for r in rows for k in r if k.startswith("artifact_") and r[k]}
    assert {k for s, k in paths if s == "case10_good"} == {"cpg", "dot", "metadata", "subgraph", "translation_unit", "udf_filtered", "udf_verification", "verification"}
    assert {k for s, k in paths if s == "case10_bad"} == {"cpg", "metadata", "translation_unit"}
    text = {}
    for key, path in paths.items():
        with open(path, "rb") as f:
            text[key] = f.read()
    assert not [f for _, _, names in os.walk(out) for f in names if f.endswith(".part")]
    assert text["case10_good", "dot"].decode() == TEXT and text["case10_good", "cpg"] == b"g" * 1500 and text["case10_bad", "translation_unit"] == b"#include <a>\n"
    short, whole = json.loads(text["case10_good", "verification"]), json.loads(text["case10_good", "udf_verification"])
    assert short["passed"] and short["original_dot"] == paths["case10_good", "dot"] and short["extracted_dot"] == paths["case10_good", "subgraph"] and short["timestamp"] > 0
    assert whole["files"] == {"original_dot": paths["case10_good", "subgraph"], "filtered_dot": paths["case10_good", "udf_filtered"]} and whole["overall_passed"]
    assert whole["counts"] == {"original_nodes": 4, "original_edges": 4, "filtered_nodes": 3, "filtered_edges": 3}
    assert set(whole["verification_results"]) == {"udf_identification", "cfg_reachability", "edge_filtering", "node_integrity"}
    assert json.loads(text["case11_bad", "metadata"])["sample_data"]["program_path"] == "a/bad/x.cpp"
    done = [r for r in rows if r["status"] == "completed"]
    assert all(float(r["duration"]) == pytest.approx(float(r["end_time"]) - float(r["start_time"])) and float(r["duration"]) > 0 for r in done)


def test_error_report(spark, tmp_path):
    """A graph for which the second checks gave nothing has the report that says so."""
    empty = spark.createDataFrame([], "graph_id string, category string, passed boolean, issues array<string>")
    from sparkweft.operators import verify

    done = spark.createDataFrame([("a", TEXT)], "graph_id string, dot string")
    at = done.select("graph_id", F.lit("o").alias("dot"), F.lit("s").alias("subgraph"), F.lit("f").alias("udf_filtered"))
    p = verify.parsed(done)
    row = pipeline._reports(done, verify.verify_subgraph(done, done), empty, p, p, at, ("CALL", "CFG")).first()
    assert json.loads(row.udf_verification) == {"verification_passed": False, "error": "the checks gave no result", "original_dot": "s", "filtered_dot": "f"}


def _script(path, text):
    path.write_text("#!/bin/sh\n" + text)
    path.chmod(path.stat().st_mode | stat.S_IXUSR)
    return str(path)


def test_rendering_by_sample(spark, tmp_path):
    """Both documents are rendered, images where the tool works; finished samples are not offered again."""
    for n in ("a", "b"):
        for part, text in (("udf/CFG_CALL_original_udf_filtered.dot", TEXT), ("subgraphs/CFG_CALL_original.dot", TEXT.replace("main", "main" + n))):
            path = tmp_path / "d" / "test" / n / part
            path.parent.mkdir(parents=True)
            path.write_text(text)
    docs = None
    for source, _ in pipeline.RENDERED:
        part = documents.read_documents(spark, str(tmp_path / "d"), source).withColumn("sample_dir", F.regexp_replace(F.regexp_replace("path", "/[^/]*/[^/]*$", ""), "^file:/+", "/")).withColumn("source", F.lit(source))
        docs = part if docs is None else docs.unionByName(part)
    tool = external.Tool((_script(tmp_path / "draw", 'grep -q mainb "$1" && exit 1; echo png > "$2"\n'), "{input}", "{output}"), ".dot", ".png", tries=1)
    rows = {r.sample_dir.rpartition("/")[2]: r for r in pipeline.render_html(docs, str(tmp_path / "d"), tool).collect()}
    assert {k: r.generated_count for k, r in rows.items()} == {"a": 4, "b": 3} and rows["a"].errors is None and len(rows["b"].errors) == 1
    made = {n: sorted(os.listdir(tmp_path / "d/test" / n / "html")) for n in ("a", "b")}
    assert made["a"] == ["CFG_CALL_original_html.dot", "CFG_CALL_original_html.png", "CFG_CALL_original_udf_filtered_udf_filtered_html.dot", "CFG_CALL_original_udf_filtered_udf_filtered_html.png"] and len(made["b"]) == 3
    assert "mainb" in (tmp_path / "d/test/b/html/CFG_CALL_original_html.dot").read_text()
    assert [r.sample_dir.rpartition("/")[2] for r in documents.renderable(spark, str(tmp_path), "d").collect()] == ["b"]
    summary = json.loads(spark.read.text(str(tmp_path / "d/HTML_GENERATION_SUMMARY.json")).first()[0])
    assert (summary["total_samples"], summary["completed"]) == (2, 2)
    assert cli.main(["html-batch", "--artifacts-root", str(tmp_path), "--dataset", "d"]) == 0


def test_tools_make_documents(spark, tmp_path):
    _dataset(tmp_path / "juliet")
    (tmp_path / "text.dot").write_text(TEXT)
    build = external.Tool((_script(tmp_path / "build", '(cat "$1"; head -c 2000 /dev/zero) > "$2"; (sleep 0.3; printf x >> "$2") &\n'), "{input}", "{output}"), ".c", ".bin", 1000, tries=1)
    export = external.Tool(("cp", str(tmp_path / "text.dot"), "{output}"), ".bin", ".dot", 100, tries=1)
    summary = pipeline.run(spark, str(tmp_path / "juliet"), None, str(tmp_path / "out"), tools=(build, export))
    assert (summary["total_samples"], summary["completed"]) == (4, 4)
    cpg = (tmp_path / "out/juliet/test/case10_good/joern/cpg.bin").read_bytes()
    assert cpg.startswith(b"#include") and cpg.endswith(b"x")  # the late byte is there: the size had to settle
    with pytest.raises(external.ToolMissing):
        pipeline.run(spark, str(tmp_path / "juliet"), None, str(tmp_path / "out"))


def test_single_file(spark, tmp_path, capfd):
    (tmp_path / "x.c").write_text("int main() { return 0; }")
    (tmp_path / "text.dot").write_text(TEXT)
    build = _script(tmp_path / "build", 'head -c 2000 /dev/zero > "$2"\n')
    assert cli.main(["process-file", str(tmp_path / "x.c"), str(tmp_path / "o"), "--build", build, "{input}", "{output}", "--export", "cp", str(tmp_path / "text.dot"), "{output}"]) == 0
    said = json.loads(capfd.readouterr().out.strip().splitlines()[-1])
    assert said["status"] == "completed" and said["udf_verification_passed"] and all(os.path.exists(p) for p in said["artifacts"].values())


def test_dataset_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([(i, "train" if i % 3 else "test", f"body {i}", ["CWE-1"]) for i in range(50)], "idx long, split string, func_body string, cwe_list array<string>")
    for _ in range(2):
        files.write_dataset(rows, str(tmp_path / "d"))
    assert samples.splits(spark, str(tmp_path / "d")) == ["test", "train"]
    back = samples.read_dataset(spark, str(tmp_path / "d"), ["train", "test"])
    assert sorted(tuple(r) for r in back.select(*rows.columns).collect()) == sorted(tuple(r) for r in rows.collect())


def test_first_file_is_bad(spark, tmp_path):
    folder = tmp_path / "j" / "split" / "test"
    folder.mkdir(parents=True)
    (folder / "0.arrow").write_bytes(b"not arrow")
    table = pa.table({"a": [1, 2]})
    with pa.OSFile(str(folder / "1.arrow"), "wb") as f, pa.ipc.new_stream(f, table.schema) as out:
        out.write_table(table)
    assert [r.a for r in samples.read_split(spark, str(tmp_path / "j"), "test").orderBy("a").collect()] == [1, 2]


def test_graphml_round_trip(spark, tmp_path):
    nodes = spark.createDataFrame([("g", "1", "METHOD", [("NAME", "a<b>&\"c\"")]), ("g", "2", "CALL", [])], "path string, node_id string, label string, attrs array<struct<k:string,v:string>>")
    edges = spark.createDataFrame([("g", "1", "2", "CFG")], "path string, src string, dst string, label string")
    (tmp_path / "g.xml").write_text(documents.write_graphml(nodes, edges).first().graphml)
    got, links = documents.read_graphml(spark, str(tmp_path / "g.xml"))
    found = {r.node_id: (r.label, {x.k: x.v for x in r.attrs}) for r in got.collect()}
    assert found == {"1": ("METHOD", {"labelV": "METHOD", "NAME": "a<b>&\"c\""}), "2": ("CALL", {"labelV": "CALL"})}
    assert [(r.src, r.dst, r.label) for r in links.collect()] == [("1", "2", "CFG")]


def test_limit_is_distributed(spark):
    rows = spark.range(1000).select((999 - F.col("id")).alias("idx"), F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("split"))
    got = datasets.first_samples(rows, ["b", "a"], 600).collect()
    assert sorted((r.split, r.idx) for r in got) == sorted([("b", i) for i in range(0, 1000, 2)] + [("a", i) for i in range(1, 200, 2)])


