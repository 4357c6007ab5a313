"""Results of a run: status of every sample, manifest, summaries and metadata documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dot import looks_like_dot, marker_count
from ..functions.samples import hash_prefix

VERSION = "1.2"
#: Columns of the manifest, and the artifacts that a sample can have.
COLUMNS = (
    "sample_id", "split", "idx", "hash", "func_name", "is_vulnerable", "status", "stage", "verification_passed",
    "udf_verification_passed", "duration", "error_message", "start_time", "end_time",
)
ARTIFACTS = ("cpg", "dot", "metadata", "subgraph", "translation_unit", "udf_filtered", "udf_verification", "verification")
#: Least sizes in bytes of the files of the external tool.
LEAST_CPG, LEAST_DOT = 1000, 100


def outcome(again: Column, cpg_bytes: Column, document: Column) -> Column:
    """(status, stage, error_message) of a sample: whether its id came before, and what the external tool left. The texts are fixed values."""
    said = lambda status, stage, text: F.struct(F.lit(status).alias("status"), F.lit(stage).alias("stage"), (text if isinstance(text, Column) else F.lit(text)).alias("error_message"))
    size = F.coalesce(cpg_bytes, F.lit(0))
    length = F.coalesce(F.octet_length(document), F.lit(0))
    small = lambda what, n: F.concat(F.lit(f"Joern {what} failed - file missing or too small ("), n.cast("string"), F.lit(" bytes)"))
    return (
        F.when(again, said("skipped_exists", "final_check", "Final artifacts already exist"))
        .when(size < LEAST_CPG, said("failed", "joern_cpg", small("CPG generation", size)))
        .when(length < LEAST_DOT, said("failed", "joern_dot", small("DOT export", length)))
        .when(~looks_like_dot(document), said("failed", "joern_dot", "Joern DOT export failed - invalid DOT format (missing digraph)"))
        .otherwise(said("completed", "udf_complete", ""))
    )


def debug_info(document: Column) -> Column:
    """Counts of edge markers; nodes whose first attribute is such a label count too."""
    flow, calls = marker_count(document, "CFG"), marker_count(document, "CALL")
    return F.struct(flow.alias("cfg_edges"), calls.alias("call_edges"), (flow > 0).alias("has_cfg"), (calls > 0).alias("has_call"))


def artifact_paths(root: Column, stage: Column, extension: Column) -> Column:
    """The artifacts of a sample in its folder, by how far it came; the last stages have all."""
    order = ["create_metadata", "create_tu", "joern_cpg", "joern_dot", "udf_complete"]
    reached = lambda n: F.array_position(F.array(*map(F.lit, order)), stage) > n
    parts = [
        ("metadata", F.lit("metadata.json"), F.lit(True)),
        ("translation_unit", F.concat(F.lit("src/unit."), extension), reached(2)),
        ("cpg", F.lit("joern/cpg.bin"), reached(3)),
        ("dot", F.lit("joern/dot_files/all/export.dot"), reached(4)),
        ("subgraph", F.lit("subgraphs/CFG_CALL_original.dot"), reached(4)),
        ("verification", F.lit("verify/verification.json"), reached(4)),
        ("udf_filtered", F.lit("udf/CFG_CALL_original_udf_filtered.dot"), reached(4)),
        ("udf_verification", F.lit("udf/udf_verification.json"), reached(4)),
    ]
    entries = F.array_compact(F.array(*(F.when(there, F.struct(F.lit(k), F.concat(root, F.lit("/"), path))) for k, path, there in parts)))
    return F.map_from_entries(entries)


def manifest(results: DataFrame, artifacts: Sequence[str] | None = ARTIFACTS) -> DataFrame:
    """A row a result: the columns of the manifest, and artifact_<key> for each artifact, empty where there is none.

    With artifacts None the keys are those that some result has, found by a pass over the results.
    """
    if artifacts is None:
        artifacts = [r[0] for r in results.select(F.explode(F.map_keys("artifacts")).alias("k")).distinct().orderBy("k").collect()]  # names of artifacts: a few
    known = set(results.columns)
    plain = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) if c in known else F.lit("").alias(c) for c in COLUMNS]
    return results.select(*plain, *(F.coalesce(F.try_element_at("artifacts", F.lit(k)), F.lit("")).alias(f"artifact_{k}") for k in sorted(artifacts)))


def run_summary(results: DataFrame, seconds: float | None = None) -> DataFrame:
    """One row: totals, the share completed, and samples a second if seconds are given."""
    total = F.count(F.lit(1))
    done = F.count_if(F.col("status") == "completed")
    skipped = F.count_if(F.startswith("status", F.lit("skipped")))
    out = results.agg(
        total.alias("total_samples"), done.alias("completed"), (total - done - skipped).alias("failed"), skipped.alias("skipped"),
        F.when(total > 0, done / total).otherwise(F.lit(0.0)).alias("success_rate"),
    )
    return out if seconds is None else out.withColumn("total_time", F.lit(seconds)).withColumn("samples_per_second", F.col("total_samples") / F.lit(seconds))


def rendering_summary(results: DataFrame) -> DataFrame:
    """One row on rendering: totals, with the success rate in percent. A sample fails if nothing was generated."""
    total, done = F.count(F.lit(1)), F.count_if(F.col("generated_count") > 0)
    return results.agg(total.alias("total_samples"), done.alias("completed"), (total - done).alias("failed"), F.when(total > 0, done / total * 100).otherwise(F.lit(0.0)).alias("success_rate"))


def result_rows(samples: DataFrame, *more: str) -> DataFrame:
    """The fields of samples that go into results, and more columns."""
    return samples.select("sample_id", "split", F.col("idx").cast("string").alias("idx"), hash_prefix(F.col("hash")).alias("hash"), "func_name", F.coalesce("is_vulnerable", F.lit(False)).alias("is_vulnerable"), *more)


#: What sample_data holds by dataset type.
DATA_FIELDS = {
    "juliet": ("testcases_name", "originated_program_path", "program_path"),
    "secvaleval": ("func_name", "filepath", "hash", "project", "commit_id", "commit_message", "changed_lines", "changed_statements", "fixed_func_idx", "context"),
    "unknown": (),
}


def metadata(samples: DataFrame, kind: str, stamp: Column | None = None) -> DataFrame:
    """(sample_id, metadata): the JSON document of each normalised sample, nulls kept, with the whole sample."""
    have = set(samples.columns)
    field = lambda name, default: F.col(name) if name in have else default
    none = F.array().cast("array<string>")
    info = F.struct(F.col("dataset_name"), F.col("split"), F.col("idx").alias("index"), F.col("sample_id"), F.lit(kind).alias("dataset_type"))
    vulnerability = F.struct(field("is_vulnerable", F.lit(False)).alias("is_vulnerable"), field("cve_list", none).alias("cve_list"), field("cwe_list", none).alias("cwe_list"))
    processing = F.struct(F.date_format(stamp if stamp is not None else F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"), F.lit(VERSION).alias("pipeline_version"))
    code = "whole_program_body" if kind == "juliet" else "func_body"
    data = F.struct(*(field(n, F.lit("")).alias(n) for n in DATA_FIELDS[kind]), F.lit(code).alias("code_field"))
    whole = F.struct(*(F.col(c) for c in samples.columns))
    body = F.struct(info.alias("dataset_info"), vulnerability.alias("vulnerability_info"), processing.alias("processing_info"), data.alias("sample_data"), whole.alias("complete_sample"))
    return samples.select("sample_id", F.to_json(body, {"ignoreNullFields": "false"}).alias("metadata"))
