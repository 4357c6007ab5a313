"""Columns of other people: stages and operators that carry rows keep every column, whatever its name, and rows that share an id have one defined result."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sparkweft.llm import mixing, neardup, secrets, warc
from sparkweft.llm.shared import free_prefix, own

CLASHING = [
    "_id", "_doc", "_rules", "_spans", "spans", "_mix_total", "_mix_rows", "_mix_doc_id", "_mix_nth", "_pred", "_score", "_LANG", "lang_pred", "lang_score", "__id", "_total", "_nth", "_row", "row", "rows", "size", "target",
    "copies", "kept", "component_id", "n_shingles", "rep", "token", "trigram", "doc", "text_hash", "bucket", "of", "at", "a.b", "with space", "tick`tick", "_", "__", "ids", "key",
]


@pytest.mark.parametrize("stage", [n for n, _ in corpus_pipeline.STAGES[:-1]])
def test_stages_keep_columns_of_any_name(spark, odd, stage):
    docs = odd.select("*", *(F.concat(F.lit(f"{name} of "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))).alias(name) for name in CLASHING))
    made = dict(corpus_pipeline.STAGES)[stage](spark, docs, "")
    assert made.columns == docs.columns
    rows = made.collect()
    assert rows
    for r in rows:
        values = tuple(r)[len(odd.columns) :]
        assert values == tuple(f"{name} of {'none' if r.doc_id is None else r.doc_id}" for name in CLASHING)


def test_free_prefix(spark):
    docs = spark.createDataFrame([(1, 2, 3)], "`_A` int, `__b` int, `c.d` int")
    assert free_prefix(docs) == "___" and docs.select(*own(docs)).columns == ["_A", "__b", "c.d"]


def test_repeated_rows_have_one_defined_result(spark):
    rows = [(1, "a b c d e f", "x", n) for n in (3, 1, 2)] + [(2, "p q r s t u", "x", 9)]
    for order in (rows, rows[::-1]):
        docs = spark.createDataFrame(order, "doc_id long, text string, source string, extra long")
        assert sorted((r.doc_id, r.extra) for r in neardup.deduplicated(docs).collect()) == [(1, 1), (2, 9)]
        assert {r.extra for r in mixing.mixed(docs).where("doc_id = 1").collect()} == {1}


def test_rows_without_id_are_dealt_over_buckets(spark):
    docs = spark.range(20_000).select(F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("w "), "id").alias("text"), F.lit("s").alias("source"))
    plan = mixing.sampling_plan(docs)
    assert plan.select("before").distinct().count() == 20_000
    assert plan.agg(F.max("rows")).first()[0] == 1


def test_more_rules_and_trigrams_than_bits(spark):
    rules = [secrets.Rule(f"k{i}", f"key{i:03d}[0-9]{{4,}}") for i in range(90)]
    docs = spark.createDataFrame([(i, f"some key{i:03d}{'7' * 5} here") for i in range(90)] + [(None, None), (500, "x" * 9000 + "KEY004 key0041234" + "y" * 9000)], "doc_id long, text string")
    found = {r.doc_id: [(s.start, s.kind, s.end) for s in r.spans] for r in secrets.scan(docs, rules).collect()}
    assert all(found[i] == [(5, i, 16)] for i in range(90)) and found[None] == []
    assert found[500] == [(9007, 4, 9017)]


def test_an_index_serves_later_rules(spark, odd):
    """Made once of the texts' own trigrams, whatever is asked of it afterwards."""
    key = secrets.document_key()
    index = secrets.inverted_index(odd, F.coalesce("text", F.lit("")), key).persist()
    long = odd.where("doc_id = 7").select(key.alias("k"), F.lower("text").alias("t")).first()
    assert {r.trigram for r in index.where(F.col("doc") == long.k).collect()} == {long.t[i : i + 3] for i in range(len(long.t) - 2)}
    rules = [secrets.Rule("fox", "quick (brown|red) fox"), secrets.Rule("w", "wort9[0-9]+")]
    assert sorted(map(str, secrets.scan(odd, rules, index=index).collect())) == sorted(map(str, secrets.scan(odd, rules).collect()))
    index.unpersist()


@pytest.mark.parametrize("url", ["http://x/ä b", "http://x/%C3%A4", "a\r\nb: c", "", None, "http://x/?q=1&r=%20"])
def test_urls_come_back_as_given(url):
    made = warc.record(1, url, b"x", "2d711642b726b04401627ca9fbac32f5c8530fb1903cc4db02258717921a4881", None)
    assert warc.parsed(made)["url"] == url
