"""The registered queries: like SQL where there is some, else held against the data they ran on; and the pipeline."""

import collections
import os
import re
import zlib

import numpy as np
import pytest
from oracle import DATA, same
from pyspark.sql import functions as F

import corpus_pipeline
from sparkweft.llm import ann, media, mixing, neardup, packing, queries, secrets

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_like_sql(spark, name):
    assert same(queries.QUERIES[name](spark, DATA), queries.ORACLES[name]) > 0


def documents(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


def test_names():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES) == list(range(1, 11))


def test_nearest(spark):
    """Against brute force over the query's own table."""
    table = spark.read.parquet(f"{DATA}/embeddings.parquet").orderBy("vec_id").collect()
    ids, data = np.array([r.vec_id for r in table]), np.array([r.embedding for r in table], float)
    rows = queries.QUERIES["op4_nearest"](spark, DATA).collect()
    got = collections.defaultdict(list)
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        got[r.query_id].append(r)
    place = {int(x): i for i, x in enumerate(ids)}
    assert set(got) == {x for x in place if x % 20 == 0}
    hits = 0
    for q, found in got.items():
        score = data @ data[place[q]]
        assert [r.rank for r in found] == list(range(1, 21))
        assert [r.score for r in found] == pytest.approx([score[place[r.vec_id]] for r in found], abs=1e-12)
        assert [(-r.score, r.vec_id) for r in found] == sorted((-r.score, r.vec_id) for r in found)
        score[place[q]] = -np.inf
        hits += len({r.vec_id for r in found} & set(ids[np.argsort(-score)[:20]].tolist()))
    assert hits >= 0.9 * len(rows)
    products = ann.found(spark.read.parquet(f"{DATA}/embeddings.parquet"), F.col("vec_id") % 20 == 0).agg(F.sum("products")).first()[0]
    assert products < len(got) * len(ids)


def test_pack(spark):
    """Every column, by the tokenizer itself; and the fewest sequences, or nearly."""
    from tokenizers import Tokenizer

    encode = Tokenizer.from_file(packing.default_vocabulary())
    rows = queries.QUERIES["op5_pack"](spark, DATA).collect()
    total, sequences = sum(r.length for r in rows), collections.defaultdict(list)
    pieces = collections.defaultdict(dict)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id][r.piece] = r
    assert len(sequences) <= 1.01 * total / 2048 + 2
    for found in sequences.values():
        ends = np.cumsum([n for _, n in sorted(found)])
        assert [o for o, _ in sorted(found)] == [0, *ends[:-1]] and ends[-1] <= 2048
    docs = documents(spark).collect()
    assert set(pieces) == {r.doc_id for r in docs}
    for r in docs:
        ids, at = np.array([*encode.encode(r.text or "", add_special_tokens=False).ids, 0], "<u4"), 0
        own = pieces[r.doc_id]
        assert sorted(own) == list(range(-(-len(ids) // 2048)))
        for n in sorted(own):
            p = own[n]
            assert p.start == at and p.ids_crc32 == zlib.crc32(ids[at : at + p.length].tobytes()) and (n == 0 or p.length == 2048)
            at += p.length
        assert at == len(ids)


def test_held_out(spark):
    texts = {r.doc_id: r for r in documents(spark).collect()}
    for name in ("op6_toxicity", "op7_language"):
        rows = queries.QUERIES[name](spark, DATA).collect()
        assert len(rows) == len(texts)
        assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    held = [r.lang_pred == texts[r.doc_id].lang for r in rows if r.held_out]
    assert sum(held) >= 0.95 * len(held)


@pytest.mark.skipif(not os.path.isdir(f"{os.path.dirname(DATA)}/sf0.1"), reason="no larger tables")
def test_toxicity_held_out(spark):
    """Accuracy and recall on rows never learned from, where there are enough labels; some labels of these tables say toxic of texts with no word that others share."""
    larger = f"{os.path.dirname(DATA)}/sf0.1"
    rows = queries.QUERIES["op6_toxicity"](spark, larger).where("held_out")
    both = rows.join(spark.read.parquet(f"{larger}/labels.parquet").where("toxic is not null"), "doc_id").select("toxic", "predicted", "score").collect()
    caught = sum(r.predicted for r in both if r.toxic == 1)
    assert sum(r.toxic == r.predicted for r in both) >= 0.96 * len(both)
    assert caught >= 0.7 * sum(r.toxic for r in both)
    assert sum(r.predicted for r in both if r.toxic == 0) <= 0.01 * len(both)
    assert all(r.predicted == (r.score >= 0.5) for r in both)


def test_media(spark):
    """Every column from the text alone; what is stored decodes to it by a decoder that is not the writer's."""
    import hashlib

    rows = {r.doc_id: r for r in queries.QUERIES["op8_media"](spark, DATA).collect()}
    docs = documents(spark).collect()
    assert set(rows) == {r.doc_id for r in docs}
    for r in docs:
        raw, got = (r.text or "").encode(), rows[r.doc_id]
        body = raw + bytes(-len(raw) % 64 if raw else 64)
        image = media.image(body)
        assert (got.n_bytes, got.payload_bytes, got.payload_sha256, got.tail_crc32) == (len(raw), len(body), hashlib.sha256(body).hexdigest(), zlib.crc32(body[-64:]))
        assert (got.media_bytes, got.media_sha256, got.feature) == (len(image), hashlib.sha256(image).hexdigest(), media.feature(body))
        assert (got.width, got.height) == (64, len(body) // 64)


def test_near_duplicates(spark):
    from test_llm_operators import components_by_hand

    docs = documents(spark)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.QUERIES["op10_near_duplicates"](spark, DATA).collect()}
    assert got == components_by_hand([(r.doc_id, r.text) for r in docs.collect()], 2)


def test_pipeline_stage_by_stage(spark, odd, empty):
    """Each stage's decisions, on real and odd rows."""
    from test_llm_operators import components_by_hand

    extra = [(10_000 + i, t, lang, s, None) for i, (t, lang, s) in enumerate([(None, "en", "x"), ("...", "en", "x"), ("12 34", None, None), ("the house and the garden of the king", None, "x"), ("secret = 'abcdefghijklmnop' end", "en", "x")])]
    docs = documents(spark)
    docs = docs.unionByName(spark.createDataFrame(extra, docs.schema))
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language", "near_dedup", "secrets", "mix", "pack"]
    one = stages["language"](spark, docs, DATA)
    assert one.columns == docs.columns
    assert {r.doc_id for r in docs.collect()} - {r.doc_id for r in one.collect()} == {10_000, 10_001, 10_002}
    assert one.where("doc_id = 10003").first().lang is not None
    unstated = stages["language"](spark, docs.withColumn("lang", F.lit(None).cast("string")), DATA)
    assert unstated.columns == docs.columns and unstated.count() == one.count()
    two = stages["near_dedup"](spark, one, DATA)
    want = components_by_hand([(r.doc_id, r.text) for r in one.collect()], neardup.WORDS)
    assert sorted(r.doc_id for r in two.collect()) == sorted(i for i, (_, c) in want.items() if i == c)
    three = stages["secrets"](spark, two, DATA)
    assert three.count() == two.count() and secrets.scan(three).where("size(spans) > 0").count() == 0
    assert three.where("doc_id = 10004").first().text == "[SECRET]' end"
    assert all(r.n_chars == len(r.text) for r in three.collect())
    four = stages["mix"](spark, three, DATA)
    copies = {r.doc_id: r.copies for r in mixing.sampled(mixing.sampling_plan(three)).collect()}
    assert four.columns == docs.columns
    assert collections.Counter(r.doc_id for r in four.collect()) == +collections.Counter(copies)
    five = stages["pack"](spark, four, DATA).collect()
    encode = packing.encoder(packing.default_vocabulary())
    texts = {r.doc_id: r.text for r in four.collect()}
    assert sum(r.length for r in five) == sum((len(encode(t)) + 1) * copies[i] for i, t in texts.items())
    for frame in (odd, empty):
        rows = frame
        for _, stage in corpus_pipeline.STAGES:
            rows = stage(spark, rows, DATA)
        assert (rows.count() > 0) == (frame is odd)


def test_pipeline_runs(spark):
    rows = corpus_pipeline.run(spark, DATA)
    by = rows.groupBy("sequence_id").agg(F.sum("length").alias("n")).collect()
    assert rows.count() > 0 and all(r.n <= 2048 for r in by)
