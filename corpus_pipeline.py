"""A corpus pipeline: five stages over `documents`, each written as Parquet and read again by the next.

language      op 7: texts without a recognisable language (null, or no letter) go; all others stay, with
              the predicted language in `lang` where none was given.
near_dedup    op 10, on shingles of five words: one document of each group stays.
secrets       op 3: every secret is replaced by a mask; no document goes. n_chars follows the text.
mix           op 1: sources in the wanted shares; a document is repeated or left out as the sample takes it.
pack          op 5: pieces of token ids with their place in sequences of 2048 tokens.

All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkweft.llm import langid, mixing, neardup, packing, secrets
from sparkweft.llm.shared import free_prefix, own, written
from sparkweft.tables import mark, release


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; learned from the languages that docs state. If they state none, any text with a letter stays."""
    model = langid.fit(docs)
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    p = free_prefix(docs)
    found = langid.identify(docs, model, lang=f"{p}lang", score=f"{p}score").where(F.col(f"{p}lang") != langid.UNKNOWN)
    return found.withColumn("lang", F.coalesce("lang", f"{p}lang")).select(*own(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.deduplicated(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = secrets.redacted(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else clean


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows (doc_id, piece, start, length, ids_crc32, ids, sequence_id, offset)."""
    return packing.packed(docs, keep_ids=True)


STAGES = [("language", language), ("near_dedup", near_dedup), ("secrets", secret_scan), ("mix", mix), ("pack", pack)]

#: Language profiles and token ids cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents. What a stage wrote on its way is removed as soon as its result stands; of results, the last is kept."""
    docs, since = spark.read.parquet(f"{sf_dir}/documents.parquet"), mark(spark)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
        release(spark, since, keep=1)
    return docs
