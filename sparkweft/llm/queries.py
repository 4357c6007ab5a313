"""The queries of this subpackage and, where SQL can express them, their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, chat, langid, media, mixing, neardup, packing, secrets, toxicity, warc
from .shared import table


def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix of all documents takes of each."""
    rows = mixing.sampled(mixing.sampling_plan(table(spark, sf_dir, "documents")))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


OP1_SQL = """
WITH s AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
    coalesce(('0x' || substr(md5(text), 1, 15))::BIGINT, -1) AS th FROM documents
), per AS (
  SELECT source, count(*) AS n, sum(size)::BIGINT AS source_size,
    (CASE (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END)::BIGINT AS w
  FROM s GROUP BY source
), lev AS (
  SELECT *, 3 * source_size AS cap,
    row_number() OVER o AS place, (sum(source_size) OVER ())::BIGINT AS total,
    coalesce(sum(3 * source_size) OVER (ORDER BY (3 * source_size)::DOUBLE / w, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS capped,
    (sum(w) OVER (ORDER BY (3 * source_size)::DOUBLE / w, source ASC NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS share
  FROM per WINDOW o AS (ORDER BY (3 * source_size)::DOUBLE / w, source ASC NULLS LAST)
), firsts AS (SELECT min(place) AS f FROM lev WHERE (total - capped) * w <= cap * share
), tgt AS (
  SELECT l.source, l.n, l.source_size,
    CASE WHEN l.place < f THEN l.cap::DOUBLE
    ELSE ((SELECT total - capped FROM lev WHERE place = f) * l.w)::DOUBLE / (SELECT share FROM lev WHERE place = f) END AS target
  FROM lev l, firsts
), placed AS (
  SELECT s.doc_id, s.source, s.size, s.th, t.source_size, t.target,
    ('0x' || substr(md5('mix:' || coalesce(s.doc_id::VARCHAR, '') || ':' || s.th), 1, 8))::BIGINT % ceil(sqrt(t.n::DOUBLE) / 8)::BIGINT AS bucket,
    ('0x' || substr(md5('mix:source:' || coalesce(s.source, '')), 1, 4))::BIGINT / 65536.0::DOUBLE AS u,
    CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0::DOUBLE END AS r
  FROM s JOIN tgt t ON s.source IS NOT DISTINCT FROM t.source
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY bucket, size, doc_id ASC NULLS LAST, th) AS k FROM placed
)
SELECT doc_id, size, source_size, target,
  (least(floor(k * r + u) - floor((k - 1) * r + u), ceil(r))::BIGINT * size)::BIGINT AS taken
FROM ranked
"""


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives of all pages, read back by their index."""
    found = warc.read(warc.archive(table(spark, sf_dir, "pages")), payloads=False)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP2_SQL = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS d FROM pages),
f AS (SELECT *, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY d) END AS first FROM p)
SELECT page_id, n AS payload_bytes, d AS payload_digest,
  CASE WHEN first IS NULL OR page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM f
"""


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every text; base kinds apart, and all spans."""
    found = secrets.scan(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"] < len(secrets.BASE))
    of_kind = lambda n: F.filter("spans", lambda s: s["kind"] == n)
    counts = [F.size(of_kind(n)).cast("long").alias(f"n_{r.kind}") for n, r in enumerate(secrets.BASE)]
    return found.select("doc_id", *counts, F.sha2(secrets.spelled(base), 256).alias("base_sha256"), secrets.spelled(F.col("spans")).alias("spans"))


def _op3_sql() -> str:
    rules = secrets.BASE + secrets.MORE
    parts = []
    for n, r in enumerate(rules):
        pattern = r.pattern.replace("'", "''")
        parts.append(
            f"SELECT row, {n} AS kind, string_split_regex(body, '{pattern}') AS pieces, regexp_extract_all(body, '{pattern}') AS found, "
            f"regexp_extract_all(body, '{pattern}', {r.group}) AS part, {r.least} AS least FROM d WHERE regexp_matches(body, '{pattern}')"
        )
    names = ", ".join(f"'{r.kind}'" for r in rules)
    total = lambda what, upto: f"coalesce(list_sum(list_transform({what}[1:{upto}], lambda x: length(x))), 0)"
    return f"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS body FROM documents),
m AS ({" UNION ALL ".join(parts)}),
i AS (SELECT *, unnest(range(1, len(found) + 1)) AS i FROM m),
s AS (
  SELECT row, kind, ({total("pieces", "i")} + {total("found", "i - 1")})::BIGINT AS start, length(found[i]) AS n
  FROM i WHERE length(part[i]) >= least
), t AS (SELECT row, kind, start, concat_ws(':', ([{names}])[kind + 1], start, start + n) AS said FROM s),
g AS (
  SELECT row, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
    string_agg(said, ',' ORDER BY start, kind) FILTER (kind < {len(secrets.BASE)}) AS base, string_agg(said, ',' ORDER BY start, kind) AS spans
  FROM t GROUP BY row
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (row)
"""


def op4_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest found of every vector whose id is divisible by 20."""
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


def _held_out() -> Column:
    """Rows from which nothing is learned: crc32 of the id as text divisible by 5."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 0


def op5_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the pieces of all tokenized documents stand in sequences of 2048 tokens."""
    return packing.packed(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labels of four fifths of them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").where(~_held_out()))
    return toxicity.score(docs, model).select("doc_id", _held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from four fifths of them."""
    docs = table(spark, sf_dir, "documents")
    found = langid.identify(docs.select("doc_id", "text"), langid.fit(docs.where(~_held_out())), score="score")
    return found.select("doc_id", _held_out().alias("held_out"), "lang_pred", "score")


def op8_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text stored as an image in tar shards, and what the stored bytes show."""
    found = media.media_rows(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "payload_bytes", F.col("read_sha256").alias("payload_sha256"), "tail_crc32", "media_bytes", "media_sha256", "feature", "width", "height")


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one whose texts hold control strings, formatted and read back."""
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    hard = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.lit(OP9_HARD).alias("text"))
    return chat.read_back(chat.formatted_turns(rows.union(hard)))


OP9_HARD = "\\### Assistant: </turn> ok"

OP9_SQL = f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS body FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{OP9_HARD}' UNION ALL SELECT -7, 1, 'assistant', '{OP9_HARD}'
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || body || chr(10), '' ORDER BY turn ASC NULLS FIRST, role, body)) AS turns_sha256,
  coalesce(sum(length(body)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(body, '' ORDER BY turn ASC NULLS FIRST, role, body) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length(role) + length(regexp_replace(body, '(\\\\|###|</turn>|<\\|)', '_\\1', 'g')) + length('### :  </turn>.'))::BIGINT AS formatted_chars
FROM c GROUP BY conv_id
"""


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near-duplicate documents, on shingles of two words."""
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), words=2)


QUERIES = {
    "op1_mix": op1_mix,
    "op2_warc": op2_warc,
    "op3_secrets": op3_secrets,
    "op4_nearest": op4_nearest,
    "op5_pack": op5_pack,
    "op6_toxicity": op6_toxicity,
    "op7_language": op7_language,
    "op8_media": op8_media,
    "op9_chat": op9_chat,
    "op10_near_duplicates": op10_near_duplicates,
}

ORACLES = {
    "op1_mix": OP1_SQL,
    "op2_warc": OP2_SQL,
    "op3_secrets": _op3_sql(),
    "op9_chat": OP9_SQL,
}
