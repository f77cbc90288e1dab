"""The ``opN_*`` queries: each applies its operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimcheck.llm import chat, mixing, nndescent, packing, pii, rpforest, setsketch, spm, toxicity, warc


DEMO_KEY = "claimcheck-demo-key"  # of the test queries; real data needs a secret of its own


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one of control strings, formatted and read back from the ids."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return chat.read_back(chat.format_conversations(rows.unionByName(own)), ordered=True)


def op2_setsketch_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose 2-word shingle sets have a similarity of 0.8 or more."""
    out = setsketch.near_duplicates(table(spark, sf_dir, "documents"), shingle_words=2, num=80, den=100)
    kept = F.col("id").eqNullSafe(F.col("component_id"))
    return out.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", kept.alias("kept"))


def op3_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with pseudonyms for personal data, and how many of each kind."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymise(docs, DEMO_KEY)


def op4_forest_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of embeddings of one label with a cosine of 0.93 or more."""
    out = rpforest.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.93)
    return out.select(F.col("id").alias("vec_id"), "n_links", "component_id", "kept")


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document and whether they decode to its text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = spm.encode(docs, check_col="round_trip")
    return out.select("doc_id", F.size("ids").cast("long").alias("n_ids"), "round_trip", "ids")


def op6_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents mixed with sources weighing the root of their size, shuffled globally."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    return mixing.mix(docs)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' token ids packed into rows of 2048."""
    return packing.pack(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC records and read back by looking up their URLs in the capture index."""
    pages = table(spark, sf_dir, "pages")
    out = warc.archive(pages).lookup(pages)
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = toxicity.detect(docs, table(spark, sf_dir, "labels"))
    held = F.crc32(F.col("id").cast("string")) % 5 == 0
    return out.select(F.col("id").alias("doc_id"), F.coalesce(held, F.lit(False)).alias("held_out"), "score", "predicted", F.size("spans").alias("n_spans"))


def op10_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest rows of every hundredth embedding."""
    vectors = table(spark, sf_dir, "embeddings")
    return nndescent.nearest(vectors, vectors.where("vec_id % 100 = 0"), top=10)


QUERIES = {
    "op1_chat_format": op1_chat_format,
    "op2_setsketch_near_dedup": op2_setsketch_near_dedup,
    "op3_pii_pseudonyms": op3_pii_pseudonyms,
    "op4_forest_near_dedup": op4_forest_near_dedup,
    "op5_sentencepiece": op5_sentencepiece,
    "op6_poisson_mix": op6_poisson_mix,
    "op7_packing": op7_packing,
    "op8_warc_index": op8_warc_index,
    "op9_toxicity": op9_toxicity,
    "op10_nn_descent": op10_nn_descent,
}

ORACLE_SQL: dict[str, str] = {
    "op1_chat_format": r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
),
e AS (
  SELECT *, regexp_replace(text, '(<s>|</s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>|\[ROLE\]|\[/ROLE\])', '\\\1', 'g') AS esc FROM c
)
SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(3 + sum(length(esc) + CASE role WHEN 'user' THEN 16 WHEN 'system' THEN 18 WHEN 'assistant' THEN 5 ELSE 21 + length(role) END) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id""",
    "op2_setsketch_near_dedup": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
),
sh AS (
  SELECT doc_id, CASE len(w) WHEN 0 THEN CAST([] AS VARCHAR[]) WHEN 1 THEN w ELSE list_distinct([w[i] || ' ' || w[i + 1] for i in range(1, len(w))]) END AS s FROM w
),
flat AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sh),
link AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM flat a JOIN flat b ON a.x = b.x AND a.doc_id <> b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
),
reach AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON l.a = r.b),
low AS (SELECT a, min(b) AS m FROM reach GROUP BY a)
SELECT sh.doc_id, CAST(len(s) AS BIGINT) AS n_shingles, least(sh.doc_id, coalesce(m, sh.doc_id)) AS component_id, sh.doc_id <= coalesce(m, sh.doc_id) AS kept
FROM sh LEFT JOIN low ON low.a = sh.doc_id""",
    "op4_forest_near_dedup": """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
n AS (SELECT *, sqrt(list_dot_product(e, e)) AS z FROM v),
link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM n a JOIN n b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_dot_product(a.e, b.e) / (a.z * b.z) >= 0.93::DOUBLE
),
reach AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON l.a = r.b),
low AS (SELECT a, min(b) AS m FROM reach GROUP BY a),
deg AS (SELECT a, count(*) AS k FROM link GROUP BY a)
SELECT e.vec_id, coalesce(k, 0) AS n_links, least(e.vec_id, coalesce(m, e.vec_id)) AS component_id, e.vec_id <= coalesce(m, e.vec_id) AS kept
FROM embeddings e LEFT JOIN low ON low.a = e.vec_id LEFT JOIN deg ON deg.a = e.vec_id""",
    "op6_poisson_mix": mixing.oracle_sql(),
    "op8_warc_index": """
WITH h AS (SELECT page_id, coalesce(html, '') AS p, sha1(coalesce(html, '')) AS x FROM pages),
b AS (
  SELECT *, array_to_string([['0000', '0001', '0010', '0011', '0100', '0101', '0110', '0111', '1000', '1001', '1010', '1011', '1100', '1101', '1110', '1111'][instr('0123456789abcdef', c)]
    for c in string_split(x, '')], '') AS bits, min(page_id) OVER (PARTITION BY x) AS first
  FROM h
)
SELECT page_id, CAST(strlen(p) AS BIGINT) AS payload_bytes,
  array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + instr('0000 0001 0010 0011 0100 0101 0110 0111 1000 1001 1010 1011 1100 1101 1110 1111', substr(bits, 5 * k + 2, 4)) // 5
    + if(substr(bits, 5 * k + 1, 1) = '1', 16, 0), 1) for k in range(0, 32)], '') AS payload_digest,
  if(page_id = first, 'response', 'revisit') AS record_type, if(page_id = first, NULL, first) AS refers_to
FROM b""",
}
