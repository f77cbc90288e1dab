"""A training corpus from raw documents, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again before the next.  All but the last return the columns
of ``documents``.  All take whole texts of any length, rows of any ids, repeated
ones and null ones included, and empty tables, which give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimcheck.llm import mixing, pii, queries, setsketch, spm, toxicity
from claimcheck.llm._util import broadcast_if, cut, new_folder, prepare

BROADCAST_ROWS = 100_000  # at most so many row keys are broadcast
KEY_SETTING = "spark.claimcheck.pii.key"  # names the secret of the pseudonyms; the demo key where it is unset


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a model of the labelled ones does not find toxic.

    Each row is judged by its text alone, so rows of one text share its fate,
    whatever their ids.  Null and empty texts are judged as texts without
    tokens.  Without labels of both kinds nothing goes if none is toxic.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.keep_clean(docs, toxicity.fitted(docs, labels))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies on 5-word shingles: that of the smallest id.

    Rows are told apart by id and text.  Of rows of one group with one id that
    of the smallest text hash stays, of rows that repeat id and text one; a row
    that shares its id with another text has its own fate; rows with a null id
    come last in the choice.  Null, empty and blank texts are copies of nothing
    and all stay.
    """
    rows = setsketch.near_duplicates(docs, shingle_words=5, num=80, den=100)
    seen = rows.where("n_shingles > 0").groupBy(F.col("id").alias("__id"), F.col("th").alias("__th")).agg(F.first("kept").alias("__kept"), F.count("*").alias("__n"))
    odd = cut(seen.where("not __kept or __n > 1").drop("__n"))
    mine = F.xxhash64(F.col("text").cast("string"))
    marked = docs.join(broadcast_if(odd, BROADCAST_ROWS), (F.col("doc_id").cast("long").eqNullSafe(F.col("__id"))) & (mine == F.col("__th")), "left")
    out = marked.where("__kept is null").select(docs.columns)
    if odd.where("__kept").limit(1).count():
        same = Window.partitionBy("__id", "__th").orderBy(F.xxhash64(*docs.columns))
        once = marked.where("__kept").withColumn("__r", F.row_number().over(same)).where("__r = 1")
        out = out.unionByName(once.select(docs.columns))
    return out


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with format-preserving pseudonyms; null texts stay null, ``n_chars`` follows the text."""
    out = pii.pseudonymise(docs, spark.conf.get(KEY_SETTING, queries.DEMO_KEY), counts=False)
    return out.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources repeated so that each weighs the root of its size, shuffled globally.

    A null source is a source; rows of one id, null too, draw the same number of copies.
    """
    return mixing.mix(docs).select(docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text, checked by decoding them; null and empty texts have none.

    ``round_trip`` is false for texts that hold U+2581, which the model takes for a space.
    """
    out = spm.encode(docs, check_col="round_trip")
    return out.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_ids"), "round_trip", "ids")


STAGES = [
    ("toxicity", reject_toxic),
    ("minhash_near_dedup", drop_near_copies),
    ("pii", hide_personal_data),
    ("mixing", mix_sources),
    ("sentencepiece", encode),
]

ORACLE_SQL = None  # the stages are tested against brute force instead


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each but the last written to the shared folder and read again."""
    prepare(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            folder = new_folder(spark, "pipeline")
            docs.write.parquet(folder)
            docs = spark.read.parquet(folder)
    return docs
