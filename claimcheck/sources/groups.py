"""The manifest of groups: one line a group."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimcheck.functions import scalars as S
from claimcheck.functions import text as T


# How a manifest line names a user and an id.
USER = r"(?i)\busername:\s*([A-Za-z0-9_@]+|None|N/A)\b"
NUMBER = r"(?i)\bid:\s*(-?\d+)\b"
NO_USER = ("none", "n/a", "na")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """(line_no, line) of a manifest file, lines in order."""
    whole = spark.read.text(path, wholetext=True)
    return whole.select(F.posexplode(F.split("value", "\r\n|\r|\n")).alias("line_no", "line"))


def parse(lines: DataFrame) -> DataFrame:
    """(line_no, label, target): a user name before an id before the line itself; comments and blanks go.

    Of lines with one target (ids by value, names by lower case) the first stays.
    """
    line = T.strip(F.col("line"))
    user = F.nullif(F.regexp_extract(line, USER, 1), F.lit(""))
    user = F.when(~F.lower(user).isin(*NO_USER), F.regexp_replace(user, "^@+", ""))
    number = F.nullif(F.regexp_extract(line, NUMBER, 1), F.lit(""))
    rest = F.regexp_replace(T.strip(F.element_at(F.split(line, r"\|"), -1)), "^@+", "")
    target = F.coalesce(user, number, rest)
    label = T.strip(F.split(line, r"\|")[0])
    out = lines.where((line != "") & ~line.startswith("#")).select("line_no", F.coalesce(F.nullif(label, F.lit("")), target).alias("label"), target.alias("target"))
    out = out.where("target <> ''")
    plain = F.regexp_replace(T.strip(F.col("target")), "^@+", "")
    key = F.when(plain.rlike(r"^-?\d+$"), plain.cast("decimal(38,0)").cast("string")).otherwise(F.lower(plain))
    w = Window.partitionBy("key").orderBy("line_no")
    return out.withColumn("key", key).withColumn("r", F.row_number().over(w)).where("r = 1").drop("key", "r")


def label_map(lines: DataFrame) -> DataFrame:
    """(group_id, label) of lines with an id; the last of a repeated id counts."""
    line = T.strip(F.col("line"))
    number = F.nullif(F.regexp_extract(line, NUMBER, 1), F.lit(""))
    rows = lines.where(~line.startswith("#")).select("line_no", number.alias("group_id"), T.strip(F.split(line, r"\|")[0]).alias("label"))
    return rows.where("group_id is not null and label <> ''").groupBy("group_id").agg(F.max_by("label", "line_no").alias("label"))


def with_labels(df: DataFrame, labels: DataFrame, longest: int = 0) -> DataFrame:
    """``df`` with ``group``: the label of its group_id or the id itself, cut to ``longest``."""
    known = labels.select("group_id", F.col("label").alias("__label"))
    return df.join(known, "group_id", "left").withColumn("group", S.label(F.col("group_id"), F.col("__label"), longest)).drop("__label")


def coverage(manifest: DataFrame, seen: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(targets never seen, seen ids not in the manifest)."""
    m, s = manifest.select(F.lower("target").alias("id")), seen.select(F.lower("group_id").alias("id"))
    return m.exceptAll(s).distinct(), s.exceptAll(m).distinct()
