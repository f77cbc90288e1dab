"""Raw chat messages: CSV folders, typed rows, live-source contract."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimcheck import schemas
from claimcheck.functions import scalars as S
from claimcheck.functions import text as T

RAW = "group string, message_id string, timestamp_utc string, sender_id string, text string, reply_to_msg_id string, views string, forwards string, reply_count string"


def read_csv_dir(spark: SparkSession, folder: str) -> DataFrame:
    """All rows of all *.csv of a folder as text, with the file's stem; no files give no rows.

    Columns are matched by the header's names in each file, quotes double
    inside quoted fields, and fields may hold line breaks.
    """
    options = {"header": True, "multiLine": True, "escape": '"', "enforceSchema": False, "pathGlobFilter": "*.csv", "mode": "PERMISSIVE"}
    try:
        df = spark.read.schema(RAW).options(**options).csv(folder)
    except Exception as e:
        if "PATH_NOT_FOUND" in str(e):
            return spark.createDataFrame([], RAW + ", stem string")
        raise
    name = F.regexp_replace(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1), r"\.csv$", "")
    return df.withColumn("stem", F.url_decode(name))


def _whole(col: str):
    """Whole part of a number text, null if blank or malformed."""
    x = T.strip(F.coalesce(F.col(col), F.lit(""))).try_cast("double")
    return F.when(F.abs(x) < 9e18, F.when(x < 0, F.ceil(x)).otherwise(F.floor(x))).try_cast("long")


def coerce(raw: DataFrame, method: str = "csv_backfill") -> DataFrame:
    """Typed messages and ``skip``: rows without a number or a time are marked to be dropped."""
    group = F.coalesce(F.nullif(T.strip(F.coalesce("group", F.lit(""))), F.lit("")), F.col("stem"))
    number = _whole("message_id")
    time = T.strip(F.coalesce("timestamp_utc", F.lit("")))
    return raw.select(
        S.uid(group, number.cast("string")).alias("message_uid"),
        group.alias("group_id"),
        number.alias("message_id"),
        S.utc(time).alias("ts"),
        F.nullif(T.strip(F.coalesce("sender_id", F.lit(""))), F.lit("")).alias("sender_id"),
        F.coalesce("text", F.lit("")).alias("text"),
        *[_whole(c).alias(c) for c in ("reply_to_msg_id", "views", "forwards", "reply_count")],
        F.lit(method).alias("ingest_method"),
        "stem",
        (number.isNull() | (time == "")).alias("skip"),
    )


def backfill(raw: DataFrame, existing: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(new messages, stats by file): typed rows, the first of each key, that ``existing`` does not hold.

    stats: file, read, skipped, inserted.
    """
    from claimcheck.sources import store

    rows = coerce(raw)
    good = rows.where("not skip").drop("skip")
    empty = good.limit(0)
    new = store.new_rows(existing if existing is not None else empty, good, "messages", ["ts", "stem", "text"])
    counts = rows.groupBy("stem").agg(F.count("*").alias("read"), F.count_if("skip").alias("skipped"))
    added = new.groupBy("stem").agg(F.count("*").alias("inserted"))
    stats = counts.join(added, "stem", "left").select(F.col("stem").alias("file"), "read", "skipped", F.coalesce("inserted", F.lit(0)).alias("inserted"))
    return new.drop("stem"), stats


# The fields of a chat service's message objects.
API_FIELDS = "id long, date string, sender_id string, message string, reply_to_msg_id long, views long, forwards long, replies struct<replies: long>"


def from_api(objects: DataFrame, group: str, json_col: str = "json", method: str = "api") -> DataFrame:
    """Messages of one group from JSON objects, one a row; objects without a number or a time are left out.

    The count of replies is nested, and null where the object or the count is missing.
    """
    m = objects.select(F.from_json(F.col(json_col), API_FIELDS).alias("m"))
    rows = m.select(
        S.uid(F.lit(group), F.col("m.id").cast("string")).alias("message_uid"), F.lit(group).alias("group_id"), F.col("m.id").alias("message_id"), S.utc(F.col("m.date")).alias("ts"),
        F.col("m.sender_id").alias("sender_id"), T.strip(F.coalesce("m.message", F.lit(""))).alias("text"), F.col("m.reply_to_msg_id").alias("reply_to_msg_id"),
        F.col("m.views").alias("views"), F.col("m.forwards").alias("forwards"), F.col("m.replies.replies").alias("reply_count"), F.lit(method).alias("ingest_method"),
    )
    return rows.where("message_id is not null and ts is not null")


class ChatApi:
    """Messages of targets from a chat service's client.

    ``resolve`` gives a target's group id; ``pages`` iterates over lists of
    message objects as JSON texts, newest first.  Pages older than ``start``
    are not asked for, and no more than one page is held at a time.
    """

    def __init__(self, spark: SparkSession, resolve: Callable[[str], str], pages: Callable[[str], Iterable[list[str]]]):
        self.spark, self.resolve, self.pages = spark, resolve, pages

    def fetch(self, key: str, folder: str, start: str | None = None, end: str | None = None) -> DataFrame:
        """A group's messages from start to end; pages are written below ``folder`` as they come."""
        path = f"{folder}/{key}"
        self.spark.createDataFrame([], schemas.MESSAGES).write.mode("overwrite").parquet(path)
        for page in self.pages(key):
            rows = from_api(self.spark.createDataFrame([(x,) for x in page], "json string"), key)
            accept(rows, start, end).write.mode("append").parquet(path)
            if start is not None and rows.where(F.col("ts") < S.utc(F.lit(start))).limit(1).count():
                break
        return accept(self.spark.read.parquet(path))


def accept(rows: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """The contract of live sources: rows from start to end, texts stripped, in order of time and number."""
    out = rows.withColumn("text", T.strip(F.coalesce("text", F.lit(""))))
    if start is not None:
        out = out.where(F.col("ts") >= S.utc(F.lit(start)))
    if end is not None:
        out = out.where(F.col("ts") <= S.utc(F.lit(end)))
    return out.orderBy("ts", "message_id")


def fetch_groups(targets: Iterable[str], resolve: Callable[[str], str], fetch: Callable[[str], DataFrame]) -> tuple[DataFrame | None, dict[str, str]]:
    """Messages of all targets from a live source, and the errors of those that failed.

    Targets that resolve to one id are fetched once.  The source itself is a
    function, as no network is taken for granted.
    """
    seen, out, errors = set(), None, {}
    for t in targets:
        try:
            key = resolve(t)
            if key in seen:
                continue
            seen.add(key)
            df = fetch(key)
        except Exception as e:  # noqa: BLE001 - a source's own errors are reported by group
            errors[t] = str(e)
            continue
        out = df if out is None else out.unionByName(df)
    return out, errors


def textless(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count_if(T.strip(F.coalesce("text", F.lit(""))) == "").alias("n"))
