"""Chat messages and minute bars projected from the ``events`` table.

The tables at hand hold no trading texts, so each event becomes a message by
its type and the remainders of its id: purchases signals, clicks reached
targets, errors stopped trades, views and sign-ups talk, promotion and other
follow-ups.  Values become prices in quarter steps, which are exact doubles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

GROUPS = 12
STOP, TARGET = 20.0, 10.0
REPLY_EVERY = 3
KINDS = ["purchase", "click", "error", "view"]


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their price ``p`` and group's number ``g``; ``kind`` is the number of their type from 1, 0 for others."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts", "user_id", "event_type", "value")
    price = F.lit(1900.0) + F.floor(F.least("value", F.lit(100.0)) * 4).cast("double") / 4
    kind = F.array_position(F.array(*map(F.lit, KINDS)), F.col("event_type")).cast("int")
    return e.select("event_id", "ts", kind.alias("kind"), price.alias("p"), (F.col("user_id") % GROUPS).alias("g"))


def _price(x: Column) -> Column:
    return F.format_string("%.2f", x)


def message_text() -> Column:
    i, p, kind = F.col("event_id"), F.col("p"), F.col("event_type")
    rem = lambda n: i % n
    buy = rem(2) == 0
    side, sign = F.when(buy, "BUY").otherwise("SELL"), F.when(buy, 1.0).otherwise(-1.0)
    form = rem(10)
    head = (
        F.when(form == 6, F.concat(F.lit("GOLD "), side, F.lit(" "), _price(p), F.lit(" - "), _price(p + 2)))
        .when(form == 9, F.concat(F.lit("XAU/USD "), side, F.lit(" "), _price(p), F.lit("/"), _price(p + 2)))
        .otherwise(F.concat(F.lit("XAUUSD "), side, F.lit(" "), _price(p)))
    )
    stop = F.when(form.isin(7, 9), "").otherwise(F.concat(F.lit("\nSL "), _price(p - sign * STOP)))
    ladder = F.transform(
        F.sequence(F.lit(1), (1 + rem(4)).cast("int")), lambda n: F.concat(F.lit("\nTP"), n.cast("string"), F.lit(" "), _price(p + sign * TARGET * n))
    )
    targets = F.when(form.isin(8, 9), "").otherwise(F.array_join(ladder, ""))
    n = (1 + rem(3)).cast("string")
    at = F.when(rem(5) == 0, F.concat(F.lit(" AT "), _price(p))).otherwise("")
    return (
        F.when(kind == "purchase", F.concat(head, stop, targets))
        .when(kind == "click", F.concat(F.lit("TP"), n, F.lit(" HIT +"), n, F.lit("0 PIPS"), at))
        .when(kind == "error", F.concat(F.lit("SL HIT -"), (5 + rem(50)).cast("string"), F.lit(" PIPS")))
        .when(kind == "view", F.when(rem(3) == 0, "market looks quiet today").when(rem(3) == 1, "Running +20 pips").otherwise("Cancel the signal"))
        .otherwise(
            F.when(rem(4) == 0, "JOIN HERE for VIP bonus https://example.org/x").when(rem(4) == 1, "Move SL to BE").when(rem(4) == 2, "")
            .otherwise("Close now, secured +15 pips")
        )
    )


def _latest_purchase(e: DataFrame) -> DataFrame:
    """``e`` with the id of its group's latest earlier purchase, null without one.

    Days are looked through one by one and what the days before leave over is
    carried on, so that no task needs all events of a group.  Rows are dealt
    out once, as numbers; each day's last purchase is found before that.
    Only what replies or was bought is dealt out: no other row's is used.
    """
    bought, order = F.col("kind") == 1 + KINDS.index("purchase"), F.struct("ts", "event_id")
    day = F.to_date("ts")
    days = e.groupBy("g", day.alias("day")).agg(F.max_by(F.when(bought, F.col("event_id")), F.when(bought, order)).alias("last"))
    before = Window.partitionBy("g").orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    days = days.select("g", "day", F.last("last", ignorenulls=True).over(before).alias("carried"))
    # dealt by number, which is not merged into few tasks: texts cost more than their bytes tell
    n = int(e.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    needed = F.coalesce((F.col("event_id") % REPLY_EVERY == 0) | bought, F.lit(False))
    rest = e.where(~needed & F.col("g").isNotNull() & day.isNotNull()).withColumn("latest", F.lit(None).cast("long"))
    e = e.where(needed).repartition(n, "g", day).withColumn("day", day)
    earlier = Window.partitionBy("g", "day").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, -1)
    e = e.withColumn("today", F.last(F.when(bought, F.col("event_id")), ignorenulls=True).over(earlier))
    e = e.join(days, ["g", "day"]).withColumn("latest", F.coalesce("today", "carried")).drop("today", "carried", "day")
    # a table of few parts would be read and classified by few tasks
    few = rest.rdd.getNumPartitions() < e.sparkSession.sparkContext.defaultParallelism
    return e.unionByName(rest.repartition(n) if few else rest)


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages table; every third message answers its group's latest earlier purchase."""
    e = _latest_purchase(events(spark, sf_dir))
    kind = F.get(F.array(*map(F.lit, KINDS)), F.col("kind") - 1)
    e = e.select("event_id", "ts", "p", "latest", kind.alias("event_type"), F.concat(F.lit("g"), F.col("g").cast("string")).alias("group_id"))
    return e.select(
        F.concat_ws(":", "group_id", F.col("event_id").cast("string")).alias("message_uid"),
        "group_id",
        F.col("event_id").alias("message_id"),
        "ts",
        F.lit(None).cast("string").alias("sender_id"),
        message_text().alias("text"),
        F.when(F.col("event_id") % REPLY_EVERY == 0, F.col("latest")).alias("reply_to_msg_id"),
        F.lit("demo").alias("ingest_method"),
    )


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-minute bars of the prices of all events."""
    e = events(spark, sf_dir)
    minute = F.date_trunc("minute", F.col("ts")).cast("timestamp_ntz")
    order = F.struct("ts", "event_id")
    out = e.groupBy(minute.alias("minute")).agg(
        F.min_by("p", order).alias("open"), F.max("p").alias("high"), F.min("p").alias("low"), F.max_by("p", order).alias("close"), F.count("*").cast("double").alias("volume")
    )
    return out.select(
        F.concat(F.lit("XAUUSD:1min:"), F.date_format("minute", "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit(":demo")).alias("bar_id"),
        F.lit("XAUUSD").alias("instrument"), F.lit("1min").alias("interval"), F.col("minute").alias("ts"), "open", "high", "low", "close", "volume", F.lit("demo").alias("provider"),
    )
