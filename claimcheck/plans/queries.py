"""The engine's queries over the demo projection, flat columns only."""

from __future__ import annotations

import contextlib
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimcheck import resolver
from claimcheck.config import Settings
from claimcheck.functions import scalars as S
from claimcheck.operators import analytics, classify, compare, link, market
from claimcheck.plans.stages import Pipeline
from claimcheck.sources import bars as bar_sources
from claimcheck.sources import chat, groups, store

CFG = Settings()
FIXED = replace(CFG, default_sl_policy="FIXED_PIPS", max_holding_hours=6.0)


_last: list[Pipeline] = []


def _p(spark: SparkSession, sf_dir: str, cfg: Settings = CFG, **more) -> Pipeline:
    """The stages of one query; what the query before has persisted is given up first.

    (Later would be too late: Spark knows persisted tables by their plans, which
    queries share.)
    """
    while _last:
        with contextlib.suppress(Exception):  # its session may be gone
            _last.pop().close()
    _last.append(Pipeline.demo(spark, sf_dir, cfg, **more))
    return _last[-1]


def _prices(col: str) -> Column:
    return F.array_join(F.transform(col, lambda x: F.format_string("%.2f", x)), "|").alias(col)


def classify_messages(spark, sf_dir):
    return _p(spark, sf_dir).classes.select("message_uid", "class", F.bround("confidence", 6).alias("confidence"), F.array_join("reasons", "|").alias("reasons"))


def class_counts(spark, sf_dir):
    return analytics.counts(_p(spark, sf_dir).classes, "class")


def unclassified_messages(spark, sf_dir):
    p = _p(spark, sf_dir)
    return classify.unclassified(p.messages, p.classes.where("class <> 'UNCERTAIN'")).select("message_uid", "ts")


def parse_signals(spark, sf_dir):
    cols = ["signal_id", "group_id", "ts", "direction", "instrument", "entry", "entry_low", "entry_high", "stop_loss"]
    return _p(spark, sf_dir).signals.select(*cols, _prices("take_profits"), "quality_flag", "parse_confidence")


def quality_counts(spark, sf_dir):
    return analytics.counts(_p(spark, sf_dir).signals, "quality_flag")


def parse_follow_ups(spark, sf_dir):
    cols = ["follow_up_id", "group_id", "ts", "event_type", "tp_index", "claimed_price", "claimed_pips", "new_stop_loss", "parse_confidence"]
    return _p(spark, sf_dir).follow_ups.select(*cols)


def event_type_counts(spark, sf_dir):
    return analytics.counts(_p(spark, sf_dir).follow_ups, "event_type")


def link_reply_to(spark, sf_dir):
    p = _p(spark, sf_dir)
    return link.reply_links(p.follow_ups, p.told, p.signals)


def link_interval_candidates(spark, sf_dir):
    p = _p(spark, sf_dir)
    return link.interval_candidates(p.follow_ups, p.signals, CFG, digits=6).select("follow_up_id", "signal_id", "score", "link_method")


def links(spark, sf_dir):
    return _p(spark, sf_dir).links.select("link_id", "follow_up_id", "signal_id", "link_method", F.bround("link_confidence", 6).alias("link_confidence"))


def contested_links(spark, sf_dir):
    p = _p(spark, sf_dir)
    return link.contested(link.best_candidates(p.follow_ups, p.signals, CFG, 2, keyed=True), CFG).select("follow_up_id", F.bround("best", 6).alias("best"), F.bround("second", 6).alias("second"))


def link_method_stats(spark, sf_dir):
    return link.method_stats(_p(spark, sf_dir).links, CFG)


def low_confidence_links(spark, sf_dir):
    p = _p(spark, sf_dir, texts=True)
    return link.low_confidence(p.linked, None, p.signals, None, CFG).withColumn("link_confidence", F.bround("link_confidence", 6))


def reported_outcomes(spark, sf_dir):
    return _p(spark, sf_dir).reported.drop("computed_version")


def actual_outcomes(spark, sf_dir):
    return _p(spark, sf_dir).actual.drop("computed_version", "win_policy", "default_sl_policy", "max_holding_hours")


def actual_outcomes_fixed_sl(spark, sf_dir):
    return _p(spark, sf_dir, FIXED).actual.drop("computed_version", "win_policy", "default_sl_policy", "max_holding_hours")


def actual_state_counts(spark, sf_dir):
    return analytics.counts(_p(spark, sf_dir, FIXED).actual, "final_state")


def discrepancies(spark, sf_dir):
    return _p(spark, sf_dir).discrepancies


def discrepancy_counts(spark, sf_dir):
    return compare.discrepancy_counts(_p(spark, sf_dir).discrepancies)


def group_metrics(spark, sf_dir):
    p = _p(spark, sf_dir)
    return analytics.group_metrics(p.signals, p.reported, p.actual)


def group_metrics_window(spark, sf_dir):
    p = _p(spark, sf_dir)
    return analytics.group_metrics(p.signals, p.reported, p.actual, "2024-01-05T00:00:00Z", "2024-01-15T12:00:00Z")


def tp_depth_levels(spark, sf_dir):
    p = _p(spark, sf_dir)
    return analytics.tp_depth_levels(p.signals, p.reported)


def tp_depth_summary(spark, sf_dir):
    p = _p(spark, sf_dir)
    return analytics.tp_depth_summary(p.signals, p.reported)


def tp_depth_wide(spark, sf_dir):
    p = _p(spark, sf_dir)
    return analytics.tp_depth_wide(analytics.tp_depth_summary(p.signals, p.reported), analytics.tp_depth_levels(p.signals, p.reported))


def tp_depth_long(spark, sf_dir):
    p = _p(spark, sf_dir)
    return analytics.tp_depth_long(analytics.tp_depth_levels(p.signals, p.reported))


def leaderboard(spark, sf_dir):
    p = _p(spark, sf_dir)
    return analytics.leaderboard(p.signals, p.reported).withColumn("win_rate", F.bround("win_rate", 6))


def required_bar_range(spark, sf_dir):
    return market.required_range(_p(spark, sf_dir).signals, CFG)


def market_gaps(spark, sf_dir):
    p = _p(spark, sf_dir)
    return market.gaps(p.bars, market.required_range(p.signals, CFG), CFG)


def insert_or_ignore(spark, sf_dir):
    """Ids of messages that a delivery of all adds to one without replies: the first of each key stays."""
    m = _p(spark, sf_dir).messages
    return store.new_rows(m.where("reply_to_msg_id is null"), m, "messages", ["ts", "message_uid"]).select("message_uid")


def upsert_keeping(spark, sf_dir):
    """Classes after an update that settles all unsure ones and leaves the reasons alone."""
    c = _p(spark, sf_dir).classes.select("message_uid", "class", "confidence", "reasons")
    later = c.where("class = 'UNCERTAIN'").withColumns({"class": F.lit("NOISE"), "confidence": F.lit(1.0), "reasons": F.array(F.lit("by_hand"))})
    return store.merged(c, later, "classifications", keep=["reasons"]).select("message_uid", "class", F.bround("confidence", 6).alias("confidence"), F.array_join("reasons", "|").alias("reasons"))


def links_of_group(spark, sf_dir):
    p = _p(spark, sf_dir)
    return link.of_group(p.links, p.signals, "g3").select("link_id", "link_method")


def outcome_lookup(spark, sf_dir):
    """The reported outcome of the first signal."""
    p = _p(spark, sf_dir)
    first = p.signals.agg(F.min("signal_id")).scalar()
    return p.reported.where(F.col("signal_id") == first).select("signal_id", "final_state", "source_follow_up_count")


def _deliveries(spark, sf_dir) -> DataFrame:
    """Events as raw rows of CSV files: numbers as floating text, sign-ups without a usable number, errors without a time."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    kind = F.col("event_type")
    return e.select(
        F.when(kind == "view", " ").otherwise(F.concat(F.lit(" g"), (F.col("user_id") % 12).cast("string"))).alias("group"),
        F.when(kind == "signup", "n/a").otherwise(F.concat(F.col("event_id").cast("string"), F.lit(".0"))).alias("message_id"),
        F.when(kind == "error", "").otherwise(F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00"))).alias("timestamp_utc"),
        F.when(kind == "view", "").otherwise(F.col("user_id").cast("string")).alias("sender_id"),
        F.when(kind != "click", kind).alias("text"),
        F.concat(F.col("user_id").cast("string"), F.lit(".75")).alias("reply_to_msg_id"),
        F.lit("-3.5").alias("views"), F.lit("many").alias("forwards"), F.lit(None).cast("string").alias("reply_count"),
        F.concat(F.lit("file"), (F.col("user_id") % 3).cast("string")).alias("stem"),
    )


def backfilled_messages(spark, sf_dir):
    """Typed messages of raw rows; unusable ones are dropped."""
    new, _ = chat.backfill(_deliveries(spark, sf_dir))
    return new.select("message_uid", "group_id", "message_id", "ts", "sender_id", "text", "reply_to_msg_id", "views", "forwards", "reply_count")


def backfill_stats(spark, sf_dir):
    """Rows read, skipped and inserted of each file."""
    return chat.backfill(_deliveries(spark, sf_dir))[1]


def chat_api_messages(spark, sf_dir):
    """Messages of a chat service's JSON objects, with the nested count of replies."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    kind = F.col("event_type")
    replies = F.when(kind != "view", F.struct(F.when(kind != "click", F.col("user_id")).alias("replies")))
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    obj = F.struct(F.col("event_id").alias("id"), stamp.alias("date"), F.concat(F.lit(" "), kind, F.lit("\n")).alias("message"), F.col("user_id").alias("sender_id"), replies.alias("replies"))
    return chat.from_api(e.select(F.to_json(obj).alias("json")), "c").select("message_uid", "message_id", "ts", "sender_id", "text", "reply_count")


def tagged_bars(spark, sf_dir):
    """Bars as a provider marks them."""
    rows = _p(spark, sf_dir).bars.select("ts", "open", "high", "low", "close", "volume")
    return bar_sources.tagged(rows, F.lit("XAUUSD"), "1min", "demo").select("bar_id", "instrument", "interval", "ts", "open", "close", "volume", "provider")


def answer_costs(spark, sf_dir):
    """What the cache of answers has cost, with an answer for each event."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    return resolver.spent(e.select(F.col("event_id").cast("string").alias("cache_key"), (F.floor("value") * F.lit(0.25)).cast("double").alias("cost_usd")))


def manifest_targets(spark, sf_dir):
    """Targets and labels of a manifest with a line for each event."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    user, kind = F.col("user_id").cast("string"), F.col("event_type")
    line = (
        F.when(kind == "purchase", F.concat(F.lit("Room "), user, F.lit(" | id: -100"), user, F.lit(" | username: @Room"), user))
        .when(kind == "click", F.concat(F.lit("Hall "), user, F.lit(" | ID: "), user, F.lit(" | username: none")))
        .when(kind == "view", F.concat(F.lit("@rOOm"), user)).when(kind == "signup", F.concat(F.lit("# "), user)).otherwise(" ")
    )
    return groups.parse(e.select(F.col("event_id").alias("line_no"), line.alias("line"))).select("line_no", "label", "target")


def insert_or_replace(spark, sf_dir):
    """Bars after a later delivery has replaced every second one."""
    b = _p(spark, sf_dir).bars.select("instrument", "interval", "ts", "provider", "close")
    later = b.where(F.minute("ts") % 2 == 0).withColumn("close", F.col("close") + 1.0)
    return store.merged(b, later, "bars").select("ts", "close")


def scalar_functions(spark, sf_dir):
    """Small functions on every event."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    side = F.when(F.col("event_id") % 2 == 0, "BUY").otherwise("SELL")
    entry = F.lit(1900.0) + F.floor(F.least("value", F.lit(100.0)) * 4).cast("double") / 4
    return e.select(
        "event_id",
        S.pips(entry, F.lit(1950.0), side).alias("pips"),
        S.message_number(F.concat_ws(":", F.lit("g"), F.col("event_id").cast("string"))).alias("message_number"),
        S.iso(F.col("ts")).alias("iso"),
        S.cache_key("m", "v1", F.concat(F.lit("  A  "), F.col("event_type"), F.lit("\nB "))).alias("cache_key"),
        S.label(F.col("event_type"), F.lit(None).cast("string"), 5).alias("label"),
        S.uid("event_type", F.col("event_id").cast("string")).alias("uid"),
        S.iso(S.utc(F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("-03:30")))).alias("utc"),
        F.size(S.number_list(F.when(side == "BUY", F.concat(F.lit("[1, "), F.col("event_id").cast("string"), F.lit(".5]"))).otherwise("[1, "))).alias("numbers"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        classify_messages, class_counts, unclassified_messages, parse_signals, quality_counts, parse_follow_ups, event_type_counts,
        link_reply_to, link_interval_candidates, links, contested_links, link_method_stats, low_confidence_links, reported_outcomes,
        actual_outcomes, actual_outcomes_fixed_sl, actual_state_counts, discrepancies, discrepancy_counts, group_metrics, group_metrics_window,
        tp_depth_levels, tp_depth_summary, tp_depth_wide, tp_depth_long, leaderboard, required_bar_range, market_gaps, insert_or_ignore,
        insert_or_replace, upsert_keeping, links_of_group, outcome_lookup, backfilled_messages, backfill_stats, chat_api_messages, manifest_targets,
        tagged_bars, answer_costs,
        scalar_functions,
    )
}
