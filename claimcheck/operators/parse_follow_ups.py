"""Follow-up texts to events; the first rule that applies decides."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimcheck.config import Settings
from claimcheck.functions import text as T

P = T.FOLLOW_UP


def signed_pips(text: Column) -> Column:
    n = T.number(T.first_of(text, P["pips"], 2))
    return F.when(F.regexp_extract(text, "(?i)" + P["pips"], 1) == "-", -n).otherwise(n)


def claimed_price(text: Column, cfg: Settings) -> Column:
    p = T.number(T.first_of(text, P["at_price"], 1))
    return F.when(T.in_band(p, cfg.min_price, cfg.max_price), p)


def moved_stop(text: Column, cfg: Settings) -> Column:
    """The new stop of the first such phrase, if in the band."""
    p = T.number(F.coalesce(*[T.first_of(text, P["sl_moved"], g) for g in (1, 2, 3)]))
    return F.when(T.in_band(p, cfg.min_price, cfg.max_price), p)


def parse_text(df: DataFrame, cfg: Settings, text_col: str = "text") -> DataFrame:
    """``df`` with the event's columns; ``event_type`` is null where there is none."""
    t = F.col("__t")
    out = df.withColumn("__t", T.tidy(F.col(text_col)))
    index = F.coalesce(T.first_of(t, P["tp_hit"], 1), T.first_of(t, P["hit_tp"], 1)).try_cast("int")
    out = out.withColumns(
        {
            "__tp": index,
            "__sl": T.has(t, P["sl_hit"]) | T.has(t, P["stopped_out"]),
            "__all": T.has(t, P["all_tps"]),
            "__moved": moved_stop(t, cfg),
            "__pips": signed_pips(t),
            "__price": claimed_price(t, cfg),
        }
    )
    tp, sl, every = F.col("__tp").isNotNull(), F.col("__sl"), F.col("__all")
    # condition, event, confidence, reason
    rules = [
        (T.has(t, P["cancel"]), "CANCEL", 0.9, F.lit("cancel_keyword")),
        (tp & sl, "AMBIGUOUS", 0.5, F.lit("tp_and_sl_in_same_message")),
        (sl, "SL_HIT", 0.9, F.lit("sl_hit")),
        (tp | every, "TP_HIT", 0.9, F.when(F.col("__tp") > 0, F.concat(F.lit("tp_hit_index="), F.col("__tp").cast("string"))).otherwise("all_tps")),
        (T.has(t, P["break_even"]), "BE_MOVED", 0.85, F.lit("be_keyword")),
        (F.col("__moved").isNotNull(), "SL_MOVED", 0.85, F.concat(F.lit("sl_moved_to="), F.col("__moved").cast("string"))),
        (T.has(t, P["manual_close"]), "MANUAL_CLOSE", 0.8, F.lit("manual_close")),
        (T.has(t, P["pips"]), "UPDATE", 0.6, F.lit("pips_only")),
    ]
    event, sure, why = (F.lit(None).cast("string"), F.lit(None).cast("double"), F.lit(None).cast("string"))
    for cond, name, confidence, reason in reversed(rules):
        event, sure, why = F.when(cond, name).otherwise(event), F.when(cond, confidence).otherwise(sure), F.when(cond, reason).otherwise(why)
    out = T.settle(out.withColumns({"event_type": event, "parse_confidence": sure, "parse_reasons": F.array_compact(F.array(why))}))
    kind = F.col("event_type")
    out = out.withColumns(
        {
            "tp_index": F.when(kind.isin("TP_HIT", "AMBIGUOUS"), F.col("__tp")),
            "claimed_price": F.when(kind.isin("TP_HIT", "MANUAL_CLOSE"), F.col("__price")),
            "claimed_pips": F.when(kind.isin("SL_HIT", "TP_HIT", "MANUAL_CLOSE", "UPDATE"), F.col("__pips")),
            "new_stop_loss": F.when(kind == "SL_MOVED", F.col("__moved")),
        }
    )
    return out.drop("__t", "__tp", "__sl", "__all", "__moved", "__pips", "__price")


COLUMNS = [
    "follow_up_id", "message_uid", "group_id", "ts", "event_type", "tp_index", "claimed_price", "claimed_pips", "new_stop_loss", "parse_method",
    "parse_confidence", "parse_version", "parse_reasons",
]


def parse_follow_ups(messages: DataFrame, cfg: Settings, more: list[str] | None = None) -> DataFrame:
    """Events of the messages that tell one; an event has its message's uid, and its columns ``more``."""
    parsed = parse_text(messages, cfg).where(F.col("event_type").isNotNull())
    named = {"follow_up_id": F.col("message_uid"), "parse_method": F.lit("rules"), "parse_version": F.lit(cfg.version)}
    return parsed.select(*[named.get(c, F.col(c)).alias(c) for c in COLUMNS], *more or [])
