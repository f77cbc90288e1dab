"""Schemas of all tables as DDL, their keys and their value sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MESSAGES = (
    "message_uid string, group_id string, message_id long, ts timestamp_ntz, sender_id string, text string, "
    "reply_to_msg_id long, views long, forwards long, reply_count long, ingest_method string"
)
CLASSIFICATIONS = (
    "message_uid string, class string, confidence double, method string, reasons array<string>, classifier_version string"
)
SIGNALS = (
    "signal_id string, message_uid string, group_id string, ts timestamp_ntz, direction string, instrument string, "
    "entry double, entry_low double, entry_high double, stop_loss double, take_profits array<double>, quality_flag string, "
    "parse_method string, parse_confidence double, parse_version string, parse_reasons array<string>"
)
FOLLOW_UPS = (
    "follow_up_id string, message_uid string, group_id string, ts timestamp_ntz, event_type string, tp_index int, "
    "claimed_price double, claimed_pips double, new_stop_loss double, parse_method string, parse_confidence double, "
    "parse_version string, parse_reasons array<string>"
)
LINKS = (
    "link_id string, follow_up_id string, signal_id string, link_method string, link_confidence double, reasons array<string>, linker_version string"
)
REPORTED = (
    "signal_id string, final_state string, max_tp_hit int, claimed_pips double, closed_at timestamp_ntz, source_follow_up_count long, computed_version string"
)
BARS = (
    "bar_id string, instrument string, interval string, ts timestamp_ntz, open double, high double, low double, close double, volume double, provider string"
)
ACTUAL = (
    "signal_id string, final_state string, first_touch_event string, first_touch_price double, first_touch_at timestamp_ntz, "
    "realized_rr double, realized_pips double, bars_to_outcome long, win_policy string, max_holding_hours double, "
    "default_sl_policy string, computed_version string"
)
RESOLVER_CACHE = (
    "cache_key string, model string, prompt_version string, content_hash string, response_json string, "
    "tokens_in long, tokens_out long, cost_usd double"
)

KEYS = {
    "messages": ["group_id", "message_id"],
    "classifications": ["message_uid"],
    "signals": ["signal_id"],
    "follow_ups": ["follow_up_id"],
    "links": ["follow_up_id", "signal_id"],
    "reported": ["signal_id"],
    "bars": ["instrument", "interval", "ts", "provider"],
    "actual": ["signal_id"],
    "resolver_cache": ["cache_key"],
}

# What each coded column may hold.
VALUES = {
    "class": ["SIGNAL", "FOLLOW_UP", "NOISE", "UNCERTAIN"],
    "direction": ["BUY", "SELL"],
    "quality_flag": ["COMPLETE", "MISSING_SL", "MISSING_TP", "MISSING_BOTH", "ENTRY_RANGE"],
    "event_type": ["TP_HIT", "SL_HIT", "BE_MOVED", "SL_MOVED", "MANUAL_CLOSE", "UPDATE", "CANCEL", "AMBIGUOUS"],
    "link_method": ["reply_to", "temporal_numeric", "recent_open"],
    "final_state": ["WIN", "LOSS", "BREAK_EVEN", "OPEN", "OPEN_AT_EXPIRY", "AMBIGUOUS", "NO_REPORT", "INSUFFICIENT_DATA"],
}


TABLES = {
    "messages": MESSAGES,
    "classifications": CLASSIFICATIONS,
    "signals": SIGNALS,
    "follow_ups": FOLLOW_UPS,
    "links": LINKS,
    "reported": REPORTED,
    "bars": BARS,
    "actual": ACTUAL,
    "resolver_cache": RESOLVER_CACHE,
}


def columns(table: str) -> list[tuple[str, str]]:
    """(name, type) of a table's columns."""
    return [tuple(c.split(" ", 1)) for c in TABLES[table].split(", ")]


def decoded(df: DataFrame, table: str) -> DataFrame:
    """Stored rows as the table's schema has them.

    Columns that the stored table lacks are null, others than the schema's go;
    lists are never null, message texts neither, and a coded value that is none
    of its column's is an error.
    """
    out = []
    for name, kind in columns(table):
        x = F.col(f"`{name}`").cast(kind) if name in df.columns else F.lit(None).cast(kind)
        if kind.startswith("array"):
            x = F.coalesce(x, F.array().cast(kind))
        if (table, name) == ("messages", "text"):
            x = F.coalesce(x, F.lit(""))
        if name in VALUES:
            wrong = F.raise_error(F.concat(F.lit(f"{table}.{name} cannot be "), x))
            x = F.when(x.isNull() | x.isin(VALUES[name]), x).otherwise(wrong)
        out.append(x.alias(name))
    return df.select(out)


def bad_values(df: DataFrame, column: str) -> DataFrame:
    """Rows whose coded column holds none of its values."""
    return df.where(F.col(column).isNull() | ~F.col(column).isin(VALUES[column]))


def effective_entry() -> Column:
    """The point entry, else the middle of the range."""
    return F.coalesce("entry", (F.col("entry_low") + F.col("entry_high")) / 2)


def bad_signals(signals: DataFrame) -> DataFrame:
    """Signals without a point entry or a full range, or with a range upside down."""
    no_entry = F.col("entry").isNull() & (F.col("entry_low").isNull() | F.col("entry_high").isNull())
    return signals.where(no_entry | F.coalesce(F.col("entry_low") > F.col("entry_high"), F.lit(False)))
