"""Small tables for the engine's tests."""

from datetime import datetime, timedelta

T0 = datetime(2026, 1, 17, 10)


def at(minutes: float) -> datetime:
    return T0 + timedelta(minutes=minutes)


def messages(spark, rows):
    """(message_id, minutes, text, reply_to) rows of group g."""
    full = [(f"g:{i}", "g", i, at(m), None, t, r, "test") for i, m, t, r in rows]
    return spark.createDataFrame(full, "message_uid string, group_id string, message_id long, ts timestamp_ntz, sender_id string, text string, reply_to_msg_id long, ingest_method string")


def signals(spark, rows):
    """(id, minutes, direction, entry, low, high, sl, tps, flag) rows; id g:n."""
    full = [(i, i, i.split(":")[0], at(m), d, "XAUUSD", *r) for i, m, d, *r in rows]
    return spark.createDataFrame(
        full,
        "signal_id string, message_uid string, group_id string, ts timestamp_ntz, direction string, instrument string, entry double, entry_low double, entry_high double, "
        "stop_loss double, take_profits array<double>, quality_flag string",
    )


def follow_ups(spark, rows):
    """(id, minutes, event, tp_index, price, pips) rows."""
    full = [(i, i, i.split(":")[0], at(m), e, t, p, n) for i, m, e, t, p, n in rows]
    return spark.createDataFrame(full, "follow_up_id string, message_uid string, group_id string, ts timestamp_ntz, event_type string, tp_index int, claimed_price double, claimed_pips double")


def links(spark, rows):
    return spark.createDataFrame(rows, "follow_up_id string, signal_id string, link_confidence double")


def bars(spark, ohlc, start=0, provider="csv"):
    full = [(f"b{i}", "XAUUSD", "1min", at(start + i), *map(float, x), 10.0, provider) for i, x in enumerate(ohlc)]
    return spark.createDataFrame(full, "bar_id string, instrument string, interval string, ts timestamp_ntz, open double, high double, low double, close double, volume double, provider string")
