"""Classifier and parsers on texts of our own."""

import pytest

from claimcheck.config import Settings
from claimcheck.operators import classify, parse_follow_ups, parse_signals
from tests.engine.helpers import messages

CFG = Settings()
FULL = "XAUUSD BUY NOW 2410\nSL 2400\nTP1 2420\nTP2 2430"

CLASSES = [
    (FULL, None, "SIGNAL"),
    ("⭐️GOLD SELL 2410 SL: 2420 TP: 2400", None, "SIGNAL"),
    ("TP1 HIT +30 pips", None, "FOLLOW_UP"),
    ("SL hit, -40 pips", None, "FOLLOW_UP"),
    ("Move SL to BE", 1, "FOLLOW_UP"),
    ("Move SL to BE", None, "UNCERTAIN"),
    ("cancel it", None, "UNCERTAIN"),
    ("cancel it", 1, "FOLLOW_UP"),
    ("Join here for VIP https://x.org", None, "NOISE"),
    ("XAUT GOLD TOKEN bonus", None, "NOISE"),
    ("VIP_SIGNALS payment", None, "NOISE"),
    ("", None, "NOISE"),
    ("  \n ", None, "NOISE"),
    ("🔥🔥", None, "NOISE"),
    ("good morning traders", None, "UNCERTAIN"),
    (None, None, "NOISE"),
]


def test_classes(spark):
    df = messages(spark, [(i, i, t, r) for i, (t, r, _) in enumerate(CLASSES)])
    got = {int(r.message_uid[2:]): r for r in classify.classify(df, CFG).collect()}
    assert {i: got[i]["class"] for i in got} == {i: c for i, (_, _, c) in enumerate(CLASSES)}
    assert got[0].confidence >= 0.7 and got[0].reasons[:2] == ["has_instrument", "has_direction"]
    assert got[4].confidence == pytest.approx(0.7)
    assert got[5].reasons[0].startswith("score_signal=")
    assert got[11].reasons == ["empty_text"] and got[14].reasons == ["no_evidence"]


def test_class_scans(spark):
    df = messages(spark, [(1, 0, FULL, None), (2, 1, FULL, None), (3, 2, "hi all", None)])
    c = classify.classify(df, CFG)
    assert classify.unclassified(df, c.limit(0)).count() == 3
    assert [r.message_id for r in classify.of_class(df, c, "SIGNAL", 1).collect()] == [1]


# text, direction, entry, low, high, stop, targets, flag
SIGNALS = [
    (FULL, "BUY", 2410.0, None, None, 2400.0, [2420.0, 2430.0], "COMPLETE"),
    ("GOLD SELL 2410/2413\nSL 2420\nTP 2400", "SELL", None, 2410.0, 2413.0, 2420.0, [2400.0], "COMPLETE"),
    ("xau/usd sell zone 2413 - 2410", "SELL", None, 2410.0, 2413.0, None, [], "ENTRY_RANGE"),
    ("XAUUSD BUY 2410 TP1 2420 TP2 2420.0", "BUY", 2410.0, None, None, None, [2420.0], "MISSING_SL"),
    ("XAUUSD BUY 2410 SL 2400", "BUY", 2410.0, None, None, 2400.0, [], "MISSING_TP"),
    ("XAUUSD BUY 2410", "BUY", 2410.0, None, None, None, [], "MISSING_BOTH"),
    ("GOLD LONG\nENTRY PRICE: 2410\nSTOP LOSS 2400\nTAKE PROFIT 1 2420", "BUY", 2410.0, None, None, 2400.0, [2420.0], "COMPLETE"),
    ("**XAUUSD** `BUY` @ 2410\r\n\r\nS/L: 2400\r\nTP: 2420", "BUY", 2410.0, None, None, 2400.0, [2420.0], "COMPLETE"),
    ("XAUUSD BUY ２４１０ SL 2400 TP 2420", "BUY", 2410.0, None, None, 2400.0, [2420.0], "COMPLETE"),
    ("GOLD BUY running hit 2412\nBUY 2410\nSL 2400", "BUY", 2410.0, None, None, 2400.0, [], "MISSING_TP"),
    ("GOLD zone 2300-2400\nBUY 2410 SL 2400", "BUY", 2410.0, None, None, 2400.0, [], "MISSING_TP"),
]
REJECTS = [("", "empty_text"), ("GOLD 2410", "no_direction"), ("BUY 2410", "no_instrument"), ("GOLD BUY now", "no_entry"), ("GOLD BUY 2410 TP 1", "implausible_prices"), ("XAUUSD BUY 2410 SL 240", "implausible_prices")]


def test_signals(spark):
    df = messages(spark, [(i, i, r[0], None) for i, r in enumerate(SIGNALS)])
    got = {int(r.signal_id[2:]): r for r in parse_signals.parse_signals(df, CFG).collect()}
    for i, (_, *want) in enumerate(SIGNALS):
        r = got[i]
        assert [r.direction, r.entry, r.entry_low, r.entry_high, r.stop_loss, r.take_profits, r.quality_flag] == want, SIGNALS[i][0]
    assert [got[i].parse_confidence for i in (0, 1, 2, 5)] == [0.96, 0.75, 0.4, 0.6]


def test_rejects(spark):
    df = messages(spark, [(i, i, t, None) for i, (t, _) in enumerate(REJECTS)])
    got = {int(r.message_uid[2:]): r.reject for r in parse_signals.parse_text(df, CFG).collect()}
    assert got == {i: why for i, (_, why) in enumerate(REJECTS)}


# text, event, tp_index, price, pips, stop
EVENTS = [
    ("TP1 hit +30 pips", "TP_HIT", 1, None, 30.0, None),
    ("hit TP 2 at 2420.5", "TP_HIT", 2, 2420.5, None, None),
    ("All TPs hit! 120+ pips", "TP_HIT", None, None, 120.0, None),
    ("TP3 ✅✅ done", "TP_HIT", 3, None, None, None),
    ("SL hit -40 pips", "SL_HIT", None, None, -40.0, None),
    ("stopped out at 2400", "SL_HIT", None, None, None, None),
    ("TP1 hit then SL hit", "AMBIGUOUS", 1, None, None, None),
    ("All TPs hit, SL hit", "SL_HIT", None, None, None, None),
    ("move SL to BE", "BE_MOVED", None, None, None, None),
    ("Break even secured", "BE_MOVED", None, None, None, None),
    ("Move SL to 2405", "SL_MOVED", None, None, None, 2405.0),
    ("SL now at 2406.5", "SL_MOVED", None, None, None, 2406.5),
    ("close all trades now +15 pips at 2411", "MANUAL_CLOSE", None, 2411.0, 15.0, None),
    ("running + 25 pips", "UPDATE", None, None, 25.0, None),
    ("cancelled, TP1 hit", "CANCEL", None, None, None, None),
    ("ignore the signal", "CANCEL", None, None, None, None),
    ("good morning", None, None, None, None, None),
    ("move SL to 10", None, None, None, None, None),
    ("", None, None, None, None, None),
]


def test_events(spark):
    df = messages(spark, [(i, i, r[0], None) for i, r in enumerate(EVENTS)])
    got = {int(r.message_uid[2:]): r for r in parse_follow_ups.parse_text(df, CFG).collect()}
    for i, (text, *want) in enumerate(EVENTS):
        r = got[i]
        assert [r.event_type, r.tp_index, r.claimed_price, r.claimed_pips, r.new_stop_loss] == want, text
    assert parse_follow_ups.parse_follow_ups(df, CFG).count() == sum(e[1] is not None for e in EVENTS)
