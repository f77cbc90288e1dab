"""Quality gates over hand-written messages: classes, signals and follow-ups as a reader takes them."""

import pytest

from claimcheck.config import Settings
from claimcheck.operators import classify, parse_follow_ups, parse_signals
from tests.engine import helpers as h

CLASSES = [
    # (text, is a reply, class)
    ("XAUUSD BUY NOW 2410\nSL 2400\nTP1 2420\nTP2 2430", False, "SIGNAL"),
    ("Gold sell limit 2450 - 2453\nSL: 2460\nTP: 2440", False, "SIGNAL"),
    ("XAU/USD LONG 1999.5\nStop loss 1990\nTake profit 2010", False, "SIGNAL"),
    ("#XAUUSD SHORT @ 2300\nSL 2310\nTP 1: 2290\nTP 2: 2280", False, "SIGNAL"),
    ("gold buy zone 2320/2318 sl 2312 tp 2330", False, "SIGNAL"),
    ("BUY GOLD 2401\n\nSL-2391\nTP-2411", False, "SIGNAL"),
    ("SELL XAUUSD 4712.25\nSL 4722\nTP1 4702\nTP2 4692\nTP3 4682", False, "SIGNAL"),
    ("XAUUSD\nBUY STOP 2500\nSL 2490\nTP 2520", False, "SIGNAL"),
    ("**GOLD** BUY 2666\nS/L 2656\nTP1 2676", False, "SIGNAL"),
    ("Gold long 2410, stoploss 2400, TP 2425", False, "SIGNAL"),
    ("XAUUSD sell now 3021.5 SL 3030 TP 3010", True, "SIGNAL"),
    ("GOLD SELL 2377\nSL : 2385\nTAKE PROFIT 1 : 2370\nTAKE PROFIT 2 : 2360", False, "SIGNAL"),
    ("XAU/USD buy 2288 sl 2280", False, "SIGNAL"),
    ("Gold buy now 2300", False, "SIGNAL"),
    ("xauusd short 4000\ntp 3990", False, "SIGNAL"),
    ("XAUUSD BUY 2410 ENTRY\nSL 2400 TP 2415", False, "SIGNAL"),
    ("TP1 HIT +30 pips", True, "FOLLOW_UP"),
    ("TP2 hit ✅ 60 pips", True, "FOLLOW_UP"),
    ("SL hit -50 pips", True, "FOLLOW_UP"),
    ("Running +45 pips", True, "FOLLOW_UP"),
    ("closed at 2415 +50 pips secured", True, "FOLLOW_UP"),
    ("Move SL to BE, 20 pips secured", True, "FOLLOW_UP"),
    ("Secured 30 pips, break even now", False, "FOLLOW_UP"),
    ("Cancel this, price ran 40 pips", True, "FOLLOW_UP"),
    ("All TPs hit, booked 120 pips", True, "FOLLOW_UP"),
    ("Target hit +80 pips", True, "FOLLOW_UP"),
    ("Trailing, +25 PIPS running", False, "FOLLOW_UP"),
    ("stopped out, -40 pips", True, "FOLLOW_UP"),
    ("Book now! 55 pips", True, "FOLLOW_UP"),
    ("TP3 reached, 90 pips done", True, "FOLLOW_UP"),
    ("breakeven hit, closing the trade", True, "FOLLOW_UP"),
    ("Join here for VIP https://example.org", False, "NOISE"),
    ("Deposit today, 50% bonus", False, "NOISE"),
    ("Whatsapp me for VIP access", False, "NOISE"),
    ("", False, "NOISE"),
    ("🔥🔥🔥", False, "NOISE"),
    ("...", False, "NOISE"),
    ("ok", False, "NOISE"),
    ("Subscribe and register now: https://example.org/a", False, "NOISE"),
    ("Use promo code at https://example.org", False, "NOISE"),
    ("Gold token XAUT wallet payment, VIP only", False, "NOISE"),
]

SIGNALS = [
    # (text, direction, entry, low, high, stop, targets, quality); direction None: no signal
    ("XAUUSD BUY NOW 2410\nSL 2400\nTP1 2420\nTP2 2430", "BUY", 2410.0, None, None, 2400.0, [2420.0, 2430.0], "COMPLETE"),
    ("Gold sell limit 2450 - 2453\nSL: 2460\nTP: 2440", "SELL", None, 2450.0, 2453.0, 2460.0, [2440.0], "COMPLETE"),
    ("XAU/USD LONG AT 1999.5\nStop loss 1990\nTake profit 2010", "BUY", 1999.5, None, None, 1990.0, [2010.0], "COMPLETE"),
    ("#XAUUSD SHORT ENTRY 2300\nSL 2310\nTP 1: 2290\nTP 2: 2280", "SELL", 2300.0, None, None, 2310.0, [2290.0, 2280.0], "COMPLETE"),
    ("gold buy zone 2320/2318 sl 2312 tp 2330", "BUY", None, 2318.0, 2320.0, 2312.0, [2330.0], "COMPLETE"),
    ("BUY GOLD 2401\n\nSL-2391\nTP-2411", "BUY", 2401.0, None, None, 2391.0, [2411.0], "COMPLETE"),
    ("SELL XAUUSD 4712.25\nSL 4722\nTP1 4702\nTP2 4692\nTP3 4682", "SELL", 4712.25, None, None, 4722.0, [4702.0, 4692.0, 4682.0], "COMPLETE"),
    ("**GOLD** BUY 2666\nS/L 2656\nTP1 2676", "BUY", 2666.0, None, None, 2656.0, [2676.0], "COMPLETE"),
    ("XAUUSD BUY 2288 to 2285", "BUY", None, 2285.0, 2288.0, None, [], "ENTRY_RANGE"),
    ("Gold buy now 2300", "BUY", 2300.0, None, None, None, [], "MISSING_BOTH"),
    ("xauusd short price 4000\ntp 3990", "SELL", 4000.0, None, None, None, [3990.0], "MISSING_SL"),
    ("GOLD LONG\nENTRY PRICE: 2222\nSL 2212", "BUY", 2222.0, None, None, 2212.0, [], "MISSING_TP"),
    ("GOLD SELL 2377\nSL : 2385\nTAKE PROFIT 1 : 2370\nTAKE PROFIT 2 : 2360", "SELL", 2377.0, None, None, 2385.0, [2370.0, 2360.0], "COMPLETE"),
    ("XAUUSD BUY 2410\nTP1 2420\nTP2 2420\nTP3 2440\nSL 2400", "BUY", 2410.0, None, None, 2400.0, [2420.0, 2440.0], "COMPLETE"),
    ("XAUUSD SELL １９９９\nSL 2009\nTP 1989", "SELL", 1999.0, None, None, 2009.0, [1989.0], "COMPLETE"),
    ("good morning traders", None, None, None, None, None, None, None),
    ("BUY now 2410 SL 2400", None, None, None, None, None, None, None),
    ("XAUUSD at support 2410", None, None, None, None, None, None, None),
    ("GOLD BUY soon", None, None, None, None, None, None, None),
    ("XAUUSD BUY 2410\nSL 240\nTP 2420", None, None, None, None, None, None, None),
]

FOLLOW_UPS = [
    # (text, event, target, pips, price, new stop); event None: none
    ("TP1 HIT +30 pips", "TP_HIT", 1, 30.0, None, None),
    ("TP 2 ✅ reached", "TP_HIT", 2, None, None, None),
    ("hit TP3 +90 PIPS", "TP_HIT", 3, 90.0, None, None),
    ("All TPs hit", "TP_HIT", None, None, None, None),
    ("TP1 booked 25 pips at 2435.5", "TP_HIT", 1, 25.0, 2435.5, None),
    ("tapped TP4", "TP_HIT", 4, None, None, None),
    ("TP1 done +20 pips", "TP_HIT", 1, 20.0, None, None),
    ("SL hit -50 pips", "SL_HIT", None, -50.0, None, None),
    ("SL taken", "SL_HIT", None, None, None, None),
    ("Stopped out, sorry", "SL_HIT", None, None, None, None),
    ("stop loss hit - 40 pips", "SL_HIT", None, -40.0, None, None),
    ("TP1 hit but SL hit after", "AMBIGUOUS", 1, None, None, None),
    ("Move SL to BE", "BE_MOVED", None, None, None, None),
    ("break even secured", "BE_MOVED", None, None, None, None),
    ("SL to entry please", "BE_MOVED", None, None, None, None),
    ("Move SL to 2405", "SL_MOVED", None, None, None, 2405.0),
    ("SL now at 2411.5", "SL_MOVED", None, None, None, 2411.5),
    ("update SL to 4690", "SL_MOVED", None, None, None, 4690.0),
    ("Close now +15 pips", "MANUAL_CLOSE", None, 15.0, None, None),
    ("Closed at 2415", "MANUAL_CLOSE", None, None, None, None),
    ("close all at 2433", "MANUAL_CLOSE", None, None, 2433.0, None),
    ("Exit the trade", "MANUAL_CLOSE", None, None, None, None),
    ("close the position, +12 pips", "MANUAL_CLOSE", None, 12.0, None, None),
    ("Cancel the signal", "CANCEL", None, None, None, None),
    ("signal void", "CANCEL", None, None, None, None),
    ("ignore the signal", "CANCEL", None, None, None, None),
    ("cancelled", "CANCEL", None, None, None, None),
    ("Running +20 pips", "UPDATE", None, 20.0, None, None),
    ("35 pips and counting", "UPDATE", None, 35.0, None, None),
    ("what a day", None, None, None, None, None),
    ("XAUUSD looks strong", None, None, None, None, None),
]


def gate(wrong, n):
    assert len(wrong) <= 0.05 * n, wrong


def test_classes(spark):
    rows = [(i, i, t, 1 if r else None) for i, (t, r, _) in enumerate(CLASSES)]
    got = {int(r.message_uid.split(":")[1]): r["class"] for r in classify.classify(h.messages(spark, rows), Settings()).collect()}
    gate([(t, want, got[i]) for i, (t, _, want) in enumerate(CLASSES) if got[i] != want], len(CLASSES))
    told = [i for i in got if got[i] == "SIGNAL"]
    gate([CLASSES[i][0] for i in told if CLASSES[i][2] != "SIGNAL"], len(told))


def test_signals(spark):
    m = h.messages(spark, [(i, i, r[0], None) for i, r in enumerate(SIGNALS)])
    got = {int(r.message_uid.split(":")[1]): r for r in parse_signals.parse_signals(m, Settings()).collect()}
    wrong = []
    for i, (text, direction, *want) in enumerate(SIGNALS):
        r = got.get(i)
        have = r and (r.direction, r.entry, r.entry_low, r.entry_high, r.stop_loss, r.take_profits, r.quality_flag)
        if have != ((direction, *want) if direction else None):
            wrong.append((text, have))
    gate(wrong, len(SIGNALS))


def test_follow_ups(spark):
    m = h.messages(spark, [(i, i, r[0], None) for i, r in enumerate(FOLLOW_UPS)])
    got = {int(r.message_uid.split(":")[1]): r for r in parse_follow_ups.parse_follow_ups(m, Settings()).collect()}
    wrong = []
    for i, (text, event, *want) in enumerate(FOLLOW_UPS):
        r = got.get(i)
        have = r and [r.event_type, r.tp_index, r.claimed_pips, r.claimed_price, r.new_stop_loss]
        if have != ([event, *want] if event else None):
            wrong.append((text, have))
    gate(wrong, len(FOLLOW_UPS))


@pytest.mark.parametrize("table", [CLASSES, SIGNALS, FOLLOW_UPS])
def test_texts_are_told_once(table):
    assert len({r[0] for r in table}) == len(table)
