"""Links, reported and actual outcomes, comparison and analytics on small tables."""

import random
from dataclasses import replace

import pytest

from claimcheck.config import Settings
from claimcheck.operators import actual, analytics, compare, link, market, reported
from tests.engine import helpers as h

CFG = Settings()
BUY = ("g:1", 0, "BUY", 4700.0, None, None, 4690.0, [4710.0, 4720.0], "COMPLETE")


def test_link_tiers(spark):
    s = h.signals(spark, [BUY, ("g:2", 60, "BUY", 4800.0, None, None, None, [4810.0], "MISSING_SL"), ("k:3", 5, "BUY", 4700.0, None, None, None, [], "MISSING_BOTH")])
    m = h.messages(spark, [(1, 0, "s", None), (2, 60, "s", None), (10, 70, "r", 1), (11, 80, "p", None), (12, 90, "n", 99), (13, 43300, "late", None), (14, 95, "chat", None)])
    f = h.follow_ups(spark, [("g:10", 70, "TP_HIT", 1, None, None), ("g:11", 80, "TP_HIT", 2, 4710.4, None), ("g:12", 90, "SL_HIT", None, None, None), ("g:13", 43300, "TP_HIT", 1, None, None)])
    got = {r.follow_up_id: r for r in link.link(f, s, m, CFG).collect()}
    assert (got["g:10"].signal_id, got["g:10"].link_method, got["g:10"].link_confidence) == ("g:1", "reply_to", 0.98)
    assert (got["g:11"].signal_id, got["g:11"].link_method) == ("g:1", "temporal_numeric") and got["g:11"].link_confidence == 0.95
    assert (got["g:12"].signal_id, got["g:12"].link_method) == ("g:2", "recent_open") and got["g:12"].link_confidence < 0.31
    assert "g:13" not in got and len(got) == 3
    assert {r.link_method: (r.n_links, r.n_low_confidence) for r in link.method_stats(link.link(f, s, m, CFG), CFG).collect()} == {"reply_to": (1, 0), "temporal_numeric": (1, 0), "recent_open": (1, 1)}


def test_window_ends_are_inclusive_and_ties_go_to_the_earliest(spark):
    s = h.signals(spark, [("g:1", 0, "BUY", 4700.0, None, None, None, [], "MISSING_BOTH"), ("g:2", 0, "BUY", 4700.0, None, None, None, [], "MISSING_BOTH")])
    f = h.follow_ups(spark, [("g:9", 48 * 60, "UPDATE", None, None, 5.0), ("g:10", 48 * 60 + 0.1, "UPDATE", None, None, 5.0), ("g:11", 0, "UPDATE", None, None, 5.0)])
    m = h.messages(spark, [(9, 1, "x", None)])
    assert {(r.follow_up_id, r.signal_id) for r in link.link(f, s, m, CFG).collect()} == {("g:9", "g:1"), ("g:11", "g:1")}
    c = link.interval_candidates(f, s, CFG)
    assert {r.follow_up_id for r in link.contested(c, CFG).collect()} == {"g:9", "g:11"}
    pick = lambda rows: rows.where("rank = 2").select("follow_up_id", "signal_id")
    assert {r.signal_id for r in link.link(f, s, m, CFG, pick).collect()} == {"g:2"}


CASES = [
    ([("TP_HIT", 1, 10.0), ("TP_HIT", 2, 20.0)], ("WIN", 2, 30.0, 2)),
    ([("SL_HIT", None, -10.0), ("TP_HIT", 1, 5.0)], ("LOSS", None, -10.0, 2)),
    ([("TP_HIT", 1, None), ("SL_HIT", None, -10.0)], ("WIN", 1, None, 2)),
    ([("TP_HIT", None, None)], ("WIN", None, None, 1)),
    ([("TP_HIT", 1, 5.0), ("CANCEL", None, None)], ("NO_REPORT", None, None, 2)),
    ([("UPDATE", None, 5.0)], ("OPEN", None, None, 1)),
    ([("MANUAL_CLOSE", None, 7.0), ("MANUAL_CLOSE", None, 9.0)], ("BREAK_EVEN", None, 7.0, 2)),
    ([], ("NO_REPORT", None, None, 0)),
]


def test_reported(spark):
    s, f, lk = [], [], []
    for k, (events, _) in enumerate(CASES):
        s.append((f"g:{k}", 0, "BUY", 4700.0, None, None, None, [], "MISSING_BOTH"))
        for j, (kind, tp, pips) in enumerate(events):
            f.append((f"g:{100 * k + j + 1000}", j + 1, kind, tp, None, pips))
            lk.append((f[-1][0], f"g:{k}", 0.9))
    f.append(("g:5000", 1, "SL_HIT", None, None, None))
    lk.append(("g:5000", "g:7", 0.59))
    got = {r.signal_id: r for r in reported.reported_outcomes(h.signals(spark, s), h.links(spark, lk), h.follow_ups(spark, f), CFG).collect()}
    for k, (events, want) in enumerate(CASES):
        r = got[f"g:{k}"]
        assert (r.final_state, r.max_tp_hit, r.claimed_pips, r.source_follow_up_count) == want, events
    assert got["g:0"].closed_at == h.at(2) and got["g:4"].closed_at == h.at(2) and got["g:5"].closed_at is None


FLAT = (4700, 4705, 4695, 4700)


def run(spark, signal, ohlc, cfg=CFG, start=0):
    (r,) = actual.actual_outcomes(h.signals(spark, [signal]), h.bars(spark, ohlc, start), cfg).collect()
    return r.final_state, r.first_touch_event, r.first_touch_price, r.realized_pips, r.realized_rr, r.bars_to_outcome


def test_actual_outcomes(spark):
    sell = ("g:1", 0, "SELL", 4700.0, None, None, 4710.0, [4690.0], "COMPLETE")
    assert run(spark, BUY, [FLAT, FLAT, (4705, 4715, 4700, 4712)]) == ("WIN", "TP1", 4710.0, 100.0, 1.0, 3)
    assert run(spark, sell, [FLAT, (4705, 4712, 4700, 4708)]) == ("LOSS", "SL", 4710.0, -100.0, -1.0, 2)
    assert run(spark, BUY, [(4700, 4725, 4685, 4700)]) == ("AMBIGUOUS", "AMBIGUOUS(SL+TP1+TP2)", pytest.approx(4706.6666667), None, None, 1)
    assert run(spark, BUY, [FLAT] * 5) == ("OPEN_AT_EXPIRY", "EXPIRY", 4700.0, 0.0, None, 5)
    assert run(spark, BUY, [FLAT], start=-5) == ("INSUFFICIENT_DATA", None, None, None, None, None)


def test_actual_entries_and_policies(spark):
    ranged = ("g:1", 0, "BUY", None, 4680.0, 4690.0, None, [4710.0], "MISSING_SL")
    gap = [(4700, 4702, 4695, 4700), (4670, 4675, 4660, 4670)]  # the hour's hull holds the range, no bar does
    assert run(spark, ranged, gap)[:2] == ("OPEN_AT_EXPIRY", "ENTRY_NOT_FILLED")
    assert run(spark, ranged, [(4700, 4711, 4699, 4700), (4690, 4692, 4688, 4690)])[:3] == ("WIN", "TP1", 4710.0)
    fixed = replace(CFG, default_sl_policy="FIXED_PIPS")
    assert run(spark, ("g:1", 0, "BUY", 4700.0, None, None, None, [], "MISSING_BOTH"), [FLAT], fixed) == ("LOSS", "SL", 4695.0, -50.0, -1.0, 1)
    assert run(spark, ("g:1", 0, "BUY", None, None, None, None, [], "MISSING_BOTH"), [FLAT])[0] == "INSUFFICIENT_DATA"
    no_risk = ("g:1", 0, "BUY", 4700.0, None, None, 4700.0, [4710.0], "COMPLETE")
    assert run(spark, no_risk, [(4705, 4712, 4701, 4708)])[4] is None


def test_far_touches_and_holding_ends(spark):
    calm = [FLAT] * 600
    hit = calm[:500] + [(4705, 4711, 4700, 4708)] + calm
    assert run(spark, BUY, hit) == ("WIN", "TP1", 4710.0, 100.0, 1.0, 501)
    short = replace(CFG, max_holding_hours=500 / 60)
    assert run(spark, BUY, hit, short)[0] == "WIN"
    shorter = replace(CFG, max_holding_hours=499 / 60)
    assert run(spark, BUY, hit, shorter) == ("OPEN_AT_EXPIRY", "EXPIRY", 4700.0, 0.0, None, 500)
    late = ("g:1", 30, *BUY[2:])
    assert run(spark, late, hit)[5] == 471


def states(spark, rows, extra):
    return spark.createDataFrame(rows, "signal_id string, final_state string, " + extra)


def test_compare_and_metrics(spark):
    s = h.signals(spark, [(f"g:{k}", k, *BUY[2:]) for k in range(5)])
    r = states(spark, [("g:0", "WIN", 10.0, 2), ("g:1", "WIN", None, None), ("g:2", "WIN", None, 1), ("g:3", "LOSS", -5.0, None)], "claimed_pips double, max_tp_hit int")
    a = states(spark, [("g:0", "WIN", 10.0, 1.0, 3), ("g:1", "LOSS", -5.0, -1.0, 4), ("g:2", "AMBIGUOUS", None, None, 9), ("g:3", "OPEN_AT_EXPIRY", 1.0, None, 20)], "realized_pips double, realized_rr double, bars_to_outcome long")
    got = {x.signal_id: x.category for x in compare.discrepancies(s, r, a).collect()}
    assert got == {"g:0": "AGREES", "g:1": "REPORTED_WIN_ACTUAL_LOSS", "g:2": "AMBIGUOUS_BAR", "g:3": "UNKNOWN", "g:4": "INSUFFICIENT_DATA"}
    (m,) = analytics.group_metrics(s, r, a).collect()
    assert (m.n_signals, m.reported_win_rate, m.actual_win_rate, m.win_rate_gap) == (5, 0.75, 0.5, 0.25)
    assert (m.avg_realized_pips, m.avg_realized_rr, m.median_bars_to_outcome, m.ambiguous_bars, m.insufficient_data) == (2.0, 0.0, 6.5, 1, 0)
    (w,) = analytics.group_metrics(s, r, a, "2026-01-17T10:01:00Z", "2026-01-17T10:02:00Z").collect()
    assert w.n_signals == 2
    levels = {x.level: (x.denom, x.hits, x.hit_rate) for x in analytics.tp_depth_levels(s, r).collect()}
    assert levels == {1: (4, 2, 0.5), 2: (4, 1, 0.25)}
    (t,) = analytics.tp_depth_summary(s, r).collect()
    assert (t.n_signals, t.n_reported, t.no_report_rate, t.sl_hit_rate, t.max_tp_level) == (5, 4, 0.2, 0.25, 2)
    (b,) = analytics.leaderboard(s, r).collect()
    assert (b.n_signals, b.wins, b.losses, b.win_rate) == (4, 3, 1, 0.75)


def test_every_pair_of_states_has_its_category(spark):
    from pyspark.sql import functions as F

    from claimcheck.schemas import VALUES

    pairs = [(r, a) for r in VALUES["final_state"] for a in VALUES["final_state"]]
    df = spark.createDataFrame(pairs, "r string, a string")
    got = {(x.r, x.a): x.c for x in df.withColumn("c", compare.category(F.col("r"), F.col("a"))).collect()}
    assert got["WIN", "BREAK_EVEN"] == "REPORTED_WIN_ACTUAL_OPEN" and got["BREAK_EVEN", "OPEN"] == "AGREES"
    assert got["NO_REPORT", "OPEN_AT_EXPIRY"] == "REPORTED_NO_REPORT_ACTUAL_NONE" and got["AMBIGUOUS", "WIN"] == "UNKNOWN"
    assert len(set(got.values())) == 12


def test_gaps(spark):
    r = spark.createDataFrame([("XAUUSD", h.at(0), h.at(120))], "instrument string, range_start timestamp_ntz, range_end timestamp_ntz")
    assert market.gaps(h.bars(spark, [FLAT] * 60), r, CFG).count() == 0
    (g,) = market.gaps(h.bars(spark, [FLAT] * 59), r, CFG).collect()
    assert (g.n_bars, g.expected_bars, g.threshold, g.slice_start) == (59, 120, 60, h.at(0))
    assert market.required_range(h.signals(spark, []), CFG).count() == 0
    with pytest.raises(ValueError):
        market.gaps(h.bars(spark, [FLAT]), r, CFG, "2min")


@pytest.mark.parametrize("top", [1, 2, 5])
def test_best_candidates_are_those_of_all_pairs(spark, top):
    rng = random.Random(top)
    minute = lambda: rng.choice([0, 1, 2, 48 * 60, 48 * 60 + 1, rng.randrange(9000), rng.randrange(9000), 0.001 + rng.randrange(90)])
    price = lambda *also: rng.choice([*also, 4700 + rng.randrange(40) / 4, 4700 + rng.random(), 4701.0 + 1e-9, 1e300])
    s = [(f"{rng.choice('gk')}:{i}", minute(), "BUY", price(None), price(None), price(None), price(None), rng.choice([None, [], [price()], [price(), price(), price()]]), "COMPLETE") for i in range(400)]
    f = [(f"{rng.choice('ghk')}:{1000 + i}", minute(), "TP_HIT", rng.choice([None, 0, 1, 2, 3, 9]), price(None, None), None) for i in range(300)]
    s, f = h.signals(spark, s), h.follow_ups(spark, f)
    pairs = link.interval_candidates(f, s, CFG)
    best = lambda c: {(r.follow_up_id, r.rank): r for r in link._ranked(c).where(f"rank <= {top}").collect()}
    few = link.best_candidates(f, s, CFG, top).cache()
    want = best(pairs)
    assert best(few) == want and len({k for k, _ in want}) > 150
    assert few.columns == pairs.columns and few.count() <= 300 * 4 * 2 * 9 * top


def test_links_of_a_busy_hour_do_not_meet_in_pairs(spark):
    n = 1500
    s = h.signals(spark, [(f"g:{i}", i / n, "BUY", 4700.0 + i % 7, None, None, None, [4800.0] * (i % 3), "COMPLETE") for i in range(n)])
    f = h.follow_ups(spark, [(f"g:{5000 + i}", 2 + i / n, "TP_HIT", 1 + i % 2, None, None) for i in range(n)])
    got = link.best_candidates(f, s, CFG, 1)
    assert got.count() <= 2 * n
    m = h.messages(spark, [(1, 0, "s", None)])
    want = {f"g:{5000 + i}": f"g:{n - 1}" for i in range(n)}  # the last signal has two targets
    assert {r.follow_up_id: r.signal_id for r in link.link(f, s, m, CFG).collect()} == want
