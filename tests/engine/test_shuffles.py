"""What the queries deal out over the cluster."""

import re

import pytest

from claimcheck.config import Settings
from claimcheck.operators import link
from claimcheck.plans import demo, queries

from . import helpers as h

SF = "/root/testdata/sf0.001"


def dealt_by(df):
    """The keys of every exchange, without Spark's numbers."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return {re.sub(r"#\d+L?|, \d+$", "", keys) for keys in re.findall(r"Exchange hashpartitioning\((.*?)\), ", plan)}


# a busy group's signals are many times their number once they are spread over levels and targets
@pytest.mark.parametrize("name", ["links", "links_of_group", "low_confidence_links", "contested_links", "reported_outcomes", "outcome_lookup", "tp_depth_levels", "group_metrics", "discrepancy_counts"])
def test_links_deal_rows_out_before_they_multiply(spark, name):
    keys = dealt_by(queries.QUERIES[name](spark, SF))
    assert "group_id, slot" in keys
    assert not [k for k in keys if re.search(r"follow_up_id|message_uid|level, k|slot, b", k)]


def test_messages_are_dealt_out_once(spark):
    keys = dealt_by(demo.messages(spark, SF))
    assert not [k for k in keys if "group_id" in k]  # text is wider than a number


def test_carried_columns_are_those_of_the_follow_up(spark):
    s = h.signals(spark, [("g:1", 0, "BUY", 4700.0, None, None, None, [4710.0], "COMPLETE"), ("g:2", 5, "BUY", 4700.0, None, None, None, [], "MISSING_TP")])
    f = h.follow_ups(spark, [("g:7", 10, "TP_HIT", 1, None, 30.0), ("g:8", 11, "CANCEL", None, None, None), ("g:9", 12, "SL_HIT", None, 4700.5, -5.0)])
    m = h.messages(spark, [(7, 10, "a", None), (8, 11, "b", 1), (9, 12, "c", 77)])
    pick = lambda c: c.where("rank = 1").select("follow_up_id", "signal_id")
    for tiebreak in (None, pick):
        got = {r.follow_up_id: r for r in link.link(f, s, m, Settings(), tiebreak, ["ts", "event_type", "tp_index", "claimed_price", "claimed_pips"]).collect()}
        assert {k: (r.signal_id, r.link_method) for k, r in got.items()} == {"g:7": ("g:1", "temporal_numeric"), "g:8": ("g:1", "reply_to"), "g:9": ("g:2", "temporal_numeric")}
        assert [(got[k].ts, got[k].event_type, got[k].tp_index, got[k].claimed_price, got[k].claimed_pips) for k in ("g:7", "g:8", "g:9")] == [
            (h.at(10), "TP_HIT", 1, None, 30.0), (h.at(11), "CANCEL", None, None, None), (h.at(12), "SL_HIT", None, 4700.5, -5.0),
        ]


def test_follow_ups_meet_their_pairs_in_one_slot(spark):
    plan = queries.QUERIES["link_interval_candidates"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    spread = re.findall(r"Generate explode\(array\(.*?\]", plan)
    assert spread and all("signal_id" in x and "follow_up_id" not in x for x in spread)


def test_alike_signals_meet_alike_follow_ups_once(spark, monkeypatch):
    """Pairs are made of what the join gives, one row for each number of ids, and all are there, however few ids a row takes."""
    monkeypatch.setattr(link, "ALIKE", 3, raising=False)
    s = [(f"{'gk'[i % 2]}:{i}", i % 6 * 700, "BUY", 4700.0 + i % 3, None, None, None, [None, [], [4710.0]][i % 3], "COMPLETE") for i in range(60)]
    f = [(f"{'gkh'[i % 3]}:{100 + i}", 100 + i % 5 * 1200, "TP_HIT", None if i % 5 else 1, 4701.5 if i % 2 else None, None) for i in range(70)]
    got = link.interval_candidates(h.follow_ups(spark, f), h.signals(spark, s), Settings())
    want = sorted((y[0], x[0]) for x in s for y in f if x[0][0] == y[0][0] and 0 <= y[1] - x[1] <= 48 * 60)
    assert sorted((r.follow_up_id, r.signal_id) for r in got.collect()) == want and len(want) > 300
    for r in got.collect():
        x, y = s[int(r.signal_id[2:])], f[int(r.follow_up_id[2:]) - 100]
        price, tp = y[4] is not None and x[7] is not None and abs(y[4] - x[3]) <= 1, y[3] == 1 and x[7] == [4710.0]
        assert (r.price_match, r.tp_match) == (price, tp)
        assert abs(r.score - (0.55 * price + 0.35 * tp + 0.3 * (1 - (y[1] - x[1]) / 2880))) < 1e-9
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("explode(signal_ids") < plan.index("Join Inner")


def test_only_what_replies_or_was_bought_is_dealt_out(spark, tmp_path):
    """Of a table of many parts the other rows, more than half, stay where they are; all have the same messages."""
    whole = spark.read.parquet(f"{SF}/events.parquet")
    whole.repartition(16).write.option("maxRecordsPerFile", 100).parquet(f"{tmp_path}/events.parquet")
    key = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", "128m")
    try:
        many = demo.messages(spark, str(tmp_path))
        assert "RoundRobin" not in many._jdf.queryExecution().executedPlan().toString()
        want = sorted(demo.messages(spark, SF).collect(), key=lambda r: r.message_id)
        assert sorted(many.collect(), key=lambda r: r.message_id) == want and len(want) == whole.count()
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", key)


def test_few_signals_go_to_two_slots(spark):
    s = h.signals(spark, [(f"g:{i}", 60 * i, "BUY", 4700.0, None, None, None, [4710.0], "COMPLETE") for i in range(1, 900)])
    f = h.follow_ups(spark, [(f"g:{1000 + i}", 60 * i + 1, "TP_HIT", 1, None, 30.0) for i in range(0, 950, 7)])
    f = f.unionByName(h.follow_ups(spark, [("g:5000", 899 * 60 + 48 * 60, "TP_HIT", 1, None, 1.0), ("g:5001", 899 * 60 + 48 * 60 + 0.001, "TP_HIT", 1, None, 1.0)]))
    cfg = Settings()
    best = link.best_candidates(f, s, cfg, 1).groupBy("follow_up_id").agg(link.F.max("score")).collect()
    every = link.interval_candidates(f, s, cfg).groupBy("follow_up_id").agg(link.F.max("score")).collect()
    assert sorted(best) == sorted(every)
    assert "g:5000" in {r[0] for r in best} and "g:5001" not in {r[0] for r in best}
    own, last = link._slot(link.F.col("ts"), cfg.link_window_hours * link.SLOT_WINDOWS), link._slot(link.F.col("ts") + link.S.hours(cfg.link_window_hours), cfg.link_window_hours * link.SLOT_WINDOWS)
    assert s.where(own != last).count() < 0.4 * s.count()


def multiplied(df):
    """The most rows that a generator of the plan made."""
    df.collect()
    nodes, most = [df._jdf.queryExecution().executedPlan()], 0
    while nodes:
        x = nodes.pop()
        if x.nodeName() == "AdaptiveSparkPlan":
            nodes.append(x.executedPlan())
        elif x.nodeName().endswith("QueryStage"):
            nodes.append(x.plan())
        else:
            below = x.children()
            nodes += [below.apply(i) for i in range(below.size())]
        if x.nodeName() == "Generate":
            most = max(most, x.metrics().apply("numOutputRows").value())
    return most


@pytest.mark.parametrize("top", [1, 2, 5])
def test_signals_posted_again_are_not_multiplied(spark, top):
    """Of 400 posts of one ladder at one time those that can be best are spread over levels and targets, before it was all."""
    ladder = [4710.0, 4720.0, 4730.0, 4740.0]
    posts = [(f"g:{1000 + i}", 0, "BUY", 4700.0, None, None, 4690.0, ladder, "COMPLETE") for i in range(400)]
    other = [("g:1", 0, "BUY", 4700.0, None, None, 4690.0, ladder[:3], "COMPLETE"), ("g:2", -1, "BUY", 4700.0, None, None, 4690.0, ladder, "COMPLETE"), ("g:3", 0, "BUY", 4711.0, None, None, None, [], "MISSING_BOTH")]
    s = h.signals(spark, posts + other)
    f = h.follow_ups(spark, [("g:9001", 1, "TP_HIT", 4, 4740.0, None), ("g:9002", 1, "TP_HIT", 3, None, None), ("g:9003", 0, "SL_HIT", None, 4711.0, None), ("g:9004", 2, "CANCEL", None, None, None), ("g:9005", 1, "TP_HIT", 9, 4690.0, None)])
    cfg = Settings()
    best = link.best_candidates(f, s, cfg, top)
    firsts = lambda c: sorted(map(tuple, link._ranked(c).where(f"rank <= {top}").select("follow_up_id", "rank", "signal_id", "score").collect()))
    assert firsts(best) == firsts(link.interval_candidates(f, s, cfg))
    assert multiplied(best) < 1000  # 806 are the signals in their slots
