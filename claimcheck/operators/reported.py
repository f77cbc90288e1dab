"""What a channel reported for each signal."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimcheck.config import Settings


def reported_outcomes(signals: DataFrame, links: DataFrame, follow_ups: DataFrame | None, cfg: Settings) -> DataFrame:
    """One row a signal from its linked events, by one aggregation.

    Cancelled: NO_REPORT.  A stop at or before the first target: LOSS.  Any
    target: WIN, deepest target, sum of pips, closed at the last.  Closed by
    hand: BREAK_EVEN.  Other events: OPEN.  None: NO_REPORT.

    ``follow_ups``: None if the links carry their columns.
    """
    events = links.where(F.col("link_confidence") >= cfg.min_link_confidence)
    if follow_ups is not None:
        events = events.select("signal_id", "follow_up_id").join(follow_ups.select("follow_up_id", "ts", "event_type", "tp_index", "claimed_pips"), "follow_up_id")

    def first(kind):
        return F.min(F.when(F.col("event_type") == kind, F.struct("ts", "follow_up_id", "claimed_pips")))

    tp = F.col("event_type") == "TP_HIT"
    per = events.groupBy("signal_id").agg(
        F.count("*").alias("n"),
        first("CANCEL").alias("cancel"),
        first("SL_HIT").alias("sl"),
        first("MANUAL_CLOSE").alias("hand"),
        F.min(F.when(tp, F.col("ts"))).alias("tp_first"),
        F.max(F.when(tp, F.col("ts"))).alias("tp_last"),
        F.max(F.when(tp, F.col("tp_index"))).alias("tp_max"),
        F.sum(F.when(tp, F.col("claimed_pips"))).alias("tp_pips"),
    )
    out = signals.select("signal_id").join(per, "signal_id", "left")
    n = F.coalesce("n", F.lit(0))
    cancel, sl, hand, tps = (F.col(c).isNotNull() for c in ("cancel", "sl", "hand", "tp_first"))
    loss = sl & (~tps | (F.col("sl")["ts"] <= F.col("tp_first")))
    state = F.when(n == 0, "NO_REPORT").when(cancel, "NO_REPORT").when(loss, "LOSS").when(tps, "WIN").when(hand, "BREAK_EVEN").otherwise("OPEN")
    won = state == "WIN"
    return out.select(
        "signal_id",
        state.alias("final_state"),
        F.when(won, F.col("tp_max")).cast("int").alias("max_tp_hit"),
        F.when(state == "LOSS", F.col("sl")["claimed_pips"]).when(won, F.nullif("tp_pips", F.lit(0.0))).when(state == "BREAK_EVEN", F.col("hand")["claimed_pips"]).alias("claimed_pips"),
        F.when(cancel, F.col("cancel")["ts"]).when(state == "LOSS", F.col("sl")["ts"]).when(won, F.col("tp_last")).when(state == "BREAK_EVEN", F.col("hand")["ts"]).alias("closed_at"),
        n.cast("long").alias("source_follow_up_count"),
        F.lit(cfg.version).alias("computed_version"),
    )
