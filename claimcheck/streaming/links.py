"""Linking as a stream: an extension beyond the batch stages.

Signals and follow-ups arrive as streams; each follow-up is joined to the
signals of its group in the window before it, and state older than the window
is dropped by watermarks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimcheck.config import Settings


def candidates(follow_ups: DataFrame, signals: DataFrame, cfg: Settings, late: str = "10 minutes") -> DataFrame:
    """(follow_up_id, signal_id, group_id, ts, signal_ts) of every signal in the window before a follow-up."""
    # event time must carry a time zone for a watermark
    s = signals.select("signal_id", F.col("group_id").alias("s_group"), F.col("ts").cast("timestamp").alias("signal_ts")).withWatermark("signal_ts", late)
    f = follow_ups.select("follow_up_id", "group_id", F.col("ts").cast("timestamp").alias("ts")).withWatermark("ts", late)
    hours = int(cfg.link_window_hours)
    cond = F.expr(f"group_id = s_group AND signal_ts <= ts AND signal_ts >= ts - interval {hours} hours")
    return f.join(s, cond).select("follow_up_id", "signal_id", "group_id", "ts", "signal_ts")
