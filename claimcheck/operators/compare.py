"""Reported against actual outcomes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Category by reported and actual state; "*" is any other actual state.
CATEGORIES = {
    "WIN": {"WIN": "AGREES", "LOSS": "REPORTED_WIN_ACTUAL_LOSS", "*": "REPORTED_WIN_ACTUAL_OPEN"},
    "LOSS": {"LOSS": "AGREES", "WIN": "REPORTED_LOSS_ACTUAL_WIN", "*": "UNKNOWN"},
    "OPEN": {"WIN": "REPORTED_OPEN_ACTUAL_WIN", "LOSS": "REPORTED_OPEN_ACTUAL_LOSS", "*": "AGREES"},
    "OPEN_AT_EXPIRY": {"WIN": "REPORTED_OPEN_ACTUAL_WIN", "LOSS": "REPORTED_OPEN_ACTUAL_LOSS", "*": "AGREES"},
    "BREAK_EVEN": {"WIN": "REPORTED_OPEN_ACTUAL_WIN", "LOSS": "REPORTED_OPEN_ACTUAL_LOSS", "*": "AGREES"},
    "NO_REPORT": {"WIN": "REPORTED_NO_REPORT_ACTUAL_WIN", "LOSS": "REPORTED_NO_REPORT_ACTUAL_LOSS", "*": "REPORTED_NO_REPORT_ACTUAL_NONE"},
}


def category(reported: Column, actual: Column) -> Column:
    out = F.lit("UNKNOWN")
    for state, by_actual in CATEGORIES.items():
        inner = F.lit(by_actual["*"])
        for a, name in by_actual.items():
            if a != "*":
                inner = F.when(actual == a, name).otherwise(inner)
        out = F.when(reported == state, inner).otherwise(out)
    return F.when(actual == "INSUFFICIENT_DATA", "INSUFFICIENT_DATA").when(actual == "AMBIGUOUS", "AMBIGUOUS_BAR").otherwise(out)


def discrepancies(signals: DataFrame, reported: DataFrame, actual: DataFrame, group: str | None = None) -> DataFrame:
    """Every signal with both states, its category and both pips."""
    s = signals if group is None else signals.where(F.col("group_id") == group)
    r = reported.select("signal_id", F.col("final_state").alias("r"), F.col("claimed_pips").alias("reported_pips"))
    a = actual.select("signal_id", F.col("final_state").alias("a"), F.col("realized_pips").alias("actual_pips"))
    out = s.select("signal_id", "group_id").join(r, "signal_id", "left").join(a, "signal_id", "left")
    out = out.withColumns({"reported_state": F.coalesce("r", F.lit("NO_REPORT")), "actual_state": F.coalesce("a", F.lit("INSUFFICIENT_DATA"))})
    return out.select("signal_id", "group_id", "reported_state", "actual_state", category(F.col("reported_state"), F.col("actual_state")).alias("category"), "reported_pips", "actual_pips")


def discrepancy_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("category").agg(F.count("*").alias("n"))
