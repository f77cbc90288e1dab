"""Per-group metrics, target depth and leaderboard."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimcheck.functions import scalars as S

LEVELS_SHOWN = 5


def in_window(signals: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Signals from start to end, both inclusive (ISO text)."""
    if start is not None:
        signals = signals.where(F.col("ts") >= S.utc(F.lit(start)))
    if end is not None:
        signals = signals.where(F.col("ts") <= S.utc(F.lit(end)))
    return signals


def group_metrics(signals: DataFrame, reported: DataFrame, actual: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Win rates as reported and as they were, mean pips and risk ratio, median bars: a row a group."""
    r = reported.select("signal_id", F.col("final_state").alias("r"))
    a = actual.select("signal_id", F.col("final_state").alias("a"), "realized_pips", "realized_rr", "bars_to_outcome")
    rows = in_window(signals, start, end).select("signal_id", "group_id").join(r, "signal_id", "left").join(a, "signal_id", "left")
    n = lambda col, state: F.count_if(F.col(col) == state)
    out = rows.groupBy("group_id").agg(
        F.count("*").alias("n_signals"),
        n("r", "WIN").alias("reported_wins"),
        n("r", "LOSS").alias("reported_losses"),
        n("a", "WIN").alias("actual_wins"),
        n("a", "LOSS").alias("actual_losses"),
        S.mean(F.col("realized_pips")).alias("avg_realized_pips"),
        S.mean(F.col("realized_rr")).alias("avg_realized_rr"),
        S.median(F.col("bars_to_outcome")).alias("median_bars_to_outcome"),
        n("a", "AMBIGUOUS").alias("ambiguous_bars"),
        n("a", "INSUFFICIENT_DATA").alias("insufficient_data"),
    )
    out = out.withColumns({"reported_decided": F.col("reported_wins") + F.col("reported_losses"), "actual_decided": F.col("actual_wins") + F.col("actual_losses")})
    out = out.withColumns(
        {
            "reported_win_rate": S.ratio(F.col("reported_wins"), F.col("reported_decided")),
            "actual_win_rate": S.ratio(F.col("actual_wins"), F.col("actual_decided")),
        }
    )
    return out.withColumn("win_rate_gap", F.bround(F.col("reported_win_rate") - F.col("actual_win_rate"), 4)).select(
        "group_id", "n_signals", "reported_wins", "reported_losses", "reported_decided", "reported_win_rate", "actual_wins", "actual_losses",
        "actual_decided", "actual_win_rate", "win_rate_gap", "avg_realized_pips", "avg_realized_rr", "median_bars_to_outcome", "ambiguous_bars", "insufficient_data",
    )


def _with_report(signals: DataFrame, reported: DataFrame) -> DataFrame:
    r = reported.select("signal_id", F.when(F.col("final_state") != "NO_REPORT", F.col("final_state")).alias("r"), "max_tp_hit")
    tps = F.coalesce("take_profits", F.array().cast("array<double>"))
    return signals.select("signal_id", "group_id", F.size(tps).alias("n_tps")).join(r, "signal_id", "left")


def tp_depth_levels(signals: DataFrame, reported: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """(group_id, level, denom, hits, hit_rate) of every level up to a group's deepest ladder."""
    rows = _with_report(in_window(signals, start, end), reported).where("n_tps > 0")
    each = rows.select("group_id", "r", "max_tp_hit", F.explode(F.sequence(F.lit(1), F.col("n_tps"))).alias("level"))
    told = F.col("r").isNotNull()
    out = each.groupBy("group_id", "level").agg(F.count_if(told).alias("denom"), F.count_if(told & (F.col("max_tp_hit") >= F.col("level"))).alias("hits"))
    return out.withColumn("hit_rate", S.ratio(F.col("hits"), F.col("denom")))


def tp_depth_summary(signals: DataFrame, reported: DataFrame, start: str | None = None, end: str | None = None, min_signals: int = 0) -> DataFrame:
    """(group_id, n_signals, n_reported, no_report_rate, sl_hit_rate, max_tp_level)."""
    rows = _with_report(in_window(signals, start, end), reported)
    out = rows.groupBy("group_id").agg(
        F.count("*").alias("n_signals"), F.count("r").alias("n_reported"), F.count_if(F.col("r") == "LOSS").alias("losses"), F.max("n_tps").alias("max_tp_level")
    )
    out = out.where(F.col("n_signals") >= min_signals)
    return out.select(
        "group_id", "n_signals", "n_reported", S.ratio(F.col("n_signals") - F.col("n_reported"), F.col("n_signals")).alias("no_report_rate"),
        S.ratio(F.col("losses"), F.col("n_reported")).alias("sl_hit_rate"), "max_tp_level",
    )


def tp_depth_long(levels: DataFrame, shown: int = LEVELS_SHOWN) -> DataFrame:
    """(group_id, tp_level, hit_rate) of the levels shown that have a rate."""
    return levels.where((F.col("level") <= shown) & F.col("hit_rate").isNotNull()).select("group_id", F.concat(F.lit("TP"), F.col("level").cast("string")).alias("tp_level"), "hit_rate")


def tp_depth_wide(summary: DataFrame, levels: DataFrame, shown: int = LEVELS_SHOWN) -> DataFrame:
    """The summary with tp1_hit_rate .. as columns; one aggregation, no pivot job."""
    rates = levels.groupBy("group_id").agg(*[F.max(F.when(F.col("level") == n, F.col("hit_rate"))).alias(f"tp{n}_hit_rate") for n in range(1, shown + 1)])
    return summary.drop("max_tp_level").join(rates, "group_id", "left")


def leaderboard(signals: DataFrame, reported: DataFrame) -> DataFrame:
    """Counts of reported states a group, most wins first; a win rate of 0 where nothing is decided."""
    rows = signals.select("signal_id", "group_id").join(reported.select("signal_id", "final_state"), "signal_id")
    n = lambda state: F.count_if(F.col("final_state") == state)
    out = rows.groupBy("group_id").agg(
        F.count("*").alias("n_signals"), n("WIN").alias("wins"), n("LOSS").alias("losses"), n("OPEN").alias("open"), n("NO_REPORT").alias("no_report")
    )
    decided = F.col("wins") + F.col("losses")
    return out.withColumn("win_rate", F.coalesce(F.col("wins") / F.nullif(decided, F.lit(0)), F.lit(0.0))).orderBy(F.desc("wins"), "group_id")


def by_actual_rate(metrics: DataFrame) -> DataFrame:
    """Metrics in the report's order: actual rate from high to low, none as 0."""
    return metrics.orderBy(F.desc(F.coalesce("actual_win_rate", F.lit(0.0))), "group_id")


def by_first_target(wide: DataFrame) -> DataFrame:
    """Depth rows by the first target's rate from high to low, none last."""
    return wide.orderBy(F.desc(F.coalesce("tp1_hit_rate", F.lit(-1.0))), "group_id")


def counts(df: DataFrame, column: str) -> DataFrame:
    """Rows of each value of a coded column: a stage's run statistics."""
    return df.groupBy(column).agg(F.count("*").alias("n"))
