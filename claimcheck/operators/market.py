"""Which bars are needed and which are missing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimcheck.config import Settings
from claimcheck.functions import scalars as S


def required_range(signals: DataFrame, cfg: Settings) -> DataFrame:
    """(instrument, range_start, range_end): from the first signal to the last one's end of holding."""
    return signals.groupBy("instrument").agg(F.min("ts").alias("range_start"), (F.max("ts") + S.hours(cfg.max_holding_hours)).alias("range_end"))


def gaps(bars: DataFrame, ranges: DataFrame, cfg: Settings, interval: str | None = None) -> DataFrame:
    """Day slices of the ranges with fewer bars than the threshold.

    A slice of m minutes expects m / bar minutes, at least 1; the threshold is
    the covered ratio of that, at least 1.
    """
    interval = interval or cfg.bar_interval
    minutes = S.interval_minutes(interval)
    first = F.date_trunc("day", F.col("range_start")).cast("timestamp_ntz")
    one = F.expr("interval 1 day")
    days = ranges.where("range_start < range_end").select("*", F.explode(F.sequence(first, F.col("range_end"), one)).alias("day"))
    slices = days.select("instrument", "day", F.greatest("day", "range_start").alias("slice_start"), F.least(F.col("day") + one, F.col("range_end")).alias("slice_end"))
    slices = slices.where("slice_start < slice_end")
    b = bars.where(F.col("interval") == interval).select("instrument", F.col("ts"), F.date_trunc("day", F.col("ts")).cast("timestamp_ntz").alias("day"))
    kept = b.join(slices, ["instrument", "day"]).where("ts >= slice_start and ts < slice_end").groupBy("instrument", "day").agg(F.count("*").alias("n"))
    out = slices.join(kept, ["instrument", "day"], "left").withColumn("n_bars", F.coalesce("n", F.lit(0)))
    expected = F.greatest(F.lit(1), F.floor(S.seconds_between(F.col("slice_start"), F.col("slice_end")) / (60.0 * minutes)).cast("long"))
    out = out.withColumn("expected_bars", expected)
    out = out.withColumn("threshold", F.greatest(F.lit(1), F.floor(F.col("expected_bars") * F.lit(cfg.coverage_ratio)).cast("long")))
    return out.where("n_bars < threshold").select("instrument", "slice_start", "slice_end", "n_bars", "expected_bars", "threshold")


def fetch_missing(missing: DataFrame, provider, interval: str) -> tuple[DataFrame, DataFrame]:
    """(bars, errors) of all gaps, whatever their number, in one plan; errors are kept by gap, not raised."""
    return provider.fetch_ranges(missing.select("instrument", "slice_start", "slice_end"), interval)
