"""What the market did after each signal: the first touch of a stop or target.

A walk over up to ten thousand minute bars a signal becomes two equi-joins.
Hours are rolled up once to their extremes.  A signal meets the hours inside
its holding time, which says in which hour a level is first reached (exact, as
every touch test is one-sided), and then the minute bars of at most three
hours: the first, that one and the last.  Signals with an entry range also meet the
bars of an hour that overlaps the range, and of the others only if that does
not fill it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimcheck.config import Settings
from claimcheck.functions import scalars as S


BROADCAST_HOURS = 500_000  # hours of all instruments, of some sixty bytes, that are broadcast at most


def hour(ts: Column) -> Column:
    return F.date_trunc("hour", ts).cast("timestamp_ntz")


def numbered_bars(bars: DataFrame, interval: str = "1min") -> tuple[DataFrame, DataFrame]:
    """(bars with seq, hours): bars counted along each instrument, and hourly extremes.

    The count adds up hours first and then the bars within an hour, so that no
    task needs all bars of an instrument.
    """
    b = bars.where(F.col("interval") == interval).select("instrument", "ts", "provider", "high", "low", "close", hour(F.col("ts")).alias("hr"))
    hours = b.groupBy("instrument", "hr").agg(
        F.count("*").alias("n"), F.max("high").alias("hi"), F.min("low").alias("lo")
    )
    before = Window.partitionBy("instrument").orderBy("hr").rowsBetween(Window.unboundedPreceding, -1)
    hours = hours.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0)))
    within = Window.partitionBy("instrument", "hr").orderBy("ts", "provider")
    b = b.withColumn("pos", F.row_number().over(within)).join(hours.select("instrument", "hr", "base"), ["instrument", "hr"])
    return b.withColumn("seq", F.col("base") + F.col("pos")).drop("base", "pos"), hours


def _levels(signals: DataFrame, cfg: Settings) -> DataFrame:
    """Signals with the stop in force and the nearest target."""
    mid = (F.least("entry_low", "entry_high") + F.greatest("entry_low", "entry_high")) / 2
    buy = F.col("direction") == "BUY"
    out = signals.select(
        "signal_id", "instrument", "ts", "direction", "entry", "entry_low", "entry_high", "stop_loss", "quality_flag",
        F.coalesce("take_profits", F.array().cast("array<double>")).alias("tps"),
    )
    out = out.withColumn("fill", F.coalesce("entry", F.when(F.col("entry_low").isNotNull() & F.col("entry_high").isNotNull(), mid)))
    stop = F.col("stop_loss")
    if cfg.default_sl_policy == "FIXED_PIPS":
        away = S.pips_to_price(F.lit(cfg.default_sl_pips))
        stop = F.coalesce(stop, F.col("fill") + F.when(buy, -away).otherwise(away))
    out = out.withColumns({"stop": stop, "near": F.when(buy, F.array_min("tps")).otherwise(F.array_max("tps")), "until": F.col("ts") + S.hours(cfg.max_holding_hours)})
    return out.withColumn("lo", F.least("entry_low", "entry_high")).withColumn("hi", F.greatest("entry_low", "entry_high"))


def _reaches(level: str, low: str, high: str, stop: bool) -> Column:
    """Whether a bar from low to high touches the level, for the signal's direction."""
    under, over = F.col(low) <= F.col(level), F.col(high) >= F.col(level)
    buy = F.col("direction") == "BUY"
    return F.coalesce(F.when(buy, under if stop else over).otherwise(over if stop else under), F.lit(False))


def _inner_hours(levels: DataFrame, hours: DataFrame) -> DataFrame:
    """Signals with the rolled-up hours that lie wholly inside their holding time."""
    one = F.expr("interval 1 hour")
    first, last = hour(F.col("ts")) + one, hour(F.col("until")) - one
    inner = F.when(first <= last, F.sequence(first, last, one)).otherwise(F.array().cast("array<timestamp_ntz>"))
    spread = levels.select("signal_id", "instrument", "direction", "stop", "near", "entry", F.col("lo").alias("band_lo"), F.col("hi").alias("band_hi"), F.explode(inner).alias("hr"))
    return spread.join(hours, ["instrument", "hr"])


def first_touch(levels: DataFrame, bars: DataFrame, hours: DataFrame, keep: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """Per signal: seq of the touch and of the first and last bar met, and whether a range entry fills.

    All aggregates are plain numbers and times, so they are hashed rather than
    sorted; what belongs to a bar is looked up by its seq afterwards.
    """
    met = _inner_hours(levels, hours)
    hit = _reaches("stop", "lo", "hi", True) | _reaches("near", "lo", "hi", False)
    overlap = F.col("entry").isNull() & (F.col("lo") <= F.col("band_hi")) & (F.col("hi") >= F.col("band_lo"))
    coarse = met.groupBy("signal_id").agg(
        F.min(F.when(hit, F.col("hr"))).alias("hit_hr"),
        F.min(F.when(overlap, F.col("hr"))).alias("band_hr"),
        F.min(F.col("base") + 1).alias("h_first"),
        F.max(F.col("base") + F.col("n")).alias("h_last"),
    )
    both = levels.join(coarse, "signal_id", "left")
    look = F.array_distinct(F.array_compact(F.array(hour(F.col("ts")), "hit_hr", "band_hr", hour(F.col("until")))))
    fine = both.select("signal_id", "instrument", "direction", "stop", "near", "entry", F.col("lo").alias("band_lo"), F.col("hi").alias("band_hi"), F.col("ts").alias("since"), "until", F.explode(look).alias("hr"))
    in_time = (F.col("ts") >= F.col("since")) & (F.col("ts") <= F.col("until"))
    seen = fine.join(bars.select("instrument", "hr", "ts", "seq", "low", "high"), ["instrument", "hr"]).where(in_time)
    hit = _reaches("stop", "low", "high", True) | _reaches("near", "low", "high", False)
    fills = F.coalesce((F.col("low") <= F.col("band_hi")) & (F.col("high") >= F.col("band_lo")), F.lit(False))
    per = seen.groupBy("signal_id").agg(
        F.min(F.when(hit, F.col("seq"))).alias("touch_seq"), F.min("seq").alias("f_first"), F.max("seq").alias("f_last"), F.max(fills).alias("filled")
    )
    out = keep(both.join(per, "signal_id", "left"))
    # a range that its first overlapping hour does not fill is looked for in the others
    still = out.where(F.col("entry").isNull() & F.col("band_hr").isNotNull() & ~F.coalesce("filled", F.lit(False))).select(levels.columns)
    rest = _inner_hours(still, hours).where((F.col("lo") <= F.col("band_hi")) & (F.col("hi") >= F.col("band_lo"))).select("signal_id", "instrument", "hr", "band_lo", "band_hi")
    late = rest.join(bars.select("instrument", "hr", "low", "high"), ["instrument", "hr"]).where((F.col("low") <= F.col("band_hi")) & (F.col("high") >= F.col("band_lo")))
    out = out.join(late.select("signal_id").distinct().withColumn("late", F.lit(True)), "signal_id", "left")
    return out.select(
        *levels.columns,
        "touch_seq",
        F.least("h_first", "f_first").alias("first_seq"),
        F.greatest("h_last", "f_last").alias("last_seq"),
        (F.coalesce("filled", F.lit(False)) | F.coalesce("late", F.lit(False))).alias("filled"),
    )


def actual_outcomes(signals: DataFrame, bars: DataFrame, cfg: Settings, keep: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """One row a signal: WIN, LOSS, AMBIGUOUS, OPEN_AT_EXPIRY or INSUFFICIENT_DATA.  Counts the hours when it is called.

    The first bar with a touch decides: stop and targets, AMBIGUOUS at the mean
    of what it touches; the stop alone, LOSS; targets alone, WIN at the first
    of them in the signal's order.  ``keep`` is done to the numbered bars, their
    hours and the first touches, which are read several times.
    """
    numbered, hours = map(keep, numbered_bars(bars))
    if hours.count() <= BROADCAST_HOURS:  # then the hours of every holding time meet them where they are made
        hours = F.broadcast(hours)
    t = first_touch(_levels(signals, cfg), numbered, hours, keep)
    at = lambda seq, *cols: numbered.select("instrument", F.col("seq").alias(seq), *cols)
    t = t.join(at("touch_seq", F.col("ts").alias("touch_ts"), F.col("low").alias("t_low"), F.col("high").alias("t_high")), ["instrument", "touch_seq"], "left")
    t = t.join(at("last_seq", F.col("ts").alias("last_ts"), F.col("close").alias("last_close")), ["instrument", "last_seq"], "left")
    on_stop = _reaches("stop", "t_low", "t_high", True)
    buy = F.col("direction") == "BUY"
    indexed = F.transform("tps", lambda x, i: F.struct((i + 1).alias("i"), x.alias("p")))
    reached = F.filter(indexed, lambda x: F.when(buy, F.col("t_high") >= x["p"]).otherwise(F.col("t_low") <= x["p"]))
    t = t.withColumns({"on_stop": F.col("touch_seq").isNotNull() & on_stop, "on_tps": F.when(F.col("touch_seq").isNotNull(), reached).otherwise(F.filter(indexed, lambda x: F.lit(False)))})
    n_tps = F.size("on_tps")
    none = (F.col("quality_flag") == "MISSING_BOTH") & F.col("entry").isNull() | F.col("last_seq").isNull()
    unfilled = F.col("entry").isNull() & (F.col("fill").isNull() | ~F.coalesce("filled", F.lit(False)))
    kind = (
        F.when(none, "none").when(unfilled, "unfilled").when(F.col("touch_seq").isNull(), "expiry")
        .when(F.col("on_stop") & (n_tps > 0), "both").when(F.col("on_stop"), "stop").otherwise("target")
    )
    t = t.withColumn("kind", kind)
    is_ = lambda name: F.col("kind") == name
    names = F.array_join(F.transform("on_tps", lambda x: F.concat(F.lit("+TP"), x["i"].cast("string"))), "")
    total = F.aggregate("on_tps", F.col("stop"), lambda a, x: a + x["p"])
    target = F.get(F.col("on_tps"), F.lit(0))
    price = F.when(is_("both"), total / (n_tps + 1)).when(is_("stop"), F.col("stop")).when(is_("target"), target["p"]).when(is_("expiry"), F.col("last_close"))
    risk = F.abs(F.col("fill") - F.col("stop_loss"))
    touched = F.col("kind").isin("both", "stop", "target")
    return t.select(
        "signal_id",
        F.when(is_("none"), "INSUFFICIENT_DATA").when(is_("both"), "AMBIGUOUS").when(is_("stop"), "LOSS").when(is_("target"), "WIN").otherwise("OPEN_AT_EXPIRY").alias("final_state"),
        F.when(is_("unfilled"), "ENTRY_NOT_FILLED").when(is_("expiry"), "EXPIRY").when(is_("both"), F.concat(F.lit("AMBIGUOUS(SL"), names, F.lit(")"))).when(is_("stop"), "SL")
        .when(is_("target"), F.concat(F.lit("TP"), target["i"].cast("string"))).alias("first_touch_event"),
        price.alias("first_touch_price"),
        F.when(touched, F.col("touch_ts")).when(is_("expiry"), F.col("last_ts")).alias("first_touch_at"),
        F.when(is_("stop"), F.lit(-1.0)).when(is_("target") & (risk > 0), F.bround(F.abs(target["p"] - F.col("fill")) / risk, 3)).alias("realized_rr"),
        F.when(F.col("kind").isin("stop", "target", "expiry"), S.pips(F.col("fill"), price, F.col("direction"))).alias("realized_pips"),
        F.when(touched, F.col("touch_seq") - F.col("first_seq") + 1).when(is_("expiry"), F.col("last_seq") - F.col("first_seq") + 1).cast("long").alias("bars_to_outcome"),
        F.lit(cfg.win_policy).alias("win_policy"),
        F.lit(cfg.max_holding_hours).alias("max_holding_hours"),
        F.lit(cfg.default_sl_policy).alias("default_sl_policy"),
        F.lit(cfg.version).alias("computed_version"),
    )
