"""Signal texts to direction, entry, stop and targets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimcheck.config import Settings
from claimcheck.functions import text as T

P = T.SIGNAL
WIDEST_RANGE = 50.0


def normalise(text: Column) -> Column:
    """Mark-up to spaces, spaces and blank lines collapsed, upper case, stripped."""
    out = F.translate(T.tidy(text), "\r", "\n")
    out = F.regexp_replace(out, r"\*\*|[*_`]", " ")
    out = F.regexp_replace(out, "[ \t]+", " ")
    return T.strip(F.upper(F.regexp_replace(out, "\n{2,}", "\n")))


def targets(text: Column) -> Column:
    """Prices of all TP marks, then of all TAKE PROFIT marks, the first of equal ones kept."""
    found = F.transform(F.concat(T.all_of(text, P["tp"], 1), T.all_of(text, P["take_profit"], 1)), lambda x: T.number(x))
    keyed = F.transform(found, lambda x: F.struct(x.alias("v"), F.format_string("%.4f", x).alias("k")))

    def add(seen, x):
        return F.when(F.exists(seen, lambda y: y["k"] == x["k"]), seen).otherwise(F.array_append(seen, x))

    none = F.array().cast("array<struct<v:double,k:string>>")
    return F.aggregate(keyed, none, add, lambda seen: F.transform(seen, lambda x: x["v"]))


def entry_range(text: Column, cfg: Settings) -> Column:
    """struct(low, high) of the first pair of near prices in the band."""
    pairs = F.zip_with(
        T.all_of(text, P["range"], 1),
        T.all_of(text, P["range"], 2),
        lambda a, b: F.struct(F.least(T.number(a), T.number(b)).alias("low"), F.greatest(T.number(a), T.number(b)).alias("high")),
    )
    return F.get(F.filter(pairs, lambda p: (p["low"] >= cfg.min_price) & (p["high"] <= cfg.max_price) & (p["high"] - p["low"] <= WIDEST_RANGE)), F.lit(0))


def line_entry(text: Column, direction: Column, cfg: Settings) -> Column:
    """The first price in the band on a line that names the direction and tells no outcome."""
    lines = F.filter(F.split(text, T.LINE_ENDS), lambda x: F.contains(x, direction) & ~x.rlike(P["outcome_line"]))
    numbers = F.flatten(F.transform(lines, lambda x: F.regexp_extract_all(x, F.lit(P["number"]), F.lit(0))))
    values = F.transform(numbers, lambda x: T.number(x))
    return F.get(F.filter(values, lambda v: T.in_band(v, cfg.min_price, cfg.max_price)), F.lit(0))


def parse_text(df: DataFrame, cfg: Settings, text_col: str = "text") -> DataFrame:
    """``df`` with the parsed columns and ``reject``, the reason why there is no signal, or null."""
    n = F.col("__n")
    out = df.withColumn("__n", normalise(F.col(text_col)))
    word = F.upper(T.first_of(n, P["direction"], 1))
    out = out.withColumns(
        {
            "direction": F.when(word.isin("BUY", "LONG"), "BUY").when(word.isin("SELL", "SHORT"), "SELL"),
            "instrument": F.when(T.first_of(n, P["instrument"], 1).isNotNull(), "XAUUSD"),
            "stop_loss": T.number(T.first_of(n, P["stop"], 2)),
            "take_profits": targets(n),
            "__range": entry_range(n, cfg),
        }
    )
    by_line = line_entry(n, F.coalesce("direction", F.lit("?")), cfg)
    by_word = T.number(T.first_of(n, P["entry_word"], 1))
    out = out.withColumns({"__line": by_line, "__word": F.when(T.in_band(by_word, cfg.min_price, cfg.max_price), by_word)})
    ranged = F.col("__range").isNotNull()
    out = out.withColumns(
        {
            "entry": F.when(~ranged, F.coalesce("__line", "__word")),
            "entry_low": F.col("__range")["low"],
            "entry_high": F.col("__range")["high"],
        }
    )
    prices = F.array_compact(F.concat(F.array("entry", "entry_low", "entry_high", "stop_loss"), "take_profits"))
    plausible = F.forall(prices, lambda p: T.in_band(p, cfg.min_price, cfg.max_price))
    reject = (
        F.when(n == "", "empty_text")
        .when(F.col("direction").isNull(), "no_direction")
        .when(F.col("instrument").isNull(), "no_instrument")
        .when(F.col("entry").isNull() & ~ranged, "no_entry")
        .when(~plausible, "implausible_prices")
    )
    no_stop, targets_n = F.col("stop_loss").isNull(), F.size("take_profits")
    quality = (
        F.when(ranged & no_stop & (targets_n == 0), "ENTRY_RANGE")
        .when(no_stop & (targets_n == 0), "MISSING_BOTH")
        .when(no_stop, "MISSING_SL")
        .when(targets_n == 0, "MISSING_TP")
        .otherwise("COMPLETE")
    )
    score = F.lit(0.4) + F.when(F.col("entry").isNotNull(), 0.2).otherwise(0.0) + F.when(no_stop, 0.0).otherwise(0.2)
    score = score + F.when(targets_n > 0, F.lit(0.15) + F.least(F.lit(0.05), F.lit(0.01) * (targets_n - 1))).otherwise(0.0)
    how = T.reasons(
        (F.col("direction").isNotNull(), F.concat(F.lit("direction="), "direction")),
        (F.col("instrument").isNotNull(), F.concat(F.lit("instrument="), "instrument")),
        (ranged, "entry_range"),
        (~ranged & F.col("__line").isNotNull(), "entry_from_direction_line"),
        (~ranged & F.col("__line").isNull() & F.col("__word").isNotNull(), "entry_from_keyword"),
    )
    out = out.withColumns({"reject": reject, "quality_flag": quality, "parse_confidence": F.bround(F.least(F.lit(1.0), score), 3), "parse_reasons": how})
    return T.settle(out.drop("__n", "__range", "__line", "__word"))


def parse_signals(messages: DataFrame, cfg: Settings, more: list[str] | None = None) -> DataFrame:
    """Signals of the messages that parse; a signal has its message's uid, and its columns ``more``."""
    parsed = parse_text(messages, cfg).where(F.col("reject").isNull())
    return parsed.select(
        F.col("message_uid").alias("signal_id"), "message_uid", "group_id", "ts", "direction", "instrument",
        "entry", "entry_low", "entry_high", "stop_loss", "take_profits", "quality_flag",
        F.lit("rules").alias("parse_method"), "parse_confidence", F.lit(cfg.version).alias("parse_version"), "parse_reasons", *more or [],
    )
