"""Small column functions of prices, ratios, ids and times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PIP = 0.1
# Minutes of each bar interval.
MINUTES = {"1min": 1, "5min": 5, "15min": 15, "30min": 30, "1hour": 60, "1h": 60}


def pips(entry: Column, exit_: Column, direction: Column) -> Column:
    """Profit in pips of 0.1, two places."""
    move = F.when(direction == "BUY", exit_ - entry).otherwise(entry - exit_)
    return F.bround(move / F.lit(PIP), 2)


def pips_to_price(n: Column) -> Column:
    return n * F.lit(PIP)


def ratio(part: Column, whole: Column, places: int = 4) -> Column:
    """part / whole, null for a whole of 0."""
    return F.when(whole > 0, F.bround(part / whole, places))


def mean(x: Column, places: int = 3) -> Column:
    return F.bround(F.avg(x), places)


def median(x: Column, places: int = 3) -> Column:
    return F.bround(F.percentile(x, F.lit(0.5)), places)


def message_number(uid: Column) -> Column:
    """The message's number at the end of its uid, null if there is none."""
    return F.try_element_at(F.split(uid, ":"), F.lit(-1)).try_cast("long")


def uid(*parts: Column | str) -> Column:
    return F.concat_ws(":", *parts)


def utc(text: Column) -> Column:
    """ISO-8601 text as UTC wall time; text without a zone is UTC; null if malformed."""
    zoned = F.when(text.rlike(r"(?i)(Z|[+-]\d\d:?\d\d)$"), text).otherwise(F.concat(text, F.lit("Z")))
    return F.to_utc_timestamp(zoned.try_cast("timestamp"), F.current_timezone()).cast("timestamp_ntz")


def iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def number_list(json: Column) -> Column:
    """A JSON list of numbers; null, empty and malformed text give an empty list."""
    return F.coalesce(F.from_json(json, "array<double>"), F.array().cast("array<double>"))


def cache_key(model: Column | str, prompt_version: Column | str, content: Column) -> Column:
    """model:prompt:hash of the content in lower case with white space collapsed."""
    lit = lambda x: F.lit(x) if isinstance(x, str) else x
    flat = F.regexp_replace(F.lower(F.regexp_replace(content, r"^\s+|\s+$", "")), r"\s+", " ")
    return F.concat_ws(":", lit(model), lit(prompt_version), F.substring(F.sha2(flat, 256), 1, 24))


def interval_minutes(name: str) -> int:
    if name not in MINUTES:
        raise ValueError(f"unknown bar interval {name!r}")
    return MINUTES[name]


def label(group: Column, known: Column, longest: int = 0) -> Column:
    """The known label or the id, cut to ``longest`` characters (0: not) with an ellipsis."""
    out = F.coalesce(known, group)
    if longest <= 0:
        return out
    return F.when(F.length(out) > longest, F.concat(F.substring(out, 1, longest - 1), F.lit("…"))).otherwise(out)


def hours(n: float) -> Column:
    """An interval of so many hours."""
    return F.expr(f"make_dt_interval(0, 0, 0, {n * 3600!r})")


def seconds_between(a: Column, b: Column) -> Column:
    """Seconds from a to b as a double."""
    return (F.unix_micros(b.cast("timestamp")) - F.unix_micros(a.cast("timestamp"))) / F.lit(1e6)
