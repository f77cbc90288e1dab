"""Bars from CSV files and REST services, and what any bar provider must give."""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable
from typing import Protocol

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimcheck import schemas
from claimcheck.functions import scalars as S

RAW = "timestamp_utc string, open string, high string, low string, close string, volume string"
CHUNK_MINUTES = {"1min": 5000}
OTHER_CHUNK_MINUTES = 1000
RANGES = ["instrument", "slice_start", "slice_end"]
ERRORS = "instrument string, slice_start timestamp_ntz, slice_end timestamp_ntz, error string"


class ProviderError(RuntimeError):
    """What a source answers instead of bars."""


class BarProvider(Protocol):
    """Bars of instruments with start <= ts < end, in order of time, marked with the provider's name."""

    name: str

    def fetch(self, instrument: str, interval: str, start: str, end: str) -> DataFrame: ...

    def fetch_ranges(self, ranges: DataFrame, interval: str) -> tuple[DataFrame, DataFrame]:
        """(bars, errors) of all (instrument, slice_start, slice_end) at once; a range with an error gives no bars."""
        ...


class CsvBars:
    """Bars of one CSV file; a malformed number or time is an error."""

    name = "csv"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _raw(self) -> DataFrame:
        return self.spark.read.schema(RAW).options(header=True, enforceSchema=False).csv(self.path)

    def fetch(self, instrument: str, interval: str, start: str, end: str) -> DataFrame:
        raw = self._raw()
        ts = S.utc(F.trim("timestamp_utc"))
        good = F.when(ts.isNull(), F.raise_error(F.concat(F.lit("malformed time: "), F.coalesce("timestamp_utc", F.lit("null"))))).otherwise(ts)
        rows = raw.select(good.alias("ts"), *[F.col(c).cast("double").alias(c) for c in ("open", "high", "low", "close")], F.nullif(F.trim("volume"), F.lit("")).cast("double").alias("volume"))
        rows = rows.where((F.col("ts") >= S.utc(F.lit(start))) & (F.col("ts") < S.utc(F.lit(end))))
        return tagged(rows, F.lit(instrument), interval, self.name).orderBy("ts")

    def fetch_ranges(self, ranges: DataFrame, interval: str) -> tuple[DataFrame, DataFrame]:
        """The file is read once and meets the ranges by day; a malformed row is an error of every range."""
        volume = F.nullif(F.trim("volume"), F.lit(""))
        rows = self._raw().select(
            S.utc(F.trim("timestamp_utc")).alias("ts"), *[F.col(c).try_cast("double").alias(c) for c in ("open", "high", "low", "close")], volume.try_cast("double").alias("volume"),
            (volume.isNotNull() & volume.try_cast("double").isNull()).alias("bad"), F.to_json(F.struct("*")).alias("raw"),
        )
        bad = rows.where("bad or ts is null or open is null or high is null or low is null or close is null").select("raw").first()
        if bad is not None:
            return self.spark.createDataFrame([], schemas.BARS), ranges.select(*RANGES, F.lit(f"malformed row: {bad.raw}").alias("error"))
        day = lambda c: F.date_trunc("day", F.col(c)).cast("timestamp_ntz")
        wanted = ranges.select(*RANGES, F.explode(F.sequence(day("slice_start"), F.col("slice_end"), F.expr("interval 1 day"))).alias("day"))
        met = rows.drop("bad", "raw").withColumn("day", day("ts")).join(wanted, "day").where("ts >= slice_start and ts < slice_end")
        met = met.dropDuplicates(["instrument", "ts", "open", "high", "low", "close"])  # ranges may overlap
        return tagged(met, F.col("instrument"), interval, self.name), self.spark.createDataFrame([], ERRORS)


def http_get(url: str, params: dict[str, str], timeout: float = 30.0) -> tuple[int, str]:
    """(status, body) of a GET request; a connection that fails raises OSError."""
    try:
        with urllib.request.urlopen(f"{url}?{urllib.parse.urlencode(params)}", timeout=timeout) as r:  # noqa: S310
            return r.status, r.read().decode()
    except urllib.error.HTTPError as e:
        return e.code, e.read().decode(errors="replace")


class RestBars:
    """Bars of a REST service that answers {"values": [{"datetime", "open", ..}]} or {"status": "error"}.

    Ranges are cut into requests of bounded length, which run on the executors.
    ``get`` makes a request: (url, params) to (status, body), OSError where the
    connection fails, which is tried again up to ``attempts`` times.  The key
    goes out with each request and into no table or message.
    """

    def __init__(
        self, spark: SparkSession, url: str, api_key: str, symbols: dict[str, str] | None = None, name: str = "rest",
        get: Callable[[str, dict[str, str]], tuple[int, str]] = http_get, attempts: int = 4, wait: float = 1.0, longest: float = 15.0,
    ):
        if not api_key:
            raise ProviderError("an API key is needed")
        self.spark, self.url, self.api_key, self.symbols, self.name = spark, url, api_key, symbols or {}, name
        self.get, self.attempts, self.wait, self.longest = get, attempts, wait, longest

    def fetch(self, instrument: str, interval: str, start: str, end: str) -> DataFrame:
        one = self.spark.range(1).select(F.lit(instrument).alias("instrument"), S.utc(F.lit(start)).alias("slice_start"), S.utc(F.lit(end)).alias("slice_end"))
        bars, errors = self.fetch_ranges(one, interval)
        found = errors.first()
        if found is not None:
            raise ProviderError(found.error)
        return bars.orderBy("ts")

    def fetch_ranges(self, ranges: DataFrame, interval: str) -> tuple[DataFrame, DataFrame]:
        """Each request is made once (again only for a lost executor): what it gives is kept on disk."""
        url, key, symbols, get = self.url, self.api_key, self.symbols, self.get
        attempts, wait, longest = self.attempts, self.wait, self.longest

        def request(params):
            for n in range(1, attempts + 1):
                try:
                    return get(url, params)
                except OSError:
                    if n == attempts:
                        raise
                    time.sleep(min(longest, wait * 2 ** (n - 1)))

        def values(instrument, start, end):
            # The request's parameters.
            params = {
                "symbol": symbols.get(instrument, instrument), "interval": interval, "start_date": start.isoformat(), "end_date": end.isoformat(),
                "format": "JSON", "timezone": "UTC", "apikey": key,
            }
            status, body = request(params)
            if status != 200:
                raise ProviderError(f"HTTP {status}: {body[:200]}")
            answer = json.loads(body)
            if answer.get("status") == "error":
                raise ProviderError(f"error: {answer.get('message')}")
            return [v for v in answer.get("values") or [] if isinstance(v, dict)]

        def run(frames):
            import pandas as pd

            for f in frames:
                out = []
                for r in f.itertuples(index=False):
                    try:
                        got, error = [json.dumps(v) for v in values(r.instrument, r.chunk_start, r.chunk_end)], None
                    except (OSError, ValueError, ProviderError) as e:
                        got, error = [], f"{type(e).__name__}: {e}".replace(key, "***")
                    out.append((r.instrument, r.slice_start, r.slice_end, r.chunk_start, r.chunk_end, got, error))
                yield pd.DataFrame(out, columns=[*RANGES, "chunk_start", "chunk_end", "bars", "error"])

        minutes = _chunk_minutes(interval)
        one = F.expr(f"interval {minutes} minutes")
        cut = ranges.select(*RANGES).where("slice_start < slice_end").withColumn("chunk_start", F.explode(F.sequence("slice_start", F.col("slice_end") - F.expr("interval 1 microsecond"), one)))
        cut = cut.withColumn("chunk_end", F.least(F.col("chunk_start") + one, F.col("slice_end"))).repartition("instrument", "chunk_start")
        told = cut.mapInPandas(run, "instrument string, slice_start timestamp_ntz, slice_end timestamp_ntz, chunk_start timestamp_ntz, chunk_end timestamp_ntz, bars array<string>, error string").persist()
        raw = told.where("error is null").select(*RANGES, "chunk_start", "chunk_end", F.explode("bars").alias("raw"))
        parts = F.from_json("raw", "datetime string, open string, high string, low string, close string, volume string").alias("v")
        rows = raw.select(*RANGES, "chunk_start", "chunk_end", "raw", parts)
        number = lambda c: F.col(f"v.{c}").try_cast("double")
        volume = F.nullif(F.col("v.volume"), F.lit(""))
        rows = rows.select(
            *RANGES, "chunk_start", "chunk_end", "raw", S.utc(F.replace(F.col("v.datetime"), F.lit(" "), F.lit("T"))).alias("ts"), *[number(c).alias(c) for c in ("open", "high", "low", "close")],
            volume.try_cast("double").alias("volume"), (volume.isNotNull() & volume.try_cast("double").isNull()).alias("bad"),
        )
        broken = F.col("bad") | F.col("ts").isNull() | F.col("open").isNull() | F.col("high").isNull() | F.col("low").isNull() | F.col("close").isNull()
        errors = told.where("error is not null").select(*RANGES, "error").unionByName(rows.where(broken).select(*RANGES, F.concat(F.lit("malformed bar: "), "raw").alias("error")))
        errors = errors.groupBy(*RANGES).agg(F.min("error").alias("error"))
        # a service may count the end of a request in
        good = rows.where("ts >= chunk_start and ts < chunk_end").join(errors, RANGES, "left_anti").dropDuplicates(["instrument", "ts"])
        return tagged(good, F.col("instrument"), interval, self.name), errors


def tagged(rows: DataFrame, instrument: Column, interval: str, provider: str) -> DataFrame:
    """Rows with their bar id, instrument, interval and provider."""
    out = rows.withColumns({"instrument": instrument, "interval": F.lit(interval), "provider": F.lit(provider)})
    return out.select(
        S.uid("instrument", "interval", S.iso(F.col("ts")), "provider").alias("bar_id"), "instrument", "interval", "ts", "open", "high", "low", "close", "volume", "provider"
    )


def _chunk_minutes(interval: str) -> int:
    """Minutes that one request of a remote source may span."""
    S.interval_minutes(interval)
    return CHUNK_MINUTES.get(interval, OTHER_CHUNK_MINUTES)


def chunks(spark: SparkSession, start: str, end: str, interval: str) -> DataFrame:
    """(chunk_start, chunk_end) of a range, as long as one request of a remote source may be."""
    one = F.expr(f"interval {_chunk_minutes(interval)} minutes")
    r = spark.range(1).select(S.utc(F.lit(start)).alias("a"), S.utc(F.lit(end)).alias("z")).where("a < z")
    at = r.select("z", F.explode(F.sequence("a", F.col("z") - F.expr("interval 1 microsecond"), one)).alias("chunk_start"))
    return at.select("chunk_start", F.least(F.col("chunk_start") + one, F.col("z")).alias("chunk_end"))
