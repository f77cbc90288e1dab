"""Hooks for an outside judge (such as a language model) where the rules are unsure; off by default.

A judge is a function of a list of texts that returns one dict or None each; a
dict may name what it cost under ``_tokens``: [in, out].  All hooks ask through
a ``Resolver``: a text seen before is answered from the cache table, what would
exceed the budget is not asked, each other text is asked once, and new answers
are written to the cache before anything reads them, so a plan that uses them
twice, or runs again after a lost executor, gets the same ones.  Judges run on
the executors; answers are taken apart by column expressions.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimcheck import schemas
from claimcheck.config import Settings
from claimcheck.functions import scalars as S

Judge = Callable[[list[str]], list[dict | None]]


class BudgetExceeded(RuntimeError):
    """A call that would cost more than the budget leaves."""


def spent(cache: DataFrame) -> DataFrame:
    """Sum of costs so far, 0 for none."""
    return cache.agg(F.coalesce(F.sum("cost_usd"), F.lit(0.0)).alias("cost_usd"))


class Cache:
    """The table of answers (``schemas.RESOLVER_CACHE``) in a folder; the later answer to a key counts."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _rows(self) -> DataFrame:
        try:
            return self.spark.read.schema(schemas.RESOLVER_CACHE + ", stored_at timestamp").parquet(self.path)
        except Exception as e:
            if "PATH_NOT_FOUND" in str(e):
                return self.spark.createDataFrame([], schemas.RESOLVER_CACHE + ", stored_at timestamp")
            raise

    def read(self) -> DataFrame:
        last = Window.partitionBy("cache_key").orderBy(F.desc("stored_at"), "response_json")
        return self._rows().withColumn("__r", F.row_number().over(last)).where("__r = 1").drop("__r", "stored_at")

    def add(self, answers: DataFrame) -> None:
        """Adds answers; those to known keys take the place of the old ones."""
        answers.withColumn("stored_at", F.current_timestamp()).write.mode("append").parquet(self.path)

    def get(self, key: str) -> dict | None:
        """The answer to a key, if there is one and it is an object."""
        row = self.read().where(F.col("cache_key") == key).select("response_json").first()
        answer = json.loads(row.response_json) if row else None
        return answer if isinstance(answer, dict) else None


def patient(judge: Judge, attempts: int = 3, wait: float = 1.0, longest: float = 10.0) -> Judge:
    """The judge, asked again after a growing wait if it fails."""

    def asked(texts: list[str]) -> list[dict | None]:
        for n in range(1, attempts + 1):
            try:
                return judge(texts)
            except Exception:  # noqa: BLE001 - a judge's own errors
                if n == attempts:
                    raise
                time.sleep(min(longest, wait * 2 ** (n - 1)))
        return []

    return asked


@dataclass(frozen=True)
class Resolver:
    """A judge with its cache, prices and budget.

    ``price``: USD for a million tokens in and out; ``cost_each``: what a call
    is taken to cost beforehand, and what it counts if the judge names no
    tokens.  The budget is for all that the cache has paid.
    """

    judge: Judge
    cache: Cache
    model: str
    price: tuple[float, float] = (0.0, 0.0)
    cost_each: float = 0.0
    budget: float | None = None
    attempts: int = 3
    wait: float = 1.0

    def answers(self, texts: DataFrame, prompt: str) -> DataFrame:
        """(text_id, cache_key, response_json) of (text_id, text); no row for a text that the judge leaves.

        Raises BudgetExceeded before asking if the new calls would exceed the budget.
        """
        keyed = texts.select("text_id", "text", S.cache_key(self.model, prompt, F.col("text")).alias("cache_key"))
        known = self.cache.read()
        missing = keyed.groupBy("cache_key").agg(F.min("text").alias("text")).join(known.select("cache_key"), "cache_key", "left_anti").persist()
        new = missing.count()
        if new and self.budget is not None and spent(known).first()[0] + new * self.cost_each > self.budget:
            missing.unpersist()
            raise BudgetExceeded(f"{new} calls would spend more than {self.budget} USD")
        if new:
            self.cache.add(self._asked(missing, prompt))
        missing.unpersist()
        return keyed.select("text_id", "cache_key").join(self.cache.read().select("cache_key", "response_json"), "cache_key")

    def _asked(self, missing: DataFrame, prompt: str) -> DataFrame:
        judge = patient(self.judge, self.attempts, self.wait)

        def ask(batches):
            for t in batches:
                found = judge(t.column("text").to_pylist())
                told = [(key, dict(a)) for key, a in zip(t.column("cache_key").to_pylist(), found, strict=True) if isinstance(a, dict)]
                tokens = [a.pop("_tokens", None) or (None, None) for _, a in told]
                columns = [[key for key, _ in told], [json.dumps(a) for _, a in told], [n for n, _ in tokens], [n for _, n in tokens]]
                kinds = (pa.string(), pa.string(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["cache_key", "response_json", "tokens_in", "tokens_out"])

        rows = missing.select("cache_key", "text").mapInArrow(ask, "cache_key string, response_json string, tokens_in long, tokens_out long")
        cost = (F.col("tokens_in") * self.price[0] + F.col("tokens_out") * self.price[1]) / 1e6
        return rows.select(
            "cache_key", F.lit(self.model).alias("model"), F.lit(prompt).alias("prompt_version"), F.element_at(F.split("cache_key", ":"), -1).alias("content_hash"),
            "response_json", "tokens_in", "tokens_out", F.coalesce(cost, F.lit(self.cost_each)).alias("cost_usd"),
        )


def _confidence(answer: Column) -> Column:
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.coalesce(answer["confidence"], F.lit(0.0))))


def classify_hook(resolver: Resolver, prompt: str = "classify-1") -> Callable[[DataFrame, DataFrame, Settings], DataFrame]:
    """Asks for the class of UNCERTAIN messages: {"class": .., "confidence": ..}."""

    def hook(messages: DataFrame, rules: DataFrame, cfg: Settings) -> DataFrame:
        unsure = messages.join(rules.where("class = 'UNCERTAIN'").select("message_uid"), "message_uid", "left_semi")
        told = resolver.answers(unsure.select(F.col("message_uid").alias("text_id"), F.coalesce("text", F.lit("")).alias("text")), prompt)
        answer = F.from_json("response_json", "class string, confidence double")
        told = told.select(F.col("text_id").alias("message_uid"), answer.alias("a")).where(F.col("a.class").isin("SIGNAL", "FOLLOW_UP", "NOISE"))
        out = rules.join(told, "message_uid", "left")
        seen = F.col("a").isNotNull()
        return out.select(
            "message_uid", F.coalesce("a.class", "class").alias("class"), F.when(seen, _confidence(F.col("a"))).otherwise(F.col("confidence")).alias("confidence"),
            F.when(seen, "llm").otherwise(F.col("method")).alias("method"), "reasons", "classifier_version",
        )

    return hook


def parse_hook(resolver: Resolver, key: str, fields: str, discard: str | None = None, prompt: str | None = None) -> Callable[[DataFrame, DataFrame, Settings], DataFrame]:
    """Asks for messages that did not parse or parsed with little confidence.

    ``key``: the parsed table's id; ``fields``: DDL of what an answer may set.
    An answer takes the place of the rules' row; no answer keeps it, unless the
    answer's field ``discard`` is true.  Ranges upside down are turned, and
    coded values that are none count as not set.
    """
    names = [x.split()[0] for x in fields.split(", ")]
    schema = ", ".join([fields, "confidence double", *([f"{discard} boolean"] if discard else [])])

    def hook(messages: DataFrame, rules: DataFrame, cfg: Settings) -> DataFrame:
        sure = rules.where(F.col("parse_confidence") >= cfg.resolver_threshold)
        ask_for = messages.join(sure.select("message_uid"), "message_uid", "left_anti").select("message_uid", "group_id", "ts", F.coalesce("text", F.lit("")).alias("text"))
        told = resolver.answers(ask_for.select(F.col("message_uid").alias("text_id"), "text"), prompt or f"parse-{key}-1")
        told = told.select(F.col("text_id").alias("message_uid"), F.from_json("response_json", schema).alias("a"))
        value = lambda c: F.when(F.col(f"a.{c}").isin(schemas.VALUES[c]), F.col(f"a.{c}")) if c in schemas.VALUES else F.col(f"a.{c}")
        gone = F.coalesce(F.col(f"a.{discard}"), F.lit(False)) if discard else F.lit(False)
        told = told.select("message_uid", *[value(c).alias(c) for c in names], _confidence(F.col("a")).alias("parse_confidence"), gone.alias("__drop"))
        told = told.withColumn("__told", reduce(Column.__or__, [F.col(c).isNotNull() for c in names]))
        away = told.where("__told or __drop").select("message_uid")
        new = told.where("__told and not __drop").drop("__told", "__drop").join(ask_for.drop("text"), "message_uid")
        if "entry_low" in names:
            new = new.withColumns({"entry_low": F.least("entry_low", "entry_high"), "entry_high": F.greatest("entry_low", "entry_high")})
        new = new.withColumns({key: F.col("message_uid"), "parse_method": F.lit("llm"), "parse_version": F.lit(cfg.version), "parse_reasons": F.array(F.lit("llm"))})
        return rules.join(away, "message_uid", "left_anti").unionByName(new, allowMissingColumns=True).select(rules.columns)

    return hook


SIGNAL_FIELDS = "direction string, instrument string, entry double, entry_low double, entry_high double, stop_loss double, take_profits array<double>, quality_flag string"
FOLLOW_UP_FIELDS = "event_type string, tp_index int, claimed_price double, claimed_pips double, new_stop_loss double"


def tiebreak_hook(resolver: Resolver, prompt: str = "tiebreak-1") -> Callable[[DataFrame], DataFrame]:
    """Asks which of up to five candidates is meant: {"index": n}; others are ignored."""

    def hook(candidates: DataFrame) -> DataFrame:
        listed = candidates.groupBy("follow_up_id").agg(F.sort_array(F.collect_list(F.struct("rank", "signal_id"))).alias("c"))
        listed = listed.select("follow_up_id", F.transform("c", lambda x: x["signal_id"]).alias("candidates"))
        told = resolver.answers(listed.select(F.col("follow_up_id").alias("text_id"), F.to_json(F.struct("follow_up_id", "candidates")).alias("text")), prompt)
        told = told.select(F.col("text_id").alias("follow_up_id"), F.from_json("response_json", "index int")["index"].alias("i"))
        return told.join(listed, "follow_up_id").where("i >= 0 and i < size(candidates)").select("follow_up_id", F.get("candidates", F.col("i")).alias("signal_id"))

    return hook
