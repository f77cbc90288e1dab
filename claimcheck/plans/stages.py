"""The stages put together: messages and bars in, every table out, each computed once on demand."""

from __future__ import annotations

from functools import cached_property

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimcheck.config import Settings
from claimcheck.operators import actual, classify, compare, link, parse_follow_ups, parse_signals, reported
from claimcheck.plans import demo


EVENT = ["ts", "event_type", "tp_index", "claimed_pips"]


class Pipeline:
    """Lazily planned stages over a messages and a bars table.

    ``keep``: what is done to a table that several later stages read; by
    default it is persisted in memory and on disk until ``close``,
    ``store.Store.replace`` and reading back make it a stored table instead.

    What takes space on disk is kept narrow: of the messages, only those that
    tell a signal or a follow-up; links are not kept by default, as a query
    reads them once.  They carry their follow-ups' columns, so that nobody has
    to look these up (``texts``: the texts too, as do the signals).

    ``resolvers``: optional functions by stage ("classify", "signals",
    "follow_ups", "tiebreak"), see ``claimcheck.resolver``.
    """

    def __init__(self, messages: DataFrame, bars: DataFrame | None = None, cfg: Settings | None = None, resolvers: dict | None = None, keep=None, texts: bool = False):
        self._kept: list[DataFrame] = []
        self._stored, self.keep = keep is not None, keep or self._persist
        self._messages, self.bars, self.cfg, self.resolvers = messages, bars, cfg or Settings(), resolvers or {}
        self._carried = EVENT + ["text"] * texts

    def _persist(self, df: DataFrame) -> DataFrame:
        self._kept.append(df.persist(StorageLevel.MEMORY_AND_DISK))
        return df

    def close(self) -> None:
        """Gives up what is persisted; results stay right, but are computed anew."""
        while self._kept:
            self._kept.pop().unpersist()

    @classmethod
    def demo(cls, spark: SparkSession, sf_dir: str, cfg: Settings | None = None, **more) -> Pipeline:
        return cls(demo.messages(spark, sf_dir), demo.bars(spark, sf_dir), cfg, **more)

    @cached_property
    def classified(self) -> DataFrame:
        """Messages with their class: rules need no join, judges' answers one."""
        rules = classify.with_class(self._messages, self.cfg)
        if "classify" not in self.resolvers:
            return self.keep(rules)
        classes = self.resolvers["classify"](self._messages, rules.select("message_uid", *classify.COLUMNS), self.cfg)
        return self.keep(self._messages.join(classes, "message_uid"))

    @property
    def messages(self) -> DataFrame:
        return self.classified.select(self._messages.columns)

    @property
    def classes(self) -> DataFrame:
        return self.classified.select("message_uid", *classify.COLUMNS)

    @cached_property
    def told(self) -> DataFrame:
        """Messages that tell a signal or a follow-up, with their class."""
        whole = self._stored or "classify" in self.resolvers
        rows = self.classified if whole else classify.with_class(self._messages, self.cfg)
        rows = rows.select(*self._messages.columns, "class").where(F.col("class").isin("SIGNAL", "FOLLOW_UP"))
        return rows if whole else self.keep(rows)

    def of_class(self, name: str) -> DataFrame:
        return self.told.where(F.col("class") == name).select(self._messages.columns)

    @cached_property
    def signals(self) -> DataFrame:
        told = self.of_class("SIGNAL")
        if "signals" in self.resolvers:
            out = self.keep(self.resolvers["signals"](told, parse_signals.parse_signals(told, self.cfg), self.cfg))
            return out.join(self.told.select("message_uid", "text"), "message_uid", "left") if "text" in self._carried else out
        return self.keep(parse_signals.parse_signals(told, self.cfg, [c for c in self._carried if c not in EVENT]))

    @cached_property
    def _replying(self) -> DataFrame:
        """Follow-ups with what they reply to and, if asked for, their texts, where their message is at hand."""
        told = self.of_class("FOLLOW_UP")
        more = ["reply_to_msg_id", *[c for c in self._carried if c not in EVENT]]
        if self._stored or "follow_ups" in self.resolvers:
            rules = parse_follow_ups.parse_follow_ups(told, self.cfg)
            rules = self.keep(self.resolvers["follow_ups"](told, rules, self.cfg) if "follow_ups" in self.resolvers else rules)
            return rules.join(self.told.select("message_uid", *more), "message_uid", "left")
        return self.keep(parse_follow_ups.parse_follow_ups(told, self.cfg, more))

    @property
    def follow_ups(self) -> DataFrame:
        return self._replying.select(parse_follow_ups.COLUMNS)

    @cached_property
    def candidates(self) -> DataFrame:
        return link.interval_candidates(self.follow_ups, self.signals, self.cfg)

    @cached_property
    def linked(self) -> DataFrame:
        """Links with the columns of their follow-ups."""
        out = link.link(self._replying, self.signals, None, self.cfg, self.resolvers.get("tiebreak"), self._carried)
        return self.keep(out) if self._stored or "tiebreak" in self.resolvers else out

    @property
    def links(self) -> DataFrame:
        return self.linked.drop(*self._carried)

    @cached_property
    def reported(self) -> DataFrame:
        return self.keep(reported.reported_outcomes(self.signals, self.linked, None, self.cfg))

    @cached_property
    def actual(self) -> DataFrame:
        return self.keep(actual.actual_outcomes(self.signals, self.bars, self.cfg, self.keep))

    @cached_property
    def discrepancies(self) -> DataFrame:
        return compare.discrepancies(self.signals, self.reported, self.actual)

    def rejected_signals(self) -> DataFrame:
        """Messages of class SIGNAL that do not parse, with the reason."""
        told = self.of_class("SIGNAL")
        return parse_signals.parse_text(told, self.cfg).where(F.col("reject").isNotNull()).select("message_uid", "reject")
