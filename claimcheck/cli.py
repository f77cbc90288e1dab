"""Command line over stored tables: python -m claimcheck.cli --data DIR COMMAND ..."""

from __future__ import annotations

import argparse
import importlib
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import claimcheck
from claimcheck import config, report, resolver
from claimcheck.operators import actual, analytics, classify, compare, link, market, parse_follow_ups, parse_signals, reported
from claimcheck.sources import bars as bar_sources
from claimcheck.sources import chat, groups, store


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="claimcheck")
    p.add_argument("--data", default="data", help="folder of the tables")
    p.add_argument("--settings", help="TOML file")
    p.add_argument("--judge", help="MODULE:NAME of a judge for what the rules leave unsure (off by default)")
    p.add_argument("--model", default="judge", help="the judge's name in the cache")
    p.add_argument("--budget", type=float, default=2.0, help="USD that the judge may cost in all")
    p.add_argument("--cost", type=float, default=0.0, help="USD that a call is taken to cost")
    sub = p.add_subparsers(dest="command", required=True)
    for name in ("version", "init-db", "parse-signals", "parse-follow-ups", "link", "reported", "leaderboard", "required-range", "gaps", "cost"):
        sub.add_parser(name)
    x = sub.add_parser("classify")
    x.add_argument("--new", action="store_true", help="only messages without a class")
    x = sub.add_parser("backfill")
    x.add_argument("folder")
    x = sub.add_parser("fetch-messages", help="from a chat service")
    x.add_argument("client", help="MODULE:NAME of an object with resolve(target) and pages(group)")
    x.add_argument("targets", nargs="*")
    x.add_argument("--manifest", help="file that lists the targets")
    x.add_argument("--start")
    x.add_argument("--end")
    x = sub.add_parser("review")
    x.add_argument("out")
    x = sub.add_parser("actual")
    x.add_argument("--hold", type=float)
    x.add_argument("--sl-policy", choices=["NONE", "FIXED_PIPS"])
    x.add_argument("--sl-pips", type=float)
    x = sub.add_parser("fetch-bars")
    x.add_argument("csv", nargs="?")
    x.add_argument("--provider", help="MODULE:NAME of a function of (spark, settings) that gives a bar provider")
    for name in ("tp-depth", "metrics"):
        x = sub.add_parser(name)
        x.add_argument("--start")
        x.add_argument("--end")
        x.add_argument("--min-signals", type=int, default=0)
    x = sub.add_parser("compare")
    x.add_argument("--csv")
    x.add_argument("--group")
    for name in ("html", "dashboard"):
        x = sub.add_parser(name)
        x.add_argument("out")
        x.add_argument("--manifest")
        x.add_argument("--start")
        x.add_argument("--end")
        x.add_argument("--min-signals", type=int, default=0 if name == "html" else 20)
    return p


def named(place: str):
    """The object that MODULE:NAME names."""
    module, _, name = place.partition(":")
    return getattr(importlib.import_module(module), name)


def _fetch_messages(t: store.Store, a) -> str:
    client = named(a.client)
    targets = list(a.targets)
    if a.manifest:
        targets += [r.target for r in groups.parse(groups.read_manifest(t.spark, a.manifest)).orderBy("line_no").collect()]
    source = chat.ChatApi(t.spark, client.resolve, client.pages)
    staged = f"{t.root}/_staged"
    found, errors = chat.fetch_groups(targets, source.resolve, lambda key: source.fetch(key, staged, a.start, a.end))
    n = textless = 0
    if found is not None:
        textless = chat.textless(found).first().n
        n = t.add("messages", store.new_rows(t["messages"], found, "messages", ["ts", "text"]))
    fs, at = t._fs(staged)
    fs.delete(at, True)
    return f"{n} new messages, {textless} without text, {len(errors)} errors" + "".join(f"\n{k}: {v}" for k, v in errors.items())


def _fetch_bars(t: store.Store, a, cfg: config.Settings) -> str:
    if bool(a.csv) == bool(a.provider):
        raise SystemExit("fetch-bars takes a CSV file or --provider")
    provider = bar_sources.CsvBars(t.spark, a.csv) if a.csv else named(a.provider)(t.spark, cfg)
    missing = market.gaps(t["bars"], market.required_range(t["signals"], cfg), cfg).persist()
    found, errors = market.fetch_missing(missing, provider, cfg.bar_interval)
    n = t.upsert("bars", found)
    failed = errors.orderBy("instrument", "slice_start").limit(20).collect()
    out = f"{n} bars, {missing.count() - errors.count()} gaps fetched, {errors.count()} errors"
    missing.unpersist()
    return out + "".join(f"\n{r.instrument} {r.slice_start}: {r.error}" for r in failed)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> DataFrame | int | str:
    """Runs one command; returns what it shows."""
    a = parser().parse_args(argv)
    if a.command == "version":
        return claimcheck.__version__
    spark = spark or SparkSession.builder.appName("claimcheck").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    t, cfg = store.Store(spark, a.data), config.load(a.settings)
    steps = t.migrate()
    judge = None
    if a.judge:
        judge = resolver.Resolver(named(a.judge), resolver.Cache(spark, f"{t.root}/resolver_cache"), a.model, cost_each=a.cost, budget=a.budget)
    hook = lambda make, *args: make(judge, *args) if judge else (lambda told, rules, cfg: rules)
    if a.command == "init-db":
        return f"schema steps taken: {', '.join(map(str, steps)) or 'none'}"
    if a.command == "cost":
        return resolver.spent(resolver.Cache(spark, f"{t.root}/resolver_cache").read())
    if a.command == "backfill":
        new, stats = chat.backfill(chat.read_csv_dir(spark, a.folder), t["messages"])
        stats = stats.persist()
        stats.count()
        t.add("messages", new.select(t["messages"].columns))
        return stats
    if a.command == "fetch-messages":
        return _fetch_messages(t, a)
    if a.command == "classify":
        messages = classify.unclassified(t["messages"], t["classifications"]) if a.new else t["messages"]
        t.upsert("classifications", hook(resolver.classify_hook)(messages, classify.classify(messages, cfg), cfg))
        return analytics.counts(t["classifications"], "class")
    if a.command == "parse-signals":
        told = classify.of_class(t["messages"], t["classifications"], "SIGNAL")
        t.upsert("signals", hook(resolver.parse_hook, "signal_id", resolver.SIGNAL_FIELDS, "not_a_signal")(told, parse_signals.parse_signals(told, cfg), cfg))
        return analytics.counts(t["signals"], "quality_flag")
    if a.command == "parse-follow-ups":
        told = classify.of_class(t["messages"], t["classifications"], "FOLLOW_UP")
        t.upsert("follow_ups", hook(resolver.parse_hook, "follow_up_id", resolver.FOLLOW_UP_FIELDS)(told, parse_follow_ups.parse_follow_ups(told, cfg), cfg))
        return analytics.counts(t["follow_ups"], "event_type")
    if a.command == "link":
        t.upsert("links", link.link(t["follow_ups"], t["signals"], t["messages"], cfg, resolver.tiebreak_hook(judge) if judge else None))
        return link.method_stats(t["links"], cfg)
    if a.command == "review":
        weak = link.low_confidence(t["links"], t["follow_ups"], t["signals"], t["messages"], cfg)
        report.write_csv(weak, a.out)
        return weak
    if a.command == "reported":
        t.upsert("reported", reported.reported_outcomes(t["signals"], t["links"], t["follow_ups"], cfg))
        return analytics.counts(t["reported"], "final_state")
    if a.command == "fetch-bars":
        return _fetch_bars(t, a, cfg)
    if a.command == "actual":
        changes = {"max_holding_hours": a.hold, "default_sl_policy": a.sl_policy, "default_sl_pips": a.sl_pips}
        cfg = replace(cfg, **{k: v for k, v in changes.items() if v is not None})
        t.upsert("actual", actual.actual_outcomes(t["signals"], t["bars"], cfg))
        return analytics.counts(t["actual"], "final_state")
    if a.command == "leaderboard":
        return analytics.leaderboard(t["signals"], t["reported"])
    if a.command == "tp-depth":
        return report.frames(t["signals"], t["reported"], t["actual"], a.start, a.end, a.min_signals)["tp_depth"]
    if a.command == "metrics":
        return report.frames(t["signals"], t["reported"], t["actual"], a.start, a.end, a.min_signals)["metrics"]
    if a.command == "required-range":
        return market.required_range(t["signals"], cfg)
    if a.command == "gaps":
        return market.gaps(t["bars"], market.required_range(t["signals"], cfg), cfg)
    if a.command == "compare":
        rows = compare.discrepancies(t["signals"], t["reported"], t["actual"], a.group)
        if a.csv:
            report.write_csv(rows, a.csv)
        return compare.discrepancy_counts(rows)
    labels = {}
    if a.manifest:
        labels = {r.group_id: r.label for r in groups.label_map(groups.read_manifest(spark, a.manifest)).select(F.col("group_id"), "label").collect()}
    write = report.write_html if a.command == "html" else report.write_dashboard
    return str(write(a.out, t["signals"], t["reported"], t["actual"], labels=labels, start=a.start, end=a.end, min_signals=a.min_signals))


if __name__ == "__main__":
    out = main()
    out.show(100, truncate=False) if isinstance(out, DataFrame) else print(out)
