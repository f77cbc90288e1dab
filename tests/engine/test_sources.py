"""Readers, stores, manifest, resolver, report, stream and command line."""

import pytest
from pyspark.sql import functions as F

from claimcheck import cli, config, report, resolver, schemas
from claimcheck.config import Settings
from claimcheck.functions import scalars as S
from claimcheck.operators import classify, link, market
from claimcheck.plans.stages import Pipeline
from claimcheck.sources import bars, chat, groups, store
from tests.engine import helpers as h

HEAD = "group,message_id,timestamp_utc,sender_id,text,reply_to_msg_id,views,forwards,reply_count\n"


@pytest.fixture
def csv_dir(tmp_path):
    (tmp_path / "a b.csv").write_text(HEAD + ',1.0,2026-01-17T10:00:00Z,,"XAUUSD BUY 4700\nSL 4690\nTP1 4710, ""now""",,5,x,\n,bad,2026-01-17T10:00:00Z,1,t,,,,\n,2,,1,t,,,,\n')
    (tmp_path / "c.csv").write_text(HEAD + "g9,7,2026-01-17T12:00:00+02:00,u,TP1 HIT +30 pips,6,1,2,3\ng9,7,2026-01-17T12:00:01+02:00,u,again,,,,\n")
    return str(tmp_path)


def test_backfill(spark, csv_dir, tmp_path):
    raw = chat.read_csv_dir(spark, csv_dir)
    new, stats = chat.backfill(raw)
    rows = {r.message_uid: r for r in new.collect()}
    assert set(rows) == {"a b:1", "g9:7"}
    assert rows["a b:1"].text == 'XAUUSD BUY 4700\nSL 4690\nTP1 4710, "now"' and rows["a b:1"].sender_id is None and rows["a b:1"].forwards is None
    assert rows["g9:7"].ts == h.at(0) and rows["g9:7"].reply_to_msg_id == 6
    assert {r.file: (r.read, r.skipped, r.inserted) for r in stats.collect()} == {"a b": (3, 2, 1), "c": (2, 0, 1)}
    again, _ = chat.backfill(raw, new)
    assert again.count() == 0
    assert chat.read_csv_dir(spark, str(tmp_path / "nothing")).count() == 0


def test_accept_and_fetch(spark):
    m = h.messages(spark, [(2, 10, " b ", None), (1, 5, "", None), (3, 99, "c", None)])
    got = chat.accept(m, "2026-01-17T10:05:00Z", "2026-01-17T10:10:00Z").collect()
    assert [(r.message_id, r.text) for r in got] == [(1, ""), (2, "b")]
    assert chat.textless(m).first().n == 1

    def fetch(key):
        if key == "bad":
            raise RuntimeError("no access")
        return m

    df, errors = chat.fetch_groups(["x", "X", "bad"], str.lower, fetch)
    assert df.count() == 3 and errors == {"bad": "no access"}


def test_store_merges(spark, tmp_path):
    b = h.bars(spark, [(1, 2, 0, 1), (2, 3, 1, 2)])
    later = h.bars(spark, [(5, 6, 4, 5)])
    out = {r.ts: r.close for r in store.merged(b, later, "bars").collect()}
    assert out == {h.at(0): 5.0, h.at(1): 2.0}
    s = h.signals(spark, [("g:1", 0, "BUY", 1.0, None, None, None, [], "MISSING_BOTH")])
    t = h.signals(spark, [("g:1", 9, "SELL", 2.0, None, None, None, [], "MISSING_BOTH"), ("g:2", 9, "SELL", 2.0, None, None, None, [], "MISSING_BOTH")])
    got = {r.signal_id: r for r in store.merged(s, t, "signals", ["message_uid", "group_id", "ts"]).collect()}
    assert got["g:1"].direction == "SELL" and got["g:1"].ts == h.at(0) and got["g:2"].ts == h.at(9)
    store.write(b, str(tmp_path / "bars"), "bars")
    store.write(later.where("false"), str(tmp_path / "bars"), "bars")
    assert store.read(spark, str(tmp_path / "bars")).count() == 2
    assert store.lookup(s, "g:1").count() == 1


def test_manifest(spark, tmp_path):
    p = tmp_path / "groups.txt"
    p.write_text("# groups\nGold Room | id: -1001 | username: goldroom\nQuiet | id: -1002 | username: None\n@GoldRoom\nplain\n-1002\n\nLonger name here | id: 7 | username: na\n")
    lines = groups.read_manifest(spark, str(p))
    got = [(r.label, r.target) for r in groups.parse(lines).orderBy("line_no").collect()]
    assert got == [("Gold Room", "goldroom"), ("Quiet", "-1002"), ("plain", "plain"), ("Longer name here", "7")]
    labels = groups.label_map(lines)
    df = spark.createDataFrame([("7",), ("-1001",), ("zz",)], "group_id string")
    assert {r.group_id: r.group for r in groups.with_labels(df, labels, 8).collect()} == {"7": "Longer …", "-1001": "Gold Ro…", "zz": "zz"}
    missing, extra = groups.coverage(groups.parse(lines), spark.createDataFrame([("PLAIN",), ("q",)], "group_id string"))
    assert {r.id for r in missing.collect()} == {"goldroom", "-1002", "7"} and [r.id for r in extra.collect()] == ["q"]


def test_csv_bars(spark, tmp_path):
    p = tmp_path / "b.csv"
    p.write_text("timestamp_utc,open,high,low,close,volume\n" + "".join(f"2026-01-17T10:{i:02d}:00,{4700 + i},{4701 + i},4699,4700.5,{'' if i % 2 else 10}\n" for i in range(59, -1, -1)))
    got = bars.CsvBars(spark, str(p)).fetch("XAUUSD", "1min", "2026-01-17T10:10:00Z", "2026-01-17T10:20:00Z").collect()
    assert len(got) == 10 and got[0].ts == h.at(10) and got[0].bar_id == "XAUUSD:1min:2026-01-17T10:10:00Z:csv" and got[1].volume is None
    p.write_text("timestamp_utc,open,high,low,close,volume\n2026-01-17T10:00:00Z,x,1,1,1,1\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        bars.CsvBars(spark, str(p)).fetch("XAUUSD", "1min", "2026-01-17T10:00:00Z", "2026-01-18T10:00:00Z").collect()
    assert bars.chunks(spark, "2026-01-01T00:00:00Z", "2026-01-08T00:00:00Z", "1min").count() == 3


def test_scalars(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("[1, 2.5]", "g:7", "  A\n b "), ("", "x", "a  B"), (None, "g:z", None), ("[", "5", "")], "j string, u string, t string")
    got = df.select(S.number_list(F.col("j")).alias("n"), S.message_number(F.col("u")).alias("m"), S.cache_key("m", "p", F.col("t")).alias("k")).collect()
    assert [r.n for r in got] == [[1.0, 2.5], [], [], []] and [r.m for r in got] == [7, None, None, 5]
    assert got[0].k == got[1].k
    with pytest.raises(ValueError):
        S.interval_minutes("7min")
    with pytest.raises(ValueError):
        Settings(default_sl_policy="ATR")


def test_settings_file(tmp_path):
    p = tmp_path / "s.toml"
    p.write_text("[link]\nactive_window_hours = 24\n[evaluate]\ndefault_sl_policy = 'FIXED_PIPS'\n")
    c = config.load(p, classify_threshold=0.8)
    assert (c.link_window_hours, c.default_sl_policy, c.classify_threshold) == (24.0, "FIXED_PIPS", 0.8)


def counting(folder):
    """A judge whose calls leave a file for each text, as it runs in other processes."""

    def judge(texts):
        import uuid
        from pathlib import Path

        for t in texts:
            (Path(folder) / uuid.uuid4().hex).write_text(t)
        return [
            None if "dunno" in t
            else {"class": "NOISE", "confidence": 3, "_tokens": [1000, 200]} if "morning" in t.lower()
            else {"class": "SIGNAL", "direction": "SELL", "entry_low": 9.0, "entry_high": 8.0, "quality_flag": "FINE", "index": 1}
            for t in texts
        ]

    return judge


@pytest.fixture
def asked(tmp_path):
    (tmp_path / "asked").mkdir()
    return lambda: sorted(p.read_text() for p in (tmp_path / "asked").iterdir())


def test_resolver_hooks_ask_once(spark, tmp_path, asked):
    m = h.messages(spark, [(1, 0, "good morning", None), (2, 1, "XAUUSD BUY NOW 2410\nSL 2400\nTP1 2420", None), (3, 2, "Good  MORNING", None), (4, 3, "dunno really", None)])
    r = resolver.Resolver(counting(tmp_path / "asked"), resolver.Cache(spark, str(tmp_path / "cache")), "m", price=(2.0, 10.0))
    hooks = {"classify": resolver.classify_hook(r), "signals": resolver.parse_hook(r, "signal_id", resolver.SIGNAL_FIELDS)}
    p = Pipeline(m, resolvers=hooks)
    got = {x.message_uid: (x["class"], x.method, x.confidence) for x in p.classes.collect()}
    assert got["g:1"] == got["g:3"] == ("NOISE", "llm", 1.0) and got["g:2"][1] == "rules" and got["g:4"][:2] == ("UNCERTAIN", "rules")
    assert [x.parse_method for x in p.signals.collect()] == ["rules"]
    assert len(asked()) == 2  # of two texts alike one
    assert resolver.spent(r.cache.read()).first()[0] == pytest.approx(0.004)
    unsure = hooks["signals"](m, p.signals.where("false"), Settings())
    for _ in range(2):
        rows = {x.signal_id: x for x in unsure.collect()}
    assert set(rows) == {"g:2"} and rows["g:2"].entry_low == 8.0 and rows["g:2"].parse_method == "llm" and rows["g:2"].quality_flag is None
    assert len(asked()) == 5  # three texts under another prompt, once each
    assert hooks["signals"](m, p.signals.where("false"), Settings()).count() == 1
    assert len(asked()) == 6  # only what the judge had left is asked again


def test_tiebreak_hook(spark, tmp_path, asked):
    r = resolver.Resolver(counting(tmp_path / "asked"), resolver.Cache(spark, str(tmp_path / "cache")), "m")
    s = h.signals(spark, [(f"g:{i}", i, "BUY", 4700.0, None, None, 4690.0, [4710.0], "COMPLETE") for i in (1, 2, 3)])
    f = h.follow_ups(spark, [("g:9", 9, "UPDATE", None, None, 1.0)])
    m = h.messages(spark, [(9, 9, "x", None)])
    best = link.interval_candidates(f, s, Settings()).orderBy(F.desc("score"), "signal_ts").collect()
    assert best[0].score - best[1].score <= Settings().tiebreak_epsilon
    out = link.link(f, s, m, Settings(), resolver.tiebreak_hook(r)).collect()
    assert [x.signal_id for x in out] == [best[1].signal_id] and len(asked()) == 1


def test_resolver_budget_cache_and_patience(spark, tmp_path, asked):
    cache = resolver.Cache(spark, str(tmp_path / "cache"))
    texts = spark.createDataFrame([("a", "hi  there"), ("b", "HI there"), ("c", "morning")], "text_id string, text string")
    r = resolver.Resolver(counting(tmp_path / "asked"), cache, "m", cost_each=0.5, budget=0.9)
    with pytest.raises(resolver.BudgetExceeded):
        r.answers(texts, "p")
    assert asked() == [] and cache.get("m:p:x") is None
    r = resolver.Resolver(counting(tmp_path / "asked"), cache, "m", cost_each=0.5, budget=1.0)
    out = r.answers(texts, "p").collect()
    assert len(out) == 3 and len({x.cache_key for x in out}) == 2 and len(asked()) == 2
    assert r.answers(texts, "p").count() == 3 and len(asked()) == 2  # the budget is spent but nothing is asked
    assert cache.get(out[0].cache_key)["class"] in ("NOISE", "SIGNAL")
    cache.add(cache.read().withColumn("response_json", F.lit("[1]")))
    assert cache.get(out[0].cache_key) is None and cache.read().count() == 2
    tries = []

    def weak(texts):
        tries.append(1)
        if len(tries) < 3:
            raise OSError
        return [{} for _ in texts]

    assert resolver.patient(weak, 3, 0.0)(["a"]) == [{}] and len(tries) == 3
    tries.clear()
    with pytest.raises(OSError):
        resolver.patient(weak, 2, 0.0)(["a"])


def test_stream_equals_batch(spark, tmp_path):
    from claimcheck.streaming import links as stream

    s = h.signals(spark, [("g:1", 0, "BUY", 4700.0, None, None, None, [], "MISSING_BOTH")])
    f = h.follow_ups(spark, [("g:5", 10, "UPDATE", None, None, 1.0), ("g:6", 48 * 60 + 1, "UPDATE", None, None, 1.0)])
    for name, df in (("s", s), ("f", f)):
        df.write.parquet(str(tmp_path / name))
    read = lambda name, df: spark.readStream.schema(df.schema).parquet(str(tmp_path / name))
    q = stream.candidates(read("f", f), read("s", s), Settings()).writeStream.format("memory").queryName("linked").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = {(r.follow_up_id, r.signal_id) for r in spark.table("linked").collect()}
    assert got == {(r.follow_up_id, r.signal_id) for r in link.interval_candidates(f, s, Settings()).collect()} == {("g:5", "g:1")}


def test_command_line_and_report(spark, csv_dir, tmp_path):
    data = str(tmp_path / "data")
    run = lambda *a: cli.main(["--data", data, *a], spark)
    assert cli.main(["version"]) == "0.1.0"
    assert run("backfill", csv_dir).count() == 2
    assert {r["class"]: r.n for r in run("classify").collect()} == {"SIGNAL": 1, "FOLLOW_UP": 1}
    assert run("parse-signals").count() == 1 and run("parse-follow-ups").count() == 1
    assert run("link").count() == 0
    assert {r.final_state: r.n for r in run("reported").collect()} == {"NO_REPORT": 1}
    p = tmp_path / "bars.csv"
    p.write_text("timestamp_utc,open,high,low,close,volume\n2026-01-17T10:00:00,4700,4701,4699,4700,\n2026-01-17T10:01:00,4700,4711,4699,4700,1\n")
    assert run("fetch-bars", str(p)).startswith("2 bars")
    assert {r.final_state: r.n for r in run("actual", "--hold", "2").collect()} == {"WIN": 1}
    assert {r.category: r.n for r in run("compare", "--csv", str(tmp_path / "d")).collect()} == {"REPORTED_NO_REPORT_ACTUAL_WIN": 1}
    assert run("fetch-bars", str(p)).startswith("2 bars")  # again: nothing is doubled
    assert run("init-db") == "schema steps taken: none" and run("cost").first()[0] == 0.0
    assert {r["class"]: r.n for r in run("classify", "--new").collect()} == {"SIGNAL": 1, "FOLLOW_UP": 1}
    board = open(run("dashboard", str(tmp_path / "board.html"), "--min-signals", "1")).read()
    assert "REPORTED_NO_REPORT_ACTUAL_WIN" in board and "type=range" in board
    (drill,) = (tmp_path / "board.signals").iterdir()
    assert drill.name in board and '"signal_id": "a b:1"' in drill.read_text()
    assert run("metrics").first().actual_win_rate == 1.0 and run("tp-depth").count() == 1 and run("leaderboard").count() == 1
    assert run("required-range").count() == 1 and run("gaps").count() > 0 and run("review", str(tmp_path / "r")).count() == 0
    page = open(run("html", str(tmp_path / "page.html"))).read()
    assert "100.0%" in page and "REPORTED_NO_REPORT_ACTUAL_WIN" in page
    assert spark.read.csv(str(tmp_path / "d"), header=True).count() == 1
    assert classify.classify(h.messages(spark, []), Settings()).count() == 0
    report.write_csv(spark.createDataFrame([([1, 2],)], "a array<int>"), str(tmp_path / "arr"))


def gaps(spark, n):
    return spark.range(n).selectExpr(
        "concat('I', id % 7) AS instrument", "timestamp_ntz '2020-01-01' + make_dt_interval(cast(id AS int)) AS slice_start", "timestamp_ntz '2020-01-01' + make_dt_interval(cast(id AS int), 3) AS slice_end"
    )


def rest(spark, folder, **kw):
    def get(url, params):
        import json
        import uuid
        from pathlib import Path

        (Path(folder) / uuid.uuid4().hex).write_text(params["symbol"])
        start = params["start_date"].replace("T", " ")
        if start.startswith("2020-01-02"):
            raise OSError("no line " + params["apikey"])
        if start.startswith("2020-01-03"):
            return 500, "oops"
        if start.startswith("2020-01-04"):
            return 200, '{"status": "error", "message": "quota"}'
        bad = start.startswith("2020-01-05")
        bar = lambda t: {"datetime": t, "open": "1", "high": "x" if bad else "2", "low": "0.5", "close": "1.5", "volume": ""}
        return 200, json.dumps({"values": [bar(params["end_date"].replace("T", " ")), bar(start), 7]})

    return bars.RestBars(spark, "http://bars.test/x", "secret", {"I0": "I/0"}, get=get, attempts=2, wait=0.0, **kw)


def test_rest_bars(spark, tmp_path):
    (tmp_path / "calls").mkdir()
    provider = rest(spark, str(tmp_path / "calls"))
    found, errors = market.fetch_missing(gaps(spark, 40), provider, "1min")
    got = {r.slice_start.day if r.slice_start.month == 1 else 0: r.error for r in errors.collect()}
    assert set(got) == {2, 3, 4, 5}
    assert got[2].startswith("OSError: no line ***") and "500" in got[3] and "quota" in got[4] and "malformed bar" in got[5]
    rows = found.collect()
    assert len(rows) == 36 and {r.provider for r in rows} == {"rest"} and all(r.ts.hour == 0 and r.volume is None for r in rows)
    assert {r.instrument for r in rows} == {f"I{i}" for i in range(7)}
    calls = [p.read_text() for p in (tmp_path / "calls").iterdir()]
    assert len(calls) == 41 and "I/0" in calls  # each once, the failing connection twice
    with pytest.raises(bars.ProviderError, match="quota"):
        provider.fetch("I1", "1min", "2020-01-04T00:00:00Z", "2020-01-04T01:00:00Z")
    assert provider.fetch("I1", "1hour", "2020-02-01T00:00:00Z", "2020-02-03T00:00:00Z").count() == 3  # chunks of 1000 minutes
    with pytest.raises(bars.ProviderError):
        bars.RestBars(spark, "u", "")


def test_all_gaps_are_fetched_at_once(spark, tmp_path):
    p = tmp_path / "b.csv"
    p.write_text("timestamp_utc,open,high,low,close,volume\n" + "".join(f"2020-01-{d:02d}T0{k}:00:00,1,2,0,1,\n" for d in range(1, 29) for k in range(5)))
    found, errors = market.fetch_missing(gaps(spark, 10_003), bars.CsvBars(spark, str(p)), "1min")
    assert found.count() == 28 * 3 and errors.count() == 0
    p.write_text("timestamp_utc,open,high,low,close,volume\n2020-01-01T00:00:00Z,x,1,1,1,1\n")
    found, errors = market.fetch_missing(gaps(spark, 10_003), bars.CsvBars(spark, str(p)), "1min")
    assert found.count() == 0 and errors.count() == 10_003


def test_versions_upserts_and_schema_steps(spark, tmp_path):
    t = store.Store(spark, str(tmp_path / "d"))
    assert t.migrate() == [1, 2] and t.migrate() == []
    assert t["signals"].count() == 0 and t["schema_versions"].count() == 2
    c = spark.createDataFrame([("g:1", "SIGNAL", 0.9), ("g:2", "NOISE", 0.8)], "message_uid string, class string, confidence double")
    assert t.upsert("classifications", c) == 2
    later = spark.createDataFrame([("g:2", "FOLLOW_UP", 0.7), ("g:3", "NOISE", 1.0)], "message_uid string, class string, confidence double")
    assert t.upsert("classifications", later) == 3
    assert {r.message_uid: r["class"] for r in t["classifications"].collect()} == {"g:1": "SIGNAL", "g:2": "FOLLOW_UP", "g:3": "NOISE"}
    assert t["classifications"].first().reasons == []
    before = t.path("classifications")
    broken = later.withColumn("class", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        t.replace("classifications", broken)
    assert t.path("classifications") == before and t["classifications"].count() == 3
    assert t.upsert("classifications", later) == 3 and t.path("classifications") > before
    with pytest.raises(Exception, match="cannot be HIT"):
        schemas.decoded(later.withColumn("class", F.lit("HIT")), "classifications").collect()
    spark.createDataFrame([("g:1", 1)], "message_uid string, old int").write.parquet(str(tmp_path / "d/links/v000009"))
    assert [x for x in t["links"].columns] == [x for x, _ in schemas.columns("links")]
    with pytest.raises(KeyError):
        t["nothing"]


def test_messages_from_a_chat_service(spark, tmp_path):
    import json

    def obj(i, minutes, text, **kw):
        return json.dumps({"id": i, "date": h.at(minutes).isoformat() + "+00:00", "message": text, "sender_id": 77, **kw})

    asked = []

    def pages(group):
        for page in (
            [obj(5, 50, " five ", replies={"replies": 4}), obj(4, 40, None, replies=None)],
            [obj(3, 30, "three", replies={}, reply_to_msg_id=1), '{"id": null}'],
            [obj(2, 5, "two")],
            [obj(1, 1, "one")],
        ):
            asked.append(group)
            yield page

    api = chat.ChatApi(spark, str.lower, pages)
    got = api.fetch("g", str(tmp_path), "2026-01-17T10:10:00Z", "2026-01-17T10:45:00Z").collect()
    assert [(r.message_uid, r.text, r.reply_count, r.reply_to_msg_id, r.sender_id) for r in got] == [("g:3", "three", None, 1, "77"), ("g:4", "", None, None, "77")]
    assert len(asked) == 3  # the page that begins too early is the last
    assert [r.reply_count for r in api.fetch("g", str(tmp_path)).orderBy("message_id").collect()] == [None, None, None, None, 4]
