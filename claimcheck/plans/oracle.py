"""DuckDB SQL with the rows of each query, written from the demo's remainders.

Only ``classify`` reads texts; signals and follow-ups come from what each event
must have become, so the parsers are checked by other means than themselves.
"""

from __future__ import annotations

E = """
e AS (
  SELECT event_id AS i, ts, event_type AS kind, 'g' || CAST(user_id % 12 AS VARCHAR) AS grp,
    1900.0::DOUBLE + floor(least(value, 100.0::DOUBLE) * 4) / 4 AS p
  FROM events
)"""

M = """
m AS (
  SELECT grp || ':' || CAST(i AS VARCHAR) AS uid, grp, i, ts, kind, p,
    CASE WHEN i % 3 = 0 THEN last_value(CASE WHEN kind = 'purchase' THEN i END IGNORE NULLS)
      OVER (PARTITION BY grp ORDER BY ts, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) END AS reply,
    CASE kind
      WHEN 'purchase' THEN
        CASE i % 10
          WHEN 6 THEN 'GOLD ' || side || ' ' || printf('%.2f', p) || ' - ' || printf('%.2f', p + 2)
          WHEN 9 THEN 'XAU/USD ' || side || ' ' || printf('%.2f', p) || '/' || printf('%.2f', p + 2)
          ELSE 'XAUUSD ' || side || ' ' || printf('%.2f', p) END
        || CASE WHEN i % 10 IN (7, 9) THEN '' ELSE chr(10) || 'SL ' || printf('%.2f', p - sg * 20) END
        || CASE WHEN i % 10 IN (8, 9) THEN '' ELSE
             chr(10) || 'TP1 ' || printf('%.2f', p + sg * 10)
             || CASE WHEN i % 4 >= 1 THEN chr(10) || 'TP2 ' || printf('%.2f', p + sg * 20) ELSE '' END
             || CASE WHEN i % 4 >= 2 THEN chr(10) || 'TP3 ' || printf('%.2f', p + sg * 30) ELSE '' END
             || CASE WHEN i % 4 >= 3 THEN chr(10) || 'TP4 ' || printf('%.2f', p + sg * 40) ELSE '' END END
      WHEN 'click' THEN 'TP' || (1 + i % 3) || ' HIT +' || (1 + i % 3) || '0 PIPS' || CASE WHEN i % 5 = 0 THEN ' AT ' || printf('%.2f', p) ELSE '' END
      WHEN 'error' THEN 'SL HIT -' || (5 + i % 50) || ' PIPS'
      WHEN 'view' THEN CASE i % 3 WHEN 0 THEN 'market looks quiet today' WHEN 1 THEN 'Running +20 pips' ELSE 'Cancel the signal' END
      ELSE CASE i % 4 WHEN 0 THEN 'JOIN HERE for VIP bonus https://example.org/x' WHEN 1 THEN 'Move SL to BE' WHEN 2 THEN ''
        ELSE 'Close now, secured +15 pips' END
    END AS txt
  FROM (SELECT *, CASE WHEN i % 2 = 0 THEN 'BUY' ELSE 'SELL' END AS side, CASE WHEN i % 2 = 0 THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END AS sg FROM e)
)"""

C = r"""
hits AS (
  SELECT uid, ts, trim(txt) AS t, reply IS NOT NULL AS re,
    regexp_matches(txt, '(?i)\b(#\s*)?(XAUUSD|XAU/USD|GOLD)\b') AS ins,
    regexp_matches(txt, '(?i)\b(BUY|SELL|LONG|SHORT)\b') AS dir,
    list_count(list_filter(regexp_extract_all(txt, '\b\d{3,5}(\.\d+)?\b'), lambda x: CAST(x AS DOUBLE) BETWEEN 1500 AND 5000)) AS np,
    regexp_matches(txt, '(?i)\b(SL|S/L|STOP\s*LOSS|STOPLOSS)\b\s*[:\-@]?\s*\d') AS sl,
    regexp_matches(txt, '(?i)\bTP\s*\d?\b\s*[:\-@]?\s*\d') OR regexp_matches(txt, '(?i)\bTAKE\s*PROFIT\s*\d?\b\s*[:\-@]?\s*\d') AS tp,
    regexp_matches(txt, '(?i)\b(ENTRY|PRICE)\b') AS ent,
    regexp_matches(txt, '(?i)\b(HIT|HITS|TAPPED?|RAN|RUNNING|RUNS|SECURED?|BOOK(ED)?|CLOSED?|CLOSING|STOPPED|TRAILING|REACHED|ACHIEVED)\b') AS verb,
    regexp_matches(txt, '(?i)\d{1,4}\s*PIPS?\b') AS pips,
    regexp_matches(txt, '(?i)\b(BE|BREAK\s*EVEN|MOVE\s*SL)\b') AS be,
    regexp_matches(txt, '(?i)\b(CANCEL(LED|LING)?|VOID|IGNORE\s+SIGNAL)\b') AS can,
    regexp_matches(txt, '(?i)(^|[^A-Za-z0-9])(VIP|JOIN\s+HERE|BONUS|DEPOSIT|PROMO)([^A-Za-z0-9]|$)') AS promo,
    regexp_matches(txt, '(?i)https?://\S+') AS url,
    regexp_matches(txt, '[A-Za-z0-9]') AS alnum
  FROM m
),
sc AS (
  SELECT *,
    greatest(0.0::DOUBLE, 0.0::DOUBLE + if(ins, 0.3::DOUBLE, 0) + if(dir, 0.3::DOUBLE, 0) + if(np >= 1, 0.1::DOUBLE, 0) + if(sl, 0.2::DOUBLE, 0) + if(tp, 0.2::DOUBLE, 0)
      + if(ent, 0.05::DOUBLE, 0) + if(verb AND NOT (sl AND tp), -0.4::DOUBLE, 0) + if(promo, -0.5::DOUBLE, 0) + if(url, -0.15::DOUBLE, 0)) AS s,
    greatest(0.0::DOUBLE, 0.0::DOUBLE + if(verb, 0.45::DOUBLE, 0) + if(pips, 0.3::DOUBLE, 0) + if(be, 0.3::DOUBLE, 0) + if(can, 0.35::DOUBLE, 0) + if(re, 0.1::DOUBLE, 0)
      + if(sl AND tp, -0.5::DOUBLE, 0) + if(NOT (verb OR pips OR be OR can), -0.3::DOUBLE, 0) + if(verb AND np >= 1, 0.1::DOUBLE, 0)) AS f,
    greatest(0.0::DOUBLE, 0.0::DOUBLE + if(promo, 0.55::DOUBLE, 0) + if(url, 0.3::DOUBLE, 0) + if(length(t) <= 5, 0.5::DOUBLE, 0) + if(NOT alnum, 0.6::DOUBLE, 0)
      + if(dir AND ins, -0.35::DOUBLE, 0)) AS n,
    concat_ws('|', if(ins, 'has_instrument', NULL), if(dir, 'has_direction', NULL), if(np >= 1, 'plausible_prices=' || np, NULL), if(sl, 'has_sl', NULL), if(tp, 'has_tp', NULL),
      if(ent, 'has_entry_kw', NULL), if(verb AND NOT (sl AND tp), 'outcome_verb_penalty', NULL), if(promo, 'promo_penalty', NULL), if(url, 'url_penalty', NULL)) AS ws,
    concat_ws('|', if(verb, 'outcome_verb', NULL), if(pips, 'pips_mention', NULL), if(be, 'break_even', NULL), if(can, 'cancel_signal', NULL), if(re, 'is_reply', NULL),
      if(sl AND tp, 'full_signal_form_penalty', NULL), if(NOT (verb OR pips OR be OR can), 'no_outcome_evidence', NULL), if(verb AND np >= 1, 'outcome_plus_price', NULL)) AS wf,
    concat_ws('|', if(promo, 'promo', NULL), if(url, 'url', NULL), if(length(t) <= 5, 'very_short', NULL), if(NOT alnum, 'no_alphanumeric', NULL),
      if(dir AND ins, 'signal_evidence_present', NULL)) AS wn
  FROM hits
),
lead AS (
  SELECT *, greatest(s, f, n) AS top, 0.5 + (greatest(s, f, n) - list_sort([s, f, n], 'DESC')[2]) / 2.0 AS conf FROM sc
),
c AS (
  SELECT uid, ts,
    CASE WHEN t = '' THEN 'NOISE' WHEN top <= 0 OR conf < 0.7 THEN 'UNCERTAIN' WHEN s = top THEN 'SIGNAL' WHEN f = top THEN 'FOLLOW_UP' ELSE 'NOISE' END AS class,
    CASE WHEN t = '' THEN 1.0 WHEN top <= 0 THEN 0.0 ELSE least(1.0, conf) END AS conf,
    CASE WHEN t = '' THEN 'empty_text' WHEN top <= 0 THEN 'no_evidence' ELSE
      if(conf < 0.7, printf('score_signal=%.2f|score_follow_up=%.2f|score_noise=%.2f|', s, f, n), '') || CASE WHEN s = top THEN ws WHEN f = top THEN wf ELSE wn END END AS why
  FROM lead
)"""

S = """
s AS (
  SELECT uid AS sid, grp, i, ts, if(i % 2 = 0, 'BUY', 'SELL') AS dir, p,
    if(i % 10 IN (6, 9), NULL, p) AS entry, if(i % 10 IN (6, 9), p, NULL) AS lo, if(i % 10 IN (6, 9), p + 2, NULL) AS hi,
    if(i % 10 IN (7, 9), NULL, if(i % 2 = 0, p - 20, p + 20)) AS sl,
    if(i % 10 IN (8, 9), CAST([] AS DOUBLE[]), [if(i % 2 = 0, p + 10 * k, p - 10 * k) for k in range(1, 2 + i % 4)]) AS tps,
    CASE i % 10 WHEN 9 THEN 'ENTRY_RANGE' WHEN 7 THEN 'MISSING_SL' WHEN 8 THEN 'MISSING_TP' ELSE 'COMPLETE' END AS flag,
    0.4::DOUBLE + if(i % 10 IN (6, 9), 0.0::DOUBLE, 0.2::DOUBLE) + if(i % 10 IN (7, 9), 0.0::DOUBLE, 0.2::DOUBLE)
      + if(i % 10 IN (8, 9), 0.0::DOUBLE, 0.15::DOUBLE + least(0.05::DOUBLE, 0.01::DOUBLE * (i % 4))) AS conf
  FROM m WHERE kind = 'purchase'
)"""

# a view about cancelling and a sign-up about the stop pass as follow-ups only as replies
F = """
f AS (
  SELECT uid AS fid, grp, ts, reply,
    CASE kind WHEN 'click' THEN 'TP_HIT' WHEN 'error' THEN 'SL_HIT' WHEN 'view' THEN if(i % 3 = 1, 'UPDATE', 'CANCEL') ELSE if(i % 4 = 1, 'BE_MOVED', 'MANUAL_CLOSE') END AS ev,
    CAST(if(kind = 'click', 1 + i % 3, NULL) AS INTEGER) AS tp,
    if(kind = 'click' AND i % 5 = 0, p, NULL) AS price,
    CAST(CASE WHEN kind = 'click' THEN 10 * (1 + i % 3) WHEN kind = 'error' THEN -(5 + i % 50) WHEN kind = 'view' AND i % 3 = 1 THEN 20
      WHEN kind = 'signup' AND i % 4 = 3 THEN 15 END AS DOUBLE) AS pips,
    CASE WHEN kind IN ('click', 'error') THEN 0.9 WHEN kind = 'view' THEN if(i % 3 = 1, 0.6, 0.9) WHEN i % 4 = 1 THEN 0.85 ELSE 0.8 END::DOUBLE AS conf
  FROM m
  WHERE kind IN ('click', 'error') OR kind = 'view' AND (i % 3 = 1 OR i % 3 = 2 AND reply IS NOT NULL) OR kind = 'signup' AND (i % 4 = 3 OR i % 4 = 1 AND reply IS NOT NULL)
)"""

L = """
rep AS (SELECT f.fid, s.sid FROM f JOIN s ON s.grp = f.grp AND s.i = f.reply),
cand AS (
  SELECT f.fid, s.sid, s.ts AS sts,
    if(near, 0.55::DOUBLE, 0.0::DOUBLE) + if(tpm, 0.35::DOUBLE, 0.0::DOUBLE) + 0.3::DOUBLE * greatest(0.0::DOUBLE, 1.0::DOUBLE - age / 172800.0::DOUBLE) AS score,
    if(near OR tpm, 'temporal_numeric', 'recent_open') AS method
  FROM f JOIN s ON s.grp = f.grp AND s.ts <= f.ts AND f.ts <= s.ts + INTERVAL 48 HOUR,
  LATERAL (SELECT (epoch_us(f.ts) - epoch_us(s.ts)) / 1000000.0::DOUBLE AS age,
    coalesce(list_bool_or(list_transform(list_filter(list_concat([s.entry, s.lo, s.hi, s.sl], s.tps), lambda x: x IS NOT NULL), lambda x: abs(f.price - x) <= 1.0)), false) AS near,
    coalesce(f.tp BETWEEN 1 AND len(s.tps), false) AS tpm) q
),
rk AS (SELECT *, row_number() OVER (PARTITION BY fid ORDER BY score DESC, sts, sid) AS r FROM cand),
l AS (
  SELECT fid, sid, 'reply_to' AS method, 0.98::DOUBLE AS conf FROM rep
  UNION ALL
  SELECT fid, sid, method, least(0.95::DOUBLE, score) FROM rk WHERE r = 1 AND fid NOT IN (SELECT fid FROM rep)
)"""

R = """
ev AS (SELECT l.sid, f.* FROM l JOIN f ON f.fid = l.fid WHERE l.conf >= 0.6),
ag AS (
  SELECT sid, count(*) AS n, min(ts) FILTER (ev = 'CANCEL') AS can, min(ts) FILTER (ev = 'SL_HIT') AS slt, first(pips ORDER BY ts, fid) FILTER (ev = 'SL_HIT') AS slp,
    min(ts) FILTER (ev = 'MANUAL_CLOSE') AS mct, first(pips ORDER BY ts, fid) FILTER (ev = 'MANUAL_CLOSE') AS mcp, min(ts) FILTER (ev = 'TP_HIT') AS t1, max(ts) FILTER (ev = 'TP_HIT') AS t2,
    max(tp) FILTER (ev = 'TP_HIT') AS mt, sum(pips) FILTER (ev = 'TP_HIT') AS sp
  FROM ev GROUP BY sid
),
st AS (
  SELECT s.sid, ag.* EXCLUDE (sid), CASE WHEN n IS NULL OR can IS NOT NULL THEN 'NO_REPORT' WHEN slt IS NOT NULL AND (t1 IS NULL OR slt <= t1) THEN 'LOSS'
    WHEN t1 IS NOT NULL THEN 'WIN' WHEN mct IS NOT NULL THEN 'BREAK_EVEN' ELSE 'OPEN' END AS state
  FROM s LEFT JOIN ag ON ag.sid = s.sid
),
r AS (
  SELECT sid, state, if(state = 'WIN', mt, NULL) AS mt, CASE state WHEN 'LOSS' THEN slp WHEN 'WIN' THEN nullif(sp, 0) WHEN 'BREAK_EVEN' THEN mcp END AS pips,
    CASE WHEN can IS NOT NULL THEN can WHEN state = 'LOSS' THEN slt WHEN state = 'WIN' THEN t2 WHEN state = 'BREAK_EVEN' THEN mct END AS closed, coalesce(n, 0) AS n
  FROM st
)"""

B = """
b AS (
  SELECT date_trunc('minute', ts) AS ts, first(p ORDER BY ts, i) AS open, max(p) AS high, min(p) AS low, last(p ORDER BY ts, i) AS close
  FROM e GROUP BY 1
)"""

RAW = """
raw AS (
  SELECT if(event_type = 'view', 'file' || user_id % 3, 'g' || user_id % 12) AS grp, event_id AS i, date_trunc('second', ts) - INTERVAL 2 HOUR AS ts, user_id AS u,
    if(event_type = 'view', NULL, CAST(user_id AS VARCHAR)) AS sender, if(event_type = 'click', '', event_type) AS txt, 'file' || user_id % 3 AS file, event_type NOT IN ('signup', 'error') AS ok
  FROM events
)"""


def actual(hold_hours: int, fixed_pips: float | None) -> str:
    """The first-touch walk as a plain range join of signals and bars."""
    stop = "sl" if fixed_pips is None else f"coalesce(sl, fill + if(dir = 'BUY', -{fixed_pips * 0.1}::DOUBLE, {fixed_pips * 0.1}::DOUBLE))"
    return f"""
w AS (
  SELECT *, {stop} AS stp FROM (SELECT *, coalesce(entry, (lo + hi) / 2) AS fill FROM s)
),
walk AS (
  SELECT w.sid, b.ts, b.low, b.high, b.close, row_number() OVER (PARTITION BY w.sid ORDER BY b.ts) AS k,
    coalesce(if(dir = 'BUY', b.low <= stp, b.high >= stp), false) AS on_sl,
    [x for x in range(1, len(tps) + 1) if (if(dir = 'BUY', b.high >= tps[x], b.low <= tps[x]))] AS on_tp,
    b.low <= w.hi AND b.high >= w.lo AS in_band
  FROM w JOIN b ON b.ts >= w.ts AND b.ts <= w.ts + INTERVAL {hold_hours} HOUR
),
ends AS (
  SELECT sid, max(k) AS n, last(close ORDER BY k) AS lc, max(ts) AS lt, bool_or(in_band) AS filled, min(k) FILTER (on_sl OR len(on_tp) > 0) AS tk FROM walk GROUP BY sid
),
j AS (
  SELECT w.*, ends.n, lc, lt, tk, walk.ts AS tt, on_sl, on_tp,
    CASE WHEN ends.n IS NULL THEN 'none' WHEN entry IS NULL AND NOT coalesce(filled, false) THEN 'unfilled' WHEN tk IS NULL THEN 'expiry'
      WHEN on_sl AND len(on_tp) > 0 THEN 'both' WHEN on_sl THEN 'stop' ELSE 'target' END AS how
  FROM w LEFT JOIN ends ON ends.sid = w.sid LEFT JOIN walk ON walk.sid = ends.sid AND walk.k = ends.tk
),
pr AS (
  SELECT *, CASE how WHEN 'both' THEN (stp + list_sum([tps[x] for x in on_tp])) / (len(on_tp) + 1) WHEN 'stop' THEN stp WHEN 'target' THEN tps[on_tp[1]] WHEN 'expiry' THEN lc END AS price FROM j
),
a AS (
  SELECT sid, CASE how WHEN 'none' THEN 'INSUFFICIENT_DATA' WHEN 'both' THEN 'AMBIGUOUS' WHEN 'stop' THEN 'LOSS' WHEN 'target' THEN 'WIN' ELSE 'OPEN_AT_EXPIRY' END AS state,
    CASE how WHEN 'unfilled' THEN 'ENTRY_NOT_FILLED' WHEN 'expiry' THEN 'EXPIRY' WHEN 'stop' THEN 'SL' WHEN 'target' THEN 'TP' || on_tp[1]
      WHEN 'both' THEN 'AMBIGUOUS(SL' || list_aggregate(['+TP' || x for x in on_tp], 'string_agg', '') || ')' END AS event,
    price, CASE WHEN how IN ('both', 'stop', 'target') THEN tt WHEN how = 'expiry' THEN lt END AS moment,
    CASE WHEN how = 'stop' THEN -1.0::DOUBLE WHEN how = 'target' AND abs(fill - sl) > 0 THEN round_even(abs(price - fill) / abs(fill - sl), 3) END AS rr,
    CASE WHEN how IN ('stop', 'target', 'expiry') THEN round_even(if(dir = 'BUY', price - fill, fill - price) / 0.1::DOUBLE, 2) END AS pips,
    CASE WHEN how IN ('both', 'stop', 'target') THEN tk WHEN how = 'expiry' THEN n END AS bars
  FROM pr
)"""


D = """
d AS (
  SELECT s.sid, s.grp, coalesce(r.state, 'NO_REPORT') AS rs, coalesce(a.state, 'INSUFFICIENT_DATA') AS ac, r.pips AS rp, a.pips AS ap
  FROM s LEFT JOIN r ON r.sid = s.sid LEFT JOIN a ON a.sid = s.sid
),
dc AS (
  SELECT *, CASE WHEN ac = 'INSUFFICIENT_DATA' THEN ac WHEN ac = 'AMBIGUOUS' THEN 'AMBIGUOUS_BAR'
    WHEN rs = 'LOSS' AND ac NOT IN ('WIN', 'LOSS') THEN 'UNKNOWN'
    WHEN rs IN ('WIN', 'LOSS') AND rs = ac THEN 'AGREES'
    WHEN rs = 'WIN' THEN 'REPORTED_WIN_ACTUAL_' || if(ac = 'LOSS', 'LOSS', 'OPEN')
    WHEN rs = 'LOSS' THEN 'REPORTED_LOSS_ACTUAL_WIN'
    WHEN rs = 'NO_REPORT' THEN 'REPORTED_NO_REPORT_ACTUAL_' || if(ac IN ('WIN', 'LOSS'), ac, 'NONE')
    WHEN ac IN ('WIN', 'LOSS') THEN 'REPORTED_OPEN_ACTUAL_' || ac ELSE 'AGREES' END AS cat
  FROM d
)"""

T = """
td AS (SELECT s.grp, len(s.tps) AS k, nullif(r.state, 'NO_REPORT') AS state, r.mt FROM s LEFT JOIN r ON r.sid = s.sid),
lv AS (
  SELECT grp, CAST(level AS INTEGER) AS level, count(state) AS denom, count(*) FILTER (state IS NOT NULL AND mt >= level) AS hits
  FROM td, LATERAL (SELECT unnest(range(1, k + 1)) AS level) GROUP BY 1, 2
),
lr AS (SELECT *, if(denom > 0, round_even(hits / denom, 4), NULL) AS rate FROM lv),
ts AS (
  SELECT grp, count(*) AS n, count(state) AS told, round_even((count(*) - count(state)) / count(*), 4) AS quiet,
    if(count(state) > 0, round_even(count(*) FILTER (state = 'LOSS') / count(state), 4), NULL) AS lost, CAST(max(k) AS INTEGER) AS deepest
  FROM td GROUP BY grp
)"""


def metrics(where: str = "true") -> str:
    return f"""
mt AS (
  SELECT s.grp, count(*) AS n, count(*) FILTER (r.state = 'WIN') AS rw, count(*) FILTER (r.state = 'LOSS') AS rl, count(*) FILTER (a.state = 'WIN') AS aw,
    count(*) FILTER (a.state = 'LOSS') AS al, round_even(avg(a.pips), 3) AS pips, round_even(avg(a.rr), 3) AS rr, round_even(quantile_cont(CAST(a.bars AS DOUBLE), 0.5), 3) AS med,
    count(*) FILTER (a.state = 'AMBIGUOUS') AS amb, count(*) FILTER (a.state = 'INSUFFICIENT_DATA') AS ins
  FROM s LEFT JOIN r ON r.sid = s.sid LEFT JOIN a ON a.sid = s.sid WHERE {where} GROUP BY s.grp
),
mr AS (SELECT *, if(rw + rl > 0, round_even(rw / (rw + rl), 4), NULL) AS rr1, if(aw + al > 0, round_even(aw / (aw + al), 4), NULL) AS ar1 FROM mt)"""


METRICS_COLUMNS = """grp AS group_id, n AS n_signals, rw AS reported_wins, rl AS reported_losses, rw + rl AS reported_decided, rr1 AS reported_win_rate,
  aw AS actual_wins, al AS actual_losses, aw + al AS actual_decided, ar1 AS actual_win_rate, round_even(rr1 - ar1, 4) AS win_rate_gap,
  pips AS avg_realized_pips, rr AS avg_realized_rr, med AS median_bars_to_outcome, amb AS ambiguous_bars, ins AS insufficient_data"""
ACTUAL_COLUMNS = "sid AS signal_id, state AS final_state, event AS first_touch_event, price AS first_touch_price, moment AS first_touch_at, rr AS realized_rr, pips AS realized_pips, bars AS bars_to_outcome"

A168, A6 = actual(168, None), actual(6, 50.0)


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"


ORACLE_SQL: dict[str, str] = {
    "classify_messages": _with(E, M, C) + "SELECT uid AS message_uid, class, round_even(conf, 6) AS confidence, why AS reasons FROM c",
    "class_counts": _with(E, M, C) + "SELECT class, count(*) AS n FROM c GROUP BY class",
    "unclassified_messages": _with(E, M, C) + "SELECT uid AS message_uid, ts FROM c WHERE class = 'UNCERTAIN'",
    "parse_signals": _with(E, M, S)
    + "SELECT sid AS signal_id, grp AS group_id, ts, dir AS direction, 'XAUUSD' AS instrument, entry, lo AS entry_low, hi AS entry_high, sl AS stop_loss, "
    "coalesce(list_aggregate([printf('%.2f', x) for x in tps], 'string_agg', '|'), '') AS take_profits, flag AS quality_flag, round_even(conf, 3) AS parse_confidence FROM s",
    "quality_counts": _with(E, M, S) + "SELECT flag AS quality_flag, count(*) AS n FROM s GROUP BY flag",
    "parse_follow_ups": _with(E, M, F)
    + "SELECT fid AS follow_up_id, grp AS group_id, ts, ev AS event_type, tp AS tp_index, price AS claimed_price, pips AS claimed_pips, CAST(NULL AS DOUBLE) AS new_stop_loss, conf AS parse_confidence FROM f",
    "event_type_counts": _with(E, M, F) + "SELECT ev AS event_type, count(*) AS n FROM f GROUP BY ev",
    "link_reply_to": _with(E, M, S, F, L) + "SELECT fid AS follow_up_id, sid AS signal_id FROM rep",
    "link_interval_candidates": _with(E, M, S, F, L) + "SELECT fid AS follow_up_id, sid AS signal_id, round_even(score, 6) AS score, method AS link_method FROM cand",
    "links": _with(E, M, S, F, L)
    + "SELECT fid || '->' || sid AS link_id, fid AS follow_up_id, sid AS signal_id, method AS link_method, round_even(conf, 6) AS link_confidence FROM l",
    "contested_links": _with(E, M, S, F, L)
    + "SELECT x.fid AS follow_up_id, round_even(x.score, 6) AS best, round_even(y.score, 6) AS second FROM rk x JOIN rk y ON x.fid = y.fid AND x.r = 1 AND y.r = 2 WHERE x.score - y.score <= 0.05::DOUBLE",
    "link_method_stats": _with(E, M, S, F, L) + "SELECT method AS link_method, count(*) AS n_links, count(*) FILTER (conf < 0.6) AS n_low_confidence FROM l GROUP BY method",
    "low_confidence_links": _with(E, M, S, F, L)
    + "SELECT l.fid || '->' || l.sid AS link_id, l.fid AS follow_up_id, l.sid AS signal_id, method AS link_method, round_even(l.conf, 6) AS link_confidence, ev AS event_type, "
    "dir AS direction, mf.txt AS follow_up_text, ms.txt AS signal_text FROM l JOIN f ON f.fid = l.fid JOIN s ON s.sid = l.sid JOIN m mf ON mf.uid = l.fid JOIN m ms ON ms.uid = l.sid WHERE l.conf < 0.6",
    "reported_outcomes": _with(E, M, S, F, L, R)
    + "SELECT sid AS signal_id, state AS final_state, mt AS max_tp_hit, pips AS claimed_pips, closed AS closed_at, n AS source_follow_up_count FROM r",
    "actual_outcomes": _with(E, M, S, B, A168) + f"SELECT {ACTUAL_COLUMNS} FROM a",
    "actual_outcomes_fixed_sl": _with(E, M, S, B, A6) + f"SELECT {ACTUAL_COLUMNS} FROM a",
    "actual_state_counts": _with(E, M, S, B, A6) + "SELECT state AS final_state, count(*) AS n FROM a GROUP BY state",
    "discrepancies": _with(E, M, S, F, L, R, B, A168, D)
    + "SELECT sid AS signal_id, grp AS group_id, rs AS reported_state, ac AS actual_state, cat AS category, rp AS reported_pips, ap AS actual_pips FROM dc",
    "discrepancy_counts": _with(E, M, S, F, L, R, B, A168, D) + "SELECT cat AS category, count(*) AS n FROM dc GROUP BY cat",
    "group_metrics": _with(E, M, S, F, L, R, B, A168, metrics()) + f"SELECT {METRICS_COLUMNS} FROM mr",
    "group_metrics_window": _with(E, M, S, F, L, R, B, A168, metrics("s.ts BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-15 12:00:00'"))
    + f"SELECT {METRICS_COLUMNS} FROM mr",
    "tp_depth_levels": _with(E, M, S, F, L, R, T) + "SELECT grp AS group_id, level, denom, hits, rate AS hit_rate FROM lr",
    "tp_depth_summary": _with(E, M, S, F, L, R, T)
    + "SELECT grp AS group_id, n AS n_signals, told AS n_reported, quiet AS no_report_rate, lost AS sl_hit_rate, deepest AS max_tp_level FROM ts",
    "tp_depth_wide": _with(E, M, S, F, L, R, T)
    + "SELECT ts.grp AS group_id, n AS n_signals, told AS n_reported, quiet AS no_report_rate, lost AS sl_hit_rate, "
    + ", ".join(f"max(rate) FILTER (level = {k}) AS tp{k}_hit_rate" for k in range(1, 6))
    + " FROM ts LEFT JOIN lr ON lr.grp = ts.grp GROUP BY ALL",
    "tp_depth_long": _with(E, M, S, F, L, R, T) + "SELECT grp AS group_id, 'TP' || level AS tp_level, rate AS hit_rate FROM lr WHERE level <= 5 AND rate IS NOT NULL",
    "leaderboard": _with(E, M, S, F, L, R)
    + "SELECT s.grp AS group_id, count(*) AS n_signals, count(*) FILTER (state = 'WIN') AS wins, count(*) FILTER (state = 'LOSS') AS losses, count(*) FILTER (state = 'OPEN') AS open, "
    "count(*) FILTER (state = 'NO_REPORT') AS no_report, round_even(coalesce(count(*) FILTER (state = 'WIN') / nullif(count(*) FILTER (state IN ('WIN', 'LOSS')), 0), 0.0), 6) AS win_rate "
    "FROM s JOIN r ON r.sid = s.sid GROUP BY s.grp",
    "required_bar_range": _with(E, M, S) + "SELECT 'XAUUSD' AS instrument, min(ts) AS range_start, max(ts) + INTERVAL 168 HOUR AS range_end FROM s",
    "market_gaps": _with(E, M, S, B)
    + """, rg AS (SELECT min(ts) AS a, max(ts) + INTERVAL 168 HOUR AS z FROM s),
sl AS (
  SELECT greatest(day, a) AS x, least(day + INTERVAL 1 DAY, z) AS y
  FROM rg, LATERAL (SELECT unnest(generate_series(date_trunc('day', a), z, INTERVAL 1 DAY)) AS day) WHERE greatest(day, a) < least(day + INTERVAL 1 DAY, z)
),
q AS (SELECT x, y, greatest(1, CAST(floor((epoch_us(y) - epoch_us(x)) / 60000000.0) AS BIGINT)) AS want, (SELECT count(*) FROM b WHERE b.ts >= x AND b.ts < y) AS n FROM sl)
SELECT 'XAUUSD' AS instrument, x AS slice_start, y AS slice_end, n AS n_bars, want AS expected_bars, greatest(1, CAST(floor(want * 0.5) AS BIGINT)) AS threshold
FROM q WHERE n < greatest(1, CAST(floor(want * 0.5) AS BIGINT))""",
    "insert_or_ignore": _with(E, M) + "SELECT uid AS message_uid FROM m WHERE reply IS NOT NULL",
    "upsert_keeping": _with(E, M, C)
    + "SELECT uid AS message_uid, if(class = 'UNCERTAIN', 'NOISE', class) AS class, if(class = 'UNCERTAIN', 1.0::DOUBLE, round_even(conf, 6)) AS confidence, why AS reasons FROM c",
    "links_of_group": _with(E, M, S, F, L) + "SELECT fid || '->' || l.sid AS link_id, method AS link_method FROM l JOIN s ON s.sid = l.sid WHERE s.grp = 'g3'",
    "outcome_lookup": _with(E, M, S, F, L, R) + "SELECT sid AS signal_id, state AS final_state, n AS source_follow_up_count FROM r WHERE sid = (SELECT min(sid) FROM s)",
    "backfilled_messages": _with(RAW)
    + "SELECT grp || ':' || i AS message_uid, grp AS group_id, i AS message_id, ts, sender AS sender_id, txt AS text, u AS reply_to_msg_id, CAST(-3 AS BIGINT) AS views, "
    "CAST(NULL AS BIGINT) AS forwards, CAST(NULL AS BIGINT) AS reply_count FROM raw WHERE ok",
    "backfill_stats": _with(RAW) + "SELECT file, count(*) AS read, count(*) FILTER (NOT ok) AS skipped, count(*) FILTER (ok) AS inserted FROM raw GROUP BY file",
    "chat_api_messages": "SELECT 'c:' || event_id AS message_uid, event_id AS message_id, date_trunc('second', ts) AS ts, CAST(user_id AS VARCHAR) AS sender_id, event_type AS text, "
    "if(event_type IN ('view', 'click'), NULL, user_id) AS reply_count FROM events",
    "tagged_bars": "WITH e AS (SELECT event_id AS i, ts, 1900.0::DOUBLE + floor(least(value, 100.0::DOUBLE) * 4) / 4 AS p FROM events) "
    "SELECT 'XAUUSD:1min:' || strftime(date_trunc('minute', ts), '%Y-%m-%dT%H:%M:%SZ') || ':demo' AS bar_id, 'XAUUSD' AS instrument, '1min' AS interval, date_trunc('minute', ts) AS ts, "
    "first(p ORDER BY ts, i) AS open, last(p ORDER BY ts, i) AS close, CAST(count(*) AS DOUBLE) AS volume, 'demo' AS provider FROM e GROUP BY date_trunc('minute', ts)",
    "answer_costs": "SELECT CAST(coalesce(sum(floor(value) * 0.25::DOUBLE), 0.0) AS DOUBLE) AS cost_usd FROM events",
    "manifest_targets": """
WITH x AS (
  SELECT event_id AS line_no, CASE event_type WHEN 'purchase' THEN 'Room ' || user_id WHEN 'click' THEN 'Hall ' || user_id ELSE '@rOOm' || user_id END AS label,
    CASE event_type WHEN 'purchase' THEN 'Room' || user_id WHEN 'click' THEN CAST(user_id AS VARCHAR) ELSE 'rOOm' || user_id END AS target
  FROM events WHERE event_type IN ('purchase', 'click', 'view')
)
SELECT line_no, label, target FROM x QUALIFY row_number() OVER (PARTITION BY lower(target) ORDER BY line_no) = 1""",
    "insert_or_replace": _with(E, B) + "SELECT ts, close + if(minute(ts) % 2 = 0, 1.0, 0.0)::DOUBLE AS close FROM b",
    "scalar_functions": _with(E)
    + "SELECT i AS event_id, round_even(if(i % 2 = 0, 1950.0::DOUBLE - p, p - 1950.0::DOUBLE) / 0.1::DOUBLE, 2) AS pips, i AS message_number, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS iso, "
    "'m:v1:' || left(sha256('a ' || kind || ' b'), 24) AS cache_key, if(length(kind) > 5, left(kind, 4) || '…', kind) AS label, "
    "kind || ':' || i AS uid, strftime(ts + INTERVAL 210 MINUTE, '%Y-%m-%dT%H:%M:%SZ') AS utc, CAST(if(i % 2 = 0, 2, 0) AS INTEGER) AS numbers FROM e",
}
