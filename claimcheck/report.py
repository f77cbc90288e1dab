"""CSV and HTML results; the driver formats small aggregates only."""

from __future__ import annotations

import hashlib
import json
from html import escape
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimcheck.operators import analytics, compare

STYLE = "body{font-family:sans-serif;max-width:70em;margin:2em auto}table{border-collapse:collapse}td,th{padding:.3em .7em;border-bottom:1px solid #ccc;text-align:right}"


def write_csv(df: DataFrame, path: str) -> None:
    """One CSV file with a header below ``path``, rows in their order."""
    flat = df.select([F.array_join(F.col(c).cast("array<string>"), "|").alias(c) if t.startswith("array") else F.col(c) for c, t in df.dtypes])
    flat.coalesce(1).write.mode("overwrite").options(header=True, escape='"').csv(path)


def _cell(x, rate: bool) -> str:
    if x is None:
        return "–"
    return f"{100 * x:.1f}%" if rate else escape(f"{x:.3f}".rstrip("0").rstrip(".") if isinstance(x, float) else str(x))


def _table(title: str, rows: list, columns: list[str]) -> str:
    if not rows:
        return f"<h2>{escape(title)}</h2><p>No rows.</p>"
    head = "".join(f"<th>{escape(c)}</th>" for c in columns)
    body = "".join("<tr>" + "".join(f"<td>{_cell(r[c], c.endswith('_rate') or c.endswith('_gap'))}</td>" for c in columns) + "</tr>" for r in rows)
    return f"<h2>{escape(title)}</h2><table><tr>{head}</tr>{body}</table>"


def frames(signals: DataFrame, reported: DataFrame, actual: DataFrame, start: str | None = None, end: str | None = None, min_signals: int = 0) -> dict[str, DataFrame]:
    """The dashboard's tables: metrics, tp_depth (wide), tp_depth_long, drilldown."""
    levels = analytics.tp_depth_levels(signals, reported, start, end)
    summary = analytics.tp_depth_summary(signals, reported, start, end, min_signals)
    metrics = analytics.group_metrics(signals, reported, actual, start, end).where(F.col("n_signals") >= min_signals)
    return {
        "metrics": analytics.by_actual_rate(metrics),
        "tp_depth": analytics.by_first_target(analytics.tp_depth_wide(summary, levels)),
        "tp_depth_long": analytics.tp_depth_long(levels),
        "drilldown": compare.discrepancies(signals, reported, actual),
    }


def write_html(path: str | Path, signals: DataFrame, reported: DataFrame, actual: DataFrame, title: str = "Trade claims", labels: dict[str, str] | None = None, start: str | None = None, end: str | None = None, min_signals: int = 0) -> Path:
    """Leaderboard, target depth and categories as one page; a row a group."""
    t, labels = frames(signals, reported, actual, start, end, min_signals), labels or {}

    def named(df):
        return [r.asDict() | {"group": labels.get(r["group_id"], r["group_id"])} for r in df.collect()]

    depth = named(t["tp_depth"])
    shown = [f"tp{n}_hit_rate" for n in range(1, 1 + analytics.LEVELS_SHOWN) if any(r[f"tp{n}_hit_rate"] is not None for r in depth)]
    categories = [r.asDict() for r in compare.discrepancy_counts(t["drilldown"]).orderBy(F.desc("n"), "category").collect()]
    window = f"<p>Window: {escape(start or '–')} to {escape(end or '–')}</p>" if start or end else ""
    page = [
        f"<!doctype html><meta charset=utf-8><title>{escape(title)}</title><style>{STYLE}</style><h1>{escape(title)}</h1>{window}",
        _table("Groups", named(t["metrics"]), ["group", "n_signals", "reported_win_rate", "actual_win_rate", "win_rate_gap", "avg_realized_pips", "avg_realized_rr", "ambiguous_bars", "insufficient_data"]),
        _table("Target depth", depth, ["group", "n_signals", "n_reported", "no_report_rate", "sl_hit_rate", *shown]),
        _table("Categories", categories, ["category", "n"]),
    ]
    out = Path(path)
    out.parent.mkdir(parents=True, exist_ok=True)
    out.write_text("\n".join(page), encoding="utf-8")
    return out


# The page filters and draws what is embedded in it; a group's signals are in a file of their own.
SCRIPT = """
const pct=x=>x==null?'–':(100*x).toFixed(1)+'%', num=x=>x==null?'–':typeof x==='number'?String(Math.round(1000*x)/1000):x;
const cell=(k,x)=>/_rate$|_gap$/.test(k)?pct(x):num(x);
function table(at,rows,cols){const t=document.createElement('table');const h=t.insertRow();
 for(const c of cols){const x=document.createElement('th');x.textContent=c;h.append(x)}
 for(const r of rows){const x=t.insertRow();for(const c of cols)x.insertCell().textContent=cell(c,r[c])}
 document.getElementById(at).replaceChildren(t)}
function bars(at,rows,label,series){const w=640,left=160,h=14,gap=8,ns='http://www.w3.org/2000/svg';
 const s=document.createElementNS(ns,'svg');const block=h*series.length+gap;s.setAttribute('viewBox',`0 0 ${w} ${Math.max(1,rows.length)*block}`);s.setAttribute('width',w);
 const most=Math.max(1e-9,...rows.flatMap(r=>series.map(k=>r[k]||0)));
 const add=(n,a,t)=>{const e=document.createElementNS(ns,n);for(const k in a)e.setAttribute(k,a[k]);if(t!=null)e.textContent=t;s.append(e)};
 rows.forEach((r,i)=>{add('text',{x:left-6,y:i*block+h,'text-anchor':'end','font-size':11},r[label]);
  series.forEach((k,j)=>{const v=r[k];if(v==null)return;const y=i*block+j*h;
   add('rect',{x:left,y,width:(w-left-60)*v/most,height:h-2,class:'s'+j});add('text',{x:left+(w-left-60)*v/most+4,y:y+h-4,'font-size':10},cell(k,v))})});
 const key=document.createElement('p');key.innerHTML=series.map((k,j)=>`<span class="s${j}">■</span> ${k}`).join(' ');document.getElementById(at).replaceChildren(key,s)}
function draw(){const least=+document.getElementById('least').value;document.getElementById('leastShown').textContent=least;
 const m=D.metrics.filter(r=>r.n_signals>=least),d=D.depth.filter(r=>r.n_signals>=least),ok=new Set(m.map(r=>r.group_id));
 table('metrics',m,D.metricColumns);bars('gap',m.filter(r=>r.reported_win_rate!=null&&r.actual_win_rate!=null).sort((a,b)=>b.win_rate_gap-a.win_rate_gap),'group',['reported_win_rate','actual_win_rate']);
 table('depth',d,D.depthColumns);bars('levels',d,'group',D.levels);table('categories',D.categories,['category','n']);bars('counts',D.categories,'category',['n']);
 const pick=document.getElementById('pick'),now=pick.value;pick.replaceChildren(...m.map(r=>new Option(r.group,r.file)));if([...pick.options].some(o=>o.value===now))pick.value=now;drill()}
function drill(){const f=document.getElementById('pick').value;if(!f){document.getElementById('drill').textContent='No group.';return}
 const s=document.createElement('script');s.src=D.folder+'/'+f;document.head.append(s)}
function rows(x){table('drill',x.rows,x.columns)}
document.getElementById('least').oninput=draw;document.getElementById('pick').onchange=drill;draw();
"""


def write_dashboard(path: str | Path, signals: DataFrame, reported: DataFrame, actual: DataFrame, title: str = "Trade claims", labels: dict[str, str] | None = None, start: str | None = None, end: str | None = None, min_signals: int = 20) -> Path:
    """A page with a filter, tables, charts and a drill-down to a group's signals.

    What the page holds is a row a group; the signals of each group are in a
    file of the folder next to it and read when the group is chosen.  They pass
    the driver one by one.
    """
    t, labels = frames(signals, reported, actual, start, end), labels or {}
    out = Path(path)
    folder = out.with_suffix(".signals")
    folder.mkdir(parents=True, exist_ok=True)
    file = lambda g: hashlib.sha256(str(g).encode()).hexdigest()[:16] + ".js"
    plain = lambda r: {k: v if v is None or isinstance(v, int | float | str) else str(v) for k, v in r.asDict().items()}
    more = lambda r: plain(r) | {"group": labels.get(r["group_id"], r["group_id"]), "file": file(r["group_id"])}
    depth = [more(r) for r in t["tp_depth"].collect()]
    levels = [f"tp{n}_hit_rate" for n in range(1, 1 + analytics.LEVELS_SHOWN) if any(r[f"tp{n}_hit_rate"] is not None for r in depth)]
    data = {
        "metrics": [more(r) for r in t["metrics"].collect()],
        "metricColumns": ["group", "n_signals", "reported_win_rate", "actual_win_rate", "win_rate_gap", "avg_realized_pips", "avg_realized_rr", "ambiguous_bars", "insufficient_data"],
        "depth": depth,
        "depthColumns": ["group", "n_signals", "n_reported", "no_report_rate", "sl_hit_rate", *levels],
        "levels": levels,
        "categories": [plain(r) for r in compare.discrepancy_counts(t["drilldown"]).orderBy(F.desc("n"), "category").collect()],
        "folder": folder.name,
    }
    columns = [c for c in t["drilldown"].columns if c != "group_id"]
    now, f = None, None
    for r in t["drilldown"].orderBy("group_id", "signal_id").toLocalIterator():
        if f is None or r.group_id != now:
            if f is not None:
                f.write("]})")
                f.close()
            now, f = r.group_id, (folder / file(r.group_id)).open("w", encoding="utf-8")
            f.write(f"rows({{columns:{json.dumps(columns)},rows:[")
        f.write(json.dumps({c: plain(r)[c] for c in columns}) + ",")
    if f is not None:
        f.write("]})")
        f.close()
    most = max([1, *(r["n_signals"] for r in data["metrics"])])
    embedded = json.dumps(data).replace("<", "\\u003c")
    page = f"""<!doctype html><meta charset=utf-8><title>{escape(title)}</title><style>{STYLE}.s0{{fill:#4878a8;color:#4878a8}}.s1{{fill:#e08a3c;color:#e08a3c}}.s2{{fill:#5a9e6f;color:#5a9e6f}}.s3{{fill:#b05a7a;color:#b05a7a}}.s4{{fill:#7a6aa8;color:#7a6aa8}}</style>
<h1>{escape(title)}</h1><p>Window: {escape(start or "–")} to {escape(end or "–")}</p>
<p><label>Signals of a group, at least <input id=least type=range min=1 max={most} value={min(max(1, min_signals), most)}> <b id=leastShown></b></label></p>
<h2>Groups</h2><div id=metrics></div><h2>Reported and actual win rate</h2><div id=gap></div><h2>Target depth</h2><div id=depth></div><h2>Hit rate by target</h2><div id=levels></div>
<h2>Categories</h2><div id=categories></div><div id=counts></div><h2>Signals</h2><p><select id=pick></select></p><div id=drill></div>
<script>const D={embedded};{SCRIPT}</script>"""
    out.write_text(page, encoding="utf-8")
    return out
