"""A page of a silver table's profile: distributions and a searchable list of samples."""

from __future__ import annotations

from html import escape

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.operators import profile

_STYLE = "body{font:15px sans-serif;margin:2em}table{border-collapse:collapse}td,th{padding:.2em .8em;text-align:left}.bar{background:#7aa;height:.8em}.card{border:1px solid #ccc;margin:.5em 0;padding:.5em}"
_SCRIPT = (
    "function pick(){const q=document.getElementById('q').value.toLowerCase(),s=[...document.querySelectorAll('select')];"
    "for(const c of document.querySelectorAll('.card'))c.style.display=c.textContent.toLowerCase().includes(q)&&s.every(x=>!x.value||c.dataset[x.name]==x.value)?'':'none'}"
)


def _chart(title: str, rows: list) -> str:
    most = max((r["percent"] for r in rows), default=1)
    lines = "".join(f"<tr><td>{escape(str(r['value']))}</td><td>{r['n']}</td><td>{r['percent']:.1f} %</td><td><div class=bar style='width:{r['percent'] / most * 200:.0f}px'></div></td></tr>" for r in rows)
    return f"<h2>{escape(title)}</h2><table>{lines}</table>"


def page(rows: DataFrame, order: str, fields: tuple[str, ...] = ("domain", "source_type", "publisher"), text: str = "text_plain", samples: int = 100) -> str:
    """Aggregates in Spark, a bounded number of samples in order, and the markup on the driver."""
    size = profile.text_sizes(rows, text).first()
    parts = [f"<p>{size['n']} rows, {size['chars_sum'] or 0} characters, {size['tokens_avg']:.1f} tokens on average</p>"]
    shown = [name for name in fields if name in rows.columns]
    choices = []
    for at, name in enumerate(shown):
        found = profile.shares(rows, name).orderBy(F.desc("n"), "value").collect()
        parts.append(_chart(name, found))
        choices.append(f"<select name=f{at} onchange='pick()'><option value=''>{escape(name)}</option>{''.join(f'<option>{escape(str(r["value"]))}</option>' for r in found)}</select>")
    heading = F.col("heading") if "heading" in rows.columns else F.lit("").alias("heading")
    samples_of = profile.head(rows.select(order, heading, text, *(F.col(c).cast("string").alias(f"__f{i}") for i, c in enumerate(shown))), [order], samples).collect()
    cards = []
    for r in samples_of:
        data = "".join(f" data-f{i}='{escape(str(r[f'__f{i}']))}'" for i in range(len(shown)))
        cards.append(f"<div class=card{data}><b>{escape(str(r['heading']))}</b><p>{escape(str(r[text]))}</p></div>")
    search = f"<input id=q oninput='pick()' placeholder='Filter'>{''.join(choices)}"
    return f"<!DOCTYPE html><html><head><meta charset=utf-8><style>{_STYLE}</style><script>{_SCRIPT}</script></head><body><h1>Profile</h1>{''.join(parts)}{search}{''.join(cards)}</body></html>"
