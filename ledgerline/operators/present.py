"""Presentation columns of the reports (rupiah text, dashboard HTML snippets).

Kept apart from the numeric results: every report has a numeric form that tests compare, and a
presentation form that is a last projection over a handful of rows (or, for the order-level
report, one row per order).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.money import fixed_text, rupiah_text

# fixed values: dashboard markup of the source reports
FUNNEL_COLORS = {"KOL": "#4682B4", "AM": "#2E8B57", "INTERNAL": "#8B4513", "ACTION": "#BA55D3"}
SPAN_OPEN = '<span style="color:{color};font-weight:{weight}">'
SPAN_CLOSE = "</span>"
BOLD_OPEN, BOLD_CLOSE = "<b>", "</b>"
BAR_EMPTY = '<div style="background:#eee;width:100px;height:14px;border-radius:6px;"></div>'
BAR_ROW = ('<div style="background:#eee;width:100px;height:14px;border-radius:6px;position:relative;overflow:hidden;">\n'
           '       <div style="width:{pct}%;background:#28a745;height:100%;border-radius:6px 0 0 6px;"></div>\n'
           '       <div style="position:absolute;top:0;left:0;width:100%;text-align:center;font-size:11px;line-height:14px;font-weight:500;color:#333333;">{pct}%</div>\n'
           '     </div>')
BAR_TOTAL = ('<div style="background:#eee;width:100px;height:14px;border-radius:6px;position:relative;overflow:hidden;">\n'
             '       <div style="width:{pct}%;background:#51C4D3;height:100%;"></div>\n'
             '       <div style="position:absolute;top:0;left:0;width:100%;text-align:center;font-size:11px;font-weight:500;color:#333333;">{pct}%</div>\n'
             '     </div>')


def template(tpl: str, **cols: Column) -> Column:
    """Fill ``{name}`` slots of a literal template with columns (NULL slot -> NULL result)."""
    import re
    parts = []
    for piece in re.split(r"(\{\w+\})", tpl):
        if piece.startswith("{") and piece.endswith("}"):
            parts.append(cols[piece[1:-1]])
        elif piece:
            parts.append(F.lit(piece))
    return F.concat(*parts)


def span(text: Column, group: str, weight: int) -> Column:
    return template(SPAN_OPEN.format(color=FUNNEL_COLORS[group], weight=weight) + "{v}" + SPAN_CLOSE,
                    v=text)


def rp(value: Column) -> Column:
    """``'Rp 1.234.567'``"""
    return F.concat(F.lit("Rp "), rupiah_text(value))


def bold(text: Column) -> Column:
    return F.concat(F.lit(BOLD_OPEN), text, F.lit(BOLD_CLOSE))


def percent_bar(budget: Column, tenths: Column, total_row: bool) -> Column:
    """Progress bar of a percentage (tenths of a percent); empty bar when the budget is 0."""
    pct = fixed_text(tenths, 1)
    tpl = BAR_TOTAL if total_row else BAR_ROW
    return F.when(budget == 0, F.lit(BAR_EMPTY)).otherwise(template(tpl, pct=pct))
