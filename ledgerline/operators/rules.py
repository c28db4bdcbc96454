"""Business rule tables and their compilation.

Every rule is data: a keyword list matched case-insensitively as a substring (first match wins),
and the values attached to it.  Each table compiles to a Spark ``Column`` (a ``CASE WHEN`` chain
evaluated inside whole-stage codegen) and to SQL text for the DuckDB oracle, from this single
definition, so the two sides cannot drift apart.

Rules that differ between reports are separate parameters, never one shared constant.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------------------------
# fixed values: these must equal the source reports
# ---------------------------------------------------------------------------------------------
INVALID_STATUSES = ("BARU", "DIBATALKAN", "GAGAL_KIRIM", "DIKEMBALIKAN")
SHOPEE, TIKTOK, MANUAL, KIRIMINAJA = "SHOPEE", "TIKTOK_SHOP", "MANUAL", "KIRIMINAJA"
ENDORSE = "ENDORSE"
MANUAL_PLATFORMS = ("TIKTOK_SHOP_MANUAL", "SHOPEE_MANUAL")
VAT_DIVISOR = 111                      # net of 11 % VAT = gross * 100 / 111
EXCLUDED_MANUAL_DAY = dt.date(2025, 9, 10)
SURCHARGE_SWITCH = dt.date(2026, 1, 1)
PACKING_SWITCH = dt.date(2026, 4, 1)
TIKTOK_ROAS_CREDIT_FROM = dt.date(2026, 3, 24)
WAREHOUSE_NAME_KEYWORDS = ("GUDANG", "SHOPEE KONSI")        # consignment exclusions
WAREHOUSE_NAME_KEYWORDS_LOOSE = ("GUDANG", "SHOPEE")        # manual revenue / funnel variant
NAKAMA = "NAKAMA"

# TikTok commission fee: (any of these keywords, fee rate), first match wins.
TIKTOK_FEE_RULES = (
    (("Vitabumin Madu 130", "Paramorina", "Yayle", "Cessa"), "0.1425"),
    (("Vitabumin Madu 60", "Protabumin"), "0.16"),
    (("Habbie",), "0.165"),
)
TIKTOK_FEE_FALLBACK = "0.1425"          # the funnel report uses an amount of 0 instead

# Cost of goods per unit: (keywords that must all match, unit price, unit price is gross of VAT,
# surcharge per unit, surcharge schedule).  First match wins; no match costs 0.
COGS_RULES = (
    (("Habbie Telon", "100 ml"), 31000, True, 0, None),
    (("Paramorina Madu",), 29970, True, 500, None),
    (("Paramorina Tetes",), 29970, True, 500, None),
    (("Vitabumin Madu 130",), 29970, True, 0, None),
    (("Vitabumin Madu 60",), 17760, True, 0, None),
    (("Protabumin Careos",), 63300, True, 7500, "careos"),
    (("Protabumin Nutrimom",), 43300, True, 5500, "nutrimom"),
    (("Yayle",), 22500, False, 0, None),
    (("Habbie MKP",), 35000, True, 0, None),
    (("Habbie Telon", "60 ml"), 23200, True, 0, None),
    (("GM. TP",), 4900, True, 0, None),
    (("Habbie Tester",), 8700, True, 0, None),
    (("Gm.Md Banner",), 16000, True, 0, None),
    (("Habbie Box Isi 3",), 20000, True, 0, None),
    (("Habbie Box Isi 5",), 21000, True, 0, None),
    (("Cessa",), 27000, True, 0, None),
    (("Lega",), 18500, True, 0, None),
)
PLACEHOLDER_UNIT_COST = 1000            # the monthly and shop-day reports use 1000 for every product
# Dated surcharge per unit: (special shop from the switch, other shops from the switch, before).
SURCHARGE_SCHEDULE = {"careos": (18000, 7000, 7500), "nutrimom": (12500, 5000, 5500)}

# Packing cost per order by total quantity: (lower op, lower, upper op, upper, cost); else 0.
PACKING_TIERS_ORDER_LEVEL = ((">", 0, "<=", 3, 2300), (">", 3, "<=", 10, 2800),
                             (">", 10, "<=", 60, 7400), (">", 60, None, None, 11400))
PACKING_TIERS_MONTHLY_OLD = ((">", 0, "<=", 3, 2000), (">", 3, "<=", 10, 3000),
                             (">", 10, "<=", 60, 10000), (">", 60, None, None, 12000))
PACKING_TIERS_MONTHLY_NEW = ((">=", 1, "<=", 39, 2000), (">=", 40, None, None, 10000))
PACKING_TIERS_DAILY_OLD = ((">=", 1, "<=", 3, 2000), (">=", 4, "<=", 10, 2800),
                           (">=", 11, "<=", 60, 3000), (">", 60, None, None, 10000))
PACKING_TIERS_DAILY_NEW = ((">=", 1, "<=", 39, 1000), (">=", 40, None, None, 1000))

# Marketing budget accrual and sample cost per unit, by product keyword.
BUDGET_RATES = ((("protabumin nutrimom",), 5000), (("protabumin careos",), 7000))
SAMPLE_RATES = ((("protabumin nutrimom",), 65000), (("protabumin careos",), 85000))
BUDGET_PRODUCT_KEYWORDS = ("protabumin nutrimom", "protabumin careos")
# Budget matrix: sales month -> column label (sales show under the next month's name).
BUDGET_MONTH_LABELS = ((6, "JULI"), (7, "AGUSTUS"), (8, "SEPTEMBER"), (9, "OKTOBER"),
                       (10, "NOVEMBER"), (11, "DESEMBER"))
SPEND_CATEGORIES = ("AM", "KOL", "EVENT", "PROMOSI", "SAMPEL", "IKLAN FACEBOOK")
SAMPLE_SHOPEE_STORE = "PROTABUMIN OFFICIAL SHOP"
SAMPLE_TIKTOK_STORE = "protabuminofficial"
OVERHEAD_KINDS = (("AFFILIATOR", "beban_am_bulanan"), ("CONTENT_CREATOR", "beban_cc_bulanan"),
                  ("LIVE", "beban_live_bulanan"))
# ---------------------------------------------------------------------------------------------


def fee_factor(rate: str) -> Decimal:
    """Share kept after the fee, times 100 (the VAT numerator): (1 - rate) * 100, exact."""
    return (Decimal(1) - Decimal(rate)) * 100


# --- Spark side -------------------------------------------------------------------------------

def contains_ci(col: Column, keyword: str) -> Column:
    return col.ilike(f"%{keyword}%")


def matches_all(col: Column, keywords) -> Column:
    cond = None
    for kw in keywords:
        c = contains_ci(col, kw)
        cond = c if cond is None else (cond & c)
    return cond


def matches_any(col: Column, keywords) -> Column:
    cond = None
    for kw in keywords:
        c = contains_ci(col, kw)
        cond = c if cond is None else (cond | c)
    return cond


def first_match(col: Column, rules, value_of, default, any_keyword: bool = False) -> Column:
    """``CASE WHEN kw... THEN value ... ELSE default END`` over a rule table."""
    expr = None
    for rule in rules:
        cond = matches_any(col, rule[0]) if any_keyword else matches_all(col, rule[0])
        val = value_of(rule)
        expr = F.when(cond, val) if expr is None else expr.when(cond, val)
    return expr.otherwise(default)


def cogs_rule_index(name: Column) -> Column:
    """Index (1-based) of the first cost-of-goods rule matching the product name, 0 if none."""
    return first_match(name, [(r[0], i + 1) for i, r in enumerate(COGS_RULES)],
                       lambda r: F.lit(r[1]), F.lit(0))


def tiktok_fee_factor(name: Column, fallback: str | None) -> Column:
    """(1 - fee) * 100 for the product; ``fallback`` None means the amount is 0 (factor 0)."""
    default = F.lit(fee_factor(fallback)) if fallback is not None else F.lit(Decimal("0.0000"))
    return first_match(name, TIKTOK_FEE_RULES, lambda r: F.lit(fee_factor(r[1])), default,
                       any_keyword=True)


def rate_per_unit(name: Column, rates) -> Column:
    return first_match(name, rates, lambda r: F.lit(r[1]), F.lit(0))


def tier_cost(q: Column, tiers) -> Column:
    ops = {">": lambda a, b: a > b, ">=": lambda a, b: a >= b,
           "<": lambda a, b: a < b, "<=": lambda a, b: a <= b}
    expr = None
    for lo_op, lo, hi_op, hi, cost in tiers:
        cond = ops[lo_op](q, F.lit(lo))
        if hi_op is not None:
            cond = cond & ops[hi_op](q, F.lit(hi))
        expr = F.when(cond, F.lit(cost)) if expr is None else expr.when(cond, F.lit(cost))
    return expr.otherwise(F.lit(0))


# --- SQL side (oracle) ------------------------------------------------------------------------

def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sql_matches_all(col: str, keywords) -> str:
    return " AND ".join(f"{col} ILIKE {_sql_str('%' + kw + '%')}" for kw in keywords)


def sql_matches_any(col: str, keywords) -> str:
    return "(" + " OR ".join(f"{col} ILIKE {_sql_str('%' + kw + '%')}" for kw in keywords) + ")"


def sql_first_match(col: str, rules, value_of, default: str, any_keyword: bool = False) -> str:
    match = sql_matches_any if any_keyword else sql_matches_all
    parts = [f"WHEN {match(col, r[0])} THEN {value_of(r)}" for r in rules]
    return "CASE " + " ".join(parts) + f" ELSE {default} END"


def sql_cogs_rule_index(col: str) -> str:
    return sql_first_match(col, [(r[0], i + 1) for i, r in enumerate(COGS_RULES)],
                           lambda r: str(r[1]), "0")


def sql_tiktok_fee_factor(col: str, fallback: str | None) -> str:
    default = f"CAST({fee_factor(fallback)} AS DECIMAL(9,4))" if fallback is not None \
        else "CAST(0 AS DECIMAL(9,4))"
    return sql_first_match(col, TIKTOK_FEE_RULES,
                           lambda r: f"CAST({fee_factor(r[1])} AS DECIMAL(9,4))", default,
                           any_keyword=True)


def sql_rate_per_unit(col: str, rates) -> str:
    return sql_first_match(col, rates, lambda r: str(r[1]), "0")


def sql_tier_cost(q: str, tiers) -> str:
    parts = []
    for lo_op, lo, hi_op, hi, cost in tiers:
        cond = f"{q} {lo_op} {lo}" + (f" AND {q} {hi_op} {hi}" if hi_op else "")
        parts.append(f"WHEN {cond} THEN {cost}")
    return "CASE " + " ".join(parts) + " ELSE 0 END"


def sql_in(values) -> str:
    return "(" + ", ".join(_sql_str(v) if isinstance(v, str) else str(v) for v in values) + ")"


@dataclass(frozen=True)
class CogsVariant:
    """Cost-of-goods variant of one report."""

    unit_override: int | None      # None: real unit prices; else one placeholder price
    dated_surcharge: bool          # True: surcharge schedule by date and shop; else fixed


COGS_ORDER_LEVEL = CogsVariant(unit_override=None, dated_surcharge=False)
COGS_PLACEHOLDER_DATED = CogsVariant(unit_override=PLACEHOLDER_UNIT_COST, dated_surcharge=True)
