"""The eleven KPI measures of the ad report, under two rule sets.

A measure is a conditional count (``sum(case when cond then 1 else 0)``) or a
conditional sum of a price floored to thousands. The *strict* rules are the
ones on the reference's live path (its DataFrame form); the *loose* rules are
those of its SQL form, which omit some conditions. Both render to Spark Columns
and to SQL text from this one table, so the DataFrame and SQL report forms can
never drift apart.

A NULL flag makes a condition NULL, which falls to the ``else 0`` branch: the
event counts as 0. A NULL price under a true condition is skipped by ``sum``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the report rules.
PROVIDER_MIN = 100000  # adplatformproviderid >= this: platform-side traffic
ORDER_MIN_EXCLUSIVE = 200000  # adorderid / adcreativeid > this: billable DSP ads
PRICE_UNIT = 1000  # prices are reported in thousands, floored per event

RULES = ("strict", "loose")

Cond = tuple[str, str, int]  # (column, operator, literal)


@dataclass(frozen=True)
class Measure:
    name: str
    conds: tuple[Cond, ...]
    price: str | None = None  # None: count; else sum(floor(price / PRICE_UNIT))


def _platform(*extra: Cond) -> tuple[Cond, ...]:
    return (
        ("adplatformproviderid", ">=", PROVIDER_MIN),
        ("iseffective", "=", 1),
        ("isbilling", "=", 1),
    ) + extra


_DSP = (("iswin", "=", 1), ("adorderid", ">", ORDER_MIN_EXCLUSIVE), ("adcreativeid", ">", ORDER_MIN_EXCLUSIVE))


def _measures(strict: bool) -> tuple[Measure, ...]:
    only_strict = (lambda *c: c) if strict else (lambda *c: ())
    return (
        Measure("orginal_req_cnt", (("requestmode", "=", 1), ("processnode", ">=", 1))),
        Measure("valid_req_cnt", (("requestmode", "=", 1), ("processnode", ">=", 2))),
        Measure("ad_req_cnt", (("requestmode", "=", 1), ("processnode", "=", 3))),
        Measure("join_rtx_cnt", _platform(("isbid", "=", 1), ("adorderid", "!=", 0))),
        Measure("success_rtx_cnt", _platform(("iswin", "=", 1), *only_strict(("adorderid", "!=", 0)))),
        Measure("ad_show_cnt", (("requestmode", "=", 2), ("iseffective", "=", 1))),
        Measure(
            "ad_click_cnt",
            (("requestmode", "=", 3), ("iseffective", "=", 1), *only_strict(("adorderid", "!=", 0))),
        ),
        Measure(
            "media_show_cnt",
            (("requestmode", "=", 2), ("iseffective", "=", 1), ("isbilling", "=", 1),
             *only_strict(("isbid", "=", 1), ("iswin", "=", 1))),
        ),
        Measure(
            "media_click_cnt",
            (("requestmode", "=", 3), ("iseffective", "=", 1), ("isbilling", "=", 1),
             *only_strict(("isbid", "=", 1), ("iswin", "=", 1))),
        ),
        Measure("dsp_pay_money", _platform(*_DSP), price="winprice"),
        Measure("dsp_cost_money", _platform(*only_strict(("isbid", "=", 1)), *_DSP), price="adpayment"),
    )


MEASURES = {"strict": _measures(True), "loose": _measures(False)}
MEASURE_NAMES = tuple(m.name for m in MEASURES["strict"])

# The report keeps a group only if these six counters are all non-zero.
NONZERO = (
    "join_rtx_cnt",
    "success_rtx_cnt",
    "ad_show_cnt",
    "ad_click_cnt",
    "media_show_cnt",
    "media_click_cnt",
)

# (rate column, numerator, denominator)
RATES = (
    ("success_rtx_rate", "success_rtx_cnt", "join_rtx_cnt"),
    ("ad_click_rate", "ad_click_cnt", "ad_show_cnt"),
    ("media_click_rate", "media_click_cnt", "media_show_cnt"),
)

# Columns a KPI report reads from an event row (for pruning and narrow caches).
INPUT_COLUMNS = tuple(
    sorted({c for m in MEASURES["strict"] for c, _, _ in m.conds} | {"winprice", "adpayment"})
)

def measures(rules: str = "strict") -> tuple[Measure, ...]:
    if rules not in MEASURES:
        raise ValueError(f"rules must be one of {RULES}, got {rules!r}")
    return MEASURES[rules]


def condition_sql(m: Measure, alias: str | None = None) -> str:
    prefix = f"{alias}." if alias else ""
    return " AND ".join(f"{prefix}{c} {op} {v}" for c, op, v in m.conds)


def measure_sql(m: Measure, alias: str | None = None, named: bool = True) -> str:
    """The aggregate as SQL text (columns qualified by ``alias`` if given)."""
    prefix = f"{alias}." if alias else ""
    value = "1" if m.price is None else f"floor({prefix}{m.price} / {PRICE_UNIT})"
    text = f"CAST(SUM(CASE WHEN {condition_sql(m, alias)} THEN {value} ELSE 0 END) AS BIGINT)"
    return f"{text} AS {m.name}" if named else text


def measure_column(m: Measure) -> Column:
    """Aggregate Column for one measure, typed bigint.

    Built from the SQL text: one call into the JVM per measure instead of one
    per sub-expression, which keeps plan construction cheap on the driver.
    """
    return F.expr(measure_sql(m, named=False)).alias(m.name)
