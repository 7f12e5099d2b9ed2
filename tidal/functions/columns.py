"""Scalar column expressions (all JVM-side, inside whole-stage codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference.
SEVERITY_CODES = {"info": 0, "warning": 1, "error": 2, "critical": 3}
URGENT_PRIORITY = "1-URGENT"
HIGH_PRIORITIES = ("2-HIGH", "3-MEDIUM")
ANOMALY_THRESHOLD = 0.7
BAND_Z = 1.96


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def urgency_bucket(mean_urgency) -> Column:
    """Mean urgency -> round half-even -> int -> clip to 1..3."""
    return F.greatest(F.lit(1), F.least(F.lit(3), F.bround(_c(mean_urgency), 0).cast("int")))


def weekday0(d) -> Column:
    """Day of week with Monday = 0."""
    return F.weekday(_c(d))


def is_eom(d) -> Column:
    """1 on the last three days of the month."""
    d = _c(d)
    return (F.dayofmonth(d) >= F.dayofmonth(F.last_day(d)) - 2).cast("int")


def is_quarter_end(d) -> Column:
    """1 on the last three days of March, June, September and December."""
    d = _c(d)
    return (F.month(d).isin(3, 6, 9, 12)
            & (F.dayofmonth(d) >= F.dayofmonth(F.last_day(d)) - 2)).cast("int")


def month_end_regressor(d) -> Column:
    """1.0 if day of month >= 28 or the day is a quarter end, else 0.0."""
    d = _c(d)
    return ((F.dayofmonth(d) >= 28) | (is_quarter_end(d) == 1)).cast("double")


def request_urgency_from_priority(p) -> Column:
    p = _c(p)
    return (F.when(p == URGENT_PRIORITY, 3)
            .when(p.isin(*HIGH_PRIORITIES), 2).otherwise(1))


def severity_code(s) -> Column:
    s = _c(s)
    expr = None
    for name, code in SEVERITY_CODES.items():
        expr = (F.when(s == name, code) if expr is None else expr.when(s == name, code))
    return expr


def safe_div(num, den) -> Column:
    """NULL instead of an ANSI divide-by-zero error."""
    return F.try_divide(_c(num), _c(den))


def relative_improvement(base, model) -> Column:
    """(base - model) / base * 100 rounded to 2; NULL unless base > 0."""
    base, model = _c(base), _c(model)
    return F.when(base > 0, F.round((base - model) / base * 100, 2))


def flag_anomalous(score, threshold: float = ANOMALY_THRESHOLD) -> Column:
    return _c(score) > F.lit(threshold)
