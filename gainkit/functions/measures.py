"""Column expressions for the information measures.

All measures are built from integer class counts, so the inputs are exact and
only the final log/divide steps are floating point.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

# Digits kept before any comparison (ties, the mean filter) and in reports.
COMPARE_DIGITS = 12
REPORT_DIGITS = 6


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def xlog2x(x) -> Column:
    """x * log2(x) with 0 * log2(0) = 0."""
    x = _c(x).cast("double")
    return F.when(x > 0, x * F.log2(x)).otherwise(F.lit(0.0))


def plogp(part, whole) -> Column:
    """-(part/whole) * log2(part/whole); a zero part adds nothing."""
    part = _c(part).cast("double")
    whole = _c(whole).cast("double")
    p = part / whole
    return F.when(part > 0, -p * F.log2(p)).otherwise(F.lit(0.0))


def entropy_of_counts(counts: list, total=None) -> Column:
    """Entropy in bits of a class histogram given as count columns."""
    counts = [_c(c) for c in counts]
    n = reduce(add, counts) if total is None else _c(total)
    return F.when(n > 0, reduce(add, [plogp(c, n) for c in counts])).otherwise(F.lit(0.0))


def safe_ratio(num, den) -> Column:
    """num/den, 0 when den is 0 (gain ratio of a one-valued split)."""
    num, den = _c(num), _c(den)
    return F.when(den > 0, num / den).otherwise(F.lit(0.0))


def rounded(x, digits: int = COMPARE_DIGITS) -> Column:
    return F.round(_c(x), digits)


# --- the same measures as SQL text (one JVM call per expression) -----------

def xl_sql(x: str) -> str:
    """SQL text for x * log2(x) with 0 log 0 = 0."""
    return f"(CASE WHEN {x} > 0 THEN CAST({x} AS DOUBLE) * LOG2({x}) ELSE 0D END)"


def sum_sql(terms) -> str:
    terms = list(terms)
    return "(" + " + ".join(terms) + ")" if terms else "0"
