"""Column-expression helpers.  All return JVM-side ``Column`` expressions, so
they stay inside whole-stage codegen; none of them is a UDF."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as K

# integers wide enough for money in cents times 10^scale at any table size
EXACT = "decimal(38,0)"


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def flag(predicate: Column) -> Column:
    """Boolean rule flag; an unknown (null) outcome counts as False."""
    return F.coalesce(predicate, F.lit(False))


def count_where(predicate: Column) -> Column:
    """Rows where the predicate is true, as BIGINT (nulls are not counted)."""
    return F.count_if(flag(predicate))


def idiv(num: Column, den: Column) -> Column:
    """Integral division (SQL ``div``); a zero divisor gives null."""
    return F.call_function("div", num, F.nullif(den, F.lit(0)))


def round_ratio(num: Column, den: Column, scale: int = 2) -> Column:
    """``num / den`` rounded half-up to ``scale`` decimals, as DOUBLE.

    Works on exact integers (counts, or money in cents), so the result does not
    depend on float summation order or on an engine's rounding of binary
    doubles; the final division by 10^scale is one correctly-rounded IEEE op.
    """
    p = 10**scale
    num = num.cast(EXACT)
    den = den.cast(EXACT)
    mag = idiv(F.abs(num) * F.lit(2 * p).cast(EXACT) + den, den * F.lit(2).cast(EXACT))
    return (F.signum(num).cast("long") * mag).cast("double") / p


def deviation(n: Column, total: Column, squares: Column) -> Column:
    """Sample standard deviation from the count, the sum and the sum of squares
    of integers.  With total = q n + r the squares about q are an exact
    integer, from which only r² / n, a fraction of a unit per row, is taken as
    a double; null below two values."""
    q = idiv(total, n).cast(EXACT)
    r = total.cast(EXACT) - q * n.cast(EXACT)
    about_q = squares.cast(EXACT) - q * (q * n.cast(EXACT) + F.lit(2).cast(EXACT) * r)
    rest = r.cast("double") * r.cast("double") / n.cast("double")
    return F.when(n > 1, F.sqrt(F.greatest((about_q.cast("double") - rest) / (n - 1).cast("double"), F.lit(0.0))))


def rate(num: Column, den: Column) -> Column:
    """Percentage ``round(num * 100 / den, 2)``; null when ``den`` is 0."""
    return round_ratio(num.cast(EXACT) * F.lit(100).cast(EXACT), den, 2)


def percent(num: Column, den: Column) -> Column:
    """Unrounded percentage as DOUBLE (dashboard measures)."""
    return num.cast("double") * 100.0 / F.nullif(den.cast("double"), F.lit(0.0))


def fraction(num: Column, den: Column) -> Column:
    return num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))


def cents(money: Column) -> Column:
    """Exact integer cents of a DECIMAL(·,2) money value."""
    return (money * 100).cast(EXACT)


def money(c: Column) -> Column:
    """Output form of a money value (DECIMAL inside, DOUBLE outside)."""
    return c.cast("double")


def to_crore(c: Column) -> Column:
    return c.cast("double") / K.CRORE


def initcap_trim(c: str | Column) -> Column:
    return F.initcap(F.trim(col_(c)))


def in_set(c: str | Column, values: Iterable) -> Column:
    return col_(c).isin(list(values))


def threshold_bucket(c: str | Column, cuts: Sequence[tuple], default: str) -> Column:
    """``when(c >= lo, label)...otherwise(default)``; cuts highest first."""
    c = col_(c)
    out = None
    for lo, label in cuts:
        out = F.when(c >= lo, label) if out is None else out.when(c >= lo, label)
    return out.otherwise(default)


def tenure_bucket(c: str | Column = "policy_tenure") -> Column:
    return threshold_bucket(c, K.TENURE_BUCKETS, K.TENURE_DEFAULT)


def premium_bucket(c: str | Column = "policy_premium") -> Column:
    c = col_(c)
    out = F.when(c > K.PREMIUM_VERY_HIGH_ABOVE, K.PREMIUM_VERY_HIGH)
    for lo, label in K.PREMIUM_BUCKETS:
        out = out.when(c >= lo, label)
    return out.otherwise(K.PREMIUM_DEFAULT)


def age_bucket(c: str | Column = "customer_age") -> Column:
    c = col_(c)
    out = F.when((c < K.MIN_VALID_AGE) | (c > K.MAX_VALID_AGE), K.AGE_UNREALISTIC)
    for lo, hi, label in K.AGE_BUCKETS:
        out = out.when((c >= lo) & (c <= hi), label)
    return out.when(c > K.AGE_ELDER_ABOVE, K.AGE_ELDER).otherwise(K.AGE_UNKNOWN)


def payment_frequency(c: str | Column = "avg_payment_gap") -> Column:
    c = col_(c)
    out = None
    for lo, hi, label in K.PAYMENT_FREQUENCIES:
        cond = (c >= lo) & (c <= hi)
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out.otherwise(K.IRREGULAR)


def date_lit(d) -> Column:
    return F.lit(str(d)).cast("date")
