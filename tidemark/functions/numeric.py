"""Rounding, money sums and small numeric helpers (all JVM-side column expressions)."""
from pyspark.sql import Column, functions as F

from ..fixed_values import NULL_WORDS


def _grid(x: Column, scale: float) -> Column:
    return F.rint(x * F.lit(scale)) / F.lit(scale) + F.lit(0.0)     # + 0.0 turns a negative zero into zero


def r2(x: Column) -> Column:
    return _grid(x, 100.0)


def r4(x: Column) -> Column:
    return _grid(x, 10000.0)


def r6(x: Column) -> Column:
    return _grid(x, 1000000.0)


def exact(x: Column) -> Column:
    """Money and share counts as decimals: sums no longer depend on the order of addition, so a
    recomputed task gives the same total."""
    return x.cast("decimal(28,4)")


def total(x: Column) -> Column:
    return F.coalesce(F.sum(exact(x)), F.lit(0)).cast("double")


def abs_value(val: Column) -> Column:
    return F.abs(F.coalesce(val, F.lit(0.0)))


def parse_number(text: Column) -> Column:
    """Commas, ``$`` and blanks stripped; null words, junk, NaN and infinities become NULL."""
    s = F.regexp_replace(F.trim(text), "[,$]", "")
    # a cast alone would also take Java's spellings, such as 1d, 5F and 0x1p3
    plain = s.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$")
    n = F.when(~F.upper(s).isin(NULL_WORDS) & plain, s).try_cast("double")
    return F.when(F.isnan(n) | (F.abs(n) == float("inf")), F.lit(None)).otherwise(n)


def trade_value(sh: Column, px: Column, total_value: Column | None = None) -> Column:
    """shares x price when both are reported, else the reported total (Table II), else unknown."""
    v = r2(sh * px)
    return v if total_value is None else F.coalesce(v, total_value)


def count_if(cond: Column) -> Column:
    return F.count(F.when(cond, F.lit(1)))
