"""Dates: filing-date spellings, periods, weekday arithmetic."""
from pyspark.sql import Column, functions as F

def parse_sec_date(text: Column) -> Column:
    """``15-AUG-2025``, ``2025-08-15...`` and ``15-AUG-2025 00:00:00`` become dates, anything else NULL."""
    s = F.trim(text)
    named = r"^(\d{1,2})-([A-Za-z]{3})-(\d{4})(\s.*)?$"
    spelled = F.concat_ws("-", F.regexp_extract(s, named, 1), F.initcap(F.regexp_extract(s, named, 2)), F.regexp_extract(s, named, 3))
    iso = F.regexp_extract(s, r"^(\d{4}-\d{2}-\d{2})", 1)
    return F.when(s.rlike(named), F.try_to_timestamp(spelled, F.lit("d-MMM-yyyy")).cast("date")).otherwise(iso.try_cast("date"))


def compact_date(text: Column) -> Column:
    """``20250815`` or an ISO date (only its first ten characters count)."""
    s = F.trim(text)
    dashed = F.concat_ws("-", F.substring(s, 1, 4), F.substring(s, 5, 2), F.substring(s, 7, 2))
    return F.when(s.rlike(r"^\d{8}$"), dashed).otherwise(F.substring(s, 1, 10)).try_cast("date")


def month_key(d: Column) -> Column:
    return F.date_format(d, "yyyy-MM")


def year_key(d: Column) -> Column:
    return F.date_format(d, "yyyy")


def in_year(d: Column, year: int) -> Column:
    """``d`` falls in ``year``, as bounds that reach the scan's statistics (``year(d) = ...`` does not)."""
    return (d >= F.lit(f"{year:04d}-01-01").cast("date")) & (d < F.lit(f"{year + 1:04d}-01-01").cast("date"))


def since_year(d: Column, year: int) -> Column:
    return d >= F.lit(f"{year:04d}-01-01").cast("date")


def is_weekday(d: Column) -> Column:
    return F.weekday(d) < 5


def _weekdays_through(d: Column) -> Column:
    """Weekdays from Monday 1970-01-05 through ``d``, in closed form."""
    n = F.datediff(d, F.lit("1970-01-04").cast("date"))          # 1 on that Monday
    week = F.floor(n / 7)
    return week * 5 + F.least(n - week * 7, F.lit(5))


def business_days_between(start: Column, end: Column) -> Column:
    """Weekdays after ``start`` up to and including ``end``; 0 when ``end`` is not later."""
    return F.when(end <= start, F.lit(0)).otherwise(
        (_weekdays_through(end) - _weekdays_through(start)).cast("int"))


def next_weekday(d: Column) -> Column:
    """``d`` itself on a weekday, else the Monday after it."""
    return F.when(F.weekday(d) >= 5, F.date_add(d, 7 - F.weekday(d))).otherwise(d)


def first_business_day(year: int) -> str:
    import datetime as dt
    day = dt.date(year, 1, 1)
    while day.weekday() > 4:
        day += dt.timedelta(days=1)
    return day.isoformat()


def last_business_day(year: int, asof: str) -> str:
    import datetime as dt
    day = min(dt.date.fromisoformat(asof) - dt.timedelta(days=1), dt.date(year, 12, 31))
    while day.weekday() > 4:
        day -= dt.timedelta(days=1)
    return day.isoformat()
