"""Range joins by interval buckets, and bars of tickers that changed hands.

A day lies in an interval of its key if both fall into one calendar bucket and the exact bounds hold. Intervals are repeated
once per bucket they touch, days have one bucket each, so the join is an equi-join on (key, bucket) that Spark may broadcast,
shuffle or split when skewed; the bounds are a filter on its result.
"""
import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window as W

#: Days before the first and after the last bucket belong to those, so open ends lose nothing and touch at most
#: LAST_BUCKET + 1 buckets.
BUCKET_DAYS, FIRST_DAY, LAST_BUCKET = 366, dt.date(1980, 1, 1), 80
#: Between ticker and issuer in the key of a series; no ticker holds it.
_SEP = "\x1f"


def bucket(day: Column) -> Column:
    """The calendar bucket of a day; it never falls as days go on."""
    n = F.floor(F.datediff(day, F.lit(FIRST_DAY)) / BUCKET_DAYS)
    return F.greatest(F.lit(0), F.least(F.lit(LAST_BUCKET), n)).cast("int")


def in_interval(points: DataFrame, intervals: DataFrame, day: str, keys=("tk",), start: str = "from_d", end: str = "to_d",
                how: str = "inner") -> DataFrame:
    """``points`` with the other columns of each interval of equal ``keys`` and ``start`` <= ``day`` <= ``end``; a NULL bound is open.

    A point in several intervals comes once per interval, one in none not at all (``how`` = 'left': with NULLs). NULL keys and
    NULL days meet nothing, an interval that ends before it starts holds nothing."""
    first = F.when(F.col(start).isNull(), F.lit(0)).otherwise(bucket(F.col(start)))
    last = F.when(F.col(end).isNull(), F.lit(LAST_BUCKET)).otherwise(bucket(F.col(end)))
    usable = intervals.where(F.col(start).isNull() | F.col(end).isNull() | (F.col(start) <= F.col(end)))
    named = usable.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col(start).alias("_from"), F.col(end).alias("_to"),
                          *[c for c in intervals.columns if c not in {*keys, start, end}],
                          F.explode(F.sequence(first, last)).alias("_bucket"))
    hit = F.col(day).isNotNull() & (bucket(F.col(day)) == F.col("_bucket"))      # least() steps over a NULL
    for i, k in enumerate(keys):
        hit = hit & (F.col(k) == F.col(f"_k{i}"))
    inside = (F.col("_from").isNull() | (F.col("_from") <= F.col(day))) & (F.col("_to").isNull() | (F.col(day) <= F.col("_to")))
    return points.join(named, hit & inside, how).drop("_from", "_to", "_bucket", *[f"_k{i}" for i in range(len(keys))])


def merged_validity(validity: DataFrame) -> DataFrame:
    """(tk, icik, from_d, to_d) with overlapping, touching and repeated intervals of a ticker and issuer made one; rows without ticker or
    issuer, and those that end before they start, are left out."""
    low, high = F.expr("DATE '0001-01-01'"), F.expr("DATE '9999-12-30'")
    v = (validity.where("tk IS NOT NULL AND icik IS NOT NULL")
         .select("tk", "icik", F.coalesce("from_d", low).alias("a"), F.coalesce("to_d", high).alias("b")).where("a <= b"))
    run = W.partitionBy("tk", "icik").orderBy("a", "b")
    reach = F.max("b").over(run.rowsBetween(W.unboundedPreceding, -1))
    fresh = F.when(reach.isNull() | (F.col("a") > F.date_add(reach, 1)), 1).otherwise(0)
    island = v.withColumn("_new", fresh).withColumn("_island", F.sum("_new").over(run.rowsBetween(W.unboundedPreceding, W.currentRow)))
    ends = island.groupBy("tk", "icik", "_island").agg(F.min("a").alias("a"), F.max("b").alias("b"))
    return ends.select("tk", "icik", F.nullif("a", low).alias("from_d"), F.nullif("b", high).alias("to_d"))


def _listed(df: DataFrame, validity: DataFrame) -> DataFrame:
    """``df`` with ``_listed``: true where the ticker has validity intervals."""
    tickers = validity.where("tk IS NOT NULL AND icik IS NOT NULL").select("tk").distinct().withColumn("_listed", F.lit(True))
    return df.join(tickers, "tk", "left")


def _series(tk: Column, icik: Column) -> Column:
    return F.concat(tk, F.lit(_SEP), F.coalesce(icik, F.lit("")))


def issuer_bars(bars: DataFrame, validity: DataFrame) -> DataFrame:
    """Bars with the issuer (``icik``) that held the ticker on their day. Bars of tickers without any interval belong to all
    (NULL issuer); bars of other tickers in no interval belong to nobody and are left out; where intervals of two issuers overlap,
    each has the bar."""
    owned = in_interval(bars.drop("icik"), merged_validity(validity), "d", how="left")
    return _listed(owned, validity).where("_listed IS NULL OR icik IS NOT NULL").drop("_listed")


def per_issuer(lookup: Callable[[DataFrame, DataFrame], DataFrame], left: DataFrame, bars: DataFrame, validity: DataFrame) -> DataFrame:
    """``lookup(left, bars)`` of an as-of operator, in which each row of ``left`` (tk, icik) sees its own issuer's bars alone.

    ``lookup`` gets tickers with their issuer put behind them and has to return ``left``'s rows with ``tk``; tickers without
    intervals keep their whole series."""
    own = issuer_bars(bars, validity)
    series = own.withColumn("tk", F.when(F.col("icik").isNull(), F.col("tk")).otherwise(_series(F.col("tk"), F.col("icik")))).drop("icik")
    named = _listed(left, validity).withColumn("tk", F.when(F.col("_listed"), _series(F.col("tk"), F.col("icik"))).otherwise(F.col("tk")))
    return lookup(named.drop("_listed"), series).withColumn("tk", F.substring_index("tk", _SEP, 1))
