"""Distinct counts of any range of days from one small table of mergeable sketches.

Exact distinct counts of filings, insiders or issuers have to see every identifier again for each range that is asked for. Here a
day keeps a HyperLogLog sketch per counted identifier; the union of days' sketches stands for the union of their identifiers, so the count of
a month, a year or all time comes from the daily table alone. A sketch has a bounded size, is combined in the map tasks, and a hot day or
issuer costs no more than another. Estimates keep to the error bound; their last digits may change with the order in which sketches are united.
"""
from pyspark.sql import DataFrame, functions as F

from ..functions.labels import issuer_key, owner_key
from ..functions.numeric import abs_value, total

#: log2 of the registers of a sketch; the relative standard error is about 1.04 / sqrt(2 ** PRECISION), 1.6 percent at 12.
PRECISION = 12
COUNTED = ("filings", "insiders", "issuers")


def relative_error(precision: int = PRECISION, deviations: float = 3.0) -> float:
    """Bound on the relative error of an estimate, in standard deviations."""
    return deviations * 1.04 / 2 ** (precision / 2)


def daily_sketches(trades: DataFrame, by=(), precision: int = PRECISION) -> DataFrame:
    """Per filing day, and per ``by`` columns: ``n``, ``v`` and a sketch of each of ``COUNTED``. Blank identifiers are not counted;
    rows without a filing day are left out."""
    filing = F.nullif(F.trim("acc"), F.lit(""))
    keys = [filing, owner_key(F.col("pcik"), F.col("insider")), issuer_key(F.col("icik"), F.col("tk"), F.col("co"))]
    rows = trades.where("fd IS NOT NULL").select("fd", *by, abs_value(F.col("val")).alias("v"),
                                                 *[k.alias(c) for k, c in zip(keys, COUNTED)])
    return rows.groupBy("fd", *by).agg(F.count(F.lit(1)).alias("n"), total(F.col("v")).alias("v"),
                                       *[F.hll_sketch_agg(c, precision).alias(c) for c in COUNTED])


def merge_sketches(*tables: DataFrame, by=()) -> DataFrame:
    """One daily table from several, as of an older table and the rows that came since; what both saw counts once in the
    sketches, while ``n`` and ``v`` add up."""
    rows = tables[0]
    for t in tables[1:]:
        rows = rows.unionByName(t)
    return rows.groupBy("fd", *by).agg(F.sum("n").alias("n"), total(F.col("v")).alias("v"),
                                       *[F.hll_union_agg(c).alias(c) for c in COUNTED])


def approx_totals(daily: DataFrame, keys=(), start=None, end=None) -> DataFrame:
    """Rows, value and estimated distinct counts per ``keys`` (none: one row) of the days from ``start`` to ``end``, both included."""
    if start is not None:
        daily = daily.where(F.col("fd") >= F.lit(start).cast("date"))
    if end is not None:
        daily = daily.where(F.col("fd") <= F.lit(end).cast("date"))
    return daily.groupBy(*keys).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"), total(F.col("v")).alias("v"),
        *[F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(c)), F.lit(0)).alias(c) for c in COUNTED])
