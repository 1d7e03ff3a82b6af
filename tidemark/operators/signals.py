"""Purchases -> signals, and the account of every purchase row that did not become one."""
from pyspark.sql import DataFrame, functions as F

from .. import fixed_values as fv
from ..functions.calendar import since_year
from ..functions.labels import is_common_equity, normalize_ticker, valid_ticker
from ..functions.numeric import exact, r2, r4


def _ticker(mode):
    return normalize_ticker(F.col("tk")) if mode == "engine" else F.upper(F.trim(F.coalesce("tk", F.lit(""))))


def _equity(mode):
    return is_common_equity(F.col("sec"), "lenient", F.col("der")) if mode == "engine" else is_common_equity(F.col("sec"))


def qualifying_purchase(mode: str = "site"):
    """Code P, Table I, common equity, a ticker, and positive shares and price."""
    ticker_ok = valid_ticker(F.col("tk"), "engine") if mode == "engine" else _ticker(mode) != ""
    table_one = F.coalesce(F.col("der"), F.lit(0)) == 0
    return (F.col("code") == "P") & table_one & ticker_ok & (F.col("sh") > 0) & (F.col("px") > 0) & _equity(mode)


def candidate_signals(trades: DataFrame, mode: str = "site") -> DataFrame:
    """One row per (accession, ticker), volume-weighted, before value and ticker checks."""
    order = F.struct("pos", "td", "sh", "px")
    reported = F.col("val") if mode == "engine" else F.nullif(F.col("val"), F.lit(0.0))
    value = F.coalesce(reported, F.col("sh") * F.col("px"))
    rows = trades.where(qualifying_purchase(mode)).withColumn("tk", _ticker(mode))
    head = F.struct("form", "amend", "fd", "co", "icik", "pcik", "insider", "rel", "title")
    titled = F.coalesce("sec", F.lit("")) != ""
    g = rows.groupBy("acc", "tk").agg(
        F.min_by(head, order).alias("h"), F.min("td").alias("td"),
        F.coalesce(F.min_by("sec", F.when(titled, order)), F.lit("")).alias("sec"),
        F.sum(exact(F.col("sh"))).cast("double").alias("sh"), F.sum(exact(value)).cast("double").alias("v"),
        F.count(F.lit(1)).alias("lots"))
    return g.select(F.concat_ws(":", "acc", "tk").alias("id"), "acc", "tk", "h.*", "td", "sec",
                    r4(F.col("sh")).alias("insider_sh"), r2(F.col("v")).alias("insider_val"),
                    r4(F.col("v") / F.col("sh")).alias("insider_px"), "lots")


def min_value_filter(signals: DataFrame, minimum: float = fv.SITE_MIN_VALUE) -> DataFrame:
    return signals.where((F.col("insider_val") >= minimum) & (F.col("insider_sh") > 0))


def extract_signals(trades: DataFrame, mode: str = "site", minimum: float | None = None,
                    from_year: int | None = None) -> DataFrame:
    """Signals that may open a position."""
    if minimum is None:
        minimum = fv.ENGINE_MIN_VALUE if mode == "engine" else fv.SITE_MIN_VALUE
    if from_year:
        trades = trades.where(since_year(F.col("fd"), from_year))
    return min_value_filter(candidate_signals(trades, mode), minimum).where(valid_ticker(F.col("tk"), mode))


def purchase_reason(mode: str = "site"):
    """The one reason a code-P row did not reach a signal, or ``qualifying``."""
    shares_bad = ~F.coalesce(F.col("sh") > 0, F.lit(False))
    price_bad = ~F.coalesce(F.col("px") > 0, F.lit(False))
    out = (F.when(F.coalesce(F.col("der"), F.lit(0)) != 0, F.lit("derivative"))
           .when(F.upper(F.trim(F.coalesce("tk", F.lit("")))) == "", F.lit("no_ticker")))
    if mode == "engine":
        out = out.when(shares_bad | price_bad, F.lit("no_share_or_price"))
    else:
        out = out.when(shares_bad, F.lit("no_share_count")).when(price_bad, F.lit("no_price_reported"))
    return out.when(~_equity(mode), F.lit("not_common_equity")).otherwise(F.lit("qualifying"))


def signal_coverage(trades: DataFrame, mode: str = "site", minimum: float = fv.SITE_MIN_VALUE) -> DataFrame:
    """(level, reason, n): every code-P row once, then every candidate signal once."""
    rows = (trades.where("code = 'P'").groupBy(purchase_reason(mode).alias("reason"))
            .agg(F.count(F.lit(1)).alias("n")).select(F.lit("row").alias("level"), "reason", "n"))
    fate = (F.when((F.col("insider_sh") <= 0) | (F.col("insider_val") < minimum), F.lit("below_minimum_value"))
            .when(~valid_ticker(F.col("tk"), mode), F.lit("invalid_ticker")).otherwise(F.lit("signal")))
    signals = (candidate_signals(trades, mode).groupBy(fate.alias("reason"))
               .agg(F.count(F.lit(1)).alias("n")).select(F.lit("signal").alias("level"), "reason", "n"))
    return rows.unionByName(signals)
