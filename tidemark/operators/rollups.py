"""Aggregates over the trade table: totals, cuts, flows, issuers, insiders, insider x issuer pairs."""
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window as W

from .. import fixed_values as fv
from ..functions.calendar import in_year, month_key, since_year, year_key
from ..functions.labels import issuer_key, owner_key
from ..functions.numeric import abs_value, count_if, exact, r2, r4, total


def _buy():
    return F.col("code") == "P"


def _sell():
    return F.col("code") == "S"


def _v():
    return abs_value(F.col("val"))


def _blank(c):
    return F.nullif(F.trim(c), F.lit(""))


def _latest(value, known=None):
    """Name on the latest filing day (ties: last in text order), blank when there is none."""
    ok = F.col(value) != "" if known is None else known
    return F.coalesce(F.max_by(value, F.when(ok, F.struct("last", value))), F.lit(""))


def _earliest(value):
    return F.coalesce(F.min_by(value, F.when(F.col(value) != "", F.struct("first", value))), F.lit(""))


def activity_grain(trades: DataFrame) -> DataFrame:
    """The one pass behind every issuer and insider roll-up: counts, sums and date ranges per
    (owner, issuer) and the labels they were filed under.

    Labels are grouping keys and every measure has a fixed-width buffer, so the big scan is a hash
    aggregate combined map-side; picking the latest label happens later, on the far smaller result.
    """
    v, sh = exact(_v()), exact(F.coalesce("sh", F.lit(0.0)))
    text = lambda c: F.coalesce(F.trim(F.col(c)), F.lit("")).alias(c)
    keyed = trades.select(
        owner_key(F.col("pcik"), F.col("insider")).alias("owner"),
        issuer_key(F.col("icik"), F.col("tk"), F.col("co")).alias("issuer"),
        text("insider"), text("co"), F.upper(F.coalesce(F.trim("tk"), F.lit(""))).alias("tk"), text("icik"), text("rel"),
        text("title"), "code", "fd", v.alias("v"), sh.alias("sh"))
    other = F.coalesce(~(_buy() | _sell()), F.lit(True))
    return keyed.groupBy("owner", "issuer", "insider", "co", "tk", "icik", "rel", "title").agg(
        F.count(F.lit(1)).alias("n"), count_if(_buy()).alias("buy_n"), count_if(_sell()).alias("sell_n"),
        count_if(other).alias("other_n"), F.sum(F.when(_buy(), F.col("sh"))).alias("buy_sh"),
        F.sum(F.when(_sell(), F.col("sh"))).alias("sell_sh"), F.sum(F.when(_buy(), F.col("v"))).alias("buy_v"),
        F.sum(F.when(_sell(), F.col("v"))).alias("sell_v"), F.sum(F.when(other, F.col("v"))).alias("other_v"),
        F.sum("v").alias("val"), F.min("fd").alias("first"), F.max("fd").alias("last"),
        F.min(F.when(_buy(), F.col("fd"))).alias("first_buy"), F.max(F.when(_buy(), F.col("fd"))).alias("last_buy"),
        F.min(F.when(_sell(), F.col("fd"))).alias("first_sell"), F.max(F.when(_sell(), F.col("fd"))).alias("last_sell"))


def filing_window(trades: DataFrame, target_year: int | None = None, from_year: int | None = None) -> DataFrame:
    """Rows of one filing year, of a year onward, or all. The bounds on ``fd`` reach file statistics; on a table
    partitioned by filing year (``fy``) the same bound prunes folders."""
    stored = "fy" in trades.columns
    if target_year:
        return trades.where(in_year(F.col("fd"), target_year) & ((F.col("fy") == target_year) if stored else F.lit(True)))
    if from_year:
        return trades.where(since_year(F.col("fd"), from_year) & ((F.col("fy") >= from_year) if stored else F.lit(True)))
    return trades


def paper_window(trades: DataFrame, from_year: int | None) -> DataFrame:
    """Separate lower bound for rows that may become signals."""
    return filing_window(trades, from_year=from_year)


def global_totals(trades: DataFrame) -> DataFrame:
    v = _v()
    return trades.agg(
        F.count(F.lit(1)).alias("trades"), F.count_distinct(_blank(F.col("acc"))).alias("filings"),
        total(v).alias("total"), total(F.when(_buy(), v)).alias("buy"), total(F.when(_sell(), v)).alias("sell"),
        count_if(_buy()).alias("buys"), count_if(_sell()).alias("sells"),
        count_if(_blank(F.col("tk")).isNotNull()).alias("with_ticker"),
        count_if(F.col("px") != 0).alias("with_price"), count_if(F.col("px").isNotNull()).alias("with_reported_price"),
        count_if(F.col("der") != 0).alias("derivative"),
        F.min("fd").alias("first_fd"), F.max("fd").alias("last_fd"))


def _cut(trades, key, name):
    return trades.groupBy(key.alias(name)).agg(F.count(F.lit(1)).alias("n"), total(_v()).alias("v"))


def by_code(trades: DataFrame) -> DataFrame:
    return _cut(trades, F.coalesce(_blank(F.col("code")), F.lit("?")), "code")


def by_side(trades: DataFrame) -> DataFrame:
    return _cut(trades, F.coalesce(_blank(F.col("side")), F.lit("other")), "side")


def by_form(trades: DataFrame) -> DataFrame:
    return _cut(trades, F.coalesce(_blank(F.col("form")), F.lit("?")), "form")


def split_relationships(trades: DataFrame) -> DataFrame:
    return (trades.withColumn("relationship", F.explode(F.split(F.coalesce("rel", F.lit("")), "/")))
            .withColumn("relationship", F.trim("relationship")).where("relationship <> ''"))


def by_relationship(trades: DataFrame) -> DataFrame:
    return split_relationships(trades.select("rel")).groupBy("relationship").agg(F.count(F.lit(1)).alias("n"))


def by_security(trades: DataFrame, limit: int | None = None) -> DataFrame:
    cut = _cut(trades, F.coalesce(_blank(F.col("sec")), F.lit("(unspecified)")), "sec")
    return cut.orderBy(F.desc("n"), "sec").limit(limit) if limit else cut


def trade_cuts(trades: DataFrame) -> DataFrame:
    """The cuts by code, side, form, security and filing month in one scan and one shuffle: (cut, bucket, n, v). Rows without a
    filing day have no month. A group of the grouping sets belongs to the one column that it keeps."""
    keys = {"code": F.coalesce(_blank(F.col("code")), F.lit("?")), "side": F.coalesce(_blank(F.col("side")), F.lit("other")),
            "form": F.coalesce(_blank(F.col("form")), F.lit("?")), "sec": F.coalesce(_blank(F.col("sec")), F.lit("(unspecified)")),
            "month": month_key(F.col("fd"))}
    names = list(keys)
    rows = trades.select(*[c.alias(n) for n, c in keys.items()], exact(_v()).alias("v"))
    cut = F.coalesce(*[F.when(F.grouping(n) == 0, F.lit(n)) for n in names])
    sums = rows.groupingSets([[F.col(n)] for n in names], *[F.col(n) for n in names]).agg(
        cut.alias("cut"), F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("v"), F.lit(0)).cast("double").alias("v"))
    return sums.select("cut", F.coalesce(*names).alias("bucket"), "n", "v").where("bucket IS NOT NULL")


def code_share(trades: DataFrame) -> DataFrame:
    """Share of all rows per code: the window runs over the handful of grouped rows."""
    return by_code(trades).withColumn("pct", F.col("n") / F.sum("n").over(W.partitionBy()) * 100.0)


def _flow(trades, period):
    v = _v()
    return trades.where(F.col("fd").isNotNull()).groupBy(period).agg(
        F.count(F.lit(1)).alias("n"), count_if(_buy()).alias("buy_n"), count_if(_sell()).alias("sell_n"),
        total(F.when(_buy(), v)).alias("buy"), total(F.when(_sell(), v)).alias("sell"))


def monthly_flow(trades: DataFrame) -> DataFrame:
    return _flow(trades, month_key(F.col("fd")).alias("m"))


def yearly_flow(trades: DataFrame) -> DataFrame:
    return _flow(trades, year_key(F.col("fd")).alias("y"))


def daily_flow(trades: DataFrame, asof: str | None = None, days: int | None = None) -> DataFrame:
    """Per filing day with net; optionally only the last ``days`` before ``asof``."""
    if asof and days:
        trades = trades.where(F.col("fd") >= F.date_sub(F.lit(asof).cast("date"), days))
    return _flow(trades, F.col("fd").alias("d")).withColumn("net", F.col("buy") - F.col("sell"))


def _sum(name):
    return F.coalesce(F.sum(name), F.lit(0)).cast("double")


def _flows():
    net = F.coalesce(F.sum("buy_v"), F.lit(0)) - F.coalesce(F.sum("sell_v"), F.lit(0))
    return [*[F.sum(c).alias(c) for c in ("n", "buy_n", "sell_n")], r2(_sum("buy_v")).alias("buy_v"),
            r2(_sum("sell_v")).alias("sell_v"), r2(net.cast("double")).alias("net_v"), r2(_sum("val")).alias("val")]


def _known_relationship():
    return F.coalesce(F.nullif(_latest("rel", ~F.col("rel").isin("", fv.NO_RELATIONSHIP)), F.lit("")),
                      F.lit(fv.NO_RELATIONSHIP))


def company_summary(trades: DataFrame, filings: bool = True) -> DataFrame:
    """One row per issuer. ``filings`` adds the distinct filing count (a second, key-only aggregate)."""
    out = activity_grain(trades).where("issuer IS NOT NULL").groupBy("issuer").agg(
        _latest("co").alias("co"), _earliest("tk").alias("tk"), *_flows(),
        F.count_distinct(F.nullif(F.col("insider"), F.lit(""))).alias("insiders"),
        F.min("first").alias("first"), F.max("last").alias("last"))
    if not filings:
        return out
    key = issuer_key(F.col("icik"), F.col("tk"), F.col("co"))
    counts = (trades.select(key.alias("issuer"), _blank(F.col("acc")).alias("acc")).where("issuer IS NOT NULL").distinct()
              .groupBy("issuer").agg(F.count("acc").alias("filings")))
    return out.join(counts, "issuer")


def insider_summary(trades: DataFrame, limit: int | None = None) -> DataFrame:
    """One row per reporting owner; ``limit`` keeps the published list (most active first)."""
    company = F.when(F.col("co") != "", F.coalesce(F.nullif(F.col("tk"), F.lit("")), F.col("co")))
    out = activity_grain(trades).where("owner IS NOT NULL AND insider <> ''").groupBy("owner").agg(
        _latest("insider").alias("insider"), _known_relationship().alias("rel"), _earliest("title").alias("title"),
        *_flows(), F.count_distinct(company).alias("companies"),
        F.min("first").alias("first"), F.max("last").alias("last"))
    return out.orderBy(F.desc("n"), "owner").limit(limit) if limit else out


def net_buyers(companies: DataFrame, limit: int = fv.TOP_FLOW) -> DataFrame:
    return companies.where("net_v > 0").orderBy(F.desc("net_v"), "issuer").limit(limit)


def net_sellers(companies: DataFrame, limit: int = fv.TOP_FLOW) -> DataFrame:
    return companies.where("net_v < 0").orderBy("net_v", "issuer").limit(limit)


def top_purchasers(insiders: DataFrame, limit: int = fv.TOP_FLOW) -> DataFrame:
    return insiders.where("buy_v > 0").orderBy(F.desc("buy_v"), "owner").limit(limit)


def with_pair(trades: DataFrame) -> DataFrame:
    return (trades.withColumn("owner", owner_key(F.col("pcik"), F.col("insider")))
            .withColumn("issuer", issuer_key(F.col("icik"), F.col("tk"), F.col("co")))
            .where("owner IS NOT NULL AND issuer IS NOT NULL"))


def insider_issuer_activity(trades: DataFrame) -> DataFrame:
    """One row per (owner, issuer): counts, shares, values, dates per side and the overlap flag."""
    out = activity_grain(trades).where("owner IS NOT NULL AND issuer IS NOT NULL").groupBy("owner", "issuer").agg(
        _latest("insider").alias("insider"), _latest("co").alias("co"), _earliest("tk").alias("tk"),
        _earliest("icik").alias("icik"), _known_relationship().alias("rel"), _earliest("title").alias("title"),
        *[F.sum(c).alias(c) for c in ("n", "buy_n", "sell_n", "other_n")],
        *[r4(_sum(c)).alias(c) for c in ("buy_sh", "sell_sh")], *[_sum(c).alias(c) for c in ("buy_v", "sell_v", "other_v")],
        *[F.min(c).alias(c) for c in ("first", "first_buy", "first_sell")],
        *[F.max(c).alias(c) for c in ("last", "last_buy", "last_sell")])
    return (out.withColumn("net_v", r2(F.col("buy_v") - F.col("sell_v")))
            .withColumn("overlap", (F.col("buy_n") > 0) & (F.col("sell_n") > 0)))


def review_filings(trades: DataFrame, limit: int | None = None) -> DataFrame:
    """Filings of each pair from the latest on, one row per filing; optionally only the first ``limit``."""
    from ..functions.links import filing_url
    filings = (with_pair(trades).where("acc <> ''").groupBy("owner", "issuer", "acc")
               .agg(F.max("fd").alias("fd"), F.max("icik").alias("icik"), F.max("form").alias("form"),
                    F.max("amend").alias("amend")))
    w = W.partitionBy("owner", "issuer").orderBy(F.desc("fd"), F.desc("acc"))
    ranked = filings.withColumn("rank", F.row_number().over(w))
    return ((ranked.where(F.col("rank") <= limit) if limit else ranked)
            .withColumn("url", filing_url(F.col("acc"), F.col("icik"))))


def recent_rows(trades: DataFrame, keys, limit: int) -> DataFrame:
    """Latest ``limit`` rows per key; the window group limit trims each map task to ``limit`` first."""
    w = W.partitionBy(*keys).orderBy(F.desc_nulls_last("fd"), F.desc_nulls_last("td"), F.desc("acc"), F.desc("pos"))
    return trades.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= limit)


def recent_per_company(trades: DataFrame, limit: int = fv.RECENT_PER_ISSUER) -> DataFrame:
    key = issuer_key(F.col("icik"), F.col("tk"), F.col("co"))
    return recent_rows(trades.withColumn("issuer", key).where("issuer IS NOT NULL"), ["issuer"], limit)


def recent_per_pair(trades: DataFrame, limit: int = fv.RECENT_PER_PAIR) -> DataFrame:
    return recent_rows(with_pair(trades), ["owner", "issuer"], limit)


def recent_tape(trades: DataFrame, asof: str, days: int = fv.TAPE_DAYS, limit: int | None = None) -> DataFrame:
    """Rows filed in the last ``days``, all rows when there are none; optionally only the latest ``limit``."""
    cut = F.date_sub(F.lit(asof).cast("date"), days)
    newest = trades.agg(F.max("fd").alias("newest")).scalar()
    keep = F.when(newest >= cut, F.coalesce(F.col("fd") >= cut, F.lit(False))).otherwise(F.lit(True))
    rows = trades.where(keep)
    return rows.orderBy(F.desc_nulls_last("fd"), F.desc_nulls_last("td"), F.desc("acc"), F.desc("pos")).limit(limit) if limit else rows
