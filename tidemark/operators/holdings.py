"""Reported holdings, their prices, and per-owner portfolios."""
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window as W

from .. import fixed_values as fv
from ..functions.labels import is_common_equity
from ..functions.links import filing_url
from ..functions.numeric import count_if, r2, r4, total
from .merge import keep_one
from .rollups import insider_issuer_activity, review_filings, with_pair


def reported_holdings(trades: DataFrame) -> DataFrame:
    """Latest held-after amount per (owner, issuer, security, directness, nature)."""
    rows = with_pair(trades).where((F.col("af") >= 0) & (F.coalesce("der", F.lit(0)) == 0)
                                   & is_common_equity(F.col("sec")))
    title = F.coalesce(F.nullif(F.trim("sec"), F.lit("")), F.lit("Common equity"))
    rows = (rows.withColumn("security", title).withColumn("hsec", F.lower(title))
            .withColumn("hdi", F.coalesce("di", F.lit("")))
            .withColumn("hnature", F.lower(F.trim(F.coalesce("nature", F.lit(""))))))
    newest = [F.desc_nulls_last("fd"), F.desc_nulls_last("td"), F.desc("acc"), F.desc("pos")]
    latest = keep_one(rows, ["owner", "issuer", "hsec", "hdi", "hnature"], newest)
    return latest.select("owner", "issuer", "security", "hsec", F.col("hdi").alias("di"), F.col("hnature").alias("nature"),
                         F.col("af").alias("shares"), "fd", "td", "acc", "icik",
                         filing_url(F.col("acc"), F.col("icik")).alias("url"))


def holdings_per_pair(holdings: DataFrame) -> DataFrame:
    newest = F.struct("fd", "td", "acc")
    return holdings.groupBy("owner", "issuer").agg(
        r4(total(F.col("shares"))).alias("reported_shares"), F.count(F.lit(1)).alias("holding_groups"),
        F.max("fd").alias("latest_holding_fd"), F.max_by("acc", newest).alias("latest_holding_acc"))


def price_holdings(activity: DataFrame, holdings: DataFrame, marks: DataFrame) -> DataFrame:
    """Activity with reported shares priced at the issuer's latest close; unpriced pairs stay.
    ``marks`` has one row per ticker; Spark broadcasts it only while its measured size allows."""
    m = marks.select(F.col("tk").alias("mark_tk"), "mark_d", "mark_px")
    joined = (activity.join(holdings_per_pair(holdings), ["owner", "issuer"], "left")
              .join(m, F.col("tk") == F.col("mark_tk"), "left").drop("mark_tk"))
    value = r2(F.col("reported_shares") * F.col("mark_px"))
    status = (F.when(F.col("reported_shares").isNull(), F.lit("no_reported_post_transaction_common_shares"))
              .when(value.isNull(), F.lit("shares_only_no_market_price")).otherwise(F.lit("priced")))
    return (joined.withColumn("holding_groups", F.coalesce("holding_groups", F.lit(0)))
            .withColumn("holding_value", value).withColumn("valuation_status", status))


def activity_summary(priced: DataFrame) -> DataFrame:
    return priced.agg(
        F.count(F.lit(1)).alias("pairs"), count_if(F.col("overlap")).alias("buy_sell_pairs"),
        count_if(F.col("reported_shares").isNotNull()).alias("with_reported_shares"),
        count_if(F.col("holding_value").isNotNull()).alias("with_priced_holdings"),
        r2(total(F.col("holding_value"))).alias("priced_value"))


def ranked_activity(priced: DataFrame) -> DataFrame:
    """Published order: pairs with both sides first, then the largest absolute net."""
    return priced.orderBy(F.desc("overlap"), F.desc(F.abs("net_v")), F.desc("n"), "insider", "owner", "issuer")


def insider_portfolio(priced: DataFrame) -> DataFrame:
    """Second-level roll-up: one row per owner over the issuers that owner filed against."""
    held, has_price = F.col("reported_shares").isNotNull(), F.col("holding_value").isNotNull()
    ordered = F.struct("last", "issuer")
    out = priced.groupBy("owner").agg(
        F.max_by("insider", ordered).alias("insider"),
        F.coalesce(F.min_by("rel", F.when(F.col("rel") != fv.NO_RELATIONSHIP, ordered)),
                   F.lit(fv.NO_RELATIONSHIP)).alias("rel"),
        F.coalesce(F.min_by("title", F.when(F.col("title") != "", ordered)), F.lit("")).alias("title"),
        count_if(held).alias("issuer_n"), r4(total(F.col("reported_shares"))).alias("reported_shares"),
        r2(total(F.col("holding_value"))).alias("priced_value"), count_if(has_price).alias("priced_issuer_n"),
        count_if(held & ~has_price).alias("unpriced_issuer_n"),
        F.sum("buy_n").alias("buy_n"), F.sum("sell_n").alias("sell_n"),
        r2(total(F.col("buy_v"))).alias("buy_v"), r2(total(F.col("sell_v"))).alias("sell_v"),
        F.bool_or("overlap").alias("overlap"), F.min("first").alias("first"), F.max("last").alias("last"))
    return out.withColumn("net_v", r2(F.col("buy_v") - F.col("sell_v")))


def portfolio_issuers(priced: DataFrame, limit: int | None = None) -> DataFrame:
    """The issuers under each owner, ranked by stake; optionally only the first ``limit`` of each."""
    w = W.partitionBy("owner").orderBy(F.desc(F.coalesce("holding_value", F.lit(-1.0))),
                                       F.desc(F.coalesce("reported_shares", F.lit(0.0))), "issuer")
    ranked = priced.withColumn("rank", F.row_number().over(w))
    return ((ranked.where(F.col("rank") <= limit) if limit else ranked)
            .select("owner", "rank", "issuer", "co", "tk", "icik", "n", "buy_n", "sell_n", "buy_v", "sell_v",
                    "reported_shares", "holding_value", "valuation_status", "latest_holding_fd",
                    filing_url(F.coalesce("latest_holding_acc", F.lit("")), F.col("icik")).alias("url")))


def portfolio_summary(portfolio: DataFrame) -> DataFrame:
    return portfolio.agg(
        F.count(F.lit(1)).alias("insiders"), count_if(F.col("issuer_n") > 1).alias("with_multiple_issuers"),
        count_if(F.col("priced_value") > 0).alias("with_priced_value"),
        r2(total(F.col("priced_value"))).alias("reported_value_priced"))


def publish_activity(trades: DataFrame, marks: DataFrame, links: int = fv.REVIEW_FILINGS) -> DataFrame:
    """Activity rows with their latest ``links`` review filings nested; ``review_filings`` has them all as rows."""
    priced = price_holdings(insider_issuer_activity(trades), reported_holdings(trades), marks)
    nested = (review_filings(trades, links).groupBy("owner", "issuer")
             .agg(F.array_sort(F.collect_list(F.struct("rank", "acc", "fd", "form", "amend", "url"))).alias("filings")))
    return priced.join(nested, ["owner", "issuer"], "left")
