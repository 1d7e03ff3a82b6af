"""Review flags.

Every flag kind has a *members* function (the trade rows behind its flags, each with a ``flag_key``) and a
*flag* function (one row per flag). Flags carry counts, totals and date ranges; the lists behind them
(filings, insiders, evidence) stay long tables, so a flag over a third of the data is still one small row.
"""
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window as W

from .. import fixed_values as fv
from ..functions.labels import issuer_key, owner_key
from ..functions.links import evidence_text, filing_url, money_text, shares_text
from ..functions.numeric import abs_value, count_if, exact, r2, r4
from .merge import dedupe_flags


def _code():
    return F.upper(F.substring(F.coalesce("code", F.lit("")), 1, 1))


def _table_one():
    return F.coalesce("der", F.lit(0)) == 0


def _owner():
    return F.coalesce(owner_key(F.col("pcik"), F.col("insider")), F.lit(""))


def _issuer():
    return F.coalesce(issuer_key(F.col("icik"), F.col("tk"), F.col("co")), F.lit(""))


def _key(kind, *parts):
    parts = [F.lit(kind)] + [F.coalesce((F.col(p) if isinstance(p, str) else p).cast("string"), F.lit("")) for p in parts]
    return F.concat_ws("|", *parts)


def _span(lo, hi):
    return F.when(lo.isNull(), F.lit("")).when(lo == hi, lo.cast("string")).otherwise(
        F.concat(lo.cast("string"), F.lit(" to "), hi.cast("string")))


_MEASURES = ["total_shares", "total_value", "row_n", "filing_n", "insider_n", "ticker_n", "buy_value", "sell_value",
             "sale_rows", "exercise_rows"]


def flag_item(members: DataFrame) -> DataFrame:
    """One row per ``flag_key`` with the common shape.

    First a hash aggregate per (flag, filing, owner, issuer) with fixed-width sums and day ranges, combined
    map-side; the distinct counts and the filing fingerprint then see one row per such group, spread over
    the filings, so a hot flag is not a hot task.
    """
    v, sh = exact(abs_value(F.col("val"))), exact(F.abs(F.coalesce("sh", F.lit(0.0))))
    blank = F.lit("")
    text = lambda c: F.nullif(F.col(c), blank).alias(c)
    keyed = members.select("flag_key", "kind", text("acc"), text("tk"), text("co"), text("icik"), _owner().alias("who"),
                           _code().alias("c"), (~_table_one()).alias("two"), "fd", "td", v.alias("v"), sh.alias("s"))
    c = F.col("c")
    part = keyed.groupBy("flag_key", "kind", "acc", "tk", "co", "icik", "who").agg(
        F.sum("s").alias("s"), F.sum("v").alias("v"), F.count(F.lit(1)).alias("n"), F.min("fd").alias("f0"),
        F.max("fd").alias("f1"), F.min("td").alias("t0"), F.max("td").alias("t1"),
        F.sum(F.when(c == "P", F.col("v"))).alias("bv"), F.sum(F.when(c == "S", F.col("v"))).alias("sv"),
        count_if(c == "S").alias("sn"), count_if(F.col("two") | c.isin("M", "C", "X", "O")).alias("en"))
    def value(name):
        return F.coalesce(F.sum(name), F.lit(0)).cast("double")
    g = part.groupBy("flag_key", "kind").agg(
        F.min("tk").alias("tk"), F.min("co").alias("co"), F.min("icik").alias("i0"), F.max("icik").alias("i1"),
        F.min("f0").alias("f0"), F.max("f1").alias("f1"), F.min("t0").alias("t0"), F.max("t1").alias("t1"),
        r4(value("s")).alias("total_shares"), r2(value("v")).alias("total_value"), F.sum("n").alias("row_n"),
        F.count_distinct("acc").alias("filing_n"), F.count_distinct("who").alias("insider_n"),
        F.count_distinct("tk").alias("ticker_n"),
        F.sum_distinct(F.xxhash64("acc").cast("decimal(38,0)")).alias("filing_set"),
        r2(value("bv")).alias("buy_value"), r2(value("sv")).alias("sell_value"), F.sum("sn").alias("sale_rows"),
        F.sum("en").alias("exercise_rows"))
    kinds = list(fv.FLAG_KINDS.items())
    def named(i):
        return F.create_map(*[F.lit(x) for k, t in kinds for x in (k, t[i])])[F.col("kind")]
    return g.select("flag_key", "kind", named(0).alias("category"), named(1).alias("severity"),
                    F.coalesce("tk", blank).alias("tk"), F.coalesce("co", blank).alias("co"),
                    F.when(F.col("i0") == F.col("i1"), F.col("i0")).otherwise(blank).alias("icik"),
                    _span(F.col("f0"), F.col("f1")).alias("fd_text"), _span(F.col("t0"), F.col("t1")).alias("td_text"),
                    *_MEASURES, "filing_set")


def _said(items, summary):
    return items.withColumn("summary", summary)


# ------------------------------------------------------------------ trade flags


def members_large(trades: DataFrame, minimum: float = fv.LARGE_VALUE) -> DataFrame:
    kind = F.when(_code() == "P", F.lit("large_purchase")).otherwise(F.lit("large_sale"))
    return (trades.where(_code().isin("P", "S") & (abs_value(F.col("val")) >= minimum))
            .withColumn("kind", kind).withColumn("flag_key", F.concat_ws("|", "kind", "acc")))


def flag_large_transactions(trades: DataFrame, minimum: float = fv.LARGE_VALUE) -> DataFrame:
    side = F.when(F.col("kind") == "large_purchase", F.lit("purchases")).otherwise(F.lit("sales"))
    return _said(flag_item(members_large(trades, minimum)),
                 F.concat(F.lit("Large "), side, F.lit(" in one filing total "), money_text(F.col("total_value")), F.lit(".")))


def cluster_buys(trades: DataFrame, minimum: float = fv.CLUSTER_MIN_VALUE, days: int = fv.CLUSTER_DAYS) -> DataFrame:
    """Per issuer the best ``days``-day forward window of purchases with at least two insiders:
    (issuer, start_d, end_d, window_value).

    Rows are summed per (issuer, day) first, so the RANGE frame sees at most one row per calendar day. "At
    least two insiders" needs no set: the smallest and largest owner key in the frame differ.
    """
    rows = _cluster_rows(trades)
    owner = _owner()
    daily = rows.groupBy("issuer", "day").agg(
        F.sum(abs_value(F.col("val")).cast("decimal(28,4)")).alias("v"), F.min(owner).alias("a"), F.max(owner).alias("z"))
    number = F.datediff("day", F.lit("1970-01-01").cast("date"))
    frame = W.partitionBy("issuer").orderBy("number").rangeBetween(0, days)
    windows = (daily.withColumn("number", number).withColumn("wv", F.sum("v").over(frame))
               .withColumn("wa", F.min("a").over(frame)).withColumn("wz", F.max("z").over(frame))
               .where((F.col("wa") != F.col("wz")) & (F.col("wv") >= minimum)))
    best = W.partitionBy("issuer").orderBy(F.desc("wv"), "day")
    return (windows.withColumn("_n", F.row_number().over(best)).where("_n = 1")
            .select("issuer", F.col("day").alias("start_d"), F.date_add("day", days).alias("end_d"),
                    r2(F.col("wv").cast("double")).alias("window_value")))


def _cluster_rows(trades):
    return (trades.where((_code() == "P") & _table_one()).withColumn("issuer", _issuer())
            .withColumn("day", F.coalesce("td", "fd")).where("day IS NOT NULL"))


def members_cluster(trades: DataFrame, minimum: float = fv.CLUSTER_MIN_VALUE, days: int = fv.CLUSTER_DAYS) -> DataFrame:
    best = cluster_buys(trades, minimum, days)
    rows = _cluster_rows(trades).join(best, "issuer").where(F.col("day").between(F.col("start_d"), F.col("end_d")))
    return (rows.withColumn("kind", F.lit("cluster")).withColumn("flag_key", _key("cluster", "issuer"))
            .drop("issuer", "day", "start_d", "end_d", "window_value"))


def flag_cluster_buys(trades: DataFrame, minimum: float = fv.CLUSTER_MIN_VALUE) -> DataFrame:
    return _said(flag_item(members_cluster(trades, minimum)),
                 F.concat(F.col("insider_n").cast("string"), F.lit(" insiders bought within a week for "),
                          money_text(F.col("total_value")), F.lit(".")))


def members_synchronized_sales(trades: DataFrame) -> DataFrame:
    rows = trades.where((_code() == "S") & _table_one() & F.col("td").isNotNull()).withColumn("kind", F.lit("sync_sales"))
    return rows.withColumn("flag_key", _key("sync_sales", _issuer(), "td"))


def flag_synchronized_sales(trades: DataFrame, minimum: float = fv.SYNC_SALE_MIN_VALUE) -> DataFrame:
    items = flag_item(members_synchronized_sales(trades)).where((F.col("insider_n") >= 2) & (F.col("total_value") >= minimum))
    return _said(items, F.concat(F.col("insider_n").cast("string"), F.lit(" insiders sold on the same day for "),
                                 money_text(F.col("total_value")), F.lit(".")))


def members_exercise_then_sale(trades: DataFrame) -> DataFrame:
    """All rows of the filings that hold both; the filings are found with two booleans per accession
    before any wider aggregate runs."""
    rows = trades.where(F.coalesce("acc", F.lit("")) != "")
    exercise = ~_table_one() | _code().isin("M", "C", "X", "O")
    both = rows.groupBy("acc").agg(F.bool_or(exercise).alias("e"), F.bool_or(_code() == "S").alias("s")).where("e AND s")
    rows = rows.join(both.select("acc"), "acc", "left_semi").withColumn("kind", F.lit("exercise_sale"))
    return rows.withColumn("flag_key", _key("exercise_sale", "acc"))


def flag_exercise_then_sale(trades: DataFrame) -> DataFrame:
    items = flag_item(members_exercise_then_sale(trades))
    return _said(items, F.concat(F.lit("Exercise or conversion with same-filing sales of "),
                                 money_text(F.col("sell_value")), F.lit(".")))


def members_buy_sell_overlap(trades: DataFrame) -> DataFrame:
    rows = trades.where(_code().isin("P", "S") & _table_one() & (_owner() != "") & (_issuer() != ""))
    return rows.withColumn("kind", F.lit("overlap")).withColumn("flag_key", _key("overlap", _owner(), _issuer()))


def flag_buy_sell_overlap(trades: DataFrame, minimum: float = fv.OVERLAP_MIN_VALUE) -> DataFrame:
    items = flag_item(members_buy_sell_overlap(trades)).where(
        (F.col("sale_rows") > 0) & (F.col("sale_rows") < F.col("row_n"))
        & (F.greatest("buy_value", "sell_value") >= minimum))
    return _said(items, F.concat(F.lit("Same insider bought "), money_text(F.col("buy_value")), F.lit(" and sold "),
                                 money_text(F.col("sell_value")), F.lit(" of the same issuer.")))


def members_large_noncash(trades: DataFrame, minimum: float = fv.LARGE_NONCASH_SHARES) -> DataFrame:
    kind = F.when(_code() == "G", F.lit("noncash_gift")).otherwise(F.lit("noncash"))
    return (trades.where(_code().isin("G", "A", "J") & (F.coalesce("val", F.lit(0.0)) == 0) & (F.abs("sh") >= minimum))
            .withColumn("kind", kind).withColumn("flag_key", _key("noncash", "acc", "icik", "pos")))


def flag_large_noncash(trades: DataFrame, minimum: float = fv.LARGE_NONCASH_SHARES) -> DataFrame:
    return _said(flag_item(members_large_noncash(trades, minimum)),
                 F.concat(F.lit("Row reports "), shares_text(F.col("total_shares")), F.lit(" shares without a cash value.")))


# ------------------------------------------------------------------ position flags


def _position_members(positions: DataFrame, kind: str, cond) -> DataFrame:
    return positions.where(F.coalesce((F.col("status") == "open") & cond, F.lit(False))).select(
        _key(kind, "id").alias("flag_key"), F.lit(kind).alias("kind"), "acc", "icik", "fd", "td", "tk", "co", "pcik",
        "insider", F.lit("P").alias("code"), F.lit(0).alias("der"), F.col("insider_sh").alias("sh"),
        F.col("insider_px").alias("px"), F.col("insider_val").alias("val"), F.lit(0).cast("long").alias("pos"))


def members_price_gap(positions: DataFrame) -> DataFrame:
    return _position_members(positions, "price_gap", F.abs("gap") >= 1.0)


def members_split_straddle(positions: DataFrame) -> DataFrame:
    roi = F.when(F.col("roi_review"), F.coalesce("roi_reported", "roi")).otherwise(F.col("roi"))
    extreme = F.col("roi_review") | ((roi > 2.0) & (F.coalesce("hold", F.lit(9999)) <= 90)) | (roi > 5.0)
    return _position_members(positions, "straddle", roi.isNotNull() & extreme)


def members_unsupported_mark(positions: DataFrame) -> DataFrame:
    return _position_members(positions, "unsupported_mark", F.col("entry_px").isNotNull() & F.col("r1").isNull()
                             & (F.coalesce("hold", F.lit(0)) == 0))


def flag_price_gap(positions: DataFrame) -> DataFrame:
    return _said(flag_item(members_price_gap(positions)),
                 F.concat(F.col("tk"), F.lit(": entry open is far from the price the insider reported.")))


def flag_split_straddle(positions: DataFrame) -> DataFrame:
    return _said(flag_item(members_split_straddle(positions)),
                 F.concat(F.col("tk"), F.lit(": return is implausible without a corporate action.")))


def flag_unsupported_mark(positions: DataFrame) -> DataFrame:
    return _said(flag_item(members_unsupported_mark(positions)),
                 F.concat(F.col("tk"), F.lit(": no session after entry supports the mark.")))


# ------------------------------------------------------------------ data-quality flags


def flag_data_quality(coverage: DataFrame, issue_counts: DataFrame, limit: int | None = None) -> DataFrame:
    """A coverage flag when the report has blockers, and one per issue code (or only the ``limit`` most frequent)."""
    category, severity = fv.FLAG_KINDS["coverage_gap"]
    gap = coverage.where("NOT complete").select(
        F.lit("coverage_gap").alias("flag_key"), F.lit(category).alias("category"), F.lit(severity).alias("severity"),
        F.col("target_rows").alias("row_n"), F.concat(F.lit("Coverage is not proven: "), F.col("blockers")).alias("summary"))
    worst = F.when(F.bool_or(F.col("severity") == "high"), F.lit("High")).when(
        F.bool_or(F.col("severity") == "low"), F.lit("Low")).otherwise(F.lit("Medium"))
    per_code = issue_counts.groupBy("issue").agg(F.sum("n").alias("row_n"), worst.alias("severity"))
    if limit:
        per_code = per_code.orderBy(F.desc("row_n"), "issue").limit(limit)
    codes = per_code.select(
        F.concat_ws("|", F.lit("row_issue"), "issue").alias("flag_key"),
        F.concat(F.lit(fv.FLAG_KINDS["row_issue"][0]), F.col("issue")).alias("category"), "severity", "row_n",
        F.concat(F.format_number("row_n", 0), F.lit(" rows fail the check "), F.col("issue"), F.lit(".")).alias("summary"))
    return gap.unionByName(codes)


# ------------------------------------------------------------------ published lists


def all_flags(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return dedupe_flags(out)


def top_flags(flags: DataFrame, limit: int = fv.FLAG_ROWS) -> DataFrame:
    """Severity, then value, category and ticker; numbered after the list is cut to its published length."""
    rank = F.array_position(F.array(*[F.lit(s) for s in fv.SEVERITIES]), F.col("severity"))
    order = ["rank", F.desc(F.coalesce("total_value", F.lit(0.0))), "category", "tk", "flag_key"]
    top = flags.withColumn("rank", rank).orderBy(*order).limit(limit)
    number = F.row_number().over(W.partitionBy().orderBy(*order))            # at most ``limit`` rows
    return top.withColumn("id", F.format_string("AUTO-%04d", number)).drop("rank")


def flag_evidence(flags: DataFrame, members: DataFrame, limit: int | None = None) -> DataFrame:
    """The evidence lines of each flag, numbered in filing order; optionally only the first ``limit``."""
    rows = members.join(flags.select("flag_key"), "flag_key", "left_semi")
    w = W.partitionBy("flag_key").orderBy("fd", "td", "acc", "pos", "icik")
    numbered = rows.withColumn("line", F.row_number().over(w))
    return ((numbered.where(F.col("line") <= limit) if limit else numbered)
            .select("flag_key", "line", evidence_text(F.col).alias("evidence")))


def flag_filings(flags: DataFrame, members: DataFrame) -> DataFrame:
    """Every filing behind a flag, one row each."""
    rows = members.join(flags.select("flag_key"), "flag_key", "left_semi").where("acc <> ''")
    g = rows.groupBy("flag_key", "acc").agg(F.max("icik").alias("icik"))
    return g.withColumn("url", filing_url(F.col("acc"), F.col("icik")))


def flag_parties(flags: DataFrame, members: DataFrame) -> DataFrame:
    """Every insider, ticker and company behind a flag, one row each: (flag_key, party, name, row_n)."""
    rows = members.join(flags.select("flag_key"), "flag_key", "left_semi")
    names = (("insider", F.col("insider")), ("ticker", F.col("tk")), ("company", F.col("co")))
    listed = F.inline(F.array(*[F.struct(F.lit(kind).alias("party"), c.alias("name")) for kind, c in names]))
    return rows.select("flag_key", listed).where("name <> ''").groupBy("flag_key", "party", "name").agg(F.count(F.lit(1)).alias("row_n"))
