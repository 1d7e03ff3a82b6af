"""Independent re-checks of published rows: one row per (id, check) with ``ok``."""
from pyspark.sql import DataFrame, functions as F

from .. import fixed_values as fv
from ..functions.links import filing_url_ok
from ..functions.numeric import count_if, r2, total

STAKE = fv.STAKE


def _near(a, b, tol):
    return F.coalesce(F.abs(a - b) <= tol, F.lit(False))


def _long(df, checks):
    """Checks are (name, applies, holds). One scan, no shuffle: the array is built and exploded per row."""
    items = [F.when(F.coalesce(applies, F.lit(False)),
                    F.struct(F.lit(name).alias("check"), F.coalesce(holds, F.lit(False)).alias("ok")))
             for name, applies, holds in checks]
    return df.select("id", F.explode(F.array(*items)).alias("x")).where("x IS NOT NULL").select("id", "x.*")


def verify_positions(positions: DataFrame) -> DataFrame:
    c = F.col
    is_open, flagged, review = c("status") == "open", c("split_flag"), c("roi_review") & c("roi_reported").isNotNull()
    days = F.date_diff(c("entry_d"), c("fd"))
    marked = is_open & ~review & c("last_px").isNotNull() & c("shares").isNotNull()
    eff = F.coalesce("shares_after_split", "shares")
    exited = is_open & c("exit_px").isNotNull() & c("entry_px").isNotNull()
    priced = is_open & (c("insider_px") != 0)
    mixed = is_open & flagged & (c("roi_status") == "mixed_pre_post_split")
    mark_tol = F.greatest(F.lit(0.05), eff * 1e-4, c("last_px") * 1e-4)     # published factors are rounded to 1e-4
    exit_tol = F.greatest(F.lit(0.05), c("shares") * 1e-4, c("exit_px") * 1e-4)
    checks = [
        ("open_has_verified_entry", is_open, c("entry_rule_status") == "verified"),
        ("entry_after_filing", is_open, c("entry_d") > c("fd")),
        ("entry_gap_1_to_10_days", is_open, days.between(1, fv.ENTRY_MAX_GAP_DAYS)),
        ("entry_is_weekday", is_open, F.weekday("entry_d") < 5),
        ("shares_match_stake", is_open & (c("entry_px") != 0), _near(c("shares"), STAKE / c("entry_px"), 0.01)),
        ("review_blanks_headline", is_open & review, c("roi").isNull() & c("mtm").isNull() & c("pnl").isNull()),
        ("mark_is_shares_times_price", marked, _near(c("mtm"), eff * c("last_px"), mark_tol)),
        ("pnl_is_mark_minus_stake", marked & c("mtm").isNotNull(), _near(c("pnl"), c("mtm") - STAKE, 0.05)),
        ("roi_is_mark_over_stake", marked & c("mtm").isNotNull(), _near(c("roi"), c("mtm") / STAKE - 1.0, 1e-4)),
        ("exit_after_entry", exited, c("exit_d") > c("entry_d")),
        ("exit_roi_is_price_ratio", exited, _near(c("exit_roi"), c("exit_px") / c("entry_px") - 1.0, 2e-4)),
        ("exit_pnl_is_shares_times_price", exited, _near(c("exit_pnl"), c("shares") * c("exit_px") - STAKE, exit_tol)),
        ("insider_price_is_value_over_shares", priced,
         _near(c("insider_px"), c("insider_val") / c("insider_sh"), F.greatest(F.lit(0.01), c("insider_px") * 1e-4))),
        ("gap_blank_when_split", priced & flagged, c("gap").isNull()),
        ("gap_is_entry_over_insider", priced & ~flagged, _near(c("gap"), c("entry_px") / c("insider_px") - 1.0, 1e-4)),
        ("split_has_status", is_open & flagged, c("roi_status").isin(
            "mixed_pre_post_split", "split_adjusted_series", "split_event_review")),
        ("mixed_has_adjusted_shares", mixed, c("shares_after_split").isNotNull()),
        ("mixed_roi_matches", mixed, _near(c("roi_corrected"), c("roi"), 1e-4)),
        ("filing_url_wellformed", is_open, filing_url_ok(c("filing_url"), c("acc"), c("icik"))),
        ("pending_has_no_entry", ~is_open, c("entry_px").isNull()),
    ]
    for n in fv.HORIZONS:
        r, d, px = c(f"r{n}"), c(f"r{n}_d"), c(f"r{n}_px")
        checks.append((f"r{n}_has_day_and_price", is_open & r.isNotNull(), d.isNotNull() & px.isNotNull()))
        checks.append((f"r{n}_is_price_ratio", is_open & r.isNotNull() & (c("entry_px") != 0),
                       _near(r, px / c("entry_px") - 1.0, 2e-4)))
    return _long(positions, checks)


def verify_backtest(book: DataFrame) -> DataFrame:
    c = F.col
    verified = c("entry_rule_status") == "verified"
    closed = c("exit_status").isin("exited_252", "exit_last_observed")
    return _long(book, [
        ("entry_after_filing", verified, c("entry_d") > c("fd")),
        ("entry_gap_1_to_10_days", verified, F.date_diff(c("entry_d"), c("fd")).between(1, fv.ENTRY_MAX_GAP_DAYS)),
        ("shares_match_stake", verified & (c("entry_px") != 0), _near(c("shares"), STAKE / c("entry_px"), 0.01)),
        ("filing_url_wellformed", verified, filing_url_ok(c("filing_url"), c("acc"), c("icik"))),
        ("unpriced_has_no_entry", ~verified, c("entry_px").isNull()),
        ("exit_after_entry", closed, c("exit_d") > c("entry_d")),
        ("exit_roi_is_price_ratio", closed, _near(c("exit_roi"), c("exit_px") / c("entry_px") - 1.0, 2e-4)),
    ])


def verify_activity(priced: DataFrame, holdings: DataFrame) -> DataFrame:
    """Overlap flags, and reported shares against the sum of the pair's holding groups."""
    sums = holdings.groupBy("owner", "issuer").agg(total(F.col("shares")).alias("held"))
    rows = priced.join(sums, ["owner", "issuer"], "left").withColumn("id", F.concat_ws(":", "owner", "issuer"))
    c = F.col
    return _long(rows, [
        ("overlap_consistent", F.lit(True), c("overlap") == ((c("buy_n") > 0) & (c("sell_n") > 0))),
        ("counts_add_up", F.lit(True), c("n") == c("buy_n") + c("sell_n") + c("other_n")),
        ("shares_match_holdings", c("reported_shares").isNotNull(), _near(c("reported_shares"), c("held"), 0.01)),
        ("value_is_shares_times_mark", c("holding_value").isNotNull(),
         _near(c("holding_value"), c("reported_shares") * c("mark_px"), 0.01)),
    ])


def verify_counts(checks: DataFrame) -> DataFrame:
    return checks.groupBy("check").agg(count_if(F.col("ok")).alias("passed"), count_if(~F.col("ok")).alias("failed"))


def verify_summary(positions: DataFrame, counts: DataFrame, capital: DataFrame) -> DataFrame:
    """Published totals against totals recomputed from the rows: (check, published, recomputed, ok)."""
    fresh = positions.agg(
        F.count(F.lit(1)).alias("signals"), count_if(F.col("status") == "open").alias("open"),
        count_if(F.col("status") == "no_price").alias("no_price"),
        r2(total(F.when((F.col("status") == "open") & F.col("roi").isNotNull() & ~F.col("split_flag"), F.col("mtm")))).alias("value"))
    names = ["signals", "open", "no_price", "value"]
    def unpivot(df, cols, side):
        items = F.array(*[F.struct(F.lit(n).alias("check"), F.col(n).cast("double").alias(side)) for n in cols])
        return df.select(F.explode(items).alias("x")).select("x.*")
    published = unpivot(counts, names[:3], "published").unionByName(unpivot(capital, names[3:], "published"))
    both = published.join(unpivot(fresh, names, "recomputed"), "check", "full")
    return both.withColumn("ok", F.coalesce(F.abs(F.col("published") - F.col("recomputed")) <= 0.01, F.lit(False)))


def backtest_reconciliation(book: DataFrame, signals: DataFrame) -> DataFrame:
    """Every signal is in the book exactly once, and every position is either verified or not."""
    n = signals.agg(F.count(F.lit(1))).scalar()
    verified = F.col("entry_rule_status") == "verified"
    return book.agg(F.count(F.lit(1)).alias("positions"), F.count_distinct("id").alias("ids"),
                    count_if(verified).alias("verified"), count_if(~verified).alias("unverified")
                    ).withColumn("signals", n)
