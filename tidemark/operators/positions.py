"""Signals + bars (+ splits) -> positions.

``entry_bars`` makes, from bars and split events alone, everything a follower who buys at a bar's open would
experience. Signals are read once: they meet their entry bar and their ticker's series, and the rest is
column arithmetic.
"""
from pyspark.sql import DataFrame, functions as F

from .. import fixed_values as fv
from ..functions.links import filing_url, history_url, second_history_url
from ..functions.numeric import r2, r4
from .asof import asof_keys, enrich_bars, entry_candidates
from .plan import settle
from .splits import classify_splits, event_outlook, position_split_status

STAKE = fv.STAKE


SPLIT = "struct<events:bigint,mixed:bigint,unclear:bigint,ratio:double,first_mixed:date>"


def entry_bars(bars: DataFrame, asof: str | None, splits: DataFrame | None = None) -> DataFrame:
    """(tk, d, bar, last): bars that can be bought, each with the outlook on the split events after its day.
    A ticker's events are few (the calendar bounds them), so they travel to its bars as one list."""
    enriched = enrich_bars(bars, asof)
    if splits is None:
        return entry_candidates(enriched.withColumn("split", F.lit(None).cast(SPLIT)))
    outlook = event_outlook(classify_splits(splits, enriched))
    events = outlook.groupBy("tk").agg(F.sort_array(F.collect_list(F.struct("d", "split"))).alias("events"))
    later = F.filter("events", lambda e: e["d"] > F.col("d"))
    return entry_candidates(enriched.join(events, "tk", "left").withColumn("split", F.get(later, F.lit(0))["split"]).drop("events"))


def with_entry(signals: DataFrame, bars: DataFrame, asof: str | None, splits: DataFrame | None = None) -> DataFrame:
    """``signals`` with ``bar`` (the entry session, NULL if there is none) and ``series`` (last day and close of the
    ticker, NULL without bars)."""
    candidates = entry_bars(bars, asof, splits)
    keys = signals.select("tk", F.col("fd").alias("d")).where("tk IS NOT NULL").distinct()
    # a signal without filing day has a series all the same
    last = F.when(F.col("last").isNotNull(), F.struct(F.col("last.d").alias("d"), F.col("last.c").alias("c")))
    known = [("series", F.max(last))]
    answers = asof_keys(keys, candidates, "bar", extra=known)
    answers = answers.select(F.col("tk").alias("_tk"), F.col("d").alias("_fd"), F.when(F.col("d").isNotNull(), F.col("bar")).alias("bar"), "series")
    on = (F.col("tk") == F.col("_tk")) & F.col("fd").eqNullSafe(F.col("_fd"))
    return signals.join(answers, on, "left").drop("_tk", "_fd")


def classify_position_status(bar, series, fd):
    """(status, entry_rule_status) of a signal against its series."""
    late = F.date_diff(bar["d"], fd) > fv.ENTRY_MAX_GAP_DAYS
    rule = (F.when(series.isNull(), F.lit("no_price"))
            .when(bar.isNull() & (series["d"] < fd), F.lit("no_bars_after_filing"))
            .when(bar.isNull(), F.lit("awaiting_entry"))
            .when(late, F.lit("entry_window_missing"))
            .otherwise(F.lit("verified")))
    status = (F.when(rule == "verified", F.lit("open")).when(rule == "awaiting_entry", F.lit("awaiting_entry"))
              .otherwise(F.lit("no_price")))
    return status, rule


def calendar_delays(fd, td, entry_d):
    return F.date_diff(fd, td).alias("delay_td_fd"), F.date_diff(entry_d, fd).alias("delay_fd_entry")


def _opened(j):
    """Signals with status and, where the entry rule is verified, everything the entry session knows."""
    status, rule = classify_position_status(F.col("bar"), F.col("series"), F.col("fd"))
    j = settle(j, status=status, entry_rule_status=rule)
    shown = F.col("status") == "open"
    bar, last, close = F.col("bar"), F.col("bar.last"), F.col("bar.last_close")
    def seen(c):
        return F.when(shown, c)
    horizon = {}
    for n in fv.HORIZONS:
        horizon[f"c{n}"], horizon[f"d{n}"] = seen(bar[f"c{n}"]), seen(bar[f"d{n}"])
    gap = F.when(F.col("entry_rule_status") == "entry_window_missing", F.date_diff(bar["d"], F.col("fd")))
    j = settle(j, entry_gap_days=gap, entry_d=seen(bar["d"]), epx=seen(bar["o"]), raw_shares=seen(F.lit(STAKE) / bar["o"]),
               lpx=seen(F.when(last["c"] > 0, last["c"])), last_seen=seen(last["d"]), sessions=seen(last["i"] - bar["i"]),
               kept_px=seen(F.when(close["i"] > bar["i"], close["c"])), kept_d=seen(close["d"]),
               next_jump=seen(bar["next_jump"]), crossed=seen(bar["split"]), stake=F.lit(STAKE), **horizon)
    return j.drop("bar", "series")


def _horizons(blank_from=None):
    """{name: column} for r1..r252 with their days and prices; ``blank_from``: NULL from that day on."""
    out = {}
    for n in fv.HORIZONS:
        px, day = F.col(f"c{n}"), F.col(f"d{n}")
        seen = px.isNotNull() & F.col("epx").isNotNull()
        if blank_from is not None:
            seen = seen & (blank_from.isNull() | (day < blank_from))
        out[f"r{n}"] = F.when(seen, r4(px / F.col("epx") - 1.0))
        out[f"r{n}_d"] = F.when(seen, day)
        out[f"r{n}_px"] = F.when(seen, r4(px))
    return out


def simulate_positions(signals: DataFrame, bars: DataFrame, asof: str | None = None,
                       splits: DataFrame | None = None) -> DataFrame:
    """The forward book: one stake per signal at the next session's open, marked at the last close.

    Splits are applied before the exit is valued, and a position whose share basis is doubtful keeps its
    observed numbers in ``*_reported`` while the headline columns go blank.
    """
    p = _opened(with_entry(signals, bars, asof, splits))
    status = position_split_status(F.col("crossed"))
    p = p.withColumns({"roi_status": status, "split_flag": F.col("crossed").isNotNull(),
                       "mixed": F.coalesce(status == "mixed_pre_post_split", F.lit(False)),
                       "hold": F.when(F.col("lpx").isNotNull(), F.col("sessions"))})
    p = adjust_for_splits(p)
    marked = {"mark": F.col("eff_shares") * F.col("lpx")}
    p = settle(p, **marked, **_horizons(F.when(F.col("mixed"), F.col("crossed.first_mixed"))))
    p = withhold_suspicious_returns(p)
    exited = F.col("r252_px").isNotNull()
    exit_value = F.col("raw_shares") * F.col("r252_px")
    gap = F.when(~F.col("split_flag") & (F.col("insider_px") != 0), r4(F.col("epx") / F.col("insider_px") - 1.0))
    delays = calendar_delays(F.col("fd"), F.col("td"), F.col("entry_d"))
    src = ["price_src"] if "price_src" in signals.columns else []
    has_mark = F.col("lpx").isNotNull()
    return p.select(
        "id", "acc", "tk", "form", "amend", "fd", "td", "co", "icik", "pcik", "insider", "rel", "title", "sec",
        "insider_sh", "insider_val", "insider_px", "lots", *src, "status", "entry_rule_status", "entry_gap_days",
        "stake", "entry_d", r4(F.col("epx")).alias("entry_px"), r4(F.col("raw_shares")).alias("shares"),
        F.when(has_mark, F.col("last_seen")).alias("last_d"), r4(F.col("lpx")).alias("last_px"), "mtm", "pnl", "roi",
        gap.alias("gap"), "hold", *delays, "split_flag", "roi_status",
        F.when(F.col("mixed") & has_mark, r4(F.col("eff_shares"))).alias("shares_after_split"),
        F.when(F.col("mixed"), F.col("roi_observed")).alias("roi_corrected"),
        "roi_review", "roi_reported", "pnl_reported",
        *[f"r{n}{tail}" for n in fv.HORIZONS for tail in ("", "_d", "_px")],
        F.when(exited, F.col("r252_d")).alias("exit_d"), F.col("r252_px").alias("exit_px"),
        r2(exit_value - STAKE).alias("exit_pnl"), F.col("r252").alias("exit_roi"),
        F.when(exited, F.lit("exited_252")).otherwise(F.lit("open")).alias("exit_status"),
        filing_url(F.col("acc"), F.col("icik")).alias("filing_url"), history_url(F.col("tk")).alias("history_url"),
        second_history_url(F.col("tk")).alias("second_history_url"))


def adjust_for_splits(p: DataFrame) -> DataFrame:
    """Shares on today's basis: divided by the price ratios of the mixed events since entry."""
    return p.withColumn("eff_shares", F.when(F.col("mixed"), F.col("raw_shares") / F.col("crossed.ratio"))
                        .otherwise(F.col("raw_shares")))


def withhold_suspicious_returns(p: DataFrame) -> DataFrame:
    """Adds mtm/pnl/roi, ``roi_review`` and the ``*_reported`` copies.

    Unclear split events keep their raw return but are marked for review. Without split metadata a price
    jump during the hold or an implausible return blanks the headline columns."""
    roi, pnl = F.col("roi_observed"), r2(F.col("mark") - STAKE)
    p = p.withColumn("roi_observed", r4(F.col("mark") / STAKE - 1.0))
    jumped = F.col("lpx").isNotNull() & (F.col("next_jump") <= F.col("last_seen"))
    wild = (((roi > 2.0) | (roi < -0.80)) & (F.col("hold") <= 90)) | (roi > 5.0)
    held_back = ~F.col("split_flag") & (F.coalesce(jumped, F.lit(False)) | F.coalesce(wild, F.lit(False)))
    p = settle(p, held_back=held_back)
    held, shown = F.col("held_back"), ~F.col("held_back")
    review = held | F.coalesce(F.col("roi_status") == "split_event_review", F.lit(False))
    return p.withColumns({
        "roi_review": review, "roi_reported": F.when(held, roi), "pnl_reported": F.when(held, pnl),
        "mtm": F.when(shown, r2(F.col("mark"))), "pnl": F.when(shown, pnl), "roi": F.when(shown, roi)})


def performance_factors(positions: DataFrame) -> DataFrame:
    """(id, factor, value, label): observed conditions of each position, never causes."""
    def item(name, cond, value=None, label=None):
        return F.when(cond, F.struct(F.lit(name).alias("factor"),
                                     (value if value is not None else F.lit(None)).cast("double").alias("value"),
                                     (label if label is not None else F.lit(None)).cast("string").alias("label")))
    gap = F.col("gap")
    items = F.array(
        item("entry_gap_vs_insider", gap.isNotNull(), gap),
        item("large_entry_gap_review", F.abs(gap) >= 0.30, gap),
        item("split_event_during_hold", F.col("split_flag"), None, F.col("roi_status")),
        item("observed_holding_sessions", F.col("hold").isNotNull(), F.col("hold")),
        item("entry_to_last_close_return", F.col("roi").isNotNull(), F.col("roi")),
        item("long_horizon_not_available", F.col("r252_d").isNull()))
    return positions.select("id", F.explode(items).alias("f")).where("f IS NOT NULL").select("id", "f.*")


def round_trip_backtest(signals: DataFrame, bars: DataFrame, asof: str, full_history: bool = True) -> DataFrame:
    """The historical book: exit at the +252-session close; a mature position whose complete series ended
    early leaves at its last close; everything else stays open."""
    p = _opened(with_entry(signals, bars, asof))
    day, c = F.lit(asof).cast("date"), F.col
    is_open = c("status") == "open"
    mature = F.date_diff(day, c("entry_d")) >= fv.MATURE_DAYS
    ended = (F.lit(full_history) & mature & (c("sessions") < fv.EXIT_SESSIONS) & (c("last_seen") < day)
             & c("kept_px").isNotNull())
    how = (F.when(~is_open, F.lit(None)).when(c("c252") > 0, F.lit("exited_252"))
           .when(ended, F.lit("exit_last_observed")).otherwise(F.lit("open")))
    p = settle(p, exit_status=how)
    at_252, at_last = c("exit_status") == "exited_252", c("exit_status") == "exit_last_observed"
    p = settle(p, xpx=F.when(at_252, c("c252")).when(at_last, c("kept_px")),
               exit_d=F.when(at_252, c("d252")).when(at_last, c("kept_d")),
               exit_sessions=F.when(at_252, F.lit(fv.EXIT_SESSIONS)).when(is_open, c("sessions")),
               roi_open=r4(c("raw_shares") * c("lpx") / STAKE - 1.0))
    p = settle(p, exit_roi=r4(c("raw_shares") * c("xpx") / STAKE - 1.0))
    wild = ((c("roi_open") > 2.0) | (c("roi_open") < -0.80)) & (c("sessions") <= 90)
    wild_exit = at_last & ((c("exit_roi") > 3.0) | (c("exit_roi") < -0.90))
    return p.select(
        "id", "acc", "tk", "fd", "td", "co", "icik", "insider", "rel", "title", "insider_sh", "insider_val",
        "insider_px", "stake", "status", "entry_rule_status", "entry_d", r4(c("epx")).alias("entry_px"),
        r4(c("raw_shares")).alias("shares"),
        F.when(c("insider_px") != 0, r4(c("epx") / c("insider_px") - 1.0)).alias("gap"),
        F.when(c("lpx").isNotNull(), c("last_seen")).alias("last_d"), r4(c("lpx")).alias("last_px"), "roi_open",
        r2(c("raw_shares") * c("lpx") - STAKE).alias("pnl_open"), "exit_status", "exit_d", r4(c("xpx")).alias("exit_px"),
        "exit_roi", r2(c("raw_shares") * c("xpx") - STAKE).alias("exit_pnl"), "exit_sessions",
        F.when(is_open, F.coalesce(wild, F.lit(False)) | F.coalesce(wild_exit, F.lit(False))).alias("roi_review"),
        filing_url(c("acc"), c("icik")).alias("filing_url"), history_url(c("tk")).alias("history_url"))


def price_source_counts(positions: DataFrame, src: str = "price_src") -> DataFrame:
    return positions.groupBy(F.coalesce(F.col(src), F.lit("none")).alias("source")).agg(F.count(F.lit(1)).alias("n"))


def ticker_sources(bars: DataFrame) -> DataFrame:
    """The source that supplies each ticker (after ``source_fallback`` there is exactly one)."""
    return bars.groupBy("tk").agg(F.min("src").alias("price_src"))
