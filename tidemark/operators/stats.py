"""Distribution statistics, capital, curves, findings.

Returns are published on a 1e-4 grid, so a bucket's distribution is its histogram on that grid: one
map-side-combining aggregate. Exact order statistics come from running counts over the histogram. What one
task sees of a bucket is bounded by the grid between its smallest and largest return (1e4 steps per 100%),
not by the number of positions.
"""
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window as W

from .. import fixed_values as fv
from ..functions.calendar import is_weekday, month_key, next_weekday
from ..functions.labels import role_bucket, size_bucket
from ..functions.numeric import count_if, r2, r4, total
from ..session import materialize
from .asof import asof_clip

GRID = 10_000


def _ranks(method, n):
    """0-based ranks (low, high, weight of high) of p25, median and p75 for a series of ``n`` values."""
    def linear(p):
        k = (n - 1) * F.lit(p)
        lo = F.floor(k)
        return lo, F.least(lo + 1, n - 1), k - lo
    def single(i):
        return i, i, F.lit(0.0)
    def middle():
        hi = F.floor(n / 2)
        lo = F.when(n % 2 == 1, hi).otherwise(hi - 1)
        return lo, hi, F.lit(0.5)
    if method == "linear":
        return linear(0.25), linear(0.5), linear(0.75)
    if method == "floor":
        return (single(F.floor(n * 25 / 100)), middle(), single(F.least(n - 1, F.floor(n * 75 / 100))))
    if method == "nearest":
        return tuple(single(F.rint((n - 1) * F.lit(p)).cast("long")) for p in (0.25, 0.5, 0.75))
    raise ValueError(method)


def histogram(df: DataFrame, keys, value: str) -> DataFrame:
    """(keys, k, n): how often each published value occurs; k counts steps of 1e-4."""
    k = F.rint(F.col(value) * GRID).cast("long")
    return (df.where(F.col(value).isNotNull()).groupBy(*keys, k.alias("k")).agg(F.count(F.lit(1)).alias("n")))


def stats_from_histogram(hist: DataFrame, keys, method: str = "linear") -> DataFrame:
    """n, mean, median, win rate, p25, p75, min and max per ``keys`` from (keys, k, n)."""
    keys = list(keys)
    whole = W.partitionBy(*keys)
    below = W.partitionBy(*keys).orderBy("k").rowsBetween(W.unboundedPreceding, -1)
    rows = (hist.withColumn("start", F.coalesce(F.sum("n").over(below), F.lit(0)))
            .withColumn("total", F.sum("n").over(whole)))
    def at(rank):
        return F.max(F.when((rank >= F.col("start")) & (rank < F.col("start") + F.col("n")), F.col("k"))) / float(GRID)
    parts = []
    for name, (lo, hi, w) in zip(("p25", "median", "p75"), _ranks(method, F.col("total"))):
        parts += [at(lo).alias(f"{name}_lo"), at(hi).alias(f"{name}_hi"), F.max(w).alias(f"{name}_w")]
    # the window has already placed each bucket in one partition, so this aggregate needs no shuffle
    out = rows.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.sum(F.col("k").cast("decimal(20,0)") * F.col("n").cast("decimal(18,0)")).alias("ksum"),
        F.sum(F.when(F.col("k") > 0, F.col("n")).otherwise(F.lit(0))).alias("won"),
        F.min("k").alias("kmin"), F.max("k").alias("kmax"), *parts)
    def mix(name):
        lo, hi, w = F.col(f"{name}_lo"), F.col(f"{name}_hi"), F.col(f"{name}_w")
        return r4(lo + (hi - lo) * w).alias(name)
    return out.select(*keys, "n", r4(F.col("ksum").cast("double") / GRID / F.col("n")).alias("mean"), mix("median"),
                      r4(F.col("won") / F.col("n")).alias("win"), mix("p25"), mix("p75"),
                      (F.col("kmin") / float(GRID)).alias("min"), (F.col("kmax") / float(GRID)).alias("max"))


def return_stats(df: DataFrame, keys, value: str, method: str = "linear") -> DataFrame:
    """Statistics of ``value`` per ``keys``; NULL values are skipped. ``linear`` interpolates, ``floor``
    takes index n*p/100 and averages a middle pair, ``nearest`` rounds (n-1)*p half to even."""
    return stats_from_histogram(histogram(df, keys, value), keys, method)


def clean_positions(positions: DataFrame) -> DataFrame:
    """Open positions with a trustworthy headline return."""
    return positions.where("status = 'open' AND roi IS NOT NULL AND NOT split_flag")


def stats_by_role(positions: DataFrame, mode: str = "site", method: str = "linear") -> DataFrame:
    p = clean_positions(positions).withColumn("role", role_bucket(F.col("rel"), F.col("title"), mode))
    return return_stats(p, ["role"], "roi", method)


def stats_by_size(positions: DataFrame, mode: str = "site", method: str = "linear") -> DataFrame:
    p = clean_positions(positions).withColumn("size", size_bucket(F.coalesce("insider_val", F.lit(0.0)), mode))
    return return_stats(p, ["size"], "roi", method)


def stats_by_year(positions: DataFrame, method: str = "linear") -> DataFrame:
    return return_stats(clean_positions(positions).withColumn("y", F.year("fd")), ["y"], "roi", method)


def stats_cuts(positions: DataFrame, method: str = "linear") -> DataFrame:
    """All cuts of the headline return in one pass: one histogram by (role, size, year), fanned out to the
    four cuts after it has been combined."""
    p = (clean_positions(positions)
         .withColumn("role", role_bucket(F.col("rel"), F.col("title")))
         .withColumn("size", size_bucket(F.coalesce("insider_val", F.lit(0.0))))
         .withColumn("y", F.year("fd").cast("string")))
    base = histogram(p, ["role", "size", "y"], "roi")
    cuts = F.array(*[F.struct(F.lit(n).alias("cut"), v.alias("bucket")) for n, v in (
        ("all", F.lit("all")), ("role", F.col("role")), ("size", F.col("size")), ("year", F.col("y")))])
    fanned = (base.select(F.explode(cuts).alias("c"), "k", "n").select("c.*", "k", "n")
              .groupBy("cut", "bucket", "k").agg(F.sum("n").alias("n")))
    return stats_from_histogram(fanned, ["cut", "bucket"], method)


def stats_by_horizon(positions: DataFrame, method: str = "linear", names=None) -> DataFrame:
    """Statistics per holding period (and of the entry gap), all horizons in one histogram."""
    names = names or [f"r{n}" for n in fv.HORIZONS] + ["gap"]
    items = F.array(*[F.struct(F.lit(h).alias("horizon"), F.col(h).alias("value")) for h in names])
    long = clean_positions(positions).select(F.explode(items).alias("x")).select("x.*")
    return return_stats(long, ["horizon"], "value", method)


def stats_by_exit_year(book: DataFrame) -> DataFrame:
    """Closed round trips per exit year: n, mean and win rate."""
    done = book.where("exit_roi IS NOT NULL").withColumn("exit_year", F.year("exit_d"))
    g = done.groupBy("exit_year").agg(F.count(F.lit(1)).alias("n"), total(F.col("exit_roi")).alias("s"),
                                      count_if(F.col("exit_roi") > 0).alias("w"))
    return g.select("exit_year", "n", r4(F.col("s") / F.col("n")).alias("mean_roi"),
                    r4(F.col("w") / F.col("n")).alias("win_rate"))


def capital_summary(positions: DataFrame, basis: str = "valued") -> DataFrame:
    """Stake, value, P&L and return of the open book. ``valued`` counts stake and value over the same clean,
    valued positions; ``reference`` sets their value against the stake of every open position."""
    is_open = F.col("status") == "open"
    valued = is_open & F.col("mtm").isNotNull() & F.col("roi").isNotNull() & ~F.col("split_flag")
    g = positions.agg(total(F.when(is_open if basis == "reference" else valued, F.col("stake"))).alias("deployed"),
                      r2(total(F.when(valued, F.col("mtm")))).alias("value"))
    return g.select("deployed", "value", r2(F.col("value") - F.col("deployed")).alias("pnl"),
                    F.when(F.col("deployed") != 0, r4(F.col("value") / F.col("deployed") - 1.0)).alias("roi"))


def backtest_capital(book: DataFrame) -> DataFrame:
    verified = F.col("entry_rule_status") == "verified"
    closed = F.col("exit_status").isin("exited_252", "exit_last_observed")
    return book.agg(total(F.when(verified, F.col("stake"))).alias("deployed"),
                    r2(total(F.when(closed, F.col("exit_pnl")))).alias("realised_pnl"),
                    count_if(closed).alias("exited"),
                    count_if(closed & (F.col("exit_pnl") > 0)).alias("winners"),
                    count_if(closed & (F.coalesce("exit_pnl", F.lit(0.0)) <= 0)).alias("losers"))


def position_counts(positions: DataFrame) -> DataFrame:
    is_open = F.col("status") == "open"
    rule = F.col("entry_rule_status")
    return positions.agg(
        F.count(F.lit(1)).alias("signals"), count_if(is_open).alias("open"),
        count_if(is_open & F.col("roi").isNotNull()).alias("open_with_roi"),
        count_if(is_open & F.col("roi").isNotNull() & ~F.col("split_flag")).alias("open_clean"),
        count_if(is_open & F.col("roi").isNotNull() & F.col("split_flag")).alias("open_split_flagged"),
        count_if(is_open & F.col("roi_review")).alias("roi_review"),
        count_if(F.col("status") == "awaiting_entry").alias("awaiting_entry"),
        count_if(F.col("status") == "no_price").alias("no_price"),
        count_if(rule == "entry_window_missing").alias("entry_window_missing"),
        count_if(rule == "no_bars_after_filing").alias("no_bars_after_filing"))


def outcome(pnl="pnl"):
    """winner / loser / unclassified of one position."""
    realized = ((F.col("status") == "open") & F.col(pnl).isNotNull()
                & (F.coalesce("roi_status", F.lit("")) != "split_event_review"))
    return F.when(realized & (F.col(pnl) > 0), F.lit("winner")).when(realized, F.lit("loser")).otherwise(
        F.lit("unclassified"))


def outcome_split(positions: DataFrame) -> DataFrame:
    return positions.groupBy(outcome().alias("outcome")).agg(F.count(F.lit(1)).alias("n"),
                                                             r2(total(F.col("pnl"))).alias("pnl"))


def outcome_rows(positions: DataFrame, label: str, limit: int | None = None) -> DataFrame:
    order = F.desc("pnl") if label == "winner" else F.asc("pnl")
    rows = positions.where(outcome() == label)
    return rows.orderBy(order, "id").limit(limit) if limit else rows


def best_worst_positions(positions: DataFrame, limit: int = fv.TOP_POSITIONS, value: str = "roi") -> DataFrame:
    """Top and bottom ``limit`` by return: two TakeOrdered scans, no global sort."""
    p = clean_positions(positions)
    best = p.orderBy(F.desc(value), "id").limit(limit).withColumn("side", F.lit("best"))
    worst = p.orderBy(F.asc(value), "id").limit(limit).withColumn("side", F.lit("worst"))
    return best.unionByName(worst)


def paper_verification_counts(positions: DataFrame) -> DataFrame:
    is_open = F.col("status") == "open"
    rule_ok = (F.col("entry_d") > F.col("fd")) & (F.col("entry_px") > 0)
    stake_off = F.abs(F.col("shares") * F.col("entry_px") - F.col("stake")) > 0.25
    eff = F.coalesce("shares_after_split", "shares")
    mark_off = F.abs(F.col("mtm") - eff * F.col("last_px")) > 0.25
    return positions.agg(
        count_if(is_open & ~F.coalesce(rule_ok, F.lit(False))).alias("entry_rule_failures"),
        (count_if(is_open & stake_off) + count_if(is_open & mark_off)).alias("arithmetic_failures"),
        count_if(is_open & F.col("roi").isNotNull()).alias("open_positions_checked"))


def findings(positions: DataFrame, min_n: int = fv.FINDING_MIN_N) -> DataFrame:
    """(id, metric, value, n): headline facts, gated by group size. Texts are formatted from these rows.

    The few position columns the facts need are written once and read back, so the book behind them is
    computed once however many facts there are."""
    slim = ["status", "entry_rule_status", "stake", "mtm", "roi", "gap", "split_flag", "roi_review", "rel", "title",
            "insider_val", "fd", *[f"r{n}" for n in fv.HORIZONS]]
    positions = materialize(positions.select(*slim), "findings")
    counts, capital = position_counts(positions), capital_summary(positions)
    def unpivot(df, prefix, names):
        items = F.array(*[F.struct(F.lit(prefix).alias("id"), F.lit(x).alias("metric"),
                                   F.col(x).cast("double").alias("value"), F.lit(None).cast("long").alias("n"))
                          for x in names])
        return df.select(F.explode(items).alias("x")).select("x.*")
    cuts = materialize(stats_cuts(positions), "cuts")
    overall = cuts.where("cut = 'all'").select(F.lit("roi").alias("id"), F.lit("median").alias("metric"),
                                               F.col("median").alias("value"), "n")
    big = cuts.where(F.col("n") >= min_n)
    def extreme(cut, pick, label):
        b = pick(F.struct("bucket", "median", "n"), F.struct("median", "bucket")).alias("b")
        return (big.where(F.col("cut") == cut).agg(b).where("b IS NOT NULL")
                .select(F.lit(label).alias("id"), F.col("b.bucket").alias("metric"), F.col("b.median").alias("value"),
                        F.col("b.n").alias("n")))
    horizons = stats_by_horizon(positions)
    gated = horizons.where((F.col("n") >= min_n) | (F.col("horizon") == "gap")).select(
        F.when(F.col("horizon") == "gap", F.lit("entry_gap")).otherwise(F.lit("horizon")).alias("id"),
        F.col("horizon").alias("metric"), F.col("median").alias("value"), "n")
    parts = [unpivot(counts, "counts", ["open", "open_split_flagged", "entry_window_missing", "no_bars_after_filing",
                                        "awaiting_entry", "no_price"]),
             unpivot(capital, "capital", ["deployed", "value", "pnl", "roi"]), overall, gated,
             extreme("role", F.max_by, "best_role"), extreme("role", F.min_by, "worst_role"),
             extreme("size", F.max_by, "best_size")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def equity_curve_monthly(positions: DataFrame) -> DataFrame:
    """Running stake and value by entry month; the window runs over months, not positions."""
    months = (positions.where("status = 'open' AND mtm IS NOT NULL")
              .groupBy(month_key(F.col("entry_d")).alias("m"))
              .agg(F.count(F.lit(1)).alias("n"), total(F.col("stake")).alias("ds"), total(F.col("mtm")).alias("vs")))
    run = W.partitionBy().orderBy("m").rowsBetween(W.unboundedPreceding, W.currentRow)
    out = months.withColumn("deployed", r2(F.sum("ds").over(run))).withColumn("value", r2(F.sum("vs").over(run)))
    return out.select("m", "n", "deployed", "value", r2(F.col("value") - F.col("deployed")).alias("pnl"),
                      r4(F.col("value") / F.col("deployed") - 1.0).alias("roi"))


def equity_curve_daily(positions: DataFrame, bars: DataFrame, asof: str) -> DataFrame:
    """Weekday mark-to-market of every entered position with forward-filled closes.

    Positions are first summed per (ticker, entry weekday). Each ticker then contributes only its *changes*
    of value, and the daily curve is the running total of those changes: neither positions x days nor
    tickers x days is ever built. A ticker counts from its first weekday close on or after its first entry.
    """
    wide = "decimal(38,8)"
    entered = (positions.where("status = 'open' AND entry_d IS NOT NULL AND shares IS NOT NULL")
               .groupBy("tk", next_weekday(F.col("entry_d")).alias("d"))
               .agg(F.sum(F.col("shares").cast("decimal(28,4)")).alias("sh"), F.count(F.lit(1)).alias("n")))
    closes = (asof_clip(bars, asof).where(is_weekday(F.col("d")) & (F.col("c") != 0))
              .select("tk", "d", F.col("c").cast("decimal(18,4)").alias("c")))
    both = (entered.select("tk", "d", "sh", "n", F.lit(None).cast("decimal(18,4)").alias("c"))
            .unionByName(closes.select("tk", "d", F.lit(None).cast("decimal(38,4)").alias("sh"),
                                       F.lit(0).cast("long").alias("n"), "c")))
    steps = both.groupBy("tk", "d").agg(F.sum("sh").alias("sh"), F.sum("n").alias("n"), F.max("c").alias("c"))
    run = W.partitionBy("tk").orderBy("d").rowsBetween(W.unboundedPreceding, W.currentRow)
    order = W.partitionBy("tk").orderBy("d")
    steps = steps.withColumn("held", F.sum("sh").over(run)).withColumn("held_n", F.sum("n").over(run))
    steps = steps.where("held_n > 0").withColumn("px", F.last("c", ignorenulls=True).over(run))
    value = F.coalesce((F.col("held") * F.col("px")).cast(wide), F.lit(0).cast(wide))
    live = F.when(F.col("px").isNotNull(), F.col("held_n")).otherwise(F.lit(0))
    steps = steps.withColumn("v", value).withColumn("k", live)
    deltas = steps.select("d", (F.col("v") - F.coalesce(F.lag("v").over(order), F.lit(0).cast(wide))).alias("dv"),
                          (F.col("k") - F.coalesce(F.lag("k").over(order), F.lit(0))).alias("dk"))
    daily = deltas.groupBy("d").agg(F.sum("dv").alias("dv"), F.sum("dk").alias("dk"))
    days = (daily.agg(F.min("d").alias("a")).where("a IS NOT NULL")
            .select(F.explode(F.sequence("a", F.lit(asof).cast("date"))).alias("d")).where(is_weekday(F.col("d"))))
    curve = W.partitionBy().orderBy("d").rowsBetween(W.unboundedPreceding, W.currentRow)   # one row per weekday
    out = (days.join(daily, "d", "left").withColumn("n", F.sum("dk").over(curve))
           .withColumn("value", r2(F.sum("dv").over(curve).cast("double"))).where("n > 0"))
    deployed = F.col("n") * F.lit(fv.STAKE)
    return out.select("d", "n", deployed.alias("deployed"), "value", r2(F.col("value") - deployed).alias("pnl"),
                      r4(F.col("value") / deployed - 1.0).alias("roi"))
