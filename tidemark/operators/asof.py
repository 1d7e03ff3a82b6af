"""As-of and horizon joins between filings and daily bars.

Shape of every lookup here: (1) reduce the left side to its distinct (ticker, day) pairs, a map-side
aggregate that takes a ticker with a third of all filings down to one row per calendar day; (2) put those
pairs and the bars into one window per ticker and carry the wanted bar along a running frame; (3) join the
answers back to the full left side by (ticker, day). A window group therefore holds at most one ticker's
calendar, never its filings, and the join back is an ordinary equi-join that AQE can split.
"""
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window as W

from ..fixed_values import HORIZONS, JUMP_FACTOR


def asof_clip(bars: DataFrame, asof: str | None) -> DataFrame:
    """Drop bars later than the as-of date, before anything else sees them."""
    return bars.where(F.col("d") <= F.lit(asof).cast("date")) if asof else bars


def one_per_session(bars: DataFrame) -> DataFrame:
    """One bar per (tk, d): of repeats one that can be traded before one that cannot, then the greatest in the order of its columns.
    The window is partitioned and sorted by (tk, d) first, so windows over a ticker's days need no further exchange or sort."""
    rest = [F.col(c) for c in bars.columns if c not in ("tk", "d")]
    usable = [F.coalesce(F.col("o") > 0, F.lit(False))] if "o" in bars.columns else []
    following = F.lead("d").over(W.partitionBy("tk").orderBy("d", *usable, *rest))
    return bars.withColumn("_following", following).where("_following IS NULL OR _following <> d").drop("_following")


def session_index(bars: DataFrame) -> DataFrame:
    """0-based position of each session in its ticker's series; repeated bars are one session."""
    return one_per_session(bars).withColumn("i", F.row_number().over(W.partitionBy("tk").orderBy("d")) - 1)


def asof_lookup(left: DataFrame, right: DataFrame, time: str, value: str, *, direction: str = "forward",
                strict: bool = True, by: str = "tk") -> DataFrame:
    """``left`` plus the struct column ``value`` of the nearest ``right`` row (``by``, ``d``, ``value``) after
    (forward) or before (backward) ``left.time``. Right rows whose ``value`` is NULL are stepped over."""
    keys = left.select(by, F.col(time).alias("d")).where(f"{by} IS NOT NULL AND d IS NOT NULL").distinct()
    answers = asof_keys(keys, right, value, direction=direction, strict=strict, by=by)
    answers = answers.withColumnRenamed("d", time)
    return left.join(answers, [by, time], "left")


def asof_keys(keys: DataFrame, right: DataFrame, value: str, *, direction: str = "forward", strict: bool = True,
              by: str = "tk", extra=()) -> DataFrame:
    """The window half of ``asof_lookup`` for keys that are already distinct. ``extra``: (name, column) pairs
    of whole-series aggregates over ``right`` columns, answered in the same pass."""
    kind = right.schema[value].dataType
    passed = [c for c in right.columns if c not in (by, "d", value)]
    both = (right.select(by, "d", F.col(value).alias("_v"), F.lit(True).alias("_fact"), *passed)
            # dealt like the facts: where those stand by ``by`` already, they are not dealt again
            .unionByName(keys.repartition(by).select(by, "d", F.lit(None).cast(kind).alias("_v"), F.lit(False).alias("_fact"),
                                     *[F.lit(None).cast(right.schema[c].dataType).alias(c) for c in passed])))
    # Scan toward the key and remember the last usable fact. On equal days the fact must come after the key
    # when the comparison is strict, before it when not.
    day = F.col("d").desc() if direction == "forward" else F.col("d").asc()
    tie = F.col("_fact").asc() if strict else F.col("_fact").desc()
    run = W.partitionBy(by).orderBy(day, tie).rowsBetween(W.unboundedPreceding, W.currentRow)
    out = both.withColumn(value, F.last("_v", ignorenulls=True).over(run))
    for name, agg in extra:
        out = out.withColumn(name, agg.over(W.partitionBy(by)))
    return out.where(~F.col("_fact")).select(by, "d", value, *[n for n, _ in extra])


def enrich_bars(bars: DataFrame, asof: str | None = None, horizons=tuple(HORIZONS), keep_zero: bool = True) -> DataFrame:
    """Every clipped bar with what a position opened on it will need later, so no later join touches bars:
    session number, horizon closes, the series' last bar and last close, and the next close-to-close jump."""
    asc = W.partitionBy("tk").orderBy("d")
    whole = W.partitionBy("tk").orderBy("d").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    later = W.partitionBy("tk").orderBy(F.desc("d")).rowsBetween(W.unboundedPreceding, -1)
    close = F.when(F.col("c") != 0, F.col("c"))               # a zero close counts as not printed
    steps = (0,) + tuple(h for h in horizons if h) if keep_zero else tuple(horizons)
    ratio = F.col("c") / F.lag("c").over(asc)
    jump = (F.col("c") != 0) & (F.lag("c").over(asc) > 0) & ((ratio >= JUMP_FACTOR) | (ratio <= 1.0 / JUMP_FACTOR))
    leads = [(close if n == 0 else F.lead(close, n).over(asc)).alias(f"c{n}") for n in steps]
    lead_days = [(F.col("d") if n == 0 else F.lead("d", n).over(asc)).alias(f"d{n}") for n in steps]
    bar = F.struct((F.row_number().over(asc) - 1).alias("i"), F.col("d").alias("d"), F.col("c").alias("c"),
                   close.alias("k"))
    staged = one_per_session(asof_clip(bars, asof)).select(
        "tk", "d", "o", "c", (F.row_number().over(asc) - 1).alias("i"), F.lag("c").over(asc).alias("prev_c"),
        *leads, *lead_days, F.coalesce(jump, F.lit(False)).alias("jump"), bar.alias("_bar"))
    return (staged
            .withColumn("last", F.last("_bar").over(whole))
            .withColumn("last_close", F.last(F.when(F.col("_bar.k").isNotNull(), F.col("_bar")), True).over(whole))
            .withColumn("next_jump", F.last(F.when(F.col("jump"), F.col("d")), True).over(later))
            .drop("_bar"))


def entry_candidates(enriched: DataFrame) -> DataFrame:
    """(tk, d, bar): the bar as one struct, NULL where its open cannot be traded."""
    body = F.struct(*[c for c in enriched.columns if c != "tk"])
    return enriched.select("tk", "d", F.when(F.col("o") > 0, body).alias("bar"), "last")


def with_next_bar(left: DataFrame, candidates: DataFrame, time: str = "fd", value: str = "bar") -> DataFrame:
    """``left`` plus ``value`` of the first candidate (tk, d, ``value`` not NULL) strictly after ``left.time``.

    The answer for a day depends on the bars alone: a usable bar is the answer for every calendar day from the
    usable bar before it to the day before its own. So bars are spread over those days (as many rows as the
    calendar has, whatever the number of filings) and ``left`` meets them in one equi-join. Days before a
    ticker's first usable bar have no lower end; they get that bar, one row per ticker. Candidates of one day count once
    (``one_per_session``), so no row of ``left`` is doubled and none is answered on its own day.
    """
    usable = one_per_session(candidates.where(F.col(value).isNotNull()).select("tk", "d", value))
    usable = usable.withColumn("_prev", F.lag("d").over(W.partitionBy("tk").orderBy("d")))
    days = usable.where("_prev IS NOT NULL").select("tk", F.explode(F.sequence("_prev", F.date_sub("d", 1))).alias(time), value)
    first = usable.where("_prev IS NULL").select("tk", F.col("d").alias("_first_d"), F.col(value).alias("_first"))
    out = left.join(days, ["tk", time], "left").join(first, "tk", "left")
    return (out.withColumn(value, F.coalesce(F.col(value), F.when(F.col(time) < F.col("_first_d"), F.col("_first"))))
            .drop("_first_d", "_first"))


def next_session_entry(signals: DataFrame, bars: DataFrame, asof: str | None = None) -> DataFrame:
    """Strict forward as-of join: the first bar after the filing day with a usable open; never that day."""
    right = session_index(asof_clip(bars, asof)).select(
        "tk", "d", F.when(F.col("o") > 0, F.struct("i", "d", "o", "c")).alias("bar"))
    out = with_next_bar(signals, right)
    return (out.withColumn("entry_d", F.col("bar.d")).withColumn("entry_px", F.col("bar.o"))
            .withColumn("entry_i", F.col("bar.i")).drop("bar"))


def close_on_or_before(left: DataFrame, bars: DataFrame, time: str) -> DataFrame:
    """Backward as-of join: the last usable close at or before a day."""
    right = one_per_session(bars).select("tk", "d", F.when(F.col("c") != 0, F.struct("d", "c")).alias("bar"))
    out = asof_lookup(left, right, time, "bar", direction="backward", strict=False)
    return out.withColumn("close_d", F.col("bar.d")).withColumn("close_px", F.col("bar.c")).drop("bar")


def latest_mark(bars: DataFrame, asof: str | None = None) -> DataFrame:
    """Last usable close per ticker; a mark that is not positive is no mark."""
    from ..functions.numeric import r4
    last = asof_clip(bars, asof).where("c <> 0").groupBy("tk").agg(
        F.max("d").alias("mark_d"), F.max_by("c", "d").alias("mark_px"))
    return last.where("mark_px > 0").withColumn("mark_px", r4(F.col("mark_px")))


def horizon_close(entries: DataFrame, bars: DataFrame, n: int, asof: str | None = None) -> DataFrame:
    """Close of the bar ``n`` sessions after ``entry_d``: the offset is precomputed on the bars
    (one ``lead``), so this is one equi-join on (tk, entry_d)."""
    asc = W.partitionBy("tk").orderBy("d")
    ahead = one_per_session(asof_clip(bars, asof)).select(
        "tk", F.col("d").alias("entry_d"), F.lead("d", n).over(asc).alias("horizon_d"),
        F.lead("c", n).over(asc).alias("horizon_px"))
    out = entries.join(ahead, ["tk", "entry_d"], "left")
    ok = F.col("horizon_px") != 0
    return out.withColumn("horizon_d", F.when(ok, F.col("horizon_d"))).withColumn(
        "horizon_px", F.when(ok, F.col("horizon_px")))
