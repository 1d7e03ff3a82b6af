"""Split events: what the bars did across each event, and what that means for a position."""
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window as W

from ..functions.links import corporate_action_url
from ..functions.numeric import r4
from ..sources.prices import split_ratio
from .asof import asof_lookup


def classify_splits(splits: DataFrame, enriched: DataFrame, test: str = "reference") -> DataFrame:
    """Per event: price jump across it (open on or after the event / previous close) and its kind.

    ``reference`` looks for a jump near 1 first, so an unadjusted 2:1 split reads as adjusted;
    ``log`` compares the distances to 1 and to the ratio in log space instead.
    """
    events = splits.where("num <> 0 AND den <> 0").select("tk", "d", split_ratio(F.col("num"), F.col("den")).alias("ratio"))
    events = events.where("ratio > 0")
    split = enriched.join(events.select("tk").distinct(), "tk", "left_semi")          # most tickers never split
    right = split.select("tk", "d", F.struct("o", "prev_c", "i").alias("bar"))
    at = asof_lookup(events, right, "d", "bar", strict=False)
    usable = at.where("bar.i > 0 AND bar.prev_c <> 0 AND bar.o <> 0")
    jump = usable.withColumn("jump", r4(F.col("bar.o") / F.col("bar.prev_c")))
    j, r = F.col("jump"), F.col("ratio")
    if test == "log":
        to_one, to_ratio = F.abs(F.log(j)), F.abs(F.log(j / r))
        near = F.log(F.lit(2.0))
        kind = (F.when((to_one <= near) & (to_one <= to_ratio), F.lit("adjusted"))
                .when(to_ratio <= near, F.lit("mixed")).otherwise(F.lit("indeterminate")))
    else:
        kind = (F.when(j.between(0.5, 2.0), F.lit("adjusted"))
                .when((j >= r * 0.5) & (j <= r * 2.0), F.lit("mixed")).otherwise(F.lit("indeterminate")))
    return jump.select("tk", "d", "ratio", "jump", kind.alias("kind"))


def event_outlook(events: DataFrame) -> DataFrame:
    """Per event, what holds for a position that sees this event and every later one of its ticker."""
    run = W.partitionBy("tk").orderBy(F.desc("d")).rowsBetween(W.unboundedPreceding, W.currentRow)
    mixed = F.col("kind") == "mixed"
    facts = {
        "events": F.count(F.lit(1)).over(run),
        "mixed": F.count(F.when(mixed, 1)).over(run),
        "unclear": F.count(F.when(F.col("kind") == "indeterminate", 1)).over(run),
        "ratio": F.product(F.when(mixed, F.col("ratio")).otherwise(F.lit(1.0))).over(run),
        "first_mixed": F.min(F.when(mixed, F.col("d"))).over(run),
    }
    return events.select("tk", "d", F.struct(*[c.alias(n) for n, c in facts.items()]).alias("split"))


def position_split_status(split) -> F.Column:
    """NULL without events; all unclear -> review; any mixed -> mixed; else the series is adjusted."""
    return (F.when(split.isNull(), F.lit(None))
            .when(split["unclear"] == split["events"], F.lit("split_event_review"))
            .when(split["mixed"] > 0, F.lit("mixed_pre_post_split"))
            .otherwise(F.lit("split_adjusted_series")))


def split_events_in_hold(positions: DataFrame, events: DataFrame) -> DataFrame:
    """One row per (position, event) with entry_d < event day <= last_d. The join key is the ticker and the
    day range a filter; events per ticker are bounded by the calendar, positions stay partitioned."""
    e = events.select(F.col("tk").alias("e_tk"), F.col("d").alias("event_d"), "ratio", "jump", "kind")
    hit = ((F.col("tk") == F.col("e_tk")) & (F.col("event_d") > F.col("entry_d"))
           & (F.col("event_d") <= F.col("last_d")))
    p = positions.where("status = 'open'").select("id", "tk", "icik", "entry_d", "last_d")
    return (p.join(e, hit, "inner")
            .select("id", "tk", "entry_d", "last_d", "event_d", "ratio", "jump", "kind",
                    corporate_action_url(F.col("icik")).alias("review_url")))


def find_price_discontinuity(entries: DataFrame, enriched: DataFrame) -> DataFrame:
    """First day after ``entry_d`` whose close is at least 3x or at most a third of the previous close.
    ``enriched`` already knows each bar's next jump, so this is an equi-join on (tk, entry_d)."""
    nj = enriched.select("tk", F.col("d").alias("entry_d"), F.col("next_jump").alias("jump_d"))
    return entries.join(nj, ["tk", "entry_d"], "left")
