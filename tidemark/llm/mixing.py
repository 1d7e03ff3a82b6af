"""Mixing sources to target weights.

Words are counted per source, targets follow from the weights by water-filling under a cap per source,
and a source's repetition rate is target over size. A document is emitted floor(rate) times plus one more
copy when a hash of its id, read as a number in [0, 1), falls below the fraction: reruns agree, and no
document needs to know of another.

Edge cases: a null text has size zero; a null source is a source of its own, ranked last; a source
without words has target zero and rate zero; rows with the same id share their draw; an empty table gives
an empty result.
"""
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WORD_PATTERN, checked, materialize

WEIGHTS = (3, 1, 2)
#: The mix holds this many hundredths of all words, and no source more than CAP times its own.
SHARE_PERCENT = 150
CAP = 2
SEED = "mix-1"


def size_column(text_col: str):
    return F.coalesce(F.regexp_count(F.col(f"`{text_col}`").cast("string"), F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def mix_plan(sized: DataFrame, source_col: str = "source", size_col: str = "size", weights=WEIGHTS,
             share_percent: int = SHARE_PERCENT, cap: int = CAP) -> DataFrame:
    """(source, source_size, target, rate), one row per source.

    Water-filling: a source whose cap is reached at level L keeps the cap, the others get weight x L. With the
    sources in order of cap over weight, the capped ones are a prefix, so the level follows from running sums.
    """
    ranked = (sized.groupBy(F.col(f"`{source_col}`").alias("source")).agg(F.sum(size_col).cast("long").alias("source_size"))
              .withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
              .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int")).cast("long")))
    order = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("rank"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    level = (F.lit(share_percent) * F.sum("source_size").over(everything)
             - 100 * cap * F.coalesce(F.sum("source_size").over(before), F.lit(0))).cast("double") / (
             100 * (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))).cast("double")
    levels = ranked.withColumn("level", level)
    # the first source whose cap lies above the level that it would set is the first one not capped
    opens = F.when(F.col("source_size") * cap >= F.col("weight") * F.col("level"), F.col("level"))
    target = F.least((cap * F.col("source_size")).cast("double"), F.col("weight") * F.coalesce(F.col("open"), F.lit(float("inf"))))
    return (levels.withColumn("open", F.max(opens).over(everything)).select("source", "source_size", target.alias("target"))
            .withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))))


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", size_col: str = "size", seed: str = SEED, **rules) -> DataFrame:
    """``docs`` with source_size, target, rate and copies. ``size_col`` must be there already (see ``size_column``)."""
    plan = checked(materialize(mix_plan(docs, source_col, size_col, **rules), "mix"))
    plan = plan.select(F.col("source").alias("mix_source"), "source_size", "target", "rate")
    extra = {"mix_source", "source_size", "target", "rate", "copies"}
    kept = docs.select([F.col(f"`{c}`") for c in docs.columns if c.lower() not in extra])
    # 52 bits of the digest fit a double exactly
    digits = F.substring(F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")))), 1, 13)
    draw = F.conv(digits, 16, 10).cast("long") / F.lit(float(1 << 52))
    return (kept.join(plan, F.col(f"`{source_col}`").eqNullSafe(F.col("mix_source"))).drop("mix_source")
            .withColumn("copies", F.floor("rate") + F.when(draw < F.col("rate") - F.floor("rate"), 1).otherwise(0)))


def emit(mixed: DataFrame) -> DataFrame:
    """Each document as often as the mix takes it, numbered by ``copy`` from 1."""
    return mixed.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
