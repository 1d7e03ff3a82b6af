"""Identity, deduplication and merge rules.

All "keep one row per key" rules are ``row_number() = 1`` filters. Spark turns that shape into a window
group limit: every map task keeps its own best row per key before the shuffle, so a key that holds a
third of the input reaches the reducer as at most one row per map task.
"""
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window as W

from ..fixed_values import PRICE_SOURCES

REFERENCE_IDENTITY = ["acc", "der", "td", "code", "sec", "sh", "px", "ad", "pcik"]
FULL_IDENTITY = REFERENCE_IDENTITY + ["di", "nature", "af"]


def row_key(trades: DataFrame, identity: str = "reference"):
    """Typed identity columns; blank and missing text are the same thing. ``full`` also separates equal
    lots held directly and through a trust."""
    names = REFERENCE_IDENTITY if identity == "reference" else FULL_IDENTITY
    return [F.coalesce(F.col(n), F.lit("")) if trades.schema[n].dataType.typeName() == "string" else F.col(n)
            for n in names]


def keep_one(df: DataFrame, keys, order) -> DataFrame:
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def union_sources(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def dedupe_trades(trades: DataFrame, identity: str = "reference",
                  order=("source_rank", "fd", "pos", "insider", "icik")) -> DataFrame:
    """First row per identity, bulk source before nightly source."""
    return keep_one(trades, row_key(trades, identity), order)


def upsert_shard(existing: DataFrame, incoming: DataFrame, identity: str = "reference",
                 order=("pos", "icik")) -> DataFrame:
    """Last write wins per identity; rows without a filing date are not stored."""
    both = (existing.withColumn("_batch", F.lit(0))
            .unionByName(incoming.withColumn("_batch", F.lit(1)), allowMissingColumns=True)
            .where(F.col("fd").isNotNull()))
    newest_first = [F.col("_batch").desc()] + [F.col(c).desc() for c in order]
    return keep_one(both, row_key(both, identity), newest_first).drop("_batch")


def upsert_counts(existing: DataFrame, incoming: DataFrame, identity: str = "reference") -> DataFrame:
    """One row: how many identities are new and how many incoming rows are undated."""
    names = REFERENCE_IDENTITY if identity == "reference" else FULL_IDENTITY
    def keyed(df, extra):
        return df.select(*[k.alias(n) for k, n in zip(row_key(df, identity), names)], *extra)
    flags = (keyed(existing.where("fd IS NOT NULL"), [F.lit(0).alias("_new"), F.lit(0).alias("_undated")])
             .unionByName(keyed(incoming, [F.col("fd").isNotNull().cast("int").alias("_new"),
                                           F.col("fd").isNull().cast("int").alias("_undated")])))
    per_key = flags.groupBy(*names).agg(
        F.bool_and(F.col("_new") == 1).alias("fresh"), F.max("_new").alias("seen"),
        F.sum("_undated").alias("undated"))
    return per_key.agg(F.count(F.when(F.col("fresh") & (F.col("seen") == 1), 1)).alias("added"),
                       F.coalesce(F.sum("undated"), F.lit(0)).alias("undated"))


def supersede_amendments(existing: DataFrame, incoming: DataFrame | None = None,
                         only_amendments: bool = False) -> DataFrame:
    """A re-collected accession replaces its old rows; then per (issuer, owner, period) only the latest
    filing survives, with all its rows. ``only_amendments``: a filing gives way to later amendments only.

    The winner per group is a small aggregate joined back by key, so the rows themselves are never sorted
    inside one group and AQE may split a skewed join partition.
    """
    rows = existing
    if incoming is not None:
        replaced = incoming.select("acc").distinct()
        rows = existing.join(replaced, "acc", "left_anti").unionByName(incoming, allowMissingColumns=True)
    keys = ["icik", "pcik", "period"]
    stamp = F.struct("fd", "amend", "acc")
    source = rows.where("amend = 1") if only_amendments else rows
    best = source.groupBy(*keys).agg(F.max(stamp).alias("best"))
    r, b = rows.alias("r"), best.alias("b")
    same = [F.col(f"r.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    if not only_amendments:
        return r.join(b, same + [F.col("r.acc") == F.col("b.best.acc")], "left_semi")
    older = F.struct("r.fd", "r.amend", "r.acc") < F.col("b.best")
    return r.join(b, same + [older], "left_anti")


def source_fallback(bars: DataFrame, sources=tuple(PRICE_SOURCES)) -> DataFrame:
    """The first source with any bar for a ticker supplies its whole series."""
    rank = F.coalesce(F.array_position(F.array(*[F.lit(s) for s in sources]), F.col("src")), F.lit(0))
    rank = F.when(rank == 0, F.lit(len(sources) + 1)).otherwise(rank)
    best = F.min("_rank").over(W.partitionBy("tk"))            # a ticker's bars are bounded by the calendar
    return bars.withColumn("_rank", rank).withColumn("_best", best).where("_rank = _best").drop("_rank", "_best")


def price_window_trim(bars: DataFrame, cut: str) -> DataFrame:
    """Drop bars before ``cut``, except for tickers that would lose every bar."""
    recent = F.col("d") >= F.lit(cut).cast("date")
    return (bars.withColumn("_any", F.max(recent).over(W.partitionBy("tk")))
            .where(recent | ~F.col("_any")).drop("_any"))


def merge_price_tail(old: DataFrame, tail: DataFrame) -> DataFrame:
    """New sessions are appended, the latest known session is refreshed, older sessions never change.

    Both sides go through one shuffle by ticker: the (ticker, day) aggregate and the per-ticker last day
    share that partitioning.
    """
    others = [c for c in old.columns if c in tail.columns and c not in ("tk", "d", "o", "c")]
    def tagged(df, new):
        return df.select("tk", "d", "o", "c", *others, F.lit(new).alias("new"))
    both = tagged(old, False).unionByName(tagged(tail, True)).repartition("tk")
    def pick(field, new):
        return F.max(F.when(F.col("new") == new, F.col(field)))
    days = both.groupBy("tk", "d").agg(
        pick("o", False).alias("oo"), pick("c", False).alias("oc"), pick("o", True).alias("no"),
        pick("c", True).alias("nc"), *[pick(c, False).alias(f"old_{c}") for c in others],
        *[pick(c, True).alias(f"new_{c}") for c in others], F.bool_or(~F.col("new")).alias("had"), F.bool_or("new").alias("got"))
    last = F.max(F.when(F.col("had"), F.col("d"))).over(W.partitionBy("tk"))
    def merged(o, n):
        refreshed = F.coalesce(F.nullif(F.col(n), F.lit(0.0)), F.col(o))
        return (F.when(F.col("last").isNull() | (F.col("d") > F.col("last")), F.col(n))
                .when((F.col("d") == F.col("last")) & F.col("got"), refreshed).otherwise(F.col(o)))
    def carried(c):  # the other columns follow the row that supplies the session
        return (F.when(F.col("last").isNull() | (F.col("d") > F.col("last")), F.col(f"new_{c}"))
                .when((F.col("d") == F.col("last")) & F.col("got"), F.coalesce(f"new_{c}", f"old_{c}")).otherwise(F.col(f"old_{c}")))
    return (days.withColumn("last", last)
            .where(F.col("had") | F.col("last").isNull() | (F.col("d") > F.col("last")))
            .select("tk", "d", merged("oo", "no").alias("o"), merged("oc", "nc").alias("c"),
                    *[carried(c).alias(c) for c in others]))


def merge_splits(old: DataFrame, new: DataFrame) -> DataFrame:
    """Union by (ticker, day); the newest copy of an event wins."""
    both = old.withColumn("_batch", F.lit(0)).unionByName(new.withColumn("_batch", F.lit(1)))
    return (both.groupBy("tk", "d").agg(F.max_by(F.struct("num", "den"), F.struct("_batch", "num", "den")).alias("e"))
            .select("tk", "d", "e.num", "e.den"))


def last_update_wins(log: DataFrame, key: str = "tk", seq: str = "seq") -> DataFrame:
    """Compaction of an append-only log: the document with the highest sequence number per key."""
    doc = F.struct(*[c for c in log.columns if c != key])
    return (log.groupBy(key).agg(F.max_by(doc, seq).alias("doc")).select(key, "doc.*"))


def dedupe_flags(flags: DataFrame) -> DataFrame:
    """Flags that say the same thing about the same filings are one flag. ``filing_set`` is an
    order-insensitive fingerprint of the flag's accessions (see ``flags.flag_items``)."""
    return flags.dropDuplicates(["category", "filing_set", "fd_text", "td_text", "summary"])
