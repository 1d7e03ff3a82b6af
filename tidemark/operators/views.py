"""Read-side operators: filter, sort and page a published table; sample rows for review."""
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window as W

from ..functions.calendar import month_key
from ..session import materialize


def view_filter(df: DataFrame, *, search: str = "", search_columns=("tk", "co", "insider"), role: str = "",
                win: str = "", win_column: str = "roi", equals: dict | None = None, overlap: str = "",
                holding: str = "") -> DataFrame:
    """All published-table predicates in one conjunction; an empty setting does not filter.

    ``win``: 'w' keeps positive, 'l' negative returns; ``overlap``: both/buy/sell; ``holding``: shares/priced.
    """
    cond = F.lit(True)
    for column, value in (equals or {}).items():
        if value not in ("", None):
            cond = cond & (F.col(column) == value)
    if role:
        cond = cond & F.coalesce("rel", F.lit("")).contains(role)
    if win:
        cond = cond & (F.col(win_column) > 0 if win == "w" else F.col(win_column) < 0)
    if overlap:
        cond = cond & {"both": F.col("overlap"), "buy": F.col("buy_n") > 0, "sell": F.col("sell_n") > 0}[overlap]
    if holding:
        cond = cond & F.col("reported_shares" if holding == "shares" else "holding_value").isNotNull()
    if search.strip():
        hay = F.lower(F.concat_ws(" ", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in search_columns]))
        cond = cond & hay.contains(search.strip().lower())
    return df.where(cond)


def view_sort_page(df: DataFrame, key: str, *, descending: bool = True, numeric: bool = False, page: int = 0,
                   size: int = 50, tie=()) -> DataFrame:
    """One page of the sorted view; missing values sink in both directions, text sorts without case."""
    c = F.col(key) if numeric else F.nullif(F.lower(F.col(key).cast("string")), F.lit(""))
    order = c.desc_nulls_last() if descending else c.asc_nulls_last()
    return df.orderBy(order, *tie).offset(page * size).limit(size)


def _beyond(column, value, *, descending: bool = False, nulls_last: bool = False):
    """Rows that stand after ``value`` in the order of ``column``."""
    if value is None:
        return F.lit(False) if nulls_last else column.isNotNull()
    past = column < F.lit(value) if descending else column > F.lit(value)
    return past | column.isNull() if nulls_last else past


def seek_position(row, key: str, *, numeric: bool = False, tie=()) -> tuple:
    """The continuation key of a page: sort value and ties of its last row."""
    value = row[key] if numeric or row[key] is None else str(row[key]).lower() or None
    return (value, *[row[t] for t in tie])


def view_seek_page(df: DataFrame, key: str, after: tuple | None = None, *, descending: bool = True, numeric: bool = False,
                   size: int = 50, tie=()) -> DataFrame:
    """The page behind the row whose ``seek_position`` is ``after`` (None: the first page), in the order of ``view_sort_page``.

    What precedes the page is filtered away, by the scan where it can, and a task keeps ``size`` rows whatever the depth. ``tie`` has to make
    rows distinct: of rows equal in key and ties, those beyond a page's end are stepped over. Missing ties stand first."""
    c = F.col(key) if numeric else F.nullif(F.lower(F.col(key).cast("string")), F.lit(""))
    if after is not None:
        value, *rest = after
        if len(rest) != len(tie):
            raise ValueError(f"a continuation key of 1 + {len(tie)} values is needed")
        beyond = F.lit(False)
        for name, at in reversed(list(zip(tie, rest))):
            column = F.col(name)
            beyond = _beyond(column, at) | (column.eqNullSafe(F.lit(at)) & beyond)
        beyond = _beyond(c, value, descending=descending, nulls_last=True) | (c.eqNullSafe(F.lit(value)) & beyond)
        df = df.where(beyond)
    order = c.desc_nulls_last() if descending else c.asc_nulls_last()
    return df.orderBy(order, *tie).limit(size)


def rank_rows(df: DataFrame, group, levels, tie, targets: DataFrame) -> DataFrame:
    """Rows of ``df`` standing at given 0-based ranks inside their group, without ranking whole groups.

    ``levels``: ascending sort keys as columns; ``tie``: final sort keys; ``targets``: (group, t). Each level
    counts rows per distinct key among the rows still in play, locates the key that contains each target and
    keeps only that slice, so only rows equal on all levels are ever sorted together.
    """
    state = targets.select(group, "t", F.col("t").alias("left"))
    names = []
    for i, level in enumerate(levels):
        df = df.withColumn(f"_l{i}", level)
        inplay = df.join(state.select(group, *names).distinct(), [group, *names], "left_semi") if names else df
        counts = inplay.groupBy(group, *names, f"_l{i}").agg(F.count(F.lit(1)).alias("_n"))
        located = counts.join(state, [group, *names])
        before = W.partitionBy(group, "t").orderBy(f"_l{i}").rowsBetween(W.unboundedPreceding, -1)
        located = located.withColumn("_b", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        names.append(f"_l{i}")
        state = (located.where((F.col("left") >= F.col("_b")) & (F.col("left") < F.col("_b") + F.col("_n")))
                 .select(group, *names, "t", (F.col("left") - F.col("_b")).alias("left")))
        state = materialize(state, "ranks")                   # a few rows; keeps the plan linear in the levels
    w = W.partitionBy(group, *names).orderBy(*tie)
    slices = df.join(state.select(group, *names).distinct(), [group, *names], "left_semi")
    ranked = slices.withColumn("left", F.row_number().over(w).cast("long") - 1)
    return ranked.join(state, [group, *names, "left"]).drop("left", *names)


def sample_rows(trades: DataFrame, top: int = 2, strides: int = 3, per_month: int = 25) -> DataFrame:
    """Review sample per filing month, by value: the ``top`` largest, plus ranks 0, step and 2*step with
    step = n/25. ``pick`` says which rule chose a row; a row may be chosen by both."""
    rows = trades.where("fd IS NOT NULL").withColumn("m", month_key(F.col("fd")))
    n = rows.groupBy("m").agg(F.count(F.lit(1)).alias("n"))
    step = F.greatest(F.lit(1), F.floor(F.col("n") / per_month))
    tops = n.select("m", F.explode(F.sequence(F.lit(0), F.lit(top - 1))).alias("t"), "n")
    every = (n.select("m", F.explode(F.sequence(F.lit(0), F.lit(strides - 1))).alias("j"), "n")
             .select("m", (F.col("j") * step).alias("t"), "n"))
    wanted = (tops.select("m", F.col("t").cast("long").alias("t"), "n", F.lit("top").alias("pick"))
              .unionByName(every.select("m", "t", "n", F.lit("stride").alias("pick"))).where("t < n"))
    # value first (largest first), then days and names, so that equal values do not form one big slice
    cents = F.rint(F.coalesce(F.col("val"), F.lit(0.0)) * 100).cast("long")
    levels = [-F.floor(cents / 100_000), -cents, F.datediff(F.col("fd"), F.lit("1970-01-01").cast("date")),
              F.col("tk"), F.col("acc")]
    picked = rank_rows(rows, "m", levels, ["pos", "td"], wanted.select("m", "t").distinct())
    return picked.join(wanted.select("m", "t", "pick"), ["m", "t"])
