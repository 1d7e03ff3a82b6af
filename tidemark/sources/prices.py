"""Daily bars and split events from three price sources."""
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..fixed_values import PRICE_SOURCES
from ..functions.numeric import parse_number, r4, r6
from ..schemas import BARS, with_missing
from .headers import union_by_header

CHART = """chart STRUCT<result: ARRAY<STRUCT<
  meta: STRUCT<symbol: STRING, gmtoffset: BIGINT>,
  timestamp: ARRAY<BIGINT>,
  indicators: STRUCT<quote: ARRAY<STRUCT<open: ARRAY<DOUBLE>, high: ARRAY<DOUBLE>, low: ARRAY<DOUBLE>,
                                         close: ARRAY<DOUBLE>, volume: ARRAY<BIGINT>>>>,
  events: STRUCT<splits: MAP<STRING, STRUCT<date: STRING, numerator: STRING, denominator: STRING,
                                            splitRatio: STRING>>>>>>"""
QUOTE_TABLE = ("data STRUCT<symbol: STRING, tradesTable: STRUCT<rows: ARRAY<STRUCT<date: STRING, open: STRING, "
          "high: STRING, low: STRING, close: STRING, volume: STRING>>>>")


def _session_date(unix, offset):
    """Exchange-local date, independent of the session time zone."""
    return F.date_add(F.lit("1970-01-01").cast("date"), F.floor((unix + offset) / 86400).cast("int"))


def _ticker(symbol, file):
    """The document's own symbol, else the file name up to its first dot."""
    from_name = F.upper(F.regexp_extract(file, r"([^/]+?)\.[^/]*$", 1))
    return F.coalesce(F.nullif(F.upper(symbol), F.lit("")), from_name)


def _one_per_session(bars: DataFrame) -> DataFrame:
    """The last copy of a repeated session wins. Groups are (ticker, day): never hot."""
    picked = bars.groupBy("tk", "d").agg(F.max_by(F.struct("o", "h", "l", "c", "v", "src"), "pos").alias("b"))
    return with_missing(picked.select("tk", "d", "b.*"), BARS)


def _fill(o, c):
    return r4(F.coalesce(o, c)).alias("o"), r4(F.coalesce(c, o)).alias("c")


def _results(docs):
    r = F.get(F.col("chart.result"), 0)
    return docs.select(_ticker(r["meta"]["symbol"], F.col("file")).alias("tk"),
                       F.coalesce(r["meta"]["gmtoffset"], F.lit(0)).alias("off"), r.alias("r"))


def bars_from_charts(docs: DataFrame) -> DataFrame:
    """Chart documents (``file``, ``chart``): parallel arrays zipped by position; open and close fill each
    other; shorter arrays read as NULL."""
    q = F.get(F.col("r.indicators.quote"), 0)
    def series(name, kind="double"):
        return F.coalesce(q[name], F.array().cast(f"array<{kind}>"))      # a missing array is an empty one
    zipped = F.arrays_zip(F.col("r.timestamp").alias("t"), series("open").alias("o"), series("high").alias("h"),
                          series("low").alias("l"), series("close").alias("c"), series("volume", "bigint").alias("v"))
    long = (_results(docs).select("tk", "off", F.posexplode(zipped).alias("pos", "b"))
            .where("b.t IS NOT NULL AND coalesce(b.o, b.c) IS NOT NULL"))
    return _one_per_session(long.select(
        "tk", _session_date(F.col("b.t"), F.col("off")).alias("d"), *_fill(F.col("b.o"), F.col("b.c")),
        r4(F.col("b.h")).alias("h"), r4(F.col("b.l")).alias("l"), F.col("b.v").alias("v"),
        F.lit(PRICE_SOURCES[0]).alias("src"), "pos"))


def read_bars_yahoo_json(spark: SparkSession, path: str) -> DataFrame:
    return bars_from_charts(_charts(spark, path))


def _charts(spark, path):
    return spark.read.json(path, schema=CHART, multiLine=True).withColumn("file", F.input_file_name())


def read_splits(spark: SparkSession, path: str) -> DataFrame:
    return splits_from_charts(_charts(spark, path))


def splits_from_charts(docs: DataFrame) -> DataFrame:
    """Split events of the chart documents: numerator/denominator, else an ``a:b`` text."""
    ev = _results(docs).select("tk", "off", F.explode("r.events.splits").alias("key", "e"))
    text = F.split(F.coalesce(F.col("e.splitRatio"), F.lit("")), ":")
    num, den = parse_number(F.col("e.numerator")), parse_number(F.col("e.denominator"))
    given = (F.coalesce(num, F.lit(0)) != 0) & (F.coalesce(den, F.lit(0)) != 0)
    a, b = parse_number(F.get(text, 0)), F.coalesce(parse_number(F.get(text, 1)), F.lit(1.0))
    stamp = F.coalesce(F.col("e.date"), F.col("key"))
    day = F.when(stamp.rlike(r"^\d+$"), _session_date(stamp.try_cast("bigint"), F.col("off"))).otherwise(
        F.substring(stamp, 1, 10).try_cast("date"))
    return (ev.select("tk", day.alias("d"), F.when(given, num).otherwise(a).alias("num"),
                      F.when(given, den).otherwise(b).alias("den"))
            .where("d IS NOT NULL AND num <> 0 AND den <> 0"))


def split_ratio(num, den):
    """Price multiplier across the event: 1 new share for 40 old ones multiplies the price by 40."""
    return r6(den / num)


def bars_from_csv_rows(raw: DataFrame, policy: str = "repair") -> DataFrame:
    """Text rows (``file``, date, open, high, low, close, volume). ``repair``: a non-positive open or close
    takes the other one; ``drop``: such rows go."""
    raw = raw.toDF(*[c.strip().lower() for c in raw.columns])
    tk = F.regexp_replace(_ticker(F.lit(None).cast("string"), F.col("file")), r"\.US$", "")
    n = {k: parse_number(F.col(k)) if k in raw.columns else F.lit(None).cast("double")
         for k in ("open", "high", "low", "close", "volume")}
    o, c = n["open"], n["close"]
    if policy == "repair":
        o, c = F.when(o > 0, o).otherwise(n["close"]), F.when(c > 0, c).otherwise(n["open"])
    rows = raw.select(tk.alias("tk"), F.trim("date").try_cast("date").alias("d"), r4(o).alias("o"),
                      r4(n["high"]).alias("h"), r4(n["low"]).alias("l"), r4(c).alias("c"),
                      n["volume"].cast("long").alias("v"), F.lit(PRICE_SOURCES[1]).alias("src"),
                      F.monotonically_increasing_id().alias("pos"))
    return _one_per_session(rows.where("d IS NOT NULL AND o > 0 AND c > 0"))


def read_bars_stooq_csv(spark: SparkSession, path: str, policy: str = "repair") -> DataFrame:
    raw = union_by_header(spark, path)
    if raw is None:
        raise ValueError(f"no files at {path}")
    return bars_from_csv_rows(raw.withColumn("file", F.input_file_name()), policy)


def bars_from_quote_tables(docs: DataFrame) -> DataFrame:
    """Quote-table documents (``file``, ``data``): ``MM/dd/yyyy`` dates and ``$1,234.5`` prices."""
    long = docs.select(_ticker(F.col("data.symbol"), F.col("file")).alias("tk"),
                       F.posexplode("data.tradesTable.rows").alias("pos", "b"))

    def price(field):
        return parse_number(F.regexp_replace(F.col(f"b.{field}"), "—|--", ""))

    parts = [F.regexp_extract(F.trim("b.date"), r"^(\d{2})/(\d{2})/(\d{4})$", i) for i in (3, 1, 2)]
    rows = long.select("tk", F.concat_ws("-", *parts).try_cast("date").alias("d"),
                       *_fill(price("open"), price("close")), r4(price("high")).alias("h"),
                       r4(price("low")).alias("l"), F.lit(None).cast("long").alias("v"),
                       F.lit(PRICE_SOURCES[2]).alias("src"), "pos")
    return _one_per_session(rows.where("d IS NOT NULL AND coalesce(o, c) IS NOT NULL"))


def read_bars_nasdaq_json(spark: SparkSession, path: str) -> DataFrame:
    docs = spark.read.json(path, schema=QUOTE_TABLE, multiLine=True)
    return bars_from_quote_tables(docs.withColumn("file", F.input_file_name()))
