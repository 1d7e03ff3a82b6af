"""Adapter: the star-schema test tables read as filings and price bars.

Spark and SQL spellings of the same mapping live side by side so that every operator can be compared with
an independent SQL statement over the same parquet files.
"""
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window as W

from ..functions.labels import code_side, code_text
from ..schemas import TRADES, with_missing
from ..session import freed, materialize, scratch_folder, table_path

ASOF = "2000-12-31"
BOOK_END = "2002-01-31"
TARGET_YEAR, AUDIT_ASOF = 2001, "2002-01-15"

# Thresholds that suit the size of the test values.
LARGE, SYNC, CLUSTER, NONCASH, OVERLAP = 90_000.0, 50_000.0, 25_000.0, 40.0, 25_000.0


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(folder, name))


def _when(pairs, otherwise):
    out = None
    for cond, value in pairs:
        out = (F if out is None else out).when(cond, F.lit(value))
    return out.otherwise(otherwise if not isinstance(otherwise, str) else F.lit(otherwise))


def trades_from(lineitem: DataFrame, spark: SparkSession, folder: str) -> DataFrame:
    """Also accepts a streaming ``lineitem``: the other tables are static."""
    o = table(spark, folder, "orders")
    p = table(spark, folder, "part").select("p_partkey", "p_type")
    c = table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    x = (lineitem.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
         .join(p, F.col("l_partkey") == F.col("p_partkey")).join(c, F.col("o_custkey") == F.col("c_custkey")))
    fd = F.col("o_orderdate").cast("date")
    kind = F.concat("l_returnflag", "l_linestatus")
    code = _when([(kind == "AF", "S"), (kind.isin("AO", "RF"), "P"), (kind == "NF", "A"), (kind == "NO", "M")], "G")
    segment = F.col("c_mktsegment")
    officer = segment.isin("MACHINERY", "FURNITURE")
    unpriced = kind.isin("NF", "RO")
    late = F.when(F.col("l_orderkey") % 53 == 0, F.lit(10)).otherwise(F.lit(0))
    indirect = F.col("l_linenumber") % 3 == 0
    rows = x.select(
        fd.alias("fd"), F.date_add(F.date_sub(fd, F.col("l_linenumber")), late).alias("td"),
        F.last_day(F.add_months(F.trunc(fd, "quarter"), 2)).alias("period"),
        F.when(F.col("o_orderstatus") == "P", F.lit("5")).otherwise(F.lit("4")).alias("form"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit(1)).otherwise(F.lit(0)).alias("amend"),
        F.format_string("%010d-%02d-%06d", F.col("o_custkey"), (F.year("o_orderdate") % 100).cast("int"), F.col("l_orderkey")).alias("acc"),
        F.concat(F.lit("Issuer "), F.col("l_suppkey").cast("string")).alias("co"),
        F.when(F.col("l_suppkey") % 50 == 49, F.lit("")).otherwise(F.concat(F.lit("S"), F.col("l_suppkey").cast("string"))).alias("tk"),
        F.col("l_suppkey").cast("string").alias("icik"),
        F.concat(F.lit("Owner "), F.col("o_custkey").cast("string")).alias("insider"),
        F.col("o_custkey").cast("string").alias("pcik"), F.lit(1).alias("own_n"),
        _when([(segment == "BUILDING", "Director"), (segment == "MACHINERY", "Officer"),
               (segment == "FURNITURE", "Director/Officer"), (segment == "HOUSEHOLD", "10% Owner")], "Unknown").alias("rel"),
        F.when(officer, _when([(F.col("o_custkey") % 4 == 0, "Chief Executive Officer"), (F.col("o_custkey") % 4 == 1, "CFO"),
                               (F.col("o_custkey") % 4 == 2, "President")], "General Counsel")).otherwise(F.lit("")).alias("title"),
        code.alias("code"), code_text(code).alias("ct"), code_side(code).alias("side"),
        _when([(F.col("p_type") == "PROMO", "Warrant"), (F.col("p_type") == "SMALL", "Class C Capital Stock"),
               (F.col("p_type") == "LARGE", "American Depositary Shares")], "Common Stock").alias("sec"),
        F.col("l_quantity").alias("sh"),
        F.when(~unpriced, F.col("l_extendedprice") / F.col("l_quantity")).alias("px"),
        F.when(~unpriced, F.col("l_extendedprice") + F.when(F.col("l_orderkey") % 101 == 0, F.lit(1)).otherwise(F.lit(0))).alias("val"),
        F.when(code.isin("P", "A", "M"), F.lit("A")).otherwise(F.lit("D")).alias("ad"),
        F.when(F.col("l_partkey") % 11 != 0, F.col("l_quantity") * 100 + F.col("l_partkey")).alias("af"),
        F.when(indirect, F.lit("I")).otherwise(F.lit("D")).alias("di"),
        F.when(indirect, F.lit("By Trust")).otherwise(F.lit("")).alias("nature"),
        F.when(kind == "NO", F.lit(1)).otherwise(F.lit(0)).alias("der"),
        (F.col("l_linenumber").cast("long") * 1_000_000_000_000 + F.col("l_partkey") * 100 + F.col("l_quantity").cast("long")).alias("pos"))
    return with_missing(rows, TRADES)


class Stored(str):
    """A folder of test tables whose canonical tables have been stored; queries take it in place of the folder."""
    paths: dict


def store(spark: SparkSession, folder: str) -> Stored:
    """Ingest once: write the canonical tables of ``folder`` to shared scratch, so that queries given the result
    read them like a deployment reads its stored trade and bar tables."""
    stored, more = priced(spark, folder), Stored(folder)
    more.paths = {**stored.paths, "trades": _put(trades(spark, stored), "trades")}
    return more


def priced(spark: SparkSession, folder: str) -> Stored:
    """``folder`` with its bars and splits stored, for queries that read them more than once."""
    if isinstance(folder, Stored):
        return folder
    events = materialize(_events(_raw_bars(spark, folder)), "events")
    stored = Stored(folder)
    stored.paths = {"bars": _put(_bars(events), "bars"), "splits": _put(_splits(events), "splits")}
    return stored


def _put(df: DataFrame, name: str) -> tuple:
    path = scratch_folder(df.sparkSession, name)
    with freed(df.sparkSession):
        df.write.parquet(path)
    return path, df.schema


def _stored(spark, folder, name):
    if isinstance(folder, Stored) and name in folder.paths:
        path, schema = folder.paths[name]
        return spark.read.schema(schema).parquet(path)


def trades(spark: SparkSession, folder: str) -> DataFrame:
    stored = _stored(spark, folder, "trades")
    return stored if stored is not None else trades_from(table(spark, folder, "lineitem"), spark, folder)


TRADES_SQL = """trades AS (
  SELECT fd, fd - l_linenumber::INT + CASE WHEN l_orderkey % 53 = 0 THEN 10 ELSE 0 END AS td,
    (date_trunc('quarter', fd) + INTERVAL 3 MONTH - INTERVAL 1 DAY)::DATE AS period,
    CASE WHEN o_orderstatus = 'P' THEN '5' ELSE '4' END AS form,
    CASE WHEN o_orderpriority = '5-LOW' THEN 1 ELSE 0 END AS amend,
    printf('%010d-%02d-%06d', o_custkey, CAST(year(fd) % 100 AS INT), l_orderkey) AS acc,
    'Issuer ' || l_suppkey AS co, CASE WHEN l_suppkey % 50 = 49 THEN '' ELSE 'S' || l_suppkey END AS tk,
    CAST(l_suppkey AS VARCHAR) AS icik, 'Owner ' || o_custkey AS insider, CAST(o_custkey AS VARCHAR) AS pcik, 1 AS own_n,
    CASE c_mktsegment WHEN 'BUILDING' THEN 'Director' WHEN 'MACHINERY' THEN 'Officer' WHEN 'FURNITURE' THEN 'Director/Officer'
         WHEN 'HOUSEHOLD' THEN '10% Owner' ELSE 'Unknown' END AS rel,
    CASE WHEN c_mktsegment IN ('MACHINERY', 'FURNITURE') THEN
         CASE o_custkey % 4 WHEN 0 THEN 'Chief Executive Officer' WHEN 1 THEN 'CFO' WHEN 2 THEN 'President' ELSE 'General Counsel' END
         ELSE '' END AS title,
    code, sec, sh, px, val,
    CASE code WHEN 'P' THEN 'buy' WHEN 'S' THEN 'sell' WHEN 'A' THEN 'grant' WHEN 'M' THEN 'exercise' ELSE 'gift' END AS side,
    CASE WHEN code IN ('P', 'A', 'M') THEN 'A' ELSE 'D' END AS ad,
    CASE WHEN l_partkey % 11 <> 0 THEN l_quantity * 100 + l_partkey END AS af,
    CASE WHEN l_linenumber % 3 = 0 THEN 'I' ELSE 'D' END AS di, CASE WHEN l_linenumber % 3 = 0 THEN 'By Trust' ELSE '' END AS nature,
    CASE WHEN kind = 'NO' THEN 1 ELSE 0 END AS der,
    CAST(l_linenumber AS BIGINT) * 1000000000000 + l_partkey * 100 + CAST(l_quantity AS BIGINT) AS pos
  FROM (SELECT *, CAST(o_orderdate AS DATE) AS fd, l_returnflag || l_linestatus AS kind,
          CASE l_returnflag || l_linestatus WHEN 'AF' THEN 'S' WHEN 'AO' THEN 'P' WHEN 'RF' THEN 'P' WHEN 'NF' THEN 'A'
               WHEN 'NO' THEN 'M' ELSE 'G' END AS code,
          CASE p_type WHEN 'PROMO' THEN 'Warrant' WHEN 'SMALL' THEN 'Class C Capital Stock'
               WHEN 'LARGE' THEN 'American Depositary Shares' ELSE 'Common Stock' END AS sec,
          l_quantity AS sh,
          CASE WHEN l_returnflag || l_linestatus NOT IN ('NF', 'RO') THEN l_extendedprice / l_quantity END AS px,
          CASE WHEN l_returnflag || l_linestatus NOT IN ('NF', 'RO')
               THEN l_extendedprice + CASE WHEN l_orderkey % 101 = 0 THEN 1 ELSE 0 END END AS val
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
             JOIN customer ON o_custkey = c_custkey))"""


def _raw_bars(spark, folder):
    li = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                                                 "l_extendedprice", "l_shipdate")
    p = table(spark, folder, "part").select("p_partkey", "p_retailprice")
    order = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")
    return (li.withColumn("d", F.col("l_shipdate").cast("date"))
            .where(~((F.col("l_suppkey") % 10 == 9) & (F.col("d") > "1999-12-31")))
            .join(p, F.col("l_partkey") == F.col("p_partkey"))
            .repartition("l_suppkey", "d")                  # few rows share a day: partial groups would only be wider than rows
            .groupBy("l_suppkey", "d").agg(F.min_by("p_retailprice", order).alias("o"), F.max_by("p_retailprice", order).alias("c"),
                                           F.count(F.lit(1)).alias("v")))


def _events(raw):
    n = F.row_number().over(W.partitionBy("l_suppkey").orderBy("d"))
    last = F.col("l_suppkey") % 20
    return (raw.withColumn("n", n)
            .withColumn("ev", F.max(F.when((F.col("n") == 200) & ((F.col("l_suppkey") % 5 == 0) | (last == 3)), F.col("d")))
                        .over(W.partitionBy("l_suppkey"))))


def bars(spark: SparkSession, folder: str) -> DataFrame:
    stored = _stored(spark, folder, "bars")
    return stored if stored is not None else _bars(_events(_raw_bars(spark, folder)))


def _bars(events):
    last = F.col("l_suppkey") % 20
    factor = F.when(F.col("d") >= F.col("ev"), _when([(last.isin(0, 3), 10.0), (last == 10, 4.0)], F.lit(1.0))).otherwise(F.lit(1.0))
    return events.select(
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("tk"), "d", (F.col("o") * factor).alias("o"),
        (F.col("c") * factor).alias("c"), "v", F.lit("yahoo").alias("src"))


def splits(spark: SparkSession, folder: str) -> DataFrame:
    stored = _stored(spark, folder, "splits")
    return stored if stored is not None else _splits(_events(_raw_bars(spark, folder)))


def _splits(events):
    return (events.where((F.col("d") == F.col("ev")) & (F.col("l_suppkey") % 5 == 0))
            .select(F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("tk"), "d", F.lit(1.0).alias("num"), F.lit(10.0).alias("den")))


BARS_SQL = """raw_bars AS (
  SELECT l_suppkey AS sk, CAST(l_shipdate AS DATE) AS d,
    arg_min(p_retailprice, ROW(l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice)) AS o,
    arg_max(p_retailprice, ROW(l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice)) AS c, count(*) AS v
  FROM lineitem JOIN part ON l_partkey = p_partkey
  WHERE NOT (l_suppkey % 10 = 9 AND CAST(l_shipdate AS DATE) > DATE '1999-12-31') GROUP BY 1, 2),
numbered AS (SELECT *, row_number() OVER (PARTITION BY sk ORDER BY d) AS n FROM raw_bars),
event_days AS (SELECT sk AS esk, d AS ev FROM numbered WHERE n = 200 AND (sk % 5 = 0 OR sk % 20 = 3)),
bars AS (SELECT 'S' || sk AS tk, sk, d, o * f AS o, c * f AS c, v FROM (
  SELECT *, CASE WHEN d >= ev THEN CASE WHEN sk % 20 IN (0, 3) THEN 10.0::DOUBLE WHEN sk % 20 = 10 THEN 4.0::DOUBLE ELSE 1.0::DOUBLE END
            ELSE 1.0::DOUBLE END AS f
  FROM raw_bars LEFT JOIN event_days ON sk = esk)),
splits AS (SELECT 'S' || esk AS tk, ev AS d, 1.0::DOUBLE AS num, 10.0::DOUBLE AS den FROM event_days WHERE esk % 5 = 0)"""
