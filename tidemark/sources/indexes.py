"""Filing lists: the daily pipe-separated index and full-text-search result pages."""
from itertools import chain

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window as W

from ..fixed_values import INDEX_FORMS
from ..functions.calendar import compact_date

_ACC = r"(\d{10}-\d{2}-\d{6})\.txt$"
_HITS = ("hits STRUCT<hits: ARRAY<STRUCT<_id: STRING, _source: STRUCT<adsh: STRING, form_type: STRING, "
         "file_type: STRING, file_date: STRING, ciks: ARRAY<STRING>>>>>")


def dedupe_by_accession(df: DataFrame, *order) -> DataFrame:
    """One row per accession, the first by ``order``. ``row_number() = 1`` lets Spark drop losers before
    the shuffle (window group limit), so an accession repeated in half the input is not a hot key."""
    w = W.partitionBy("acc").orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def _form_columns(form):
    roots = F.create_map(*[F.lit(x) for x in chain.from_iterable((k, v[0]) for k, v in INDEX_FORMS.items())])
    flags = F.create_map(*[F.lit(x) for x in chain.from_iterable((k, v[1]) for k, v in INDEX_FORMS.items())])
    return roots[form].alias("form"), flags[form].alias("amend")


def _in_file_order(rows: DataFrame) -> DataFrame:
    """``line_no`` by file name and place in the file, however the scan deals files to tasks."""
    at = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
                  F.monotonically_increasing_id().alias("n"))
    return rows.select("*", at.alias("line_no"))


def parse_daily_index(lines: DataFrame) -> DataFrame:
    """Five-field lines (cik, name, form, filed, file) with an order column ``line_no``."""
    form, file = F.trim("form"), F.trim("file")
    kept = (lines.where(F.col("file").isNotNull() & F.col("extra").isNull() & form.isin(list(INDEX_FORMS)))
            .withColumn("acc", F.regexp_extract(file, _ACC, 1)).where("acc <> ''"))
    return (dedupe_by_accession(kept, "line_no")
            .select("acc", file.alias("path"), *_form_columns(form), compact_date(F.col("filed")).alias("fd")))


def read_daily_index(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.csv(path, sep="|", quote="", encoding="ISO-8859-1",
                           schema="cik STRING, name STRING, form STRING, filed STRING, file STRING, extra STRING")
    return parse_daily_index(_in_file_order(lines))


def parse_search_hits(pages: DataFrame) -> DataFrame:
    """Pages with a ``hits`` struct and an order column ``line_no`` -> the same record shape as the index."""
    hit = pages.select("line_no", F.posexplode("hits.hits").alias("n", "h"))
    src = F.col("h._source")
    acc = F.coalesce(F.nullif(F.trim(src["adsh"]), F.lit("")), F.trim(F.split(F.col("h._id"), ":")[0]))
    form = F.trim(F.coalesce(F.nullif(src["form_type"], F.lit("")), src["file_type"]))
    kept = (hit.withColumn("acc", acc).withColumn("form0", form)
            .where(F.concat("acc", F.lit(".txt")).rlike(_ACC) & F.col("form0").isin(list(INDEX_FORMS))))
    first = F.get(src["ciks"], 0)
    cik = F.when(first.isNotNull(), F.coalesce(F.nullif(F.ltrim(first, F.lit("0")), F.lit("")), F.lit("0"))
                 ).otherwise(F.ltrim(F.substring_index("acc", "-", 1), F.lit("0")))
    path = F.concat(F.lit("edgar/data/"), cik, F.lit("/"), F.translate("acc", "-", ""), F.lit("/"), F.col("acc"),
                    F.lit(".txt"))
    return (dedupe_by_accession(kept, "line_no", "n")
            .select("acc", path.alias("path"), *_form_columns(F.col("form0")),
                    compact_date(src["file_date"]).alias("fd")))


def read_search_hits(spark: SparkSession, path: str) -> DataFrame:
    pages = spark.read.json(path, schema=_HITS, multiLine=True)
    return parse_search_hits(_in_file_order(pages))
