"""Quarterly bulk tables: four tab-separated members found by header name."""
import zipfile
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..schemas import RAW_TABLES, with_missing
from ..session import scratch_folder
from .headers import file_paths, read_by_header

_ALL_COLUMNS = list(dict.fromkeys(f.name for schema in RAW_TABLES.values() for f in schema.fields))
_UNZIPPED = StructType([StructField("member", StringType())]
                       + [StructField(c, StringType()) for c in _ALL_COLUMNS])


def _member(spark, folder, name):
    """One member of one quarter, columns by its own header; an absent member is an empty table."""
    # a file of that name in any case, or the part files of a folder of that name
    paths = file_paths(spark, folder, rf"(?i)/{name}\.tsv(/[^/]+)?$")
    if not paths:
        return spark.createDataFrame([], RAW_TABLES[name]).withColumn("line_no", F.lit(0).cast("long"))
    parts = [with_missing(part, RAW_TABLES[name]) for part in read_by_header(spark, paths, sep="\t", encoding="UTF-8", escape='"')]
    return reduce(DataFrame.unionByName, parts).withColumn("line_no", F.monotonically_increasing_id())


def read_bulk_tables(spark: SparkSession, *quarter_folders: str) -> dict[str, DataFrame]:
    """Extracted quarters. Files are read together only if their header lines are equal, so column order may
    differ between files, also below one folder; the result is one DataFrame per table, still splittable text scans."""
    return {name: reduce(DataFrame.unionByName, [_member(spark, q, name) for q in quarter_folders])
            for name in RAW_TABLES}


def _unzip(batches):
    import io
    for pdf in batches:
        for blob in pdf["content"]:
            with zipfile.ZipFile(io.BytesIO(blob)) as archive:
                for item in archive.namelist():
                    name = item.rsplit("/", 1)[-1].upper().removesuffix(".TSV")
                    if name not in RAW_TABLES:
                        continue
                    with archive.open(item) as fh:
                        for part in pd.read_csv(fh, sep="\t", dtype=str, keep_default_na=False, chunksize=20_000,
                                                encoding="utf-8", encoding_errors="replace"):
                            part = part.reindex(columns=_ALL_COLUMNS)
                            part.insert(0, "member", name)
                            part = part.astype(object)
                            yield part.where(part.notna(), None)


def read_bulk_archives(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Zipped quarters. A zip cannot be split, so one archive is one task, streamed out in pieces; each is unzipped once, when this
    is called, into a stored table with a folder per member. The four tables read their own folder, split as Spark likes;
    ``line_no`` follows the order of an archive's lines. No archive, or none with a member: an empty table."""
    archives = (spark.read.format("binaryFile").option("pathGlobFilter", "*.[zZ][iI][pP]")
                .option("recursiveFileLookup", "true").load(path).select("content"))
    folder = scratch_folder(spark, "archives")
    rows = archives.mapInPandas(_unzip, _UNZIPPED).withColumn("line_no", F.monotonically_increasing_id())
    rows.write.partitionBy("member").parquet(folder)
    stored = spark.read.schema(rows.schema).parquet(folder)
    return {name: with_missing(stored.where(F.col("member") == name), StructType([*schema.fields, StructField("line_no", LongType())]))
            for name, schema in RAW_TABLES.items()}
