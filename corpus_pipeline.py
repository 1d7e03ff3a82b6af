"""From documents to a training mix: five stages, each written as Parquet and read again by the next.

Each stage works on all rows that the one before kept and returns the columns of ``documents``; the last
returns the mix, a row per emitted copy with its number in ``copy``. What each stage does with nulls, empty
texts, repeated rows and empty tables is stated in its operator.
"""
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, line_dedup, mixing, near_copies, toxicity
from tidemark.session import materialize, table_path

#: Shingles of five words; near copies share 0.8 of their shingles. Fingerprints that differ in at most NEAR_BITS of 64 bits
#: are compared too, besides those that MinHash keys bring together.
SHINGLE_WORDS = 5
NEAR_BITS = 6
NEAR_SIMILARITY = 0.8


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject. It learns from the training fold of the labels."""
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3))
    model = toxicity.learn(docs, _read(spark, sf_dir, "labels").where(fold != 1))
    return toxicity.score(docs, model).where("predicted = 0").select(docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that another document keeps; n_chars follows the text."""
    kept = line_dedup.line_dedup(docs).select(docs.columns)
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else kept


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id."""
    return near_copies.keep_one(docs, width=SHINGLE_WORDS, bits=NEAR_BITS, similarity=NEAR_SIMILARITY)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.decontaminate(docs, _read(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each document as often as its source's rate takes it."""
    sized = docs.withColumn("size", mixing.size_column("text"))
    return mixing.emit(mixing.mix(sized)).select(*docs.columns, "size", "copy")


STAGES = [("toxicity", drop_toxic), ("line_dedup", drop_lines), ("simhash_near_dedup", drop_near_copies),
          ("benchmark_decontamination", drop_contaminated), ("source_mixing", mix_sources)]

# toxicity and near copies are beyond SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
