"""Line dedup: lines that many documents share stay in one of them.

Lines are exploded and normalised (ASCII whitespace stripped at both ends, A-Z lower-cased), long enough
ones are hashed to 128 bits, distinct documents are counted per hash, and the lines of hashes over the threshold are
dropped everywhere but in the document with the largest id. Only hashes held by enough rows, counted with map-side
partial sums, have their documents told apart, (hash, document) by (hash, document). What is dropped travels back as
hashes per document; texts are put together again by line position.

Edge cases: a null or empty text is one empty line; very long texts are split whole; a line repeated within a document
counts once, and all its copies share its fate; rows with the same id are one document and share what stays; each
row without id is a document of its own, ranks below all others, and a line that only such rows hold stays; extra
columns pass through whatever their names, but for n_lines and n_dropped, which are replaced; an empty table gives an
empty result.
"""
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import byte_list, checked, free_names, id_and_text, materialize, portions

MIN_POINTS = 40
MIN_DOCS = 5


def line_key(line: bytes, min_points: int) -> bytes | None:
    """128-bit hash of the normalised line, None when it has fewer than ``min_points`` code points."""
    key = line.strip().lower()
    if len(key) < min_points or len(key) < 4 * min_points and len(key.decode("utf-8", "replace")) < min_points:
        return None
    return xxhash.xxh128_digest(key)


def frequent_lines(docs: DataFrame, id_col: str, text_col: str, min_points: int, min_docs: int) -> DataFrame:
    """(doc_id, mark, keys): per document the hashes of lines that it loses; ``mark`` tells texts without id apart."""
    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in portions(whole, 1):
                at, keys = [], []
                for row, text in enumerate(byte_list(batch.column(1))):
                    own = {k for k in (line_key(x, min_points) for x in text.split(b"\n")) if k is not None}
                    at += [row] * len(own)
                    keys += own
                at = pa.array(at, pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(2).take(at), pa.array(keys, pa.binary())], names=["doc_id", "mark", "key"])

    lines = id_and_text(docs, id_col, text_col).withColumn("mark", _mark(F.col("doc_id"), F.col("text")))
    lines = materialize(lines.mapInArrow(explode, T.StructType([lines.schema["doc_id"], T.StructField("mark", T.LongType()), T.StructField("key", T.BinaryType())])), "lines")
    many = checked(materialize(lines.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") >= min_docs).select("key"), "line_candidates"))
    holders = lines.join(many, "key").groupBy("key", "doc_id").agg(F.count("*").alias("rows"))
    documents = F.sum(F.when(F.col("doc_id").isNull(), F.col("rows")).otherwise(1))
    frequent = holders.groupBy("key").agg(documents.alias("n"), F.max("doc_id").alias("keeper")).where((F.col("n") >= min_docs) & F.col("keeper").isNotNull())
    # stored first: then the lines of a very common key can be broadcast to or split, which an aggregate's own partitions cannot
    return (lines.join(checked(materialize(frequent.select("key", "keeper"), "frequent_lines")), "key").where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
            .groupBy("doc_id", "mark").agg(F.collect_set("key").alias("keys")))


def _mark(doc_id: Column, text: Column) -> Column:
    return F.when(doc_id.isNull(), F.xxhash64(F.coalesce(text, F.lit("")))).otherwise(F.lit(0).cast("long"))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_points: int = MIN_POINTS, min_docs: int = MIN_DOCS) -> DataFrame:
    """All columns of ``docs`` with the text shortened, and n_lines (before), n_dropped."""
    added = ("n_lines", "n_dropped")
    kept = docs.select([F.col(f"`{c}`") for c in docs.columns if c.lower() not in added])
    loser, text_mark, losing = free_names(kept.columns, "loser", "loser_mark", "line_keys")
    losers = materialize(frequent_lines(docs, id_col, text_col, min_points, min_docs).select(
        F.col("doc_id").alias(loser), F.col("mark").alias(text_mark), F.col("keys").alias(losing)), "dropped_lines")
    own = F.col(f"`{id_col}`")
    on = own.eqNullSafe(F.col(loser)) & (_mark(own, F.col(f"`{text_col}`").cast("string")) == F.col(text_mark))
    marked = kept.join(checked(losers), on, "left").drop(loser, text_mark)
    place, marks = kept.columns.index(text_col), len(kept.columns)
    schema = T.StructType([*kept.schema.fields, T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in portions(whole, place):
                texts, n_lines, n_dropped = batch.column(place).cast(pa.binary()).to_pylist(), [], []
                for row, keys in enumerate(batch.column(marks)):
                    lines = (texts[row] or b"").split(b"\n")
                    n_lines.append(len(lines))
                    if keys.is_valid:
                        gone = set(keys.as_py())
                        left = [x for x in lines if line_key(x, min_points) not in gone]
                        n_dropped.append(len(lines) - len(left))
                        texts[row] = b"\n".join(left)
                    else:
                        n_dropped.append(0)
                columns = [*batch.columns[:place], pa.array(texts, pa.binary()).cast(batch.schema.field(place).type), *batch.columns[place + 1:marks]]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())],
                                                 names=[*batch.schema.names[:marks], *added])

    return marked.mapInArrow(rebuild, schema)
