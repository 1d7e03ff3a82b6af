"""Helpers shared by the text operators.

Conventions of every operator here: only the id and text columns named in the call are read, other
columns (whatever their names) are ignored or carried along unchanged; an operator that adds columns
replaces an input column of the same name; a null text counts as empty.
"""
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import materialize

#: A join side is broadcast only when its measured size is below this; beyond it the rows are shuffled.
BROADCAST_BYTES = 32 << 20

#: Whitespace of the word and line rules: space, tab, line feed, vertical tab, form feed, carriage return.
#: ``bytes.split()``, ``bytes.strip()`` and ``bytes.lower()`` of Python use this set and plain A-Z.
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


#: Text bytes that a task turns into Python values at once.
PORTION_BYTES = 8 << 20


def byte_list(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """The UTF-8 bytes of a string column; null as empty."""
    return [b or b"" for b in column.cast(pa.binary()).to_pylist()]


def portions(batch: pa.RecordBatch, place: int, limit: int = PORTION_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in stretches whose texts (column ``place``) take about ``limit`` bytes, one row at least."""
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(place)), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + limit, "right")))
        yield batch.slice(at, end - at)
        at = end


def free_names(columns: list[str], *wanted: str) -> list[str]:
    """The wanted names, each with as many underscores added as no name in ``columns`` (in any case) has."""
    used, out = {c.lower() for c in columns}, []
    for name in wanted:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        out.append(name)
    return out


def id_and_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The two columns an operator reads, under its own names."""
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))


def with_columns(docs: DataFrame, text_col: str, added: str, compute: Callable[[list[bytes]], dict[str, list]],
                 replaced_text: bool = False) -> DataFrame:
    """``docs`` with the columns of the DDL string ``added``, computed batch by batch from the text.

    ``compute`` gets the texts of one Arrow batch and returns a list per added column (and, with
    ``replaced_text``, one for the text column). All other columns pass through untouched, so repeated
    ids and rows without id need no join to keep their values.
    """
    extra = T.StructType.fromDDL(added)
    names = {f.name.lower() for f in extra}
    kept = docs.select([F.col(f"`{c}`") for c in docs.columns if c.lower() not in names])
    schema = T.StructType(kept.schema.fields + extra.fields)
    arrow = {f.name: _arrow_type(f.dataType) for f in extra}
    place = kept.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in portions(whole, place):
                got = compute(byte_list(batch.column(place)))
                columns = list(batch.columns)
                if replaced_text:
                    columns[place] = pa.array(got[text_col], pa.binary()).cast(batch.schema.field(place).type)
                columns += [pa.array(got[n], t) for n, t in arrow.items()]
                yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, *arrow])

    return kept.mapInArrow(run, schema)


def _arrow_type(kind: T.DataType) -> pa.DataType:
    return {T.LongType: pa.int64(), T.IntegerType: pa.int32(), T.DoubleType: pa.float64(), T.BooleanType: pa.bool_(),
            T.StringType: pa.string(), T.BinaryType: pa.binary()}[type(kind)]


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str], start: int = 1 << 15) -> Iterator[pa.Table]:
    """Tables of complete groups from batches sorted by ``keys``: the last group of a table is held back
    until its end has been seen. Memory: ``start`` rows plus the largest group."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows < start:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        cut = table.num_rows - 1
        last = [table.column(k)[cut].as_py() for k in keys]
        change = np.zeros(table.num_rows, bool)
        for k, v in zip(keys, last):
            change |= table.column(k).to_numpy() != v
        cut = int(np.flatnonzero(change)[-1]) + 1 if change.any() else 0
        if cut:
            yield table.slice(0, cut)
        held = table.slice(cut).to_batches()
        rows = table.num_rows - cut
        start = max(start, 2 * rows)
    if rows:
        yield pa.Table.from_batches(held).combine_chunks()


def measured_bytes(table: DataFrame) -> int:
    """Rows and variable-width bytes of a stored table, as a bound of what a broadcast of it would hold."""
    size: Column = F.lit(16 * len(table.columns))
    for f in table.schema:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(f"`{f.name}`"), F.lit(0))
        elif isinstance(f.dataType, T.ArrayType):
            size = size + 24 * F.coalesce(F.size(f"`{f.name}`"), F.lit(0))
    return table.agg(F.coalesce(F.sum(size.cast("long")), F.lit(0))).first()[0]


def sized(side: DataFrame, size: int) -> DataFrame:
    """``side`` marked for the join that suits ``size`` bytes: broadcast up to ``BROADCAST_BYTES``, else a sort-merge join, which
    spills and whose large partitions adaptive execution splits."""
    return F.broadcast(side) if size <= BROADCAST_BYTES else side.hint("merge")


def checked(side: DataFrame) -> DataFrame:
    """``side`` (a stored table) marked for the join that suits its measured size."""
    return sized(side, measured_bytes(side))


def smallest_hashes(rows: DataFrame, group: str, key: str, most: dict | int) -> DataFrame:
    """At most ``most`` rows per value of ``group`` (a number, or numbers by value), those with the smallest hash of
    ``key``. A share of each group a little above what is wanted is cut out before rows are ranked, so ranking a
    group handles a bounded number of rows however large the group is."""
    limit = F.lit(most) if isinstance(most, int) else F.coalesce(*[F.when(F.col(group) == v, n) for v, n in most.items()])
    counts = materialize(rows.groupBy(group).agg(F.count("*").alias("group_rows")), "group_rows")
    unit = F.pmod(F.xxhash64(key), F.lit(1 << 30)) / F.lit(float(1 << 30))
    near = rows.join(checked(counts), group).where(unit * F.col("group_rows") <= 2 * limit + 50)
    order = Window.partitionBy(group).orderBy(unit, key)
    return near.withColumn("place", F.row_number().over(order)).where(F.col("place") <= limit).select(rows.columns)


__all__ = ["BROADCAST_BYTES", "SPACE_CLASS", "WORD_PATTERN", "byte_list", "checked", "free_names", "id_and_text", "materialize",
           "measured_bytes", "portions", "sized", "smallest_hashes", "whole_groups", "with_columns"]
