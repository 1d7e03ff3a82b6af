"""Exact dedup with counting quotient filters.

Every partition builds a counting quotient filter over the 64-bit fingerprints of its texts: a
fingerprint is cut into a quotient (the slot) and a remainder; the filter keeps, per occupied slot, the
run of sorted remainders with their counts. Fingerprint and filter entry determine each other, so filters
merge without loss by merging the sorted remainders of equal quotients and adding counts. A fingerprint
that counts one in the merged filter belongs to a unique text. The others are routed to a second read of
the documents where whole normalised texts are compared byte by byte.

Edge cases: a null text equals the empty text; a null id sorts after every other id; of repeated rows
with the same id and text exactly one is kept; an empty table gives an empty result.
"""
import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import checked, id_and_text, materialize, with_columns

#: Fingerprints that one block of the merged filter holds on average; more rows make more blocks.
BLOCK_FINGERPRINTS = 1 << 17
#: Bits of the quotient within a block, at most.
SLOT_BITS = 17
_SPACE_RUN = re.compile(rb"[\x20\x09-\x0D]+")


def normalise(text: bytes) -> bytes:
    """Each run of ASCII whitespace becomes one space."""
    return _SPACE_RUN.sub(b" ", text)


def _fingerprint(text: bytes) -> int:
    return int.from_bytes(xxhash.xxh3_64_digest(text), "big", signed=True)


class QuotientFilter:
    """The filled slots of a counting quotient filter: ``slots`` are the occupied quotients in order,
    ``runs`` the length of each slot's run, ``remainders`` and ``counts`` the runs one after another,
    remainders rising within a run."""

    def __init__(self, slots: np.ndarray, runs: np.ndarray, remainders: np.ndarray, counts: np.ndarray):
        self.slots, self.runs, self.remainders, self.counts = slots, runs, remainders, counts

    @classmethod
    def of_sorted(cls, quotients: np.ndarray, remainders: np.ndarray, counts: np.ndarray) -> "QuotientFilter":
        """From entries sorted by (quotient, remainder); equal entries fall together, their counts add up."""
        if not len(quotients):
            return cls(quotients, np.zeros(0, np.int64), remainders, counts)
        new = np.r_[True, (quotients[1:] != quotients[:-1]) | (remainders[1:] != remainders[:-1])]
        first = np.flatnonzero(new)
        quotients, remainders, counts = quotients[first], remainders[first], np.add.reduceat(counts, first)
        starts = np.flatnonzero(np.r_[True, quotients[1:] != quotients[:-1]])
        return cls(quotients[starts], np.diff(np.r_[starts, len(quotients)]), remainders, counts)

    def entries(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return np.repeat(self.slots, self.runs), self.remainders, self.counts

    def packed(self) -> list[bytes]:
        return [self.slots.astype(np.uint32).tobytes(), self.runs.astype(np.uint32).tobytes(),
                self.remainders.astype(np.uint64).tobytes(), self.counts.astype(np.int64).tobytes()]

    @classmethod
    def unpacked(cls, slots: bytes, runs: bytes, remainders: bytes, counts: bytes) -> "QuotientFilter":
        return cls(np.frombuffer(slots, np.uint32), np.frombuffer(runs, np.uint32).astype(np.int64),
                   np.frombuffer(remainders, np.uint64), np.frombuffer(counts, np.int64))


def merge(filters: list[QuotientFilter]) -> QuotientFilter:
    """Lossless merge. The runs are sorted already, which the stable sort makes use of."""
    quotients, remainders, counts = (np.concatenate(x) for x in zip(*(f.entries() for f in filters)))
    order = np.lexsort((remainders, quotients))
    return QuotientFilter.of_sorted(quotients[order], remainders[order], counts[order])


def _cut(fingerprints: np.ndarray, block_bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Block, quotient within the block, remainder of unsigned fingerprints."""
    rest = np.uint64(64 - block_bits - SLOT_BITS)
    block = (fingerprints >> np.uint64(64 - block_bits)).astype(np.int64) if block_bits else np.zeros(len(fingerprints), np.int64)
    return block, (fingerprints >> rest) & np.uint64((1 << SLOT_BITS) - 1), fingerprints & np.uint64((1 << int(rest)) - 1)


def repeated_fingerprints(fingerprints: DataFrame, column: str) -> DataFrame:
    """(fp, n) of the values of a long column that occur more than once, through per-partition filters."""
    block_bits = max(0, math.ceil(math.log2(max(1, fingerprints.count()) / BLOCK_FINGERPRINTS)))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values = [b.column(0).to_numpy().view(np.uint64) for b in batches if b.num_rows]
        if not values:
            return
        found, counts = np.unique(np.concatenate(values), return_counts=True)
        block, quotient, remainder = _cut(found, block_bits)
        edges = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
        parts = [(int(block[a]), *QuotientFilter.of_sorted(quotient[a:b], remainder[a:b], counts[a:b]).packed())
                 for a, b in zip(edges, np.r_[edges[1:], len(block)])]
        for at in range(0, len(parts), 1024):
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*parts[at:at + 1024]), [pa.int64(), *[pa.binary()] * 4])],
                                             names=["block", "slots", "runs", "remainders", "counts"])

    def join(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        whole = merge([QuotientFilter.unpacked(*r) for r in rows[["slots", "runs", "remainders", "counts"]].itertuples(index=False)])
        quotient, remainder, counts = whole.entries()
        more = counts > 1
        rest = np.uint64(64 - block_bits - SLOT_BITS)
        top = np.uint64(int(key[0]) << (64 - block_bits)) if block_bits else np.uint64(0)
        value = top | (quotient[more].astype(np.uint64) << rest) | remainder[more]
        return pd.DataFrame({"fp": value.view(np.int64), "n": counts[more]})

    filters = fingerprints.select(column).mapInArrow(build, "block long, slots binary, runs binary, remainders binary, counts binary")
    return filters.groupBy("block").applyInPandas(join, "fp long, n long")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256 (of the normalised text)."""
    texts = id_and_text(docs, id_col, text_col)

    def digest(batch: list[bytes]) -> dict[str, list]:
        plain = [normalise(t) for t in batch]
        return {"fp": [_fingerprint(t) for t in plain], "text_sha256": [hashlib.sha256(t).hexdigest() for t in plain]}

    def plain_text(batch: list[bytes]) -> dict[str, list]:
        plain = [normalise(t) for t in batch]
        return {"fp": [_fingerprint(t) for t in plain], "plain": plain}

    digests = materialize(with_columns(texts, "text", "fp long, text_sha256 string", digest).drop("text")
                          .withColumn("row_id", F.monotonically_increasing_id()), "digests")
    repeated = checked(materialize(repeated_fingerprints(digests, "fp"), "repeated").select("fp"))
    compared = (with_columns(texts, "text", "fp long, plain binary", plain_text).select("fp", "plain")
                .join(repeated, "fp", "left_semi")
                .groupBy("fp", "plain").agg(F.count("*").alias("group_size"))
                .select("fp", F.sha2("plain", 256).alias("text_sha256"), "group_size"))
    first = (digests.join(repeated, "fp", "left_semi").groupBy("fp", "text_sha256")
             .agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_id")).alias("first")))
    groups = materialize(compared.join(first, ["fp", "text_sha256"]), "groups")
    found = F.col("group_size").isNotNull()
    return (digests.join(groups, ["fp", "text_sha256"], "left")
            .select("doc_id", F.when(found, F.col("first.doc_id")).otherwise(F.col("doc_id")).alias("keep_id"),
                    F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
                    F.coalesce(F.col("first.row_id") == F.col("row_id"), F.lit(True)).alias("kept"), "text_sha256"))
