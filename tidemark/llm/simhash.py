"""SimHash near-dedup: fingerprints, links up to a Hamming radius found with pivot distance tables, classes.

1. A fingerprint per document (64 bits, one if set in over half of the shingle hashes). Equal fingerprints
   collapse first, so thousands of copies are one row from there on.
2. Places to look: the 64 bits are cut into radius + 2 parts. Two fingerprints within the radius differ in
   at most ``radius`` parts, so they agree on two whole parts; each pair of parts is a key. This loses no link.
3. Within a key, a pivot distance table: the Hamming distances of every fingerprint to reference
   fingerprints. By the triangle inequality two fingerprints within the radius differ by no more than the
   radius in every coordinate; a pair with a larger coordinate difference is discarded, survivors are verified by
   their exact distance. Small groups are compared by rising offset. Large ones (a cluster of near copies) are
   searched breadth first, which yields a spanning forest of their links, not all pairs.
4. A key with more than ``CHUNK`` fingerprints is cut into chunks by hash, and every two chunks meet in a task
   of their own, so no task holds more than two chunks of a key.
5. Connected components over the links between different fingerprints.

Edge cases: a text without words has fingerprint zero and links like any other; fewer words than a shingle
make one shingle; a null id sorts after every other id and is a component id only where no id is known;
repeated rows fall into one component; an empty table gives an empty result.
"""
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import checked, free_names, id_and_text, materialize, whole_groups, with_columns
from tidemark.llm.components import components
from tidemark.session import unmeasured

WIDTH = 4
RADIUS = 4
#: Seed of the shingle hash.
HASH_SEED = 42
#: Fingerprints of one key that a task holds at once, times two.
CHUNK = 4096
#: Groups up to this size are compared by offset.
SMALL = 24
#: Reference fingerprints of the pivot table.
PIVOTS = 8
_BLOCK = 1 << 15


def shingle_hashes(text: bytes, width: int) -> np.ndarray:
    """XXH64 of the word shingles, repeats included."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    flat = b" ".join(words)
    if len(words) <= width:
        return np.array([xxhash.xxh64_intdigest(flat, HASH_SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.r_[0, ends[:-width]].tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(flat[a:b], HASH_SEED) for a, b in zip(starts, (ends[width - 1:] - 1).tolist())), np.uint64, len(starts))


def fold(hashes: np.ndarray) -> int:
    """The fingerprint of shingle hashes as a signed 64-bit number."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _BLOCK):
        bits = np.unpackbits(hashes[at:at + _BLOCK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view(np.int64)[0])


def simhash(text: bytes, width: int = WIDTH) -> int:
    """The fingerprint as a signed 64-bit number."""
    return fold(shingle_hashes(text, width))


def with_fingerprint(docs: DataFrame, text_col: str, width: int, name: str = "fingerprint") -> DataFrame:
    return with_columns(docs, text_col, f"{name} long", lambda texts: {name: [simhash(t, width) for t in texts]})


def pivots(count: int = PIVOTS) -> np.ndarray:
    """Fixed pseudo-random reference fingerprints."""
    return np.array([xxhash.xxh64_intdigest(f"pivot {i}") for i in range(count)], np.uint64)


def distance_table(fingerprints: np.ndarray, references: np.ndarray) -> np.ndarray:
    """Distances to each reference fingerprint, one row per reference."""
    return np.stack([np.bitwise_count(fingerprints ^ p) for p in references]).astype(np.int8)


def _survivors(table: np.ndarray, values: np.ndarray, left: np.ndarray, right: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Of candidate pairs (positions), those that pass every pivot coordinate and then the exact distance."""
    for row in table:
        near = np.abs(row[left] - row[right]) <= radius
        left, right = left[near], right[near]
    near = np.bitwise_count(values[left] ^ values[right]) <= radius
    return left[near], right[near]


def _small_pairs(group: np.ndarray, size: np.ndarray, values: np.ndarray, table: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links within the small groups of a sorted batch, by rising offset between the two rows."""
    rows = np.flatnonzero(size <= SMALL)
    for offset in range(1, SMALL):
        left = rows[rows + offset < len(group)]
        left = left[group[left] == group[left + offset]]
        if not len(left):
            return
        rows = left
        yield _survivors(table, values, left, left + offset, radius)


def _forest(values: np.ndarray, table: np.ndarray, radius: int) -> tuple[list[int], list[int]]:
    """A spanning forest of the links within one large group: rows in order of the first pivot's distance, so
    that those within the radius lie in one stretch; each reached row is compared with the rows not yet reached."""
    order = np.argsort(table[0], kind="stable")
    first = table[0][order]
    waiting = np.ones(len(order), bool)
    low, high = np.searchsorted(first, first - radius, "left"), np.searchsorted(first, first + radius, "right")
    left, right = [], []
    for start in range(len(order)):
        if not waiting[start]:
            continue
        waiting[start] = False
        queue = [start]
        while queue:
            at = queue.pop()
            others = low[at] + np.flatnonzero(waiting[low[at]:high[at]])
            if not len(others):
                continue
            _, found = _survivors(table[1:], values, np.full(len(others), order[at]), order[others], radius)
            if len(found):
                met = others[np.isin(order[others], found, assume_unique=True)]
                waiting[met] = False
                queue += met.tolist()
                left += [order[at]] * len(met)
                right += order[met].tolist()
    return left, right


def _links(radius: int, references: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, ["key", "one", "two"]):
            key, one, two, values = (rows.column(c).to_numpy() for c in ("key", "one", "two", "fp"))
            values = values.view(np.uint64)
            edge = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (one[1:] != one[:-1]) | (two[1:] != two[:-1])])
            length = np.diff(np.r_[edge, len(key)])
            table = distance_table(values, references)
            found = list(_small_pairs(np.repeat(edge, length), np.repeat(length, length), values, table, radius))
            for at, n in zip(edge[length > SMALL], length[length > SMALL]):
                left, right = _forest(values[at:at + n], table[:, at:at + n], radius)
                found.append((at + np.array(left, np.int64), at + np.array(right, np.int64)))
            for left, right in found:
                if len(left):
                    yield pa.RecordBatch.from_arrays([pa.array(values[left].view(np.int64)), pa.array(values[right].view(np.int64))], names=["left", "right"])
    return run


def near_links(fingerprints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(left, right): links between different fingerprints of the distinct long column ``fp``, at most ``radius``
    bits apart; enough of them to connect every class, not each pair of a large class."""
    parts = radius + 2
    edges = [round(64 * i / parts) for i in range(parts + 1)]
    masks = [sum(1 << b for b in range(a, e)) for a, e in zip(edges, edges[1:])]
    signed = [(m1 | m2) - (1 << 64) if (m1 | m2) >> 63 else m1 | m2 for m1, m2 in combinations(masks, 2)]
    keyed = fingerprints.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in signed])).alias("place", "part"))
    keyed = keyed.select("fp", F.xxhash64("place", "part").alias("key"))
    sizes = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").withColumn("chunks", F.ceil(F.col("n") / CHUNK).cast("int"))
    own = F.pmod(F.xxhash64("fp", F.lit("chunk")), F.col("chunks")).cast("int")
    met = keyed.join(unmeasured(sizes), "key").select("key", "fp", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other"))
    met = met.select("key", F.least("own", "other").alias("one"), F.greatest("own", "other").alias("two"), "fp")
    return (met.repartition("key", "one", "two").sortWithinPartitions("key", "one", "two")
            .mapInArrow(_links(radius, pivots()), "left long, right long").distinct())


def near_classes(fingerprints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(fp, root) for each distinct value of the stored long column ``fp``: equal roots are one class."""
    distinct = materialize(fingerprints.select("fp").distinct(), "fingerprints")
    reached = components(near_links(distinct, radius), "left", "right")
    return distinct.join(unmeasured(reached.withColumnRenamed("node", "fp")), "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def with_component(marked: DataFrame, id_col: str, fingerprint_col: str, radius: int = RADIUS) -> DataFrame:
    """``marked`` (documents with their fingerprint) with component_root and component_id (the smallest id)."""
    small = materialize(marked.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(fingerprint_col).alias("fp"))
                        .groupBy("fp").agg(F.min("doc_id").alias("least")), "least_ids")
    classes = materialize(near_classes(small, radius), "classes")
    ids = checked(materialize(classes.join(unmeasured(small), "fp").groupBy("root").agg(F.min("least").alias("component_id")), "component_ids"))
    lookup = materialize(classes.join(ids, "root").select(F.col("fp").alias(fingerprint_col), F.col("root").alias("component_root"), "component_id"), "lookup")
    return marked.join(checked(lookup), fingerprint_col)


def simhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, radius: int = RADIUS) -> DataFrame:
    """One row per input row: doc_id, fingerprint (long), component_id."""
    marked = materialize(with_fingerprint(id_and_text(docs, id_col, text_col), "text", width).drop("text"), "simhash")
    return with_component(marked, "doc_id", "fingerprint", radius).select("doc_id", "fingerprint", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` that stay when each class keeps the row with its smallest id (rows without id stay
    only in a class without any id). Of rows that repeat an id within a class one stays."""
    kept_id, value = free_names(docs.columns, "kept_id", "simhash_value")
    marked = with_fingerprint(docs, text_col, width, value)
    small = materialize(marked.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(value).alias("simhash_value")), "simhash")
    labelled = with_component(small, "doc_id", "simhash_value", radius)
    first = F.col("doc_id").eqNullSafe(F.col("component_id"))
    kept = materialize(labelled.where(first).groupBy("doc_id", "component_root").agg(F.count("*").alias("rows"), F.min("simhash_value").alias(value))
                       .select(F.col("doc_id").alias(kept_id), value, "rows"), "kept")
    on = F.col(f"`{id_col}`").eqNullSafe(F.col(kept_id)) & (marked[value] == kept[value])
    left = marked.join(checked(kept.where("rows = 1").drop("rows")), on, "left_semi")
    repeated = marked.join(checked(kept.where("rows > 1").drop("rows")), on, "left_semi").dropDuplicates([id_col, value])
    return left.unionByName(repeated).select([F.col(f"`{c}`") for c in docs.columns])
