"""Near copies by shingle similarity: documents whose sets of word shingles have Jaccard similarity 0.8 or more.

1. Equal shingle sets collapse first (a number per set), so thousands of copies are one row from there on.
2. Places to look: MinHash keys, ``BANDS`` keys of ``ROWS`` least values each (a pair at 0.8 has no key in common with
   probability (1 - 0.8 ** 4) ** 20 < 3e-5, closer ones less often), equal SimHash fingerprints, and links of the SimHash
   search with pivot distance tables. These only propose pairs; whole sets decide.
3. Every member of a key is compared with the key's smallest set, which settles a cluster with pairs in its size.
4. Keys whose other members are not yet in one class are searched whole: the members meet in a task (keys of more than
   ``CHUNK`` members in chunks, every two in a task of their own) and each pair from different classes is compared.
   Keys with the same members are searched once.
5. Connected components over the links.

Edge cases: texts without words are one class; fewer words than a shingle make one shingle; a null id sorts after every
other id; repeated rows fall into one class; an empty table gives an empty result.
"""
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import byte_list, checked, free_names, materialize, whole_groups, with_columns
from tidemark.llm.components import components
from tidemark.llm.simhash import fold, near_links, shingle_hashes
from tidemark.session import unmeasured

SIMILARITY = 0.8
BANDS, ROWS = 20, 4
#: Members of one key that a task holds at once, times two.
CHUNK = 1024
_BLOCK = 1 << 12


def _mixers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Fixed pseudo-random masks and odd factors, a column each."""
    draw = np.array([xxhash.xxh64_intdigest(f"least {i}") for i in range(count)], np.uint64)
    return (draw >> np.uint64(32)).astype(np.uint32)[:, None], (draw & np.uint64(0xFFFFFFFF)).astype(np.uint32)[:, None] | np.uint32(1)


_MASKS, _FACTORS = _mixers(BANDS * ROWS)


def set_number(shingles: np.ndarray) -> int:
    """A number for a sorted set of shingle hashes."""
    return int(np.array([xxhash.xxh64_intdigest(shingles.tobytes())], np.uint64).view(np.int64)[0])


def band_keys(shingles: np.ndarray) -> bytes:
    """The MinHash keys of a set, eight bytes each; none for an empty set."""
    if not len(shingles):
        return b""
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(BANDS * ROWS, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(short), _BLOCK):
        least = np.minimum(least, ((short[None, at:at + _BLOCK] ^ _MASKS) * _FACTORS).min(axis=1))
    return b"".join(xxhash.xxh64_digest(row.tobytes(), band) for band, row in enumerate(least.reshape(BANDS, ROWS)))


def _marks(width: int):
    def compute(texts: list[bytes]) -> dict[str, list]:
        out = {"node": [], "fp": [], "keys": []}
        for text in texts:
            hashes = shingle_hashes(text, width)
            shingles = np.unique(hashes)
            out["node"].append(set_number(shingles))
            out["fp"].append(fold(hashes))
            out["keys"].append(band_keys(shingles))
        return out
    return compute


def _explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = byte_list(batch.column(1))
        node = np.repeat(batch.column(0).to_numpy(), [len(k) // 8 for k in keys])
        yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(b"".join(keys), np.int64)), pa.array(node)], names=["key", "node"])


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = byte_list(batch.column(1))
            for at in range(0, len(texts), 256):
                sets = [np.unique(shingle_hashes(t, width)).tobytes() for t in texts[at:at + 256]]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, 256), pa.array(sets, pa.binary())], names=["node", "shingles"])
    return run


def similar(a: int, b: int, both: int, similarity: float) -> bool:
    """Whether sets of sizes ``a`` and ``b`` with ``both`` common members reach the similarity."""
    return both >= similarity * (a + b - both) - 1e-9


def _verified(similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two = (byte_list(batch.column(c)) for c in (2, 3))
            good = np.zeros(batch.num_rows, bool)
            for i, (x, y) in enumerate(zip(one, two)):
                if min(len(x), len(y)) < similarity * max(len(x), len(y)) - 1e-9:
                    continue  # the similarity is at most the ratio of the sizes
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                good[i] = similar(len(x), len(y), len(np.intersect1d(x, y, assume_unique=True)), similarity)
            yield batch.select(["left", "right"]).filter(pa.array(good))
    return run


def _group_links(sets: list[bytes], root: np.ndarray, side: np.ndarray, similarity: float) -> Iterator[tuple[int, int]]:
    """Links between rows of different classes: all pairs within a chunk, or those between two chunks."""
    size = np.array([len(s) // 8 for s in sets])
    member = np.unique(np.frombuffer(b"".join(sets), np.uint64), return_inverse=True)[1]
    start = np.cumsum(np.r_[0, size])
    here = np.zeros(int(member.max(initial=-1)) + 1, bool)
    root = root.copy()
    crossing = side.any() and not side.all()
    for i in range(len(sets) - 1):
        if (root[i:] == root[i]).all() or not size[i]:
            continue
        mine = member[start[i]:start[i + 1]]
        here[mine] = True
        rest = np.add.reduceat(np.r_[here[member[start[i + 1]:]], False].astype(np.int64), start[i + 1:-1] - start[i + 1])
        here[mine] = False
        near = (rest >= similarity * (size[i] + size[i + 1:] - rest) - 1e-9) & (size[i + 1:] > 0)
        if crossing:
            near &= side[i + 1:] != side[i]
        for j in (i + 1 + np.flatnonzero(near)).tolist():
            if root[j] != root[i]:
                yield i, j
                root[root == root[j]] = root[i]


def _searched(similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, ["key", "one", "two"], CHUNK):
            key, one, two, own, node, root = (rows.column(c).to_numpy() for c in ("key", "one", "two", "own", "node", "root"))
            edge = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (one[1:] != one[:-1]) | (two[1:] != two[:-1])])
            for a, b in zip(edge, np.r_[edge[1:], len(key)]):
                found = list(_group_links(byte_list(rows.column("shingles").slice(a, b - a)), root[a:b], own[a:b] == one[a:b], similarity))
                if found:
                    left, right = np.array(found).T + a
                    yield pa.RecordBatch.from_arrays([pa.array(node[left]), pa.array(node[right])], names=["left", "right"])
    return run


def _with_roots(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(node, root) for every node, from the stored table of links."""
    reached = components(links, "left", "right")
    return nodes.select("node").join(unmeasured(reached), "node", "left").select("node", F.coalesce("root", "node").alias("root"))


def _sets_of(docs: DataFrame, nodes: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(node, shingles), stored, for the distinct nodes in ``wanted``; ``docs`` has doc_id, mark, text."""
    rows = checked(materialize(nodes.join(unmeasured(wanted), "node", "left_semi").select("node", "sample.mark", F.col("sample.doc_id").alias("sample_id")), "samples"))
    texts = docs.join(rows, (docs["mark"] == rows["mark"]) & docs["doc_id"].eqNullSafe(rows["sample_id"])).select("node", "text")
    return materialize(texts.mapInArrow(_sets(width), "node long, shingles binary").dropDuplicates(["node"]), "sets")


def near_classes(docs: DataFrame, marks: DataFrame, width: int, bits: int, similarity: float) -> tuple[DataFrame, DataFrame]:
    """(node, root) and the nodes with their least id. ``docs`` has doc_id, mark, text, ``marks`` its stored rows with set numbers."""
    nodes = materialize(marks.groupBy("node").agg(F.min("doc_id").alias("least"), F.min(F.struct("mark", "doc_id")).alias("sample"),
                                                  F.min("fp").alias("fp"), F.min("keys").alias("keys")), "nodes")
    fps = materialize(nodes.groupBy("fp").agg(F.min("node").alias("node")), "fingerprints")
    keyed = nodes.select("node", "keys").mapInArrow(_explode, "key long, node long").unionByName(nodes.select(F.col("fp").alias("key"), "node"))
    groups = keyed.groupBy("key").agg(F.count("*").alias("n"), F.min("node").alias("leader")).where("n > 1")
    met = materialize(keyed.join(unmeasured(groups), "key"), "met")
    close = near_links(fps.select("fp"), bits)
    end = [fps.select(F.col("fp").alias(s), F.col("node").alias(f"{s}_node")) for s in ("left", "right")]
    close = close.join(unmeasured(end[0]), "left").join(unmeasured(end[1]), "right").select(F.least("left_node", "right_node").alias("left"), F.greatest("left_node", "right_node").alias("right"))
    pairs = materialize(met.where("node <> leader").select(F.col("leader").alias("left"), F.col("node").alias("right")).unionByName(close).distinct(), "pairs")
    wanted = pairs.select(F.col("left").alias("node")).unionByName(pairs.select(F.col("right").alias("node"))).distinct()
    sets = _sets_of(docs, nodes, wanted, width)
    one, two = (sets.select(F.col("node").alias(s), F.col("shingles").alias(f"{s}_set")) for s in ("left", "right"))
    both = pairs.join(checked(two), "right").join(checked(one), "left").select("left", "right", "left_set", "right_set")
    links = materialize(both.mapInArrow(_verified(similarity), "left long, right long"), "verified")
    roots = materialize(_with_roots(nodes, links), "roots")
    # keys whose members, without the leader that met them all, are in more than one class
    open_keys = (met.where("node <> leader").join(unmeasured(roots), "node").groupBy("key")
                 .agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("n"), F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("members"))
                 .where("low <> high").groupBy("n", "members").agg(F.min("key").alias("key")).select("key", F.ceil(F.col("n") / CHUNK).cast("int").alias("chunks")))
    open_keys = materialize(open_keys, "open_keys")
    own = F.pmod(F.xxhash64("node", F.lit("chunk")), F.col("chunks")).cast("int")
    left = met.where("node <> leader").join(checked(open_keys), "key").join(unmeasured(roots), "node")
    left = left.select("key", "node", "root", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other"))
    left = left.select("key", F.least("own", "other").alias("one"), F.greatest("own", "other").alias("two"), "own", "node", "root").join(checked(sets), "node")
    more = (left.select("key", "one", "two", "own", "node", "root", "shingles").repartition("key", "one", "two").sortWithinPartitions("key", "one", "two")
            .mapInArrow(_searched(similarity), "left long, right long"))
    links = materialize(links.unionByName(more), "all_links")
    return materialize(_with_roots(nodes, links), "classes"), nodes


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, bits: int = 6, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` that stay when each class keeps the row with its smallest id (rows without id stay
    only in a class without any id). Of rows that repeat an id within a class one stays."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    small = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.xxhash64(text).alias("mark"), text.alias("text"))
    marks = materialize(with_columns(small, "text", "node long, fp long, keys binary", _marks(width)).drop("text"), "marks")
    classes, nodes = near_classes(small, marks, width, bits, similarity)
    ids = checked(materialize(classes.join(unmeasured(nodes.select("node", "least")), "node").groupBy("root").agg(F.min("least").alias("component_id")), "component_ids"))
    lookup = checked(materialize(classes.join(ids, "root").select("node", "root", "component_id"), "lookup"))
    first = marks.select("doc_id", "mark", "node").join(lookup, "node").where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    kept_id, kept_mark, text_mark = free_names(docs.columns, "kept_id", "kept_mark", "text_mark")
    kept = materialize(first.groupBy("doc_id", "root").agg(F.count("*").alias("rows"), F.min("mark").alias(kept_mark))
                       .select(F.col("doc_id").alias(kept_id), kept_mark, "rows"), "kept")
    marked = docs.withColumn(text_mark, F.xxhash64(text))
    on = F.col(f"`{id_col}`").eqNullSafe(F.col(kept_id)) & (F.col(text_mark) == F.col(kept_mark))
    left = marked.join(checked(kept.where("rows = 1").drop("rows")), on, "left_semi")
    repeated = marked.join(checked(kept.where("rows > 1").drop("rows")), on, "left_semi").dropDuplicates([id_col, text_mark])
    return left.unionByName(repeated).select([F.col(f"`{c}`") for c in docs.columns])
