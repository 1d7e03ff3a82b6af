"""MinHash near-dedup with odd sketches: documents whose sets of word shingles share at least ``percent`` % of their union.

1. A pass over the texts gives each document the number of its shingle set, BANDS x ROWS MinHash samples folded into
   BANDS keys, and an odd sketch: sample i with value v flips the bit at hash(i, v) of a bitmap. Equal sets collapse to one
   node, so thousands of copies are one row from there on.
2. Candidates are nodes with a common band key. Samples on which two sets differ flip two bits each, so the population
   count of the XOR of two sketches estimates the similarity; a pair beyond ``popcount_bound`` is discarded, and only pairs
   that pass are compared on whole sets. A pair at 85 % has no key in common with probability (1 - 0.85 ** 4) ** 32 < 1e-10,
   and exceeds the bound with probability < 1e-8.
3. Every member of a key meets the key's leader (another one per key), in as many pairs as there are members. What is
   confirmed on whole sets settles a cluster; components of these links are the classes so far.
4. Keys whose members are in several classes are searched by sketches alone, which proposes links between members of
   different classes. Only nodes met there are fetched with whole sets and compared, two of the same class never: all that
   proposals connect in one place. Members of a place's largest class meet the others only, in chunks, so one large class
   with few others costs its size.
5. Connected components over all confirmed links.

Edge cases: null texts and texts without words have an empty set and are linked with nothing (they are their own
component); fewer words than a shingle make one shingle; very long texts are taken whole, their samples computed in
blocks; ties do not arise (a link depends on the two sets only); repeated rows have equal sets, and each row gets an answer; a
row without id is a component's id only where no id is known, and is kept there; extra columns are ignored whatever their
names; an empty table gives an empty result.
"""
from collections.abc import Iterator
from functools import cache
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import byte_list, checked, materialize, whole_groups, with_columns
from tidemark.llm.components import components
from tidemark.llm.simhash import shingle_hashes

WIDTH = 5
PERCENT = 85
BANDS, ROWS = 32, 4
SAMPLES = BANDS * ROWS
#: Bits of an odd sketch.
SKETCH_BITS = 512
SKETCH = [f"s{i}" for i in range(SKETCH_BITS // 64)]
#: Members of a key that meet in one task: by sketches, and with whole sets.
SKETCH_CHUNK, SET_CHUNK = 4096, 256
#: Nodes connected by proposals beyond which they are compared key by key.
CLUSTER = 1024
_BLOCK = 1 << 11


def _draws(label: str, count: int) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(f"{label} {i}") for i in range(count)], np.uint64)


_MASKS = (_draws("odd sample", SAMPLES) >> np.uint64(32)).astype(np.uint32)[:, None]
_FACTORS = (_draws("odd factor", SAMPLES) >> np.uint64(32)).astype(np.uint32)[:, None] | np.uint32(1)
_PLACES = _draws("odd place", SAMPLES)


def samples(shingles: np.ndarray) -> np.ndarray:
    """The MinHash samples of a non-empty set of 64-bit shingle hashes."""
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(SAMPLES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(short), _BLOCK):
        np.minimum(least, ((short[None, at:at + _BLOCK] ^ _MASKS) * _FACTORS).min(axis=1), out=least)
    return least


def odd_sketch(least: np.ndarray) -> np.ndarray:
    """The samples folded into a parity bitmap, as 64-bit words."""
    code = (least.astype(np.uint64) ^ _PLACES) * np.uint64(0x9E3779B97F4A7C15)
    code = (code ^ (code >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
    place = (code >> np.uint64(64 - SKETCH_BITS.bit_length() + 1)).astype(np.int64)
    return np.packbits(np.bincount(place, minlength=SKETCH_BITS) & 1, bitorder="little").view(np.uint64)


def estimate(flipped: int) -> float:
    """The similarity that an XOR population count stands for."""
    share = min(2 * flipped / SKETCH_BITS, 1 - 1e-9)
    return 1 + SKETCH_BITS / (4 * SAMPLES) * np.log(1 - share)


@cache
def popcount_bound(percent: int, loss: float = 1e-8) -> int:
    """The least XOR population count that a pair at ``percent`` exceeds with a probability below ``loss``. Its samples differ
    independently, each difference flips two places; the number of odd places is followed flip by flip."""
    apart, places = 1 - percent / 100, np.arange(SKETCH_BITS + 1)
    odd, total = np.zeros(SKETCH_BITS + 1), np.zeros(SKETCH_BITS + 1)
    odd[0] = 1
    for differing in range(SAMPLES + 1):
        for _ in range(2 if differing else 0):
            up, down = odd * (SKETCH_BITS - places) / SKETCH_BITS, odd * places / SKETCH_BITS
            odd = np.r_[0, up[:-1]] + np.r_[down[1:], 0]
        total += comb(SAMPLES, differing) * apart ** differing * (1 - apart) ** (SAMPLES - differing) * odd
    beyond = np.r_[np.cumsum(total[::-1])[::-1][1:], 0]
    return int(np.argmax(beyond < loss))


def _marks(width: int):
    def compute(texts: list[bytes]) -> dict[str, list]:
        out: dict[str, list] = {name: [] for name in ("node", "n_shingles", "keys", *SKETCH)}
        for text in texts:
            shingles = np.unique(shingle_hashes(text, width))
            out["n_shingles"].append(len(shingles))
            if not len(shingles):
                for name in ("node", "keys", *SKETCH):
                    out[name].append(None)
                continue
            least = samples(shingles)
            out["node"].append(xxhash.xxh3_64_intdigest(shingles.tobytes()) - (1 << 63))
            out["keys"].append(b"".join(xxhash.xxh3_64_digest(row.tobytes(), band) for band, row in enumerate(least.reshape(BANDS, ROWS))))
            for name, word in zip(SKETCH, odd_sketch(least).view(np.int64).tolist()):
                out[name].append(word)
        return out
    return compute


def _keyed(nodes: DataFrame) -> DataFrame:
    """(key, node): a row per band."""
    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = b"".join(byte_list(batch.column(1)))
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(keys, np.int64)), pa.array(np.repeat(batch.column(0).to_numpy(), BANDS))], names=["key", "node"])
    return nodes.select("node", "keys").mapInArrow(explode, "key long, node long")


def _sets(docs: DataFrame, nodes: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(node, shingles), stored, of the nodes in ``wanted``: one document of each is read again. Where rows repeat a
    document, a node comes once per task at most; its repeats change no answer."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            texts, found = batch.column(1).cast(pa.binary()), {}
            for at, node in enumerate(batch.column(0).to_pylist()):
                if node not in seen:
                    seen.add(node)
                    found[node] = np.unique(shingle_hashes(texts[at].as_py() or b"", width)).tobytes()
                if len(found) >= 256:
                    yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.binary())], names=["node", "shingles"])
                    found = {}
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.binary())], names=["node", "shingles"])

    rows = materialize(nodes.join(wanted, "node", "left_semi").select("node", "sample.mark", F.col("sample.doc_id").alias("sample_id")), "odd_samples")
    rows = checked(rows)
    texts = docs.join(rows, (docs["mark"] == rows["mark"]) & docs["doc_id"].eqNullSafe(rows["sample_id"])).select("node", "text")
    return materialize(texts.mapInArrow(run, "node long, shingles binary"), "odd_sets")


def _reaches(one: int, two: int, both: int, percent: int) -> bool:
    return 100 * both >= percent * (one + two - both)


def _confirmed(percent: int):
    """Of pairs with both sets, those that reach the similarity."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = np.zeros(batch.num_rows, bool)
            for i, (x, y) in enumerate(zip(byte_list(batch.column(2)), byte_list(batch.column(3)))):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                good[i] = _reaches(len(x), len(y), len(np.intersect1d(x, y, assume_unique=True)), percent)
            yield batch.select(["left", "right"]).filter(pa.array(good))
    return run


def _chunked(members: DataFrame, chunk: int) -> DataFrame:
    """``members`` (key, node, root, ...) dealt to the meetings of their key: chunks of the key's largest class meet the
    chunks of the others, those meet one another; ``one`` and ``two`` name a meeting, ``own`` the row's chunk."""
    classes = members.groupBy("key", "root").agg(F.count("*").alias("n"))
    keys = classes.groupBy("key").agg(F.max_by("root", F.struct("n", "root")).alias("main"), F.max("n").alias("most"), F.sum("n").alias("rows"))
    keys = materialize(keys.select("key", "main", F.ceil(F.col("most") / chunk).cast("int").alias("main_chunks"),
                                   F.ceil((F.col("rows") - F.col("most")) / chunk).cast("int").alias("chunks")), "odd_keys")
    own = F.when(F.col("root") == F.col("main"), -1 - F.pmod(F.xxhash64("node", F.lit("chunk")), F.col("main_chunks")).cast("int")) \
        .otherwise(F.pmod(F.xxhash64("node", F.lit("chunk")), F.col("chunks")).cast("int"))
    rest = F.sequence(F.lit(0), F.col("chunks") - 1)
    meets = F.when(F.col("own") < 0, rest).otherwise(F.concat(rest, F.sequence(-F.col("main_chunks"), F.lit(-1))))
    dealt = members.join(checked(keys), "key").withColumn("own", own).withColumn("meets", F.explode(meets))
    dealt = dealt.withColumn("one", F.least("own", "meets")).withColumn("two", F.greatest("own", "meets"))
    return dealt.drop("main", "main_chunks", "chunks", "meets")


def _meetings(rows: pa.Table) -> Iterator[tuple[int, int]]:
    """First and last row of each meeting in a table sorted by them."""
    key, one, two = (rows.column(c).to_numpy() for c in ("key", "one", "two"))
    edge = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (one[1:] != one[:-1]) | (two[1:] != two[:-1])])
    yield from zip(edge.tolist(), np.r_[edge[1:], len(key)].tolist())


def _possible(at: int, others: np.ndarray, size: np.ndarray, sketch: np.ndarray, percent: int, bound: int) -> np.ndarray:
    """Of the rows ``others``, those whose size and sketch leave a link with row ``at`` possible."""
    small, large = np.minimum(size[at], size[others]), np.maximum(size[at], size[others])
    others = others[100 * small >= percent * large]
    return others[np.bitwise_count(sketch[others] ^ sketch[at]).sum(axis=1) <= bound]


def _proposed(percent: int, bound: int):
    """(key, left, right): members of different classes that could be linked by their sketches, as a spanning forest of each
    meeting's possible links."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, ["key", "one", "two"]):
            key, node, root, own, size = (rows.column(c).to_numpy() for c in ("key", "node", "root", "own", "n_shingles"))
            sketch = np.stack([rows.column(c).to_numpy() for c in SKETCH], axis=1).view(np.uint64)
            left, right = [], []
            for a, b in _meetings(rows):
                crossing, label = own[a] != own[b - 1], np.arange(a, b)
                for at in range(a, b - 1):
                    others = at + 1 + np.flatnonzero((root[at + 1:b] != root[at]) & (label[at + 1 - a:] != label[at - a]))
                    if crossing:
                        others = others[own[others] != own[at]]
                    others = _possible(at, others, size, sketch, percent, bound)
                    for j in others[np.unique(label[others - a], return_index=True)[1]].tolist():
                        left.append(at)
                        right.append(j)
                        label[label == label[j - a]] = label[at - a]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (key[left], node[left], node[right])], names=["key", "left", "right"])
    return run


def _meeting_places(members: DataFrame, proposed: DataFrame) -> DataFrame:
    """(key, node, root) of the members to compare on whole sets. What the proposals connect over all keys meets in one place,
    so a set travels once however many keys its node has; connected groups beyond CLUSTER nodes meet under each key."""
    ends = proposed.select("key", F.col("left").alias("node")).unionByName(proposed.select("key", F.col("right").alias("node"))).distinct()
    clusters = materialize(components(proposed, "left", "right").select("node", F.col("root").alias("cluster")), "odd_clusters")
    large = clusters.groupBy("cluster").agg(F.count("*").alias("n")).where(F.col("n") > CLUSTER).select("cluster", F.lit(True).alias("large"))
    placed = ends.join(checked(clusters), "node").join(checked(materialize(large, "odd_large")), "cluster", "left")
    place = F.when(F.col("large"), F.col("key")).otherwise(F.xxhash64("cluster"))
    roots = members.select("node", "root").distinct()
    return materialize(placed.select(place.alias("key"), "node").distinct().join(roots, "node").select("key", "node", "root"), "odd_open")


def _searched(percent: int, bound: int):
    """Confirmed links between members of different classes; classes merge as links are found, so a cluster yields a
    spanning forest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, ["key", "one", "two"], 2 * SET_CHUNK):
            node, root, own, size = (rows.column(c).to_numpy() for c in ("node", "root", "own", "n_shingles"))
            sketch = np.stack([rows.column(c).to_numpy() for c in SKETCH], axis=1).view(np.uint64)
            sets = rows.column("shingles")
            left, right = [], []
            for a, b in _meetings(rows):
                known = [np.frombuffer(s, np.uint64) for s in sets.slice(a, b - a).to_pylist()]
                label = np.unique(root[a:b], return_inverse=True)[1]
                crossing = own[a] != own[b - 1]
                for i in range(b - a - 1):
                    others = a + i + 1 + np.flatnonzero(label[i + 1:] != label[i])
                    if crossing:
                        others = others[own[others] != own[a + i]]
                    for j in (_possible(a + i, others, size, sketch, percent, bound) - a).tolist():
                        if label[i] != label[j] and _reaches(len(known[i]), len(known[j]), len(np.intersect1d(known[i], known[j], assume_unique=True)), percent):
                            left.append(node[a + i])
                            right.append(node[a + j])
                            label[label == label[j]] = label[i]
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["left", "right"])
    return run


def _with_roots(nodes: DataFrame, links: DataFrame) -> DataFrame:
    reached = components(links, "left", "right")
    return materialize(nodes.select("node").join(reached, "node", "left").select("node", F.coalesce("root", "node").alias("root")), "odd_roots")


def _same_meeting(rows: DataFrame) -> DataFrame:
    return rows.repartition("key", "one", "two").sortWithinPartitions("key", "one", "two", "own", "node")


def near_classes(docs: DataFrame, nodes: DataFrame, width: int, percent: int) -> DataFrame:
    """(node, root), stored. ``docs``: doc_id, mark, text; ``nodes``: node, n_shingles, keys, sketch words and sample."""
    bound = popcount_bound(percent)
    light = nodes.select("node", "n_shingles", *SKETCH)
    keyed = _keyed(nodes)
    groups = keyed.groupBy("key").agg(F.count("*").alias("n"), F.min_by("node", F.xxhash64("node", "key")).alias("leader")).where("n > 1")
    met = materialize(keyed.join(groups, "key").select("key", "node", "leader"), "odd_met")
    pairs = met.where("node <> leader").select(F.least("node", "leader").alias("left"), F.greatest("node", "leader").alias("right")).distinct()
    for side in ("left", "right"):
        pairs = pairs.join(light.select([F.col(c).alias(side if c == "node" else f"{side}_{c}") for c in light.columns]), side)
    flipped = sum((F.bit_count(F.col(f"left_{s}").bitwiseXOR(F.col(f"right_{s}"))) for s in SKETCH[1:]),
                  F.bit_count(F.col(f"left_{SKETCH[0]}").bitwiseXOR(F.col(f"right_{SKETCH[0]}"))))
    sizes = [F.col("left_n_shingles"), F.col("right_n_shingles")]
    pairs = materialize(pairs.where((100 * F.least(*sizes) >= percent * F.greatest(*sizes)) & (flipped <= bound)).select("left", "right"), "odd_pairs")
    wanted = pairs.select(F.col("left").alias("node")).unionByName(pairs.select(F.col("right").alias("node"))).distinct()
    sets = _sets(docs, nodes, wanted, width)
    one, two = (sets.select(F.col("node").alias(s), F.col("shingles").alias(f"{s}_set")) for s in ("left", "right"))
    both = pairs.join(checked(two), "right").join(checked(one), "left").select("left", "right", "left_set", "right_set")
    links = materialize(both.mapInArrow(_confirmed(percent), "left long, right long"), "odd_links")
    roots = _with_roots(nodes, links)
    classed = met.select("key", "node").join(roots, "node")
    several = classed.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("n"),
                                         F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("members")).where("low <> high")
    # keys with the same members are searched once
    several = materialize(several.groupBy("n", "members").agg(F.min("key").alias("key")).select("key"), "odd_open_keys")
    members = materialize(classed.join(checked(several), "key"), "odd_members")
    rows = _chunked(members, SKETCH_CHUNK).join(light, "node")
    proposed = materialize(_same_meeting(rows).mapInArrow(_proposed(percent, bound), "key long, left long, right long"), "odd_proposed")
    places = _meeting_places(members, proposed)
    sets = _sets(docs, nodes, places.select("node").distinct(), width)
    rows = _chunked(places, SET_CHUNK).join(light, "node").join(sets, "node")
    more = _same_meeting(rows).mapInArrow(_searched(percent, bound), "left long, right long")
    return _with_roots(nodes, materialize(links.unionByName(more), "odd_all_links"))


def odd_sketch_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept (the row's id is its component's)."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    small = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.xxhash64(text).alias("mark"), text.alias("text"))
    added = "node long, n_shingles long, keys binary, " + ", ".join(f"{s} long" for s in SKETCH)
    marks = materialize(with_columns(small, "text", added, _marks(width)).drop("text"), "odd_marks")
    first = [F.min(c).alias(c) for c in ("n_shingles", "keys", *SKETCH)]
    nodes = materialize(marks.where("node is not null").groupBy("node").agg(
        F.min("doc_id").alias("least"), F.min(F.struct("mark", "doc_id")).alias("sample"), *first), "odd_nodes")
    classes = near_classes(small, nodes, width, percent)
    least = classes.join(nodes.select("node", "least"), "node").groupBy("root").agg(F.min("least").alias("component_id"))
    lookup = materialize(classes.join(least, "root").select("node", "component_id"), "odd_lookup")
    answered = marks.select("doc_id", "n_shingles", "node").join(checked(lookup), "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return answered.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))
