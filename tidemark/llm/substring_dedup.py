"""Substring dedup on words with difference-cover anchors.

A word of a document is removed when a window of ``WINDOW`` words over it also starts in a document with a
smaller id. Hashing each window of the corpus is avoided in two rounds:

1. Anchors: windows of WINDOW - PERIOD + 1 words are hashed only at positions whose remainder modulo PERIOD is
   in a difference cover. For any two positions a cover has a shift below PERIOD that brings both into it, so
   two equal windows of WINDOW words share an aligned anchor. Anchors met in two rows are shared.
2. Extension: only windows that hold a shared anchor are hashed whole (128 bits); the smallest id per
   hash decides for the others.

Whole copies collapse before that: a row whose word sequence a smaller id has as well loses all its words. What
several documents of one Arrow batch share is settled in the batch: one occurrence goes to the shuffle by
hash, the rest skips it, so a passage that a third of all documents hold sends one row per batch to its task.

Rows are numbered once, in a stored table of ids and texts that all steps read, so neither a lost executor nor another
number of cores changes a row's number. Ids that are not whole numbers are ranked by a range-partitioned sort.

Edge cases: a null text has no words; fewer words than a window lose nothing; very long texts are taken whole; a null id
ranks above all others (with the id 2^63 - 1); rows with the same id are never removed against one another, nor are ties
between them broken; extra columns are ignored whatever their names; an empty table gives an empty result.
"""
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import byte_list, checked, id_and_text, materialize, with_columns

WINDOW = 50
#: A perfect difference cover: the differences of its members give each remainder modulo the period.
PERIOD = 31
COVER = (1, 5, 11, 24, 25, 27)
_LAST = (1 << 63) - 1


def spans(words: list[bytes], starts: np.ndarray, width: int) -> Iterator[bytes]:
    """The windows of ``width`` words at ``starts``, joined by a space."""
    flat = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    for a, b in zip((np.r_[0, ends][starts]).tolist(), (ends[starts + width - 1] - 1).tolist()):
        yield flat[a:b]


def cover_positions(n: int, period: int, cover: tuple[int, ...], width: int) -> np.ndarray:
    """The anchor positions of a document of n words, in order."""
    whole = (np.arange(0, n, period)[:, None] + np.array(sorted(cover))[None, :]).ravel()
    return whole[whole + width <= n]


def _numbered(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Stored: row, doc_id, doc (a whole number in the order of the ids), text."""
    texts = id_and_text(docs, id_col, text_col)
    if isinstance(texts.schema["doc_id"].dataType, T.IntegralType):
        texts = texts.withColumn("doc", F.col("doc_id").cast("long"))
    else:  # numbers that increase along the sorted ids, partition by partition
        ids = materialize(texts.select("doc_id").where("doc_id is not null").distinct().orderBy("doc_id").select("doc_id", F.monotonically_increasing_id().alias("doc")), "ranked_ids")
        texts = texts.join(checked(ids), "doc_id", "left")
    return materialize(texts.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.coalesce("doc", F.lit(_LAST)).alias("doc"), "text"), "numbered")


def _settled(group: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Per entry of a batch sorted by (group, row): 0 the first of a group with one row only, 1 the one that
    speaks for a group with several rows, 2 the others of such a group."""
    start = np.r_[True, group[1:] != group[:-1]]
    first = np.flatnonzero(start)
    length = np.diff(np.r_[first, len(group)])
    several = np.maximum.reduceat(row, first) != np.minimum.reduceat(row, first)
    return np.where(np.repeat(several, length), np.where(start, 1, 2), 0).astype(np.int32)


def shared_anchors(texts: DataFrame, window: int, period: int, cover: tuple[int, ...]) -> DataFrame:
    """(row, place): the anchors (by their number within the row) that another row has too."""
    width = window - period + 1

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, rows, places = [], [], []
            for row, text in zip(batch.column(0).to_pylist(), byte_list(batch.column(1))):
                words = text.split()
                starts = cover_positions(len(words), period, cover, width)
                if not len(starts):
                    continue
                keys.append(np.fromiter((xxhash.xxh3_64_intdigest(s) for s in spans(words, starts, width)), np.uint64, len(starts)))
                rows.append(np.full(len(starts), row, np.int64))
                places.append(np.arange(len(starts), dtype=np.int32))
            if keys:
                key, row, place = np.concatenate(keys), np.concatenate(rows), np.concatenate(places)
                order = np.lexsort((row, key))
                key, row, place = key[order], row[order], place[order]
                state = _settled(key, row)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (np.where(state == 2, row.view(np.uint64), key).view(np.int64), row, place, state)],
                                                 names=["key", "row", "place", "state"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Streams rows sorted by (state = 2, key, row). Memory: a batch and what one row repeats of a key."""
        held: tuple[np.ndarray, ...] | None = None  # entries of the last key while only one row has it
        open_key = None  # the last key, once several rows have it
        for batch in batches:
            key, row, place, state = (batch.column(i).to_numpy() for i in range(4))
            easy = state == 2
            out = [(row[easy], place[easy])]
            key, row, place, state = key[~easy], row[~easy], place[~easy], state[~easy]
            if held is not None:
                key, row, place, state = (np.concatenate(x) for x in zip(held, (key, row, place, state)))
                held = None
            if len(key):
                first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
                length = np.diff(np.r_[first, len(key)])
                shared = (np.maximum.reduceat(row, first) != np.minimum.reduceat(row, first)) | (np.maximum.reduceat(state, first) == 1)
                shared[0] |= open_key is not None and key[0] == open_key
                open_key = key[-1] if shared[-1] else None
                keep = np.repeat(shared, length)
                if not shared[-1]:
                    held = tuple(x[first[-1]:] for x in (key, row, place, state))
                out.append((row[keep], place[keep]))
            rows, places = (np.concatenate(x) for x in zip(*out))
            yield pa.RecordBatch.from_arrays([pa.array(rows), pa.array(places)], names=["row", "place"])

    keyed = texts.select("row", "text").mapInArrow(hashes, "key long, row long, place int, state int")
    return keyed.repartition("key").sortWithinPartitions(F.col("state") == 2, "key", "row").mapInArrow(meet, "row long, place int")


def _runs(rows: DataFrame, column: str) -> DataFrame:
    """(row, runs): the values of an int column as packed first and last values of runs without a gap."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = []
            for values in batch.column(1):
                v = np.unique(values.values.to_numpy())
                cut = np.flatnonzero(np.diff(v) > 1)
                packed.append(np.stack([np.r_[v[:1], v[cut + 1]], np.r_[v[cut], v[-1:]]], axis=1).astype(np.int32).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], names=["row", "runs"])

    return rows.groupBy("row").agg(F.collect_list(column).alias("values")).mapInArrow(pack, "row long, runs binary")


def unpack(runs: bytes) -> np.ndarray:
    """The values of packed runs."""
    pairs = np.frombuffer(runs, np.int32).reshape(-1, 2)
    return np.concatenate([np.arange(a, b + 1) for a, b in pairs.tolist()]) if len(pairs) else np.zeros(0, np.int64)


def repeated_windows(marked: DataFrame, window: int, period: int, cover: tuple[int, ...]) -> DataFrame:
    """(row, start) of the windows that a smaller id has too. ``marked``: row, doc, text, runs (shared anchors)."""
    width = window - period + 1

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, rows, ids, starts = [], [], [], []
            for row, doc, text, runs in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), byte_list(batch.column(2)), batch.column(3).to_pylist()):
                words = text.split()
                if len(words) < window:
                    continue
                anchors = cover_positions(len(words), period, cover, width)[unpack(runs)]
                change = np.zeros(len(words) + 1, np.int64)
                np.add.at(change, np.maximum(0, anchors - period + 1), 1)
                np.add.at(change, anchors + 1, -1)
                at = np.flatnonzero(np.cumsum(change)[:len(words) - window + 1])
                digests += [xxhash.xxh3_128_digest(s) for s in spans(words, at, window)]
                rows.append(np.full(len(at), row, np.int64))
                ids.append(np.full(len(at), doc, np.int64))
                starts.append(at.astype(np.int32))
            if not digests:
                continue
            pair = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            high, low, row, doc, start = pair[:, 0], pair[:, 1], np.concatenate(rows), np.concatenate(ids), np.concatenate(starts)
            order = np.lexsort((doc, low, high))
            high, low, row, doc, start = (x[order] for x in (high, low, row, doc, start))
            new = np.r_[True, (high[1:] != high[:-1]) | (low[1:] != low[:-1])]
            least = np.repeat(doc[new], np.diff(np.r_[np.flatnonzero(new), len(doc)]))
            done = doc > least  # a smaller id in this very batch
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (np.where(done, row, high), low, doc, row, start, done)],
                                             names=["high", "low", "doc", "row", "start", "done"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Streams rows sorted by (done, high, low, doc): the first id of a hash is the smallest."""
        last: tuple[int, int, int] | None = None
        for batch in batches:
            high, low, doc, row, start, done = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(6))
            if not len(high):
                continue
            new = np.r_[True, (high[1:] != high[:-1]) | (low[1:] != low[:-1]) | (done[1:] != done[:-1])]
            first = np.flatnonzero(new)
            least = doc[first].copy()
            if last is not None and not done[0] and last[:2] == (high[0], low[0]):
                least[0] = last[2]
            gone = done | (doc > np.repeat(least, np.diff(np.r_[first, len(high)])))
            last = None if done[-1] else (high[-1], low[-1], least[-1])
            yield pa.RecordBatch.from_arrays([pa.array(row[gone]), pa.array(start[gone])], names=["row", "start"])

    keyed = marked.select("row", "doc", "text", "runs").mapInArrow(hashes, "high long, low long, doc long, row long, start int, done boolean")
    return keyed.repartition("high").sortWithinPartitions("done", "high", "low", "doc").mapInArrow(meet, "row long, start int")


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, period: int = PERIOD,
                    cover: tuple[int, ...] = COVER) -> DataFrame:
    """A row per input row: doc_id, kept_text (kept words joined by a space), n_words, n_removed."""
    if {(a - b) % period for a in cover for b in cover} != set(range(period)) or not period <= window:
        raise ValueError("cover must be a difference cover of a period no longer than the window")
    texts = _numbered(docs, id_col, text_col)
    text_alone = texts.select("row", "doc", "text")

    def sequence(batch: list[bytes]) -> dict[str, list]:
        words = [t.split() for t in batch]
        return {"n": [len(w) for w in words], "digest": [xxhash.xxh3_128_digest(b" ".join(w)) for w in words]}

    rows = materialize(with_columns(text_alone, "text", "n long, digest binary", sequence).where(F.col("n") >= window).select("row", "doc", "digest"), "sequences")
    least = rows.groupBy("digest").agg(F.min("doc").alias("least"), F.count("*").alias("rows")).where("rows > 1")
    copies = materialize(rows.join(checked(materialize(least, "repeated_sequences")), "digest").where("doc > least").select("row", F.lit(True).alias("whole")), "copies")
    single = text_alone.join(checked(copies), "row", "left_anti")
    anchors = materialize(_runs(shared_anchors(single, window, period, cover), "place"), "anchors")
    removed = materialize(_runs(repeated_windows(single.join(checked(anchors), "row"), window, period, cover), "start"), "windows")
    # one table of what to remove, so the texts meet it in one join
    decided = materialize(removed.select("row", "runs", F.lit(False).alias("whole")).unionByName(copies.select("row", F.lit(None).cast("binary").alias("runs"), "whole")), "decided")
    marked = (texts.join(checked(decided), "row", "left").select("doc_id", "text", "runs", F.coalesce("whole", F.lit(False)).alias("whole")))
    kind = marked.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, total, gone = [], [], []
            for text, runs, whole in zip(byte_list(batch.column(1)), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                words = text.split()
                total.append(len(words))
                if whole:
                    words = []
                elif runs:
                    stays = np.ones(len(words), bool)
                    for a, b in np.frombuffer(runs, np.int32).reshape(-1, 2).tolist():
                        stays[a:b + window] = False
                    words = [w for w, s in zip(words, stays.tolist()) if s]
                gone.append(total[-1] - len(words))
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(kept, pa.binary()).cast(pa.string()), pa.array(total, pa.int64()), pa.array(gone, pa.int64())],
                                             names=["doc_id", "kept_text", "n_words", "n_removed"])

    return marked.mapInArrow(cut, f"doc_id {kind}, kept_text string, n_words long, n_removed long")
