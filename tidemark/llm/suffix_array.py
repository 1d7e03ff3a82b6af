"""Suffix-array dedup of bytes: merged shard Burrows-Wheeler transforms over a parse of the texts.

A byte is removed when a string of ``MIN_BYTES`` bytes over it starts anywhere else, in another document or in the
same one. A transform over single bytes would need one round per matched byte, so the texts are parsed into
phrases first, as in prefix-free parsing:

1. Parse: a phrase begins where the hash of the next GRAM bytes is the least of GAP neighbours (rightmost on
   ties). Starts depend on content only and are at most GAP apart, hence two equal strings of MIN_BYTES
   bytes share DEPTH + 1 phrase starts, the first of them within GAP bytes.
2. Shards: each partition sorts its own phrase suffixes (to depth DEPTH) and keeps phrases and order, which is its
   Burrows-Wheeler transform with the symbols before each row.
3. Merge by interleave refinement: at depth 1 a context (string of phrases) is an interval of rows in
   each shard. Counts of equal contexts are added over the shards; contexts met once are unique and go. Each
   round moves the live intervals one symbol to the left through every shard's own transform (rows with the same
   symbol before them stay together) and adds the counts again. No suffix is sorted against another shard's. After
   DEPTH - 1 rounds the live intervals are the repeated ones with a common prefix of DEPTH phrases.
4. Extension to bytes: a phrase start in a repeated interval is compared by the hash of the MIN_BYTES - GAP + 1
   bytes after it, which an equal string holds for certain. If another start also shares the GAP - 1 bytes
   before and MIN_BYTES after, all strings that begin in between are repeated. For the rest (the ends of common passages)
   the bytes around are fetched and their strings of MIN_BYTES bytes compared one by one within the
   group, or row by row over the cluster where a group is larger than ``GROUP``.

Whole copies collapse before: all of a repeated text is removed, one copy takes part for the others.

Rows are numbered once, in a stored table of ids and texts that all steps read, so neither a lost executor nor another
number of cores changes a row's number.

Edge cases: a null text has no bytes; shorter texts than MIN_BYTES lose nothing; very long texts are parsed whole; repeated
rows are copies; ties do not arise (every occurrence goes); a cut may split a character, so kept bytes are binary; extra
columns are ignored whatever their names; an empty table gives an empty result.
"""
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import byte_list, checked, id_and_text, materialize, whole_groups, with_columns

MIN_BYTES = 400
GAP = 128
GRAM = 16
#: Fetched surroundings of one group that a task compares at once.
GROUP = 1 << 15
_SHARD = "shard long, symbols binary, suffixes binary, rows binary, firsts binary"
_MIX = np.uint64(0x9E3779B97F4A7C15)


def phrase_starts(text: bytes, gap: int = GAP) -> np.ndarray:
    """Where phrases begin: the rightmost least hash of each run of ``gap`` positions."""
    data = np.frombuffer(text, np.uint8)
    if len(data) < GRAM + gap - 1:
        return np.zeros(0, np.int64)
    eight = np.lib.stride_tricks.as_strided(data, (len(data) - 7, 8), (1, 1)).copy().view(np.uint64)[:, 0]
    code = eight[:-8] * _MIX + (eight[8:] ^ (eight[8:] >> np.uint64(31))) * np.uint64(0xC2B2AE3D27D4EB4F)
    code ^= code >> np.uint64(29)
    code *= np.uint64(0xBF58476D1CE4E5B9)
    last = np.uint64(0xFFFFFFFF)
    least = (code & ~last) | (last - np.arange(len(code), dtype=np.uint64))
    span = 1
    while 2 * span <= gap:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < gap:
        least = np.minimum(least[:span - gap], least[gap - span:])
    at = (last - (least & last)).astype(np.int64)
    return at[np.r_[True, at[1:] != at[:-1]]]


def phrases(text: bytes, starts: np.ndarray) -> np.ndarray:
    """A 64-bit symbol per phrase: the bytes from a start through the gram at the next one."""
    spots = starts.tolist()
    return np.fromiter((xxhash.xxh3_64_intdigest(text[a:b + GRAM]) for a, b in zip(spots, spots[1:])), np.uint64, max(0, len(spots) - 1))


def _shards(texts: DataFrame, depth: int, gap: int, min_bytes: int) -> DataFrame:
    """One row per partition: its phrases in text order (a symbol of its own ends each document), the suffix order
    of their first ``depth`` symbols, and each document's row number and first phrase."""
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, symbols, rows, firsts, total = None, [], [], [], 0
        for batch in batches:
            for row, text in zip(batch.column(0).to_pylist(), byte_list(batch.column(1))):
                shard = row if shard is None else shard
                if len(text) < min_bytes:
                    continue
                own = phrases(text, phrase_starts(text, gap))
                symbols += [own, np.array([xxhash.xxh3_64_intdigest(f"end {row}")], np.uint64)]
                rows.append(row)
                firsts.append(total)
                total += len(own) + 1
        if total:
            flat = np.concatenate(symbols)
            padded = np.r_[flat, np.zeros(depth, np.uint64)]
            order = np.lexsort([padded[i:i + total] for i in reversed(range(depth))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()), *(pa.array([x.tobytes()], pa.binary()) for x in (
                flat, order, np.array(rows, np.int64), np.array(firsts, np.int64)))], names=["shard", "symbols", "suffixes", "rows", "firsts"])

    return texts.select("row", "text").mapInArrow(build, _SHARD)


def _first_intervals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Intervals of depth 1: the runs of equal first symbols in each shard's suffix order."""
    for batch in batches:
        for shard, symbols, suffixes in zip(*(batch.column(i).to_pylist() for i in range(3))):
            first = np.frombuffer(symbols, np.uint64)[np.frombuffer(suffixes, np.int32)]
            low = np.flatnonzero(np.r_[True, first[1:] != first[:-1]])
            n = np.diff(np.r_[low, len(first)])
            for at in range(0, len(low), 1 << 16):
                part = slice(at, at + (1 << 16))
                yield pa.RecordBatch.from_arrays([pa.array(first[low[part]].view(np.int64)), pa.array(np.full(len(low[part]), shard, np.int64)),
                                                  pa.array(low[part].astype(np.int32)), pa.array(n[part].astype(np.int32))], names=["context", "shard", "low", "n"])


def _rows_of(intervals: pd.DataFrame, suffixes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The phrase numbers that the intervals hold, and the position of each one's interval."""
    low, n = intervals["low"].to_numpy(np.int64), intervals["n"].to_numpy(np.int64)
    owner = np.repeat(np.arange(len(n)), n)
    return suffixes[np.repeat(low - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())].astype(np.int64), owner


def _extend(key: tuple, intervals: pd.DataFrame, shards: pd.DataFrame) -> pd.DataFrame:
    """One refinement round in one shard: every live interval is split by the symbol before its rows."""
    none = pd.DataFrame({"context": np.zeros(0, np.int64), "shard": np.zeros(0, np.int64), "low": np.zeros(0, np.int32), "n": np.zeros(0, np.int32)})
    if not len(intervals) or not len(shards):
        return none
    symbols, suffixes = np.frombuffer(shards["symbols"].iat[0], np.uint64), np.frombuffer(shards["suffixes"].iat[0], np.int32)
    rank = np.empty(len(suffixes), np.int32)
    rank[suffixes] = np.arange(len(suffixes), dtype=np.int32)
    where, owner = _rows_of(intervals, suffixes)
    owner, before = owner[where > 0], where[where > 0] - 1
    if not len(before):
        return none
    context = intervals["context"].to_numpy(np.int64).view(np.uint64)[owner] * _MIX
    context = (context ^ (context >> np.uint64(32))) + symbols[before]
    order = np.lexsort((rank[before], context))
    context, place = context[order], rank[before][order]
    first = np.flatnonzero(np.r_[True, context[1:] != context[:-1]])
    return pd.DataFrame({"context": context[first].view(np.int64), "shard": np.int64(key[0]), "low": place[first], "n": np.diff(np.r_[first, len(context)]).astype(np.int32)})


def _locate(key: tuple, intervals: pd.DataFrame, shards: pd.DataFrame) -> pd.DataFrame:
    """(row, starts): per document the numbers of its phrase starts in repeated intervals, packed."""
    if not len(intervals) or not len(shards):
        return pd.DataFrame({"row": np.zeros(0, np.int64), "starts": np.zeros(0, object)})
    where = np.sort(_rows_of(intervals, np.frombuffer(shards["suffixes"].iat[0], np.int32))[0])
    rows, firsts = (np.frombuffer(shards[c].iat[0], np.int64) for c in ("rows", "firsts"))
    doc = np.searchsorted(firsts, where, "right") - 1
    cut = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
    number = (where - firsts[doc]).astype(np.int32)
    return pd.DataFrame({"row": rows[doc[cut]], "starts": [number[a:b].tobytes() for a, b in zip(cut, np.r_[cut[1:], len(doc)])]})


def repeated_starts(texts: DataFrame, depth: int, gap: int, min_bytes: int) -> DataFrame:
    """(row, starts) of the phrase starts whose next ``depth`` phrases occur elsewhere too."""
    shards = materialize(_shards(texts, depth, gap, min_bytes), "shards")
    over_shards = Window.partitionBy("context")  # one row per shard at most

    def live(intervals: DataFrame) -> DataFrame:
        return intervals.withColumn("total", F.sum("n").over(over_shards)).where("total > 1").drop("total")

    intervals = live(shards.mapInArrow(_first_intervals, "context long, shard long, low int, n int"))
    by_shard = shards.groupBy("shard")
    for _ in range(depth - 1):
        intervals = live(intervals.groupBy("shard").cogroup(by_shard).applyInPandas(_extend, "context long, shard long, low int, n int"))
    return intervals.groupBy("shard").cogroup(by_shard).applyInPandas(_locate, "row long, starts binary")


def _hashed_starts(marked: DataFrame, gap: int, min_bytes: int) -> DataFrame:
    """(inner, outer, row, at): hashes of what follows each candidate start, and of its whole surroundings (a value of
    its own where the text ends before)."""
    inner = min_bytes - gap + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [])
            for row, text, numbers in zip(batch.column(0).to_pylist(), byte_list(batch.column(1)), batch.column(2).to_pylist()):
                for at in phrase_starts(text, gap)[np.frombuffer(numbers, np.int32)].tolist():
                    if at + inner > len(text):
                        break
                    whole = at >= gap - 1 and at + min_bytes <= len(text)
                    out[0].append(xxhash.xxh3_64_intdigest(text[at:at + inner]))
                    out[1].append(xxhash.xxh3_64_intdigest(text[at - gap + 1:at + min_bytes] if whole else f"{row} {at}", seed=1))
                    out[2].append(row)
                    out[3].append(at)
            yield pa.RecordBatch.from_arrays([pa.array(np.array(x, np.uint64).view(np.int64)) for x in out], names=["inner", "outer", "row", "at"])

    return marked.select("row", "text", "starts").mapInArrow(run, "inner long, outer long, row long, at long")


#: What is asked about one start: its group, its position, whether it is open, whether its group is large.
_ASKED = np.dtype([("inner", "<i8"), ("at", "<i8"), ("open", "?"), ("large", "?")])


def _packed(judged: DataFrame) -> DataFrame:
    """(row, asked): the starts of a row whose surroundings are wanted, packed."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = []
            for asked in batch.column(1):
                entries = np.empty(len(asked.values), _ASKED)
                for name in _ASKED.names:
                    entries[name] = asked.values.field(name).to_numpy(zero_copy_only=False)
                packed.append(entries.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], names=["row", "asked"])

    wanted = judged.where("asked").groupBy("row").agg(F.collect_list(F.struct("inner", "at", "open", "large")).alias("asked"))
    return wanted.mapInArrow(pack, "row long, asked binary")


def _surroundings(marked: DataFrame, gap: int, min_bytes: int) -> DataFrame:
    """Rows to compare. marked: row, text, asked. Of a group of bearable size the bytes around a start are sent under
    the group's key; of a large one a hash per string of MIN_BYTES bytes, each a key."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out)) or [()] * 5
            out.clear()
            return pa.RecordBatch.from_arrays([*(pa.array(x, pa.int64()) for x in columns[:4]), pa.array(columns[4], pa.binary())],
                                              names=["key", "row", "start", "before", "around"])

        for batch in batches:
            for row, text, asked in zip(batch.column(0).to_pylist(), byte_list(batch.column(1)), batch.column(2).to_pylist()):
                for inner, at, is_open, large in np.frombuffer(asked, _ASKED).tolist():
                    begin = max(0, at - gap + 1)
                    around = text[begin:at + min_bytes]
                    mark = (lambda start: start) if is_open else (lambda start: -1 - start)
                    if not large:
                        out.append((inner, row, mark(begin), at - begin, around))
                    else:
                        out.extend((xxhash.xxh3_64_intdigest(around[s:s + min_bytes], seed=at - begin - s) - (1 << 63), row, mark(begin + s), at - begin - s, None)
                                   for s in range(min(at - begin, len(around) - min_bytes) + 1))
                if len(out) >= 8192:
                    yield flush()
        yield flush()

    return marked.select("row", "text", "asked").mapInArrow(run, "key long, row long, start long, before long, around binary")


def _compare(min_bytes: int):
    """(row, low, high): runs of start positions of strings that another entry of the group has as well. A negative
    start marks an entry that is only there for the others."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ["key"], start=1 << 11):
            key, row, start, before = (table.column(i).to_numpy() for i in range(4))
            begin = np.where(start >= 0, start, -1 - start)
            around = table.column("around").to_pylist()
            # an entry without bytes is one string already, and its key is the string's hash
            strings = np.array([1 if a is None else max(0, min(int(b), len(a) - min_bytes) + 1) for a, b in zip(around, before)], np.int64)
            owner = np.repeat(np.arange(len(around)), strings)
            step = np.arange(len(owner)) - np.repeat(np.r_[0, np.cumsum(strings)[:-1]], strings)
            value = np.fromiter((0 if a is None else xxhash.xxh3_64_intdigest(a[s:s + min_bytes], seed=int(b) - s)
                                 for a, b, n in zip(around, before, strings.tolist()) for s in range(n)), np.uint64, len(owner))
            group = key[owner]
            order = np.lexsort((value, group))
            new = np.r_[True, (group[order][1:] != group[order][:-1]) | (value[order][1:] != value[order][:-1])][:len(order)]
            length = np.diff(np.r_[np.flatnonzero(new), len(new)])
            hit = np.zeros(len(owner), bool)
            hit[order] = np.repeat(length > 1, length)
            hit &= start[owner] >= 0
            owner, at = owner[hit], begin[owner[hit]] + step[hit]
            first = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (at[1:] != at[:-1] + 1)][:len(owner)])
            last = np.r_[first[1:], len(owner)][:len(first)] - 1
            yield pa.RecordBatch.from_arrays([pa.array(row[owner[first]]), pa.array(at[first]), pa.array(at[last])], names=["row", "low", "high"])
    return run


def _spans(decisions: DataFrame, gap: int, min_bytes: int) -> DataFrame:
    """(row, spans): the maximal runs of bytes that a row loses, packed begin and end; no spans mean the whole row."""
    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = []
            for runs, certain, whole in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3))):
                if whole:
                    packed.append(b"")
                    continue
                found = sorted([(r["low"], r["high"] + min_bytes) for r in runs or ()] + [(a - gap + 1, a + min_bytes) for a in certain or ()])
                spans = [list(found[0])]
                for low, high in found[1:]:
                    if low <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], high)
                    else:
                        spans.append([low, high])
                packed.append(np.array(spans, np.int64).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], names=["row", "spans"])

    return decisions.select("row", "runs", "certain", "whole").mapInArrow(join, "row long, spans binary")


def suffix_array_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_bytes: int = MIN_BYTES, gap: int = GAP) -> DataFrame:
    """A row per input row: doc_id, kept (bytes that stay), n_bytes, n_removed, n_spans."""
    depth = (min_bytes - GRAM + 1) // gap - 1
    if depth < 1:
        raise ValueError("gap is too long for min_bytes: no whole phrase would be certain")
    numbered = materialize(id_and_text(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id()), "numbered")

    def digest(batch: list[bytes]) -> dict[str, list]:
        return {"size": [len(t) for t in batch], "digest": [xxhash.xxh3_128_digest(t) for t in batch]}

    sizes = materialize(with_columns(numbered, "text", "size long, digest binary", digest).where(F.col("size") >= min_bytes).select("row", "digest"), "sizes")
    several = sizes.groupBy("digest").agg(F.min("row").alias("speaker"), F.count("*").alias("rows")).where("rows > 1")
    copies = materialize(sizes.join(checked(materialize(several, "repeated_texts")), "digest").select("row", (F.col("row") == F.col("speaker")).alias("speaks")), "copies")
    texts = numbered.join(checked(materialize(copies.where(~F.col("speaks")).select("row"), "silent")), "row", "left_anti")
    candidates = materialize(repeated_starts(texts, depth, gap, min_bytes), "starts")
    starts = materialize(_hashed_starts(texts.join(checked(candidates), "row"), gap, min_bytes), "hashed_starts")
    own = F.xxhash64("row", "at")  # the start that speaks for equal surroundings is the one with the least hash
    same = starts.groupBy("inner", "outer").agg(F.count("*").alias("n"), F.min(own).alias("speaker"))
    groups = same.groupBy("inner").agg(F.sum("n").alias("total"), F.count("*").alias("kinds"), F.min("n").alias("least")).where("total > 1")
    # kinds meet their group before starts meet kinds: only that join has a row per start, and it can be split
    judged = materialize(starts.join(same.join(groups, "inner"), ["inner", "outer"])
                         .select("row", "at", "inner", (F.col("n") == 1).alias("open"), (F.col("kinds") > GROUP).alias("large"),
                                 ((F.col("least") == 1) & ((F.col("n") == 1) | (own == F.col("speaker")))).alias("asked")), "judged")
    asked = materialize(_packed(judged), "asked")
    near = _surroundings(texts.join(checked(asked), "row"), gap, min_bytes)
    exact = near.repartition("key").sortWithinPartitions("key").mapInArrow(_compare(min_bytes), "row long, low long, high long")
    open_runs = exact.groupBy("row").agg(F.collect_list(F.struct("low", "high")).alias("runs"))
    certain = judged.where(~F.col("open")).groupBy("row").agg(F.collect_list(F.col("at").cast("int")).alias("certain"))
    whole = copies.select("row", F.lit(True).alias("whole"))
    decided = materialize(_spans(open_runs.join(certain, "row", "full").join(whole, "row", "full"), gap, min_bytes), "decided")
    marked = numbered.join(checked(decided), "row", "left").select("doc_id", "text", "spans")
    kind = marked.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, total, gone, count = [], [], [], []
            for text, packed in zip(byte_list(batch.column(1)), batch.column(2).to_pylist()):
                spans = [] if packed is None else [(0, len(text))] if not packed else np.frombuffer(packed, np.int64).reshape(-1, 2).tolist()
                left, at = [], 0
                for low, high in spans:
                    left.append(text[at:low])
                    at = high
                left.append(text[at:])
                kept.append(b"".join(left))
                total.append(len(text))
                gone.append(len(text) - len(kept[-1]))
                count.append(len(spans))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(kept, pa.binary()), *(pa.array(x, pa.int64()) for x in (total, gone, count))],
                                             names=["doc_id", "kept", "n_bytes", "n_removed", "n_spans"])

    return marked.mapInArrow(cut, f"doc_id {kind}, kept binary, n_bytes long, n_removed long, n_spans long")
