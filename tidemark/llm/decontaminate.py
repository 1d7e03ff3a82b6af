"""Benchmark decontamination by the q-gram lemma.

Texts and benchmark items are lower-cased and their whitespace is collapsed. An occurrence of an item of
length m with at most e edits shares at least m - q + 1 - q*e of its q-grams with the text, and these lie on
diagonals (text position minus item position) within e of one another. Shared q-grams are counted per item
in overlapping bands of diagonals; a band that meets the bound is verified by banded alignment. So each
occurrence within the edit budget is found.

The bound is positive for q <= m / (e + 1): q is 16, or 8 for items of 20 to 79 characters whose budget asks for less than 16. Items of
8 to 15 characters have a budget of no edit.

The benchmark is the query set: it is read in blocks of at most ``BLOCK_BYTES`` of text, each block goes to
every task, and a task holds one block and one Arrow batch of documents.

Edge cases: a null or empty text holds no item; a null or empty item, and an item of less than 8 characters (a common
word says nothing about a benchmark), matches nothing; equal items are all reported; of an item's occurrences in a text the one
with the fewest edits, then the first, is reported; repeated rows are reported each; texts are searched whole, however long; columns
are kept whatever their names; an empty table on either side gives an empty result.
"""
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import byte_list, free_names, id_and_text, with_columns

#: Lengths of q-grams: the first that leaves an item a positive bound.
Q = (16, 8)
#: Edits allowed, as a share of the item's length.
BUDGET = 0.05
#: Text of one block of benchmark items.
BLOCK_BYTES = 4 << 20
_BITS = 22


def normalise(text: bytes) -> str:
    return " ".join(text.decode("utf-8", "replace").lower().split())


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def gram_codes(text: str, q: int) -> np.ndarray:
    """A 64-bit code of each window of ``q`` (16 or 8) characters. Characters are folded to a byte first; a rare clash of
    codes only makes one more region to verify."""
    if len(text) < q:
        return np.zeros(0, np.uint64)
    points = _points(text)
    data = (points ^ (points >> np.uint32(8)) * np.uint32(37)).astype(np.uint8)
    eight = np.lib.stride_tricks.as_strided(data, (len(data) - 7, 8), (1, 1)).copy().view(np.uint64)[:, 0]
    mixed = (eight[:-8] if q == 16 else eight) * np.uint64(0x9E3779B97F4A7C15)
    if q == 16:
        mixed += (eight[8:] ^ (eight[8:] >> np.uint64(29))) * np.uint64(0xC2B2AE3D27D4EB4F)
    return mixed ^ (mixed >> np.uint64(32))


def aligned(item: str, region: str, budget: int, low: int, high: int) -> tuple[int, int, int] | None:
    """(edits, start, end) of the best occurrence of ``item`` in ``region`` within ``budget`` edits whose path
    stays on diagonals ``low - budget`` to ``high + budget``; None if there is none. The first best end counts."""
    at = region.find(item)
    if at >= 0:
        return 0, at, at + len(item)
    low, high = low - budget, high + budget
    text = _points(region)
    diagonals = np.arange(low, high + 1)
    far = len(item) + len(region) + 1
    inside = (diagonals >= 0) & (diagonals <= len(text))
    cost, begin = np.where(inside, 0, far), np.where(inside, diagonals, 0)  # row 0: an occurrence may begin anywhere
    steps = np.arange(len(diagonals))
    for i, letter in enumerate(_points(item), 1):
        end = diagonals + i  # text letters used on each diagonal
        valid = (end >= 0) & (end <= len(text))
        other = np.ones(len(end), np.int64)
        usable = valid & (end >= 1)
        other[usable] = text[end[usable] - 1] != letter
        same = np.where(usable, cost + other, far)
        up, up_begin = np.r_[cost[1:] + 1, far], np.r_[begin[1:], 0]  # an item letter without text letter
        better = up < same
        cost, begin = np.where(valid, np.where(better, up, same), far), np.where(better, up_begin, begin)
        # text letters without item letter: a running minimum along the row
        slack = cost - steps
        least = np.minimum.accumulate(slack)
        source = np.maximum.accumulate(np.where(slack == least, steps, 0))
        cost, begin = np.where(valid, least + steps, far), begin[source]
    best = int(np.argmin(cost))
    return (int(cost[best]), int(begin[best]), int(diagonals[best] + len(item))) if cost[best] <= budget else None


class _Grams:
    """The q-grams of items of one q, with what the counting needs."""

    def __init__(self, items: list[tuple[int, str]], edits: list[int], q: int):
        self.items, self.q = items, q
        self.edits = np.array(edits, np.int64)
        self.bound = np.array([len(t) for _, t in items], np.int64) - q + 1 - q * self.edits
        codes = [gram_codes(t, q) for _, t in self.items] or [np.zeros(0, np.uint64)]
        item = np.repeat(np.arange(len(self.items)), [len(c) for c in codes][:len(self.items)])
        offset = np.concatenate([np.arange(len(c)) for c in codes])
        every = np.concatenate(codes)
        order = np.argsort(every, kind="stable")
        self.codes, self.item, self.offset = every[order], item[order], offset[order]
        self.seen = np.zeros(1 << _BITS, bool)
        self.seen[(self.codes >> np.uint64(64 - _BITS)).astype(np.int64)] = True

    def find(self, text: str) -> list[tuple[int, int, int, int, int]]:
        """(item id, shared q-grams, edits, start, end) for each item that the normalised text holds."""
        if len(text) < self.q or not len(self.codes):
            return []
        codes = gram_codes(text, self.q)
        at = np.flatnonzero(self.seen[(codes >> np.uint64(64 - _BITS)).astype(np.int64)])
        first = np.searchsorted(self.codes, codes[at], "left")
        number = np.searchsorted(self.codes, codes[at], "right") - first
        if not number.any():
            return []
        at, first, number = at[number > 0], first[number > 0], number[number > 0]
        slot = np.repeat(first - np.r_[0, np.cumsum(number)[:-1]], number) + np.arange(number.sum())
        item, diagonal = self.item[slot], np.repeat(at, number) - self.offset[slot]
        width = 2 * self.edits[item] + 1
        band = diagonal // width
        item, band, place = (np.concatenate(x) for x in ((item, item), (band, band - 1), (self.offset[slot], self.offset[slot])))
        # each q-gram of the item counts once in a band
        order = np.lexsort((place, band, item))
        item, band, place = item[order], band[order], place[order]
        new = np.r_[True, (item[1:] != item[:-1]) | (band[1:] != band[:-1])]
        fresh = new | np.r_[True, place[1:] != place[:-1]]
        start = np.flatnonzero(new)
        shared = np.add.reduceat(fresh.astype(np.int64), start)
        found: dict[int, tuple[int, int, int, int, int]] = {}
        for k in np.flatnonzero(shared >= self.bound[item[start]]):
            i, b = int(item[start[k]]), int(band[start[k]])
            name, pattern = self.items[i]
            edits = int(self.edits[i])
            low = b * (2 * edits + 1)
            high = low + 2 * (2 * edits + 1) - 1
            begin = max(0, low - edits)
            match = aligned(pattern, text[begin:high + edits + len(pattern)], edits, low - begin, high - begin)
            if match:
                got = (match[0], begin + match[1], begin + match[2])
                if i not in found or got < found[i][2:]:
                    found[i] = (name, int(shared[k]), *got)
        return [found[i] for i in sorted(found)]


class ItemBlock:
    """A block of items, each among the q-grams of the first q that leaves it a positive bound."""

    def __init__(self, items: list[tuple[int, bytes]], budget: float):
        dealt: dict[int, list] = {}
        for name, text in ((i, normalise(t)) for i, t in items):
            edits = int(len(text) * budget)
            q = next((q for q in Q if q * (edits + 1) <= len(text)), None)
            if q:
                dealt.setdefault(q, []).append((name, text, edits))
        self.parts = [_Grams([(i, t) for i, t, _ in rows], [e for _, _, e in rows], q) for q, rows in dealt.items()]

    def find(self, text: str) -> list[tuple[int, int, int, int, int]]:
        """(item id, shared q-grams, edits, start, end) for each item that the normalised text holds."""
        return [hit for part in self.parts for hit in part.find(text)]


def item_blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", budget: float = BUDGET, block_bytes: int = BLOCK_BYTES) -> Iterator[ItemBlock]:
    """The benchmark in blocks, streamed to the driver a partition at a time."""
    items, size = [], 0
    rows = benchmark.select(F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`").cast("string")).where(F.col(f"`{text_col}`").isNotNull())
    for name, text in rows.toLocalIterator():
        items.append((name, text.encode()))
        size += len(items[-1][1])
        if size >= block_bytes:
            yield ItemBlock(items, budget)
            items, size = [], 0
    if items:
        yield ItemBlock(items, budget)


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """A row per document row and item found in it: doc_id, item_id, shared_grams, edits, start, end (positions in
    the normalised text)."""
    texts = id_and_text(docs, id_col, text_col)
    schema = T.StructType([texts.schema["doc_id"], *T.StructType.fromDDL("item_id long, shared_grams long, edits long, start long, end long")])
    parts = []
    for block in item_blocks(benchmark, **options):
        def run(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows, got = [], []
                for row, text in enumerate(byte_list(batch.column(1))):
                    found = block.find(normalise(text))
                    rows += [row] * len(found)
                    got += found
                columns = [pa.array(list(c), pa.int64()) for c in zip(*got)] or [pa.array([], pa.int64())] * 5
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), *columns], names=schema.names)

        parts.append(texts.mapInArrow(run, schema))
    if not parts:
        return docs.sparkSession.createDataFrame([], schema)
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that hold no item."""
    left, (mark,) = docs, free_names(docs.columns, "decontaminate_hits")
    for block in item_blocks(benchmark, **options):
        left = with_columns(left, text_col, f"{mark} int",
                            lambda texts, block=block: {mark: [len(block.find(normalise(t))) for t in texts]}).where(f"{mark} = 0")
    return left.select([F.col(f"`{c}`") for c in docs.columns])
