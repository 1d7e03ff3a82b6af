"""Phrase collocation mining by dynamic itemset counting over cyclic shard scans.

A phrase is a run of words within one piece of a text. Its count can reach the threshold only if those of its two
subphrases (without the last word, without the first) do, so longer phrases are counted while shorter ones still are:

1. The texts are dealt to ``shards`` stored shards. Round t scans shard t modulo ``shards``. Words are counted from round 0.
2. After a round, phrases whose count so far reached the threshold are *reached* in that round. A longer phrase is
   active from the round after both its subphrases were reached, and stays so for one full cycle, at the end of which
   its count is whole. Lengths are thus interleaved in every scan; scans end when no phrase is active.
3. In a scan, tasks look subphrases up in bitmaps that hold, at the place a hash gives, how many rounds ago the first phrase
   of that place was reached. Their size is settled once, so what is broadcast is bounded for any corpus and a place that
   is set stays so. A false hit makes a longer phrase active early, but in the same rounds for every task and for one
   whole cycle all the same: it only costs work, and no exact table has to be joined.
4. Only hashes and counts are shuffled while counting: a phrase's, and that of all but its last word. Of the states the last two
   are kept. The last word's hash follows from those two, so the phrases that were reached find their other subphrase without
   the texts; one more scan gives the spelling of the words that were reached.
5. Scores come from the counted phrases alone: a phrase's first k words and the rest are chains of its subphrases.

Phrases are known by 64-bit hashes. The words of a language are counted under the hash of its name, with length 0.

Edge cases: a null text is empty; null lang is ``und`` and counts together with a literal ``und``; empty pieces, repeated
separators and texts without words give nothing; very long texts are cut into portions that overlap by the longest
phrase, so each occurrence counts once; repeated rows and ids count each time; ties in score and count go by the
phrase's UTF-8 bytes; extra columns are ignored whatever their names; an empty table gives an empty result.
"""
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import byte_list, checked, materialize
from tidemark.session import scratch_folder

LONGEST = 5
MIN_COUNT = 100
SHARDS = 4
TOP = 2000
UNKNOWN = "und"
#: Each bitmap has 64 bits per phrase that a corpus of this size can have reached, at most 2 ** FILTER_POWER bits: 8 MB. Over
#: SHARDS shards three of them hold the rounds.
FILTER_POWER = 26
#: Words that are counted at once in a task, and counts that it holds before it sends them.
PORTION, HELD = 1 << 19, 1 << 19
#: Pieces end at . , ; : ! ? and U+000A to U+000D; all become the first, which no word holds.
_ENDS = bytes.maketrans(b",;:!?\n\x0b\x0c\r", b"." * 9)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_FINAL = np.uint64(0xBF58476D1CE4E5B9)
_COUNTS = "h long, len int, pre long, begin int, c long"
_NAMES = "h long, lang string, word string"


def tokens(text: bytes) -> list[bytes]:
    """Lower-cased words with ``.`` where pieces end."""
    return text.lower().translate(_ENDS).replace(b".", b" . ").split()


def _joined(prefix: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hashes of phrases from the hash of all but the last word and that of the last word."""
    code = (prefix ^ (prefix >> np.uint64(31))) * _MIX + word
    code = (code ^ (code >> np.uint64(29))) * _FINAL
    return code ^ (code >> np.uint64(32))


def _last(phrase: np.ndarray, prefix: np.ndarray) -> np.ndarray:
    """The hash of the last word from those of the phrase and of all but its last word: ``_joined`` backwards."""
    code = (phrase ^ (phrase >> np.uint64(32))) * np.uint64(pow(int(_FINAL), -1, 1 << 64))
    return (code ^ (code >> np.uint64(29)) ^ (code >> np.uint64(58))) - (prefix ^ (prefix >> np.uint64(31))) * _MIX


def _ages(bitmaps: list[np.ndarray], hashes: np.ndarray) -> np.ndarray:
    """The number at the place of each hash, its binary digits taken from the bitmaps; the leading bits of a hash are its place."""
    spot = (hashes >> np.uint64(64 - (8 * len(bitmaps[0])).bit_length() + 1)).astype(np.int64)
    byte, bit, out = spot >> 3, (spot & 7).astype(np.uint8), np.zeros(len(hashes), np.uint8)
    for digit, bitmap in enumerate(bitmaps):
        out |= (bitmap[byte] >> bit & 1) << digit
    return out


class _Portion:
    """Rows of a task, one per phrase of a stretch, sent together."""

    def __init__(self, names: list[str]):
        self.names, self.parts, self.size = names, [], 0

    def add(self, *columns: np.ndarray) -> None:
        self.parts.append(columns)
        self.size += len(columns[0])

    def take(self) -> Iterator[pa.RecordBatch]:
        if self.size:
            columns = [np.concatenate(x) for x in zip(*self.parts)]
            self.parts, self.size = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64) if x.dtype == np.uint64 else x) for x in columns], names=self.names)


def _distinct(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each distinct hash stands first, and how often it occurs, in the order of hashes."""
    order = np.argsort(hashes, kind="stable")
    ordered = hashes[order]
    first = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]][:len(ordered)])
    return order[first], np.diff(np.r_[first, len(ordered)])


def _portions(langs: list[str], texts: list[bytes], longest: int, portion: int) -> Iterator[tuple[str, list[bytes], int]]:
    """(lang, words, own): stretches of one language of about ``portion`` words; only phrases that begin in the first ``own``
    words belong to a stretch. Texts are kept apart by a separator."""
    for lang in dict.fromkeys(langs):
        words: list[bytes] = []
        for at, text in enumerate(texts):
            if langs[at] != lang:
                continue
            words += tokens(text)
            words.append(b".")
            while len(words) >= portion + longest:
                yield lang, words[:portion + longest - 1], portion
                words = words[portion:]
        if words:
            yield lang, words, len(words)


class _Stretch:
    """The words of a stretch by their hashes."""

    def __init__(self, lang: str, words: list[bytes]):
        coded = pa.array(words, pa.binary()).dictionary_encode()
        self.vocabulary, self.code = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        self.lang = xxhash.xxh3_64_intdigest(lang.encode())
        self.of_word = np.array([0 if w == b"." else xxhash.xxh3_64_intdigest(w, self.lang) for w in self.vocabulary], np.uint64)
        self.is_word = np.array([w != b"." for w in self.vocabulary])

    def longer(self, bitmaps: list[np.ndarray], longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(length, where, hashes by where, subphrases' hashes by place, ages by where): phrases whose subphrases were both
        reached, with the rounds since the later one was. An age of 0 stands for a phrase that was not reached."""
        single = hashes = self.of_word[self.code]
        age = (_ages(bitmaps, self.of_word) * self.is_word)[self.code]
        for length in range(2, longest + 1):
            # hashes, age: of the phrases of length - 1 by their first word
            begin = np.flatnonzero((age[:-1] > 0) & (age[1:] > 0))
            if not len(begin):
                return
            whole = _joined(hashes[begin], single[begin + length - 1])
            since = np.minimum(age[begin], age[begin + 1])
            yield length, begin, whole, hashes, since
            if length == longest:
                return
            hashes, age = np.zeros(len(hashes) - 1, np.uint64), np.zeros(len(age) - 1, np.uint8)
            hashes[begin] = whole
            # a place may have been set before this phrase could be counted
            age[begin] = np.minimum(_ages(bitmaps, whole), since)


def _scan(longest: int, portion: int, shards: int, round_: int, bitmaps: list[np.ndarray]):
    """Counts of one shard. Words are counted in the first cycle; longer phrases for a cycle after both subphrases were reached."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted = _Portion(["h", "len", "pre", "begin", "c"])

        def add(length: int, hashes: np.ndarray, prefix: np.ndarray, begin: np.ndarray, count: np.ndarray) -> None:
            counted.add(hashes, np.full(len(hashes), length, np.int32), prefix, begin.astype(np.int32), count.astype(np.int64))

        for batch in batches:
            for lang, words, own in _portions(batch.column(0).to_pylist(), byte_list(batch.column(1)), longest, portion):
                stretch = _Stretch(lang, words)
                if round_ < shards:
                    n = np.bincount(stretch.code[:own], minlength=len(stretch.vocabulary)) * stretch.is_word
                    at = np.flatnonzero(n)
                    add(1, stretch.of_word[at], np.zeros(len(at), np.uint64), np.zeros(len(at)), n[at])
                    add(0, np.array([stretch.lang], np.uint64), np.zeros(1, np.uint64), np.zeros(1), np.array([n.sum()]))
                for length, begin, hashes, shorter, since in stretch.longer(bitmaps, longest) if bitmaps else ():
                    active = np.flatnonzero((since <= shards) & (begin < own))
                    first, count = _distinct(hashes[active])
                    at = active[first]
                    add(length, hashes[at], shorter[begin[at]], round_ + 1 - since[at].astype(np.int32), count)
                if counted.size >= HELD:
                    yield from counted.take()
        yield from counted.take()
    return run


def _name_scan(longest: int, portion: int, bitmaps: list[np.ndarray]):
    """The words that the bitmaps hold, with their language; languages under their own hash, without a word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, words, _ in _portions(batch.column(0).to_pylist(), byte_list(batch.column(1)), longest, portion):
                stretch = _Stretch(lang, words)
                known = np.flatnonzero(stretch.is_word & (_ages(bitmaps, stretch.of_word) > 0))
                yield pa.RecordBatch.from_arrays([pa.array(np.r_[stretch.of_word[known], np.uint64(stretch.lang)].view(np.int64)), pa.array([lang] * (len(known) + 1)),
                                                  pa.array([*(stretch.vocabulary[i] for i in known.tolist()), None], pa.binary()).cast(pa.string())],
                                                 names=["h", "lang", "word"])
    return run


def _suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hash of all but the first word, from that of all but the first and last (``core``, null for two words)."""
    for batch in batches:
        h, pre, core = (pc.fill_null(batch.column(i), 0).to_numpy().view(np.uint64) for i in (0, 2, 4))
        last = _last(h, pre)
        suf = np.where(pc.is_null(batch.column(4)).to_numpy(zero_copy_only=False), last, _joined(core, last))
        yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(suf.view(np.int64))], names=["h", "len", "pre", "c", "suf"])


def _with_suffixes(counted: DataFrame, longest: int) -> DataFrame:
    """Counted phrases of two words or more with ``suf``, length by length."""
    out: DataFrame | None = None
    core = F.lit(None).cast("long").alias("core")
    for length in range(2, longest + 1):
        own = counted.where(F.col("len") == length).select("h", "len", "pre", "c")
        if out is None:
            own = own.select("*", core)
        else:
            own = own.join(checked(level.select(F.col("h").alias("pre"), F.col("suf").alias("core"))), "pre").select("h", "len", "pre", "c", "core")
        level = materialize(own.mapInArrow(_suffixes, "h long, len int, pre long, c long, suf long"), "phrase_suffixes")
        out = level if out is None else out.unionByName(level)
    return out


def _bitmaps(phrases: DataFrame, age: Column, digits: int, power: int) -> list[np.ndarray]:
    """Bitmaps of the binary digits of the age at each place, the greatest where phrases share one, put together by Spark as
    64-bit blocks: at most 2 ** power / 64 of them come to the driver."""
    spot = F.shiftrightunsigned("h", 64 - power)
    places = phrases.groupBy(spot.alias("spot")).agg(F.max(age).alias("age"))
    bit = F.expr("shiftleft(1L, cast(spot & 63 AS int))")
    blocks = places.groupBy(F.shiftright("spot", 6).alias("block")).agg(*[F.bit_or(F.when(F.col("age").bitwiseAND(1 << d) > 0, bit).otherwise(0)).alias(f"d{d}") for d in range(digits)])
    found, maps = blocks.toArrow(), []
    for d in range(digits):
        whole = np.zeros((1 << power) // 64, np.int64)
        whole[found["block"].to_numpy()] = found[f"d{d}"].to_numpy()
        maps.append(whole.view(np.uint8))
    return maps


def frequent_phrases(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", min_count: int = MIN_COUNT, longest: int = LONGEST,
                     shards: int = SHARDS, portion: int = PORTION, filter_power: int = FILTER_POWER) -> tuple[DataFrame, DataFrame]:
    """Two stored tables: phrases of 1 to ``longest`` words that occur ``min_count`` times or more (h, len, pre, suf, lang,
    word, c), words with lang and word; and (lang, n), all words of each language."""
    if not 0 < shards < 255:
        raise ValueError("shards must be from 1 to 254")
    spark = docs.sparkSession
    folder = scratch_folder(spark, "phrase_shards")
    dealt = docs.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit(UNKNOWN)).alias("lang"),
                        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
                        F.pmod(F.monotonically_increasing_id(), F.lit(shards)).alias("shard"))
    dealt.write.partitionBy("shard").parquet(folder)
    stored = spark.read.schema("lang string, text string, shard int").parquet(folder)
    folders = [scratch_folder(spark, "phrase_state") for _ in range(2)]
    digits = (shards + 1).bit_length()
    state: DataFrame | None = None
    round_ = power = 0
    while True:
        maps = []
        if state is not None:
            parts = state.where((F.col("reach").isNotNull()) & (F.col("len") < longest))
            if round_ >= shards and parts.where(F.col("reach") >= round_ - shards).isEmpty():
                break
            if not power:
                # a length has at most n / min_count phrases that are reached
                n = shards * (state.where("len = 0").agg(F.sum("c")).first()[0] or 0)
                power = min(filter_power, max(6, (64 * (longest - 1) * n // min_count).bit_length()))
            # rounds since: 1 in the round after the phrase was reached, all beyond a cycle alike
            maps = _shared(spark, _bitmaps(parts, F.least(F.lit(round_) - F.col("reach"), F.lit(shards + 1)), digits, power))
        shard = stored.where(F.col("shard") == round_ % shards).select("lang", "text")
        # counts of a task's portions go on as they are: they meet the state in one aggregation and one shuffle
        new = shard.mapInArrow(_lazy(_scan, maps, longest, portion, shards, round_), _COUNTS).withColumn("reach", F.lit(None).cast("int"))
        if state is not None:
            new = new.unionByName(state)
        summed = new.groupBy("h", "len").agg(F.min("pre").alias("pre"), F.sum("c").alias("c"), F.min("begin").alias("begin"), F.min("reach").alias("reach"))
        summed = summed.withColumn("reach", F.coalesce("reach", F.when((F.col("c") >= min_count) & (F.col("len") > 0), F.lit(round_))))
        # what has been counted for a whole cycle without reaching the threshold never will
        over = F.col("reach").isNull() & (F.col("len") > 0) & (F.col("begin") + shards - 1 <= round_)
        # two folders in turn: the state before the last one makes room for the next
        summed.where(~over).write.mode("overwrite").parquet(folders[round_ % 2])
        state = spark.read.schema(summed.schema).parquet(folders[round_ % 2])
        for m in maps:
            m.destroy()
        round_ += 1
    counted = materialize(state.where("reach is not null or len = 0").select("h", "len", "pre", "c"), "phrase_counts")
    short = counted.where("len < 2").select("h", "len", "c")
    maps = _shared(spark, _bitmaps(short.where("len = 1"), F.lit(1), 1, max(6, power)))
    names = materialize(stored.select("lang", "text").mapInArrow(_lazy(_name_scan, maps, longest, portion), _NAMES).distinct(), "phrase_words")
    for m in maps:
        m.destroy()
    named = names.withColumn("len", F.when(F.col("word").isNull(), 0).otherwise(1)).join(checked(short), ["h", "len"])
    none = F.lit(None)
    words = named.where("len = 1").select("h", "len", none.cast("long").alias("pre"), none.cast("long").alias("suf"), "lang", "word", "c")
    longer = _with_suffixes(counted, longest).select("h", "len", "pre", "suf", none.cast("string").alias("lang"), none.cast("string").alias("word"), "c")
    return materialize(words.unionByName(longer), "phrases"), materialize(named.where("len = 0").select("lang", F.col("c").alias("n")), "totals")


def _shared(spark, bitmaps: list[np.ndarray]) -> list:
    return [spark.sparkContext.broadcast(m) for m in bitmaps]


def _lazy(scan, maps: list, *parameters):
    """The scan with the bitmaps taken from their broadcast inside the task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return scan(*parameters, [m.value for m in maps])(batches)
    return run


def _worded(phrases: DataFrame, longest: int) -> DataFrame:
    """(h, pre, suf, lang, phrase, last, c, firsts, rests): firsts[k] is the count of the first k + 1 words, rests[k] that of
    the words after them."""
    level = materialize(phrases.where("len = 1").select("h", "pre", "suf", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"), "c",
                                                        F.expr("cast(array() AS array<bigint>)").alias("firsts"), F.expr("cast(array() AS array<bigint>)").alias("rests")), "worded")
    longer: list[DataFrame] = []
    for length in range(2, longest + 1):
        pre = level.select(F.col("h").alias("pre"), "lang", F.col("phrase").alias("head"), F.concat("firsts", F.array("c")).alias("firsts"))
        suf = level.select(F.col("h").alias("suf"), "last", F.concat(F.array("c"), "rests").alias("rests"))
        own = phrases.where(F.col("len") == length).select("h", "pre", "suf", "c")
        joined = own.join(checked(pre), "pre").join(checked(suf), "suf")
        level = materialize(joined.select("h", "pre", "suf", "lang", F.concat_ws(" ", "head", "last").alias("phrase"), "last", "c", "firsts", "rests"), "worded")
        longer.append(level)
    out = longer[0]
    for x in longer[1:]:
        out = out.unionByName(x)
    return out


def _score(k: Column) -> Column:
    """floor(1000 a n / (l r)) for the cut after k + 1 words, in whole numbers of up to 38 digits."""
    wide = [F.col(c).cast("decimal(19,0)") for c in ("c", "n")]
    sides = [F.get(F.col(c), k).cast("decimal(19,0)") for c in ("firsts", "rests")]
    over = (wide[0] * wide[1]).cast("decimal(34,0)") * F.lit(1000).cast("decimal(4,0)")
    return F.call_function("div", over.cast("decimal(38,0)"), (sides[0] * sides[1]).cast("decimal(38,0)"))


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", min_count: int = MIN_COUNT, longest: int = LONGEST,
                 shards: int = SHARDS, top: int = TOP, portion: int = PORTION, filter_power: int = FILTER_POWER) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score. A phrase that occurs only within one and
    the same longer phrase is left out; of a phrase's cuts the lowest score counts, the earliest on ties."""
    phrases, totals = frequent_phrases(docs, lang_col, text_col, min_count, longest, shards, portion, filter_power)
    words = _worded(phrases, longest)
    # a longer phrase with the same count holds one that is a word longer with the same count
    around = words.select(F.col("pre").alias("h"), "c").unionByName(words.select(F.col("suf").alias("h"), "c")).groupBy("h").agg(F.max("c").alias("around"))
    scored = words.join(checked(materialize(around, "phrases_around")), "h", "left").where(F.col("around").isNull() | (F.col("around") < F.col("c")))
    scored = scored.join(checked(totals), "lang")
    cuts = [F.struct(_score(F.lit(k)).alias("score"), F.lit(k).alias("k")) for k in range(longest - 1)]
    cut = F.array_min(F.filter(F.array(*cuts), lambda x: x["score"].isNotNull()))
    scored = scored.withColumn("cut", cut).select("lang", "phrase", F.col("c").alias("a"), F.get("firsts", F.col("cut.k")).alias("l"), F.get("rests", F.col("cut.k")).alias("r"),
                                                  "n", F.col("cut.score").alias("score"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
