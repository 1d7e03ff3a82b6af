"""Spelling variant grouping with asymmetric q-chunks: words that differ by one edit, found without comparing all pairs.

1. Words and their numbers of occurrences are counted within Arrow batches first, then over the cluster.
2. Of two words the shorter one (x, or either of two equally long ones) contributes two disjoint chunks that cover it,
   its first and its second half; the other (y) contributes positional grams of the chunks' lengths. One edit touches
   one chunk at most, so the other is preserved in y: the first at the same place, the last shifted by the difference in
   length, 0 or 1. Of all positional grams only those at these places can join, and only they are sent.
3. Words meet in an equi-join on (length of x, chunk's number, gram); each pair is verified with a banded Levenshtein
   distance.
4. A key with more than ``PAIRS`` candidate pairs is not joined: the rests are cut into two chunks again, and the rows
   meet on both chunks, and so on. A rest of one character cannot be cut, but there words share all other characters, so
   such a key holds no more words than there are letters.
5. A word's form is its most frequent near word if that is frequent enough; roots follow forms by pointer jumping.

Edge cases: null or empty texts have no words; a null id counts as empty text in the hash; very long runs are words like
any other; ties between near words go to the smallest in code-point order; repeated rows count again; runs may lose a
character (see ``counted_words``) and a run of one character may vanish; extra columns are ignored whatever their
names; an empty table gives an empty result.
"""
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import byte_list, checked, materialize

MIN_LENGTH = 6
MIN_WORDS = 5
#: A form occurs so many times as often as its variant, at least.
TIMES = 5
#: One distinct run of a document in so many loses a character.
EDITED = 199
#: Candidate pairs of a key beyond which its words are cut again.
PAIRS = 1 << 12
#: Letters A-Z, a-z and U+00C0 to U+00FF, as UTF-8.
_RUN = re.compile(rb"(?:[A-Za-z]|\xc3[\x80-\xbf])+")


def edited(run: bytes, doc_id: bytes, every: int = EDITED) -> bytes:
    """The lower-cased run, without one character where the checksum of id and run says so."""
    code = zlib.crc32(run, zlib.crc32(doc_id + b":"))
    if code % every:
        return run
    letters = run.decode()
    at = code % len(letters)
    return (letters[:at] + letters[at + 1:]).encode()


def counted_words(docs: DataFrame, id_col: str, text_col: str, edit_every: int = EDITED) -> DataFrame:
    """(word, n): the distinct words of all texts with their occurrences."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(byte_list(batch.column(0)), byte_list(batch.column(1))):
                for word, n in Counter(_RUN.findall(text.lower())).items():
                    counts[edited(word, doc_id, edit_every)] += n
            if len(counts) > 1 << 18:
                yield pa.RecordBatch.from_arrays([pa.array(list(counts.keys()), pa.binary()).cast(pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])
                counts = Counter()
        yield pa.RecordBatch.from_arrays([pa.array(list(counts.keys()), pa.binary()).cast(pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    read = docs.select(F.col(f"`{id_col}`").cast("string").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return read.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _part(text: Column | str, start: Column, length: Column) -> Column:
    """``length`` characters from ``start``, counted from 0."""
    return F.substring(text, start + 1, length)


def _chunked(rows: DataFrame, length: str) -> DataFrame:
    """The rows of x by their two chunks, and those of y by the grams that can match them; ``key`` grows, ``rest`` is what is
    left. ``length`` names the length of x's rest; y's rest is as long or one longer."""
    half = F.floor(F.col(length) / 2).cast("int")
    own = F.length("rest")
    chunks = F.explode(F.array(
        F.struct(F.lit(0).alias("side"), _part("rest", F.lit(0), half).alias("gram"), _part("rest", half, own - half).alias("left")),
        F.struct(F.lit(1).alias("side"), _part("rest", half + own - F.col(length), F.col(length) - half).alias("gram"),
                 _part("rest", F.lit(0), half + own - F.col(length)).alias("left"))))
    cut = rows.withColumn("cut", chunks)
    left_of_x = F.when(F.col("cut.side") == 0, F.col(length) - half).otherwise(half).cast("int")
    return cut.select(F.xxhash64("key", "cut.side", "cut.gram").alias("key"), "x", "word", F.col("cut.left").alias("rest"), left_of_x.alias(length))


def near_pairs(words: DataFrame, pairs: int = PAIRS) -> DataFrame:
    """(a, b): words of the stored column ``word`` (distinct) that differ by one inserted, deleted or replaced
    character; each pair in both orders, once."""
    sized = words.select("word", F.length("word").alias("n_chars"))
    start = F.explode(F.array(F.struct(F.lit(True).alias("x"), F.col("n_chars").alias("short")), F.struct(F.lit(False).alias("x"), F.col("n_chars").alias("short")),
                              F.struct(F.lit(False).alias("x"), (F.col("n_chars") - 1).alias("short"))))
    rows = sized.select("word", start.alias("as")).select(F.xxhash64("as.short").alias("key"), "as.x", "word", F.col("word").alias("rest"), F.col("as.short").alias("short"))
    found: list[DataFrame] = []
    while True:
        rows = materialize(_chunked(rows, "short"), "spelling_chunks")
        keys = rows.groupBy("key", "short").agg(F.count_if("x").alias("xs"), F.count_if(~F.col("x")).alias("ys")).where("xs > 0 and ys > 1")
        keys = materialize(keys.select("key", "short", ((F.col("xs") * F.col("ys") > pairs) & (F.col("short") > 1)).alias("again")), "spelling_keys")
        met = rows.join(checked(keys), ["key", "short"])
        now = met.where(~F.col("again"))
        one = now.where("x").select("key", "short", F.col("word").alias("a"))
        two = now.where(~F.col("x")).select("key", "short", F.col("word").alias("b"))
        close = one.join(two, ["key", "short"]).where((F.length("a") < F.length("b")) | (F.col("a") < F.col("b")))
        found.append(materialize(close.where(F.levenshtein("a", "b", 1) == 1).select("a", "b"), "spelling_pairs"))
        if not keys.where("again").limit(1).count():
            break
        rows = met.where("again").select("key", "x", "word", "rest", "short")
    both = found[0]
    for x in found[1:]:
        both = both.unionByName(x)
    both = both.distinct()
    return both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) for the words that have a form, by pointer jumping."""
    roots = materialize(forms.select("word", F.col("form").alias("root")), "spelling_roots")
    while True:
        on = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = materialize(roots.join(checked(on), "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "spelling_roots")
        roots = moved.select("word", "root")
        if not moved.where("moved").limit(1).count():
            return roots


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH, min_words: int = MIN_WORDS,
                      times: int = TIMES, pairs: int = PAIRS, edit_every: int = EDITED) -> DataFrame:
    """A row per word of ``min_length`` characters and ``min_words`` occurrences or more: word, form, root, n, n_near, form_n."""
    counts = counted_words(docs, id_col, text_col, edit_every).where((F.length("word") >= min_length) & (F.col("n") >= min_words))
    words = materialize(counts, "spelling_words")
    near = materialize(near_pairs(words, pairs), "spelling_near")
    numbers = checked(words.select(F.col("word").alias("b"), F.col("n").alias("b_n")))
    best = near.join(numbers, "b").groupBy(F.col("a").alias("word")).agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("b_n")).alias("less"), F.col("b"))).alias("best"))
    marked = words.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.col("best.b").alias("b"), (-F.col("best.less")).alias("b_n"))
    enough = F.col("b_n") >= times * F.col("n")
    formed = materialize(marked.select("word", "n", "n_near", F.when(enough, F.col("b")).alias("form"), F.when(enough, F.col("b_n")).alias("form_n")), "spelling_forms")
    roots = _roots(formed.where("form is not null"))
    return formed.join(checked(roots), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
