"""Language identification by rank-order profiles.

A profile is the list of a language's most frequent character n-grams (1 to 3 letters, words padded with a
space) in order of frequency. A document's own most frequent n-grams are compared with each profile by the
out-of-place distance: the sum over the document's n-grams of how far their rank is from the profile's, or
the profile's length for n-grams that the profile lacks. The nearest language is predicted.

Profiles are learned from at most ``MAX_TRAINING`` labelled documents per language (those with the smallest
hash of the id, whole texts); every document is predicted from its whole text.

Edge cases: a null text or one without a letter is ``und`` with score 0; ties go to the language first in
code-point order; without any labelled document everything is ``und``; repeated rows get equal predictions;
rows with a null id or null lang teach nothing; an empty table gives an empty result.
"""
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import byte_list, materialize, smallest_hashes, with_columns

#: N-grams in a profile.
TOP = 500
#: Labelled documents per language that profiles are learned from, at most.
MAX_TRAINING = 4000
_NOT_LETTERS = re.compile(r"[\W\d_]+")


def ngrams(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-grams of a text, packed 21 bits a letter, and their counts."""
    clean = _NOT_LETTERS.sub(" ", text.decode("utf-8", "replace").lower()).strip()
    if not clean:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    c = np.frombuffer(f" {clean} ".encode("utf-32-le"), np.uint32).astype(np.int64)
    one, two = c[c != 32], c[:-1] << 21 | c[1:]
    three = (two[:-1] << 21 | c[2:])[c[1:-1] != 32]
    return np.unique(np.concatenate([one, two, three]), return_counts=True)


def ranked(grams: np.ndarray, counts: np.ndarray, top: int) -> np.ndarray:
    """The most frequent n-grams in order; ties by code."""
    return grams[np.lexsort((grams, -counts))[:top]]


def learn_profiles(docs: DataFrame, lang_col: str = "lang", id_col: str = "doc_id", text_col: str = "text", top: int = TOP,
                   max_training: int = MAX_TRAINING) -> dict[str, np.ndarray]:
    """Profiles by language, from the labelled rows of ``docs``. The driver gets ``top`` n-grams per language."""
    labelled = docs.where(F.col(lang_col).isNotNull() & F.col(id_col).isNotNull())
    chosen = smallest_hashes(labelled.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{lang_col}`").cast("string").alias("lang")).distinct(),
                             "lang", "doc_id", max_training)
    # at most max_training ids per language: small by its bound
    texts = labelled.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"), F.col(f"`{lang_col}`").cast("string").alias("lang"))
    texts = texts.join(F.broadcast(materialize(chosen, "training")), ["doc_id", "lang"], "left_semi").select("text", "lang")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_lang: dict[str, list[bytes]] = {}
            for text, lang in zip(byte_list(batch.column(0)), batch.column(1).to_pylist()):
                by_lang.setdefault(lang, []).append(text)
            for lang, own in by_lang.items():
                grams, counts = ngrams(b" ".join(own))
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()), pa.array(grams), pa.array(counts)], names=["lang", "gram", "n"])

    totals = texts.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    best = totals.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))).where(F.col("rank") <= top)
    profiles: dict[str, list[int]] = {}
    for row in best.orderBy("lang", "rank").collect():
        profiles.setdefault(row.lang, []).append(row.gram)
    return {lang: np.array(grams, np.int64) for lang, grams in profiles.items()}


def predict(docs: DataFrame, profiles: dict[str, np.ndarray], text_col: str = "text", top: int = TOP) -> DataFrame:
    """``docs`` with lang_pred and score: the lead of the nearest profile over the runner-up, as a share of the
    runner-up's distance, moved into 0.5 to 1 (1 with a single language known)."""
    langs = sorted(profiles, key=lambda x: x.encode())
    tables = []
    for lang in langs:
        order = np.argsort(profiles[lang], kind="stable")
        tables.append((profiles[lang][order], order))

    def guess(text: bytes) -> tuple[str, float]:
        own = ranked(*ngrams(text), top)
        if not len(own) or not langs:
            return "und", 0.0
        place = np.arange(len(own))
        distances = []
        for grams, ranks in tables:
            at = np.minimum(np.searchsorted(grams, own), len(grams) - 1)
            distances.append(int(np.where(grams[at] == own, np.abs(ranks[at] - place), top).sum()))
        best = int(np.argmin(distances))
        other = min((d for i, d in enumerate(distances) if i != best), default=None)
        lead = 1.0 if other is None else (other - distances[best]) / max(1, other)
        return langs[best], 0.5 + 0.5 * lead

    def run(texts: list[bytes]) -> dict[str, list]:
        got = [guess(t) for t in texts]
        return {"lang_pred": [g[0] for g in got], "score": [g[1] for g in got]}

    return with_columns(docs, text_col, "lang_pred string, score double", run)
