"""Toxicity: a learned lexicon, misspellings by Levenshtein automata, and context windows.

Learning (labelled rows only, at most ``MAX_TOXIC`` and ``MAX_CLEAN`` of them, those with the smallest hash of the
id): a term enters the lexicon when toxic texts use it significantly more often than clean ones. Toxic uses are
counted by distinct neighbours, so copies of one toxic text do not promote all of its words.

A term is a word, or a stem of four to seven letters (written with a ``*``) when its words as a family are toxic.

Matching (every document, whole text): the words of a text are looked up in the lexicon. A word of five letters or more that
is no term and has no such stem is run as a Levenshtein automaton against the trie of the lexicon: words one edit away, and
stems of six letters or more one edit away from the word's beginning. Two neighbouring letters swapped count as one edit too.
Shorter words and stems have too many neighbours and must be spelled as learned. Each hit is judged in a window of words around it: inside one pair
of quotation marks that opens and closes in the window, or beside a word of attribution, it counts as quotation, otherwise as
abuse, more so when the reader is addressed. Apostrophes inside words are no marks; a mark without its partner quotes nothing.

Scoring: a logistic regression over the summed term weights of abuse, misspelled abuse and quotation,
fitted on the same labelled rows.

Edge cases: a null or empty text has no hit and gets the score of such texts; rows with a null id or null
label teach nothing; conflicting labels of an id both count; without a toxic label, score is 0; repeated
rows get equal scores; an empty table gives an empty result. Of terms equally near a word the one with fewer edits, then the first in
text order, is taken. Very long texts are read whole, a portion of texts at a time.
"""
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import byte_list, materialize, smallest_hashes, with_columns

MAX_TOXIC = 3000
MAX_CLEAN = 12000
#: A text is predicted toxic from this score on.
THRESHOLD = 0.7
#: Words on either side of a hit that are its context.
CONTEXT = 8
#: Least log-odds and log-likelihood ratio of a term.
MIN_WEIGHT = 3.5
MIN_EVIDENCE = 16.0
STEMS = (4, 5, 6, 7)
#: Least letters of a word, and of a stem, for which one edit is allowed.
FUZZY_LETTERS = 5
FUZZY_STEM_LETTERS = 6
_CACHE = 200_000

# fixed values: words that announce a quotation, and words that address the reader
ATTRIBUTION = frozenset("""said says saying called calls wrote writes quote quoted quotes cited dit écrit disait sagte nannte schrieb zitiert
dijo llamó escribió citó""".split())
ADDRESS = frozenset("you your yours u du dich dir dein deine euch tu toi vous votre ton te tú usted vosotros eres".split())
# fixed values: quotation marks that open, each with those that close it
QUOTES = {'"': '"', "“": "”", "„": "“”", "”": "”", "«": "»", "»": "«", "‹": "›", "›": "‹", "‘": "’", "‚": "‘’", "’": "’", "`": "`'"}

#: A word, or a mark; marks that serve as apostrophes do not stand between two letters.
_TOKEN = re.compile(r"[^\W\d_]+|[\"“”„«»‹›]|(?<![^\W\d_])[‘’‚`']|[‘’‚`'](?![^\W\d_])")
_WORD = re.compile(r"[^\W\d_]+")


#: Word of the text, lexicon term, edits between them, whether it is quoted, weight in its context.
Hit = tuple[str, str, int, bool, float]


class LevenshteinAutomaton:
    """Accepts the words within ``edits`` of ``word``. A state is the tuple of (position, edits so far) pairs
    that are still within the limit."""

    def __init__(self, word: str, edits: int = 1):
        self.word, self.edits = word, edits

    def _closed(self, best: dict[int, int]) -> tuple[tuple[int, int], ...]:
        for at in sorted(best):  # letters of the word may be left out
            cost = best[at]
            while at < len(self.word) and cost < self.edits:
                at, cost = at + 1, cost + 1
                if best.get(at, self.edits + 1) <= cost:
                    break
                best[at] = cost
        return tuple(sorted(best.items()))

    def start(self) -> tuple[tuple[int, int], ...]:
        return self._closed({0: 0})

    def step(self, state: tuple[tuple[int, int], ...], letter: str) -> tuple[tuple[int, int], ...]:
        best: dict[int, int] = {}
        for at, cost in state:
            if at < len(self.word):
                moved = cost + (self.word[at] != letter)
                if moved <= self.edits:
                    best[at + 1] = min(moved, best.get(at + 1, moved))
            if cost < self.edits:
                best[at] = min(cost + 1, best.get(at, cost + 1))
        return self._closed(best)

    def begins(self, state: tuple[tuple[int, int], ...]) -> int | None:
        """Least edits between what was read up to this state and some beginning of the word, None in a dead state."""
        return min((cost for _, cost in state), default=None)

    def accepts(self, state: tuple[tuple[int, int], ...]) -> int | None:
        """Edits of a word that ends in this state, None when it is not accepted."""
        return next((cost for at, cost in state if at == len(self.word)), None)


def trie_of(terms) -> dict:
    """A trie of words and of stems, whose ends are marked ``*``."""
    root: dict = {}
    for term in terms:
        node = root
        for letter in term:
            node = node.setdefault(letter, {})
        node[""] = term
    return root


def intersect(automaton: LevenshteinAutomaton, trie: dict) -> list[tuple[int, str]]:
    """(edits, term) of the trie's terms that the automaton accepts; branches without a live state are cut."""
    found, stack = [], [(trie, automaton.start())]
    while stack:
        node, state = stack.pop()
        for letter, below in node.items():
            if letter == "":
                edits = automaton.accepts(state)
                if edits is not None:
                    found.append((edits, below))
            elif letter == "*":
                edits = automaton.begins(state)
                if edits is not None:
                    found.append((edits, below[""]))
            elif after := automaton.step(state, letter):
                stack.append((below, after))
    return sorted(found)


def forms(word: str) -> list[str]:
    """The lexicon entries that a word may stand for: itself and its stems."""
    return [word, *(word[:n] + "*" for n in STEMS if len(word) > n)]


def swaps(word: str) -> Iterator[str]:
    """The word with two neighbouring letters changed about."""
    for i in range(len(word) - 1):
        if word[i] != word[i + 1]:
            yield word[:i] + word[i + 1] + word[i] + word[i + 2:]


def quotations(tokens: list[str]) -> list[tuple[int, int]]:
    """(opening, closing) places of paired quotation marks, from left to right. Marks within a pair belong to what is quoted."""
    last = {token: at for at, token in enumerate(tokens)}
    pairs, opened, closers = [], -1, ""
    for at, token in enumerate(tokens):
        if opened >= 0:
            if token in closers:
                pairs.append((opened, at))
                opened = -1
        elif token in QUOTES and any(last.get(c, -1) > at for c in QUOTES[token]):
            opened, closers = at, QUOTES[token]
    return pairs


@dataclass
class Model:
    weights: dict[str, float] = field(default_factory=dict)
    #: bias, then one for each feature; None without a toxic label
    coefficients: list[float] | None = None

    def matcher(self) -> "Matcher":
        return Matcher(self)


class Matcher:
    """Finds and weighs the terms of a text."""

    def __init__(self, model: Model):
        words = [t for t in model.weights if not t.endswith("*") and len(t) >= FUZZY_LETTERS - 1]
        stems = [t for t in model.weights if t.endswith("*") and len(t) > FUZZY_STEM_LETTERS]
        self.model, self.known = model, {}
        self.words, self.stems = trie_of(words), trie_of(stems)
        # one edit leaves the first or the second half of a term as it is; the second half of a stem may move by one place
        self.heads, self.tails = {t[:len(t) // 2] for t in words}, {t[len(t) // 2:] for t in words}
        self.head_sizes, self.tail_sizes = sorted({len(h) for h in self.heads}), sorted({len(t) for t in self.tails})
        self.stem_parts: dict[tuple[int, int], set[str]] = {}
        for stem in stems:
            half, end = (len(stem) - 1) // 2, len(stem) - 1
            for start, stop in ((0, half), (half - 1, end - 1), (half, end), (half + 1, end + 1)):
                self.stem_parts.setdefault((start, stop), set()).add(stem[:half] if start == 0 else stem[half:end])
        self.swapped: dict[str, str] = {}
        for term in sorted((t for t in words if len(t) >= FUZZY_LETTERS), reverse=True):
            self.swapped.update(dict.fromkeys(swaps(term), term))
        for stem in sorted(stems, reverse=True):
            self.swapped.update((form + "*", stem) for form in swaps(stem[:-1]))

    def term(self, word: str) -> tuple[str, int] | None:
        """The lexicon term that a word stands for, and its edits."""
        spelled = forms(word)
        for form in spelled:
            if form in self.model.weights:
                return form, 0
        if len(word) < FUZZY_LETTERS:
            return None
        found = [self.swapped[form] for form in spelled if form in self.swapped]
        if any(word[:n] in self.heads for n in self.head_sizes) or any(word[-n:] in self.tails for n in self.tail_sizes):
            found += [t for _, t in intersect(LevenshteinAutomaton(word), self.words)]
        if any(word[start:stop] in parts for (start, stop), parts in self.stem_parts.items()):
            found += [t for _, t in intersect(LevenshteinAutomaton(word), self.stems)]
        # whole words before stems
        return (min(found, key=lambda t: (t.endswith("*"), t)), 1) if found else None

    def _lookup(self, words: set[str]) -> bool:
        if len(self.known) > _CACHE:
            self.known.clear()
        hit = False
        for word in words:
            if word not in self.known:
                self.known[word] = self.term(word)
            hit = hit or self.known[word] is not None
        return hit

    def hits(self, text: bytes) -> list[Hit]:
        """The hits of a text in order."""
        plain = text.decode("utf-8", "replace").lower()
        if not self._lookup(set(_WORD.findall(plain))):
            return []
        tokens = _TOKEN.findall(plain)
        pairs, pair = quotations(tokens), 0
        found = []
        for at, token in enumerate(tokens):
            got = self.known.get(token)
            if got is None:
                continue
            while pair < len(pairs) and pairs[pair][1] < at:
                pair += 1
            inside = pair < len(pairs) and at - CONTEXT <= pairs[pair][0] < at < pairs[pair][1] <= at + CONTEXT
            around = {*tokens[max(0, at - CONTEXT):at], *tokens[at + 1:at + 1 + CONTEXT]}
            quoted = inside or bool(ATTRIBUTION & around)
            weight = self.model.weights[got[0]] * (1.0 if quoted or not ADDRESS & around else 1.25)
            found.append((token, *got, quoted, weight))
        return found

    def score(self, hits: list[Hit], size: int) -> float:
        if self.model.coefficients is None:
            return 0.0
        bias, *slopes = self.model.coefficients
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, bias + sum(a * b for a, b in zip(slopes, features(hits, size)))))))


def features(hits: list[Hit], size: int) -> list[float]:
    """Abuse, misspelled abuse and quotation, each as a saturating sum over its distinct words, and the length of the
    text if it has a hit: long texts meet weak terms by chance."""
    best: list[dict[str, float]] = [{}, {}, {}]
    for word, _, edits, quoted, weight in hits:
        kind = best[2 if quoted else 1 if edits else 0]
        kind[word] = max(weight, kind.get(word, 0.0))
    return [*(math.log1p(sum(kind.values())) for kind in best), math.log1p(size) / 10 if hits else 0.0]


def logistic(features: np.ndarray, labels: np.ndarray, ridge: float = 0.1, rounds: int = 50) -> list[float]:
    """Bias and slopes by Newton's method with a small ridge on the slopes."""
    x = np.c_[np.ones(len(features)), features]
    beta, penalty = np.zeros(x.shape[1]), np.diag([1e-6] + [ridge] * (x.shape[1] - 1))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (labels - p) - penalty @ beta)
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return beta.tolist()


def _sample(labels: DataFrame, id_col: str, label_col: str, max_toxic: int, max_clean: int) -> DataFrame:
    rows = labels.select(F.col(f"`{id_col}`").alias("label_id"), (F.col(f"`{label_col}`") == 1).cast("int").alias("toxic")).where("label_id is not null and toxic is not null").distinct()
    return smallest_hashes(rows, "toxic", "label_id", {1: max_toxic, 0: max_clean})


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          max_toxic: int = MAX_TOXIC, max_clean: int = MAX_CLEAN) -> Model:
    """A model from the labelled documents. What the driver gets is bounded by the sample; every term with enough evidence in it is taken."""
    sample = materialize(_sample(labels, id_col, label_col, max_toxic, max_clean), "labels")
    texts = docs.select(F.col(f"`{id_col}`").alias("label_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    # at most max_toxic + max_clean ids: small by its bound
    texts = materialize(texts.join(F.broadcast(sample), "label_id").select("text", "toxic"), "labelled_texts")

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[str, int]] = set()

        def flush() -> pa.RecordBatch:
            columns = list(zip(*seen)) or [(), ()]
            seen.clear()
            return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64())], names=["term", "context"])

        for batch in batches:
            for text in byte_list(batch.column(0)):
                words = _WORD.findall(text.decode("utf-8", "replace").lower())
                for before, word, after in zip(["", *words], words, [*words[1:], ""]):
                    if len(word) > 2:
                        context = xxhash.xxh64_intdigest(f"{before} {after}") >> 1
                        seen.update((form, context) for form in forms(word))
                        if len(seen) >= 1 << 16:
                            yield flush()
        yield flush()

    used = texts.where("toxic = 1").select("text").mapInArrow(contexts, "term string, context long").distinct().groupBy("term").agg(F.count("*").alias("toxic_uses"))
    used = materialize(used, "toxic_terms")
    total_toxic = used.where(~F.endswith("term", F.lit("*"))).agg(F.sum("toxic_uses")).first()[0]
    if not total_toxic:
        return Model()
    # a term needs two uses; the sample bounds how many terms there can be
    found = {r.term: r.toxic_uses for r in used.where("toxic_uses > 1").collect()}

    def clean_uses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[str, int] = {"": 0}
            for text in byte_list(batch.column(0)):
                words = _WORD.findall(text.decode("utf-8", "replace").lower())
                counts[""] += sum(len(w) > 2 for w in words)
                for word in words:
                    for form in forms(word):
                        if form in found:
                            counts[form] = counts.get(form, 0) + 1
            yield pa.RecordBatch.from_arrays([pa.array(list(counts)), pa.array(list(counts.values()), pa.int64())], names=["term", "n"])

    clean = texts.where("toxic = 0").select("text").mapInArrow(clean_uses, "term string, n long").groupBy("term").agg(F.sum("n").alias("clean_uses"))
    clean = {r.term: r.clean_uses for r in clean.collect()}
    total_clean = clean.pop("", 0)
    share = total_toxic / (total_toxic + total_clean)
    weights: dict[str, float] = {}
    for term, a in found.items():
        b = clean.get(term, 0)
        weight = math.log((a + 0.5) / total_toxic) - math.log((b + 0.5) / (total_clean + 1))
        evidence = a * math.log(a / ((a + b) * share)) + (b * math.log(b / ((a + b) * (1 - share))) if b else 0.0)
        if weight >= MIN_WEIGHT and evidence >= MIN_EVIDENCE:
            weights[term] = min(weight, 12.0)
    model = Model(dict(sorted(weights.items())))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = model.matcher()
        for batch in batches:
            rows = [features(matcher.hits(t), len(t)) for t in byte_list(batch.column(0))]
            columns = [pa.array([r[i] for r in rows], pa.float64()) for i in range(4)]
            yield pa.RecordBatch.from_arrays([*columns, batch.column(1)], names=["abuse", "misspelled", "quotation", "size", "toxic"])

    rows = texts.mapInArrow(measure, "abuse double, misspelled double, quotation double, size double, toxic int").groupBy("abuse", "misspelled", "quotation", "size", "toxic").count().collect()
    x = np.array([[r.abuse, r.misspelled, r.quotation, r.size] for r in rows for _ in range(r["count"])]).reshape(-1, 4)
    model.coefficients = logistic(x, np.array([r.toxic for r in rows for _ in range(r["count"])], float))
    return model


def score(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with score, predicted, n_hits and n_quoted."""
    matchers: list[Matcher] = []  # made once per task

    def run(texts: list[bytes]) -> dict[str, list]:
        if not matchers:
            matchers.append(model.matcher())
        hits = [matchers[0].hits(t) for t in texts]
        scores = [matchers[0].score(h, len(t)) for h, t in zip(hits, texts)]
        return {"score": scores, "predicted": [int(s >= threshold) for s in scores], "n_hits": [len(h) for h in hits], "n_quoted": [sum(x[3] for x in h) for h in hits]}

    return with_columns(docs, text_col, "score double, predicted int, n_hits int, n_quoted int", run)
