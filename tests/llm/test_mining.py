"""Odd sketches, phrases and spelling variants against brute force, with the odd cases of each."""
import random
import re
import uuid
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pytest

from helpers import documents
from tidemark.llm import collocations, odd_sketch, spelling

RANDOM = random.Random(23)


def shingles(text, width=5):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").translate({i: i + 32 for i in range(65, 91)})) if w]
    return {tuple(words[i:i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def edited(words, count):
    out = list(words)
    for at in RANDOM.sample(range(len(out)), count):
        out[at] = f"new{RANDOM.random()}"
    return out


def near_rows():
    rows = []
    for base in range(25):
        words = [f"w{RANDOM.randrange(2000)}" for _ in range(RANDOM.choice([30, 120, 400]))]
        rows.append((20 * base + 5, " ".join(words)))
        rows += [(20 * base + 6 + k, " ".join(edited(words, max(1, len(words) * k // 100)))) for k in range(5)]
        rows += [(20 * base + k, " ".join(words[:-k or None])) for k in range(1, 4)]
    words = [f"x{i}" for i in range(150)]
    rows += [(1000 + i, " ".join(edited(words, 2))) for i in range(60)]  # near the bound, in one key
    long = " ".join(f"l{RANDOM.randrange(9000)}" for _ in range(12_000))
    rows += [(2000, long), (2001, long + " tail"), (2002, long.upper()), (3000, None), (3001, ""), (3002, " \t"), (3003, "one two"), (3004, "One  two"), (3004, "One  two"),
             (3005, "one two three"), (None, "one two"), (None, None), (None, "nobody else has this text here"), (3006, "a b c d e f"), (3007, "a b c d e f")]
    return rows


def same_as_all_pairs(spark, rows):
    sets, label = [shingles(t) for _, t in rows], list(range(len(rows)))
    for a, b in combinations(range(len(rows)), 2):
        x, y = sets[a], sets[b]
        if label[a] != label[b] and x and y and 100 * len(x & y) >= 85 * len(x | y):
            old, new = label[b], label[a]
            label = [new if v == old else v for v in label]
    least = {g: min((r[0] for r, v in zip(rows, label) if v == g and r[0] is not None), default=None) for g in label}
    want = sorted(((i, len(s), least[g], i == least[g]) for (i, _), s, g in zip(rows, sets, label)), key=str)
    got = odd_sketch.odd_sketch_dedup(documents(spark, rows))
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert sorted(map(tuple, got.collect()), key=str) == want
    return label


def test_odd_sketch_classes(spark):
    label = same_as_all_pairs(spark, near_rows())
    assert len(set(label)) < 0.6 * len(label)


@pytest.mark.parametrize("cluster", [2, 1024])
def test_odd_sketch_keys_in_chunks(spark, monkeypatch, cluster):
    """Keys whose members no leader brings together are searched whole, also where they exceed a chunk."""
    monkeypatch.setattr(odd_sketch, "SKETCH_CHUNK", 8)
    monkeypatch.setattr(odd_sketch, "SET_CHUNK", 4)
    monkeypatch.setattr(odd_sketch, "CLUSTER", cluster)
    words = [f"w{k}" for k in range(160)]
    same_as_all_pairs(spark, [(i, " ".join(edited(words, 3))) for i in range(70)] + [(100 + i, " ".join(edited(words, 1))) for i in range(4)])


def test_odd_sketch_estimates():
    rng = np.random.default_rng(2)
    for share in (0.95, 0.9, 0.85):
        flips = []
        for _ in range(40):
            common = rng.integers(0, 1 << 63, int(1000 * share), dtype=np.uint64)
            own = [rng.integers(0, 1 << 63, (1000 - len(common)) // 2, dtype=np.uint64) for _ in range(2)]
            a, b = (odd_sketch.odd_sketch(odd_sketch.samples(np.r_[common, x])) for x in own)
            flips.append(int(np.bitwise_count(a ^ b).sum()))
        assert abs(np.mean([odd_sketch.estimate(f) for f in flips]) - share) < 0.02
        assert max(flips) <= odd_sketch.popcount_bound(85)


PIECE_ENDS = r"[.,;:!?\x0A-\x0D]"


def brute_phrases(rows, min_count, longest, top):
    """Every phrase of every piece counted, as the rule is worded."""
    count, total = Counter(), Counter()
    for _, text, lang, _ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(PIECE_ENDS, (text or "").translate({i: i + 32 for i in range(65, 91)})):
            words = tuple(w for w in re.split(r"[\x20\x09]+", piece) if w)
            total[lang] += len(words)
            for size in range(1, longest + 1):
                for at in range(len(words) - size + 1):
                    count[lang, words[at:at + size]] += 1
    found = {}
    frequent = {k: a for k, a in count.items() if a >= min_count}
    for (lang, p), a in frequent.items():
        if len(p) < 2:
            continue
        if any(k == lang and len(q) > len(p) and b >= a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)) for (k, q), b in frequent.items()):
            continue
        cuts = [(1000 * a * total[lang] // (count[lang, p[:k]] * count[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        found.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), count[lang, p[:k]], count[lang, p[k:]]))
    return sorted((lang, rank, p.decode(), -a, left, right, total[lang], -score) for lang, x in found.items()
                  for rank, (score, a, p, left, right) in enumerate(sorted(x)[:top], 1))


def phrase_rows(n):
    vocabulary = ["The", "of", "naïve", "Été", "x", "deep", "river", "mind", "a\x0eb", "-"]
    known = ["deep river of the mind", "deep river", "of the", "x x x x x x x", "naïve Été - the"]
    rows = []
    for i in range(n):
        parts = [RANDOM.choice(known) if RANDOM.random() < 0.3 else RANDOM.choice(vocabulary) for _ in range(RANDOM.randint(0, 25))]
        seps = [RANDOM.choice([" ", " ", "  ", "\t", ", ", ".", "\n", "\x0b", "!?", "\r\n"]) for _ in parts]
        rows.append((i, "".join(a + b for a, b in zip(parts, seps)), RANDOM.choice(["en", "en", "de", None, "und"]), "s"))
    return rows + [(9, None, "en", "s"), (9, "", "en", "s"), (None, "the of", None, None), (5, "late phrase here " * 40, "fr", "s"), (5, " . , \n", "es", "s")]


@pytest.mark.parametrize("shards, portion", [(1, 1 << 19), (3, 16)])
def test_collocations(spark, shards, portion):
    rows = phrase_rows(400)
    got = collocations.collocations(documents(spark, rows), min_count=12, shards=shards, top=40, portion=portion)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = brute_phrases(rows, 12, 5, 40)
    assert sorted(map(tuple, got.collect())) == want and len(want) > 80


def test_collocation_that_reaches_the_threshold_in_the_last_shard(spark):
    """Subphrases reached at the end of a cycle start longer phrases in the next one."""
    rows = [(i, "alpha beta gamma delta epsilon", "en", "s") for i in range(10)]
    got = collocations.collocations(documents(spark, rows), min_count=10, shards=2)
    assert [tuple(r) for r in got.collect()] == [("en", 1, "alpha beta gamma delta epsilon", 10, 10, 10, 50, 5000)]


def test_false_hits_of_the_bitmaps_change_nothing(spark):
    rows = phrase_rows(150)
    assert sorted(map(tuple, collocations.collocations(documents(spark, rows), min_count=8, shards=2, filter_power=6).collect())) == brute_phrases(rows, 8, 5, 2000)


def test_rounds_keep_two_states_of_hashes_and_counts(spark, tmp_path, monkeypatch):
    """Scratch space does not grow with the number of rounds, and only numbers are kept between them."""
    monkeypatch.setattr(collocations, "scratch_folder", lambda _, label: f"{tmp_path}/{label}-{uuid.uuid4().hex}")
    rows = [(i, "alpha beta gamma delta epsilon", lang, "s") for i in range(12) for lang in ("en", "de")]
    phrases, totals = collocations.frequent_phrases(documents(spark, rows), min_count=10, shards=3)
    assert phrases.count() == 30 and sorted(totals.collect()) == [("de", 60), ("en", 60)]
    states = list(tmp_path.glob("phrase_state-*"))
    assert len(states) == 2
    assert all(k in ("bigint", "int") for s in states for _, k in spark.read.parquet(str(s)).dtypes)


def test_last_word_of_a_phrase_hash():
    prefix, word = np.random.default_rng(4).integers(0, 1 << 64, (2, 1000), dtype=np.uint64)
    assert (collocations._last(collocations._joined(prefix, word), prefix) == word).all()


def test_wide_scores(spark):
    """Products beyond 64 bits stay exact."""
    big = 3_000_000_007
    phrases = spark.createDataFrame([(1, 1, 0, 0, "en", "a", big), (2, 1, 0, 0, "en", "b", big + 2), (3, 2, 1, 2, "", "", big - 5)], "h long, len int, pre long, suf long, lang string, word string, c long")
    words = collocations._worded(phrases, 2).withColumn("n", collocations.F.lit(10**15 + 7))
    assert words.select(collocations._score(collocations.F.lit(0))).first()[0] == 1000 * (big - 5) * (10**15 + 7) // (big * (big + 2))


LETTERS = "abcdefgéÿß×"


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_words(rows, divisor=199):
    count = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate({i: i + 32 for i in range(65, 91)})
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % divisor == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            count[run] += 1
    words = {w: n for w, n in count.items() if len(w) >= 6 and n >= 5}
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 5 * words[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w
    return sorted(((w, form[w], root(w), words[w], len(near[w]), words[form[w]] if form[w] else None) for w in words), key=str)


def spelled_rows():
    base = ["".join(RANDOM.choices(LETTERS, k=RANDOM.randint(5, 12))) for _ in range(30)] + ["recieve", "receive", "prefixed" + "long" * 40]
    words = []
    for w in base:
        words += [w] * RANDOM.choice([5, 30, 200])
        for _ in range(6):
            at = RANDOM.randrange(len(w))
            other = RANDOM.choice([w[:at] + w[at + 1:], w[:at] + RANDOM.choice(LETTERS) + w[at:], w[:at] + RANDOM.choice(LETTERS) + w[at + 1:], RANDOM.choice(LETTERS) + w, w + "a"])
            words += [other] * RANDOM.choice([3, 5, 6, 26])
    words += ["chainword"] * 400 + ["chainwerd"] * 40 + ["chainwerdd"] * 6
    words += ["linkedword"] * 600 + ["linkedwerd"] * 80 + ["linkedwerdd"] * 10
    RANDOM.shuffle(words)
    rows = [(i, RANDOM.choice([" ", "-", "1"]).join(x if RANDOM.random() < 0.8 else x[0].upper() + x[1:] for x in words[i::40])) for i in range(40)]
    return rows + [(50, None), (50, ""), (None, " ".join(words[:30])), (50, "a b c É"), (51, "repeated"), (51, "repeated " * 9)]


@pytest.mark.parametrize("pairs", [0, 1 << 12])
def test_spelling_variants(spark, pairs):
    rows = spelled_rows()
    got = spelling.spelling_variants(documents(spark, rows), pairs=pairs, edit_every=7)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = brute_words(rows, 7)
    assert sorted(map(tuple, got.collect()), key=str) == want
    assert sum(w[1] is not None for w in want) > 20 and any(w[1] != w[2] and w[1] for w in want)


def test_spelling_of_documents_as_registered(spark):
    from tidemark.llm import queries
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, queries.op13_spelling_variants(spark, "/root/testdata/sf0.001").collect()), key=str) == brute_words(rows)


def test_odd_sketch_of_documents_as_registered(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    same_as_all_pairs(spark, rows)


@pytest.mark.parametrize("operator", [odd_sketch.odd_sketch_dedup, collocations.collocations, spelling.spelling_variants])
def test_empty_tables(spark, operator):
    assert operator(documents(spark, [])).count() == 0
