"""Near copies by shingle similarity, against a comparison of every pair."""
import random
from itertools import combinations

import corpus_pipeline
from helpers import documents
from tidemark.llm import near_copies


def shingles(text, width=5):
    words = (text or "").split()
    return {tuple(words[i:i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def edited(words, share, rng):
    """Changes single words so that about ``share`` of the shingles stay."""
    out = list(words)
    for at in rng.sample(range(len(words)), max(1, round(len(words) * (1 - share) / 5 / (1 + share)))):
        out[at] = f"new{rng.random()}"
    return out


def kept_ids(rows):
    """Smallest id of each class, classes from all pairs."""
    sets, root = {i: shingles(t) for i, t in rows}, {i: i for i, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for a, b in combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x == y or (x and y and len(x & y) >= 0.8 * len(x | y)):
            one, two = sorted((find(a), find(b)))
            root[two] = one
    return {find(i) for i in root}


def test_stage_drops_every_pair_from_0_8(spark, tmp_path):
    rng, rows = random.Random(5), []
    for base in range(60):
        words = [f"w{rng.randrange(3000)}" for _ in range(rng.choice([40, 120, 300]))]
        rows.append((10 * base, " ".join(words)))
        rows += [(10 * base + k, " ".join(edited(words, share, rng))) for k, share in enumerate((0.95, 0.88, 0.82, 0.7, 0.5), 1)]
    rows += [(5000, ""), (5001, "one"), (5002, "one"), (5003, "one two"), (5004, None)]
    got = [r.doc_id for r in corpus_pipeline.drop_near_copies(spark, documents(spark, rows), str(tmp_path)).collect()]
    assert sorted(got) == sorted(kept_ids(rows))


def test_group_whose_smallest_member_is_alone(spark, monkeypatch):
    """Copies that reach 0.8 only with some of the others: what the first comparison leaves open is searched, also in chunks."""
    monkeypatch.setattr(near_copies, "CHUNK", 16)
    rng = random.Random(8)
    words = [f"w{k}" for k in range(200)]
    rows = [(i, " ".join(edited(words, 0.86, rng))) for i in range(80)]
    got = [r.doc_id for r in near_copies.keep_one(documents(spark, rows)).collect()]
    assert sorted(got) == sorted(kept_ids(rows)) and 1 < len(got) < 80


def test_far_texts_with_near_fingerprints_stay(spark):
    """Repeats weigh in a fingerprint but not in a set: equal fingerprints alone drop nothing."""
    refrain = "the same five words again " * 200
    rows = [(i, refrain + " ".join(f"own{i}x{k}" for k in range(30))) for i in range(4)]
    assert sorted(r.doc_id for r in near_copies.keep_one(documents(spark, rows)).collect()) == [0, 1, 2, 3]
