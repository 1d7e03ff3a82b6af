"""Exact, line, near, substring and suffix dedup against brute force, with the odd cases of each."""
import hashlib
import random
import re

import numpy as np
import pytest
import xxhash

from helpers import documents, stored
from tidemark.llm import exact_dedup, line_dedup, queries, simhash, substring_dedup, suffix_array

SPACE = r"[\x20\x09-\x0D]"
RANDOM = random.Random(11)
WORDS = ["".join(RANDOM.choices("abcdeéñß", k=RANDOM.randint(1, 9))) for _ in range(400)]


def text(n):
    return " ".join(RANDOM.choices(WORDS, k=n))


LONG = text(3000)
PASSAGE = text(90)
ROWS = [(1, "a  b"), (2, "a b"), (3, None), (4, ""), (5, " a b"), (5, " a b"), (6, LONG), (7, LONG), (8, "\t\n"), (9, " "), (None, "a b"), (None, None), (10, "x" * 5000),
        (11, PASSAGE + " " + text(60)), (12, text(70) + " " + PASSAGE), (13, text(30) + " " + PASSAGE + " " + text(30)), (14, "for " * 900), (15, "for " * 300 + text(100)),
        *((20 + i, LONG[200 * i:200 * i + 4000]) for i in range(6)), *((30 + i, PASSAGE[:40 * i]) for i in range(5)), *((40 + i, text(200)) for i in range(10)),
        *((60 + i, "Head\n" + "shared line " * 5 + f"\n{'  Mixed CASE line ' * 3}\ntail {i}") for i in range(7))]


def norm(t):
    return re.sub(SPACE + "+", " ", t or "")


def words(t):
    return [w for w in re.split(SPACE + "+", t or "") if w]


def test_exact_dedup(spark):
    got = exact_dedup.exact_dedup(documents(spark, ROWS)).collect()
    assert len(got) == len(ROWS)
    groups = {}
    for i, t in ROWS:
        groups.setdefault(hashlib.sha256(norm(t).encode()).hexdigest(), []).append(i)
    for r in got:
        ids = groups[r.text_sha256]
        known = [i for i in ids if i is not None]
        assert r.group_size == len(ids) and r.keep_id == (min(known) if known else None)
    for digest, ids in groups.items():
        kept = [r for r in got if r.text_sha256 == digest and r.kept]
        assert len(kept) == 1 and kept[0].doc_id == kept[0].keep_id


def test_quotient_filters_merge_without_loss():
    values = np.random.default_rng(3).integers(0, 1 << 63, 4000, dtype=np.uint64)
    parts = [np.r_[values[:1500], values[:40]], values[1200:], values[:1]]
    filters = []
    for p in parts:
        found, n = np.unique(p, return_counts=True)
        _, quotient, remainder = exact_dedup._cut(found, 0)
        f = exact_dedup.QuotientFilter.of_sorted(quotient, remainder, n)
        filters.append(exact_dedup.QuotientFilter.unpacked(*f.packed()))
    quotient, remainder, counts = exact_dedup.merge(filters).entries()
    rest = np.uint64(64 - exact_dedup.SLOT_BITS)
    merged = dict(zip(((quotient.astype(np.uint64) << rest) | remainder).tolist(), counts.tolist()))
    want, n = np.unique(np.concatenate(parts), return_counts=True)
    assert merged == dict(zip(want.tolist(), n.tolist()))


def test_line_dedup(spark):
    common, four = "the same id holds this line again and again", "four rows of one id and one of another are two documents"
    rows = [r for r in ROWS if r[0] is not None and r[0] != 5] + [(None, "shared line " * 5), (None, None)]
    rows += [(200 + i, f"{common}\nrow {i}") for i in range(5)] + [(209, f"{four}\n{i}") for i in range(4)] + [(210, four)]
    docs = documents(spark, rows)
    found = line_dedup.line_dedup(docs)
    assert [c for c in found.columns if c not in ("n_lines", "n_dropped")] == [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    got = {r.doc_id: r for r in found.collect() if r.doc_id is not None and r.doc_id != 209}
    assert [r.n_dropped for r in found.collect() if r.doc_id == 209] == [0] * 4
    key = lambda x: re.sub(f"^{SPACE}+|{SPACE}+$", "", x).translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    holders = {}
    for i, t in rows:
        for k in {key(x) for x in (t or "").split("\n")}:
            holders.setdefault(k, []).append(i if i is not None else -1)
    documents_of = lambda k: len({i for i in holders[k] if i != -1}) + holders[k].count(-1)
    for i, t in rows:
        if i is None or i == 209:
            continue
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (len(key(x)) >= 40 and documents_of(key(x)) >= 5 and i != max(holders[key(x)]))]
        assert (got[i].text or "", got[i].n_lines, got[i].n_dropped) == ("\n".join(kept), len(lines), len(lines) - len(kept))
        assert got[i].place == "x"  # other columns stay


def fingerprint(t, width=4):
    w = words("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    shingles = [" ".join(w[k:k + width]) for k in range(max(1, len(w) - width + 1))] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum((2 * sum(v >> b & 1 for v in h) > len(h)) << b for b in range(64))


def test_simhash(spark):
    rows = ROWS + [(100 + i, LONG + f" tail{i}") for i in range(60)]
    got = simhash.simhash_dedup(documents(spark, rows)).collect()
    values = [fingerprint(t) for _, t in rows]
    label = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if (values[a] ^ values[b]).bit_count() <= 4 and label[a] != label[b]:
                old, new = label[a], label[b]
                label = [new if x == old else x for x in label]
    least = {g: min((r[0] for r, x in zip(rows, label) if x == g and r[0] is not None), default=None) for g in label}
    want = sorted(((i, v, least[g]) for (i, _), v, g in zip(rows, values, label)), key=str)
    assert sorted(((r.doc_id, r.fingerprint % (1 << 64), r.component_id) for r in got), key=str) == want


def test_simhash_large_group_is_connected_without_all_pairs():
    base = np.uint64(0x0123456789ABCDEF)
    rng = np.random.default_rng(5)
    values = np.unique(base ^ np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, (400, 3)).astype(np.uint64), axis=1))
    left, right = simhash._forest(values, simhash.distance_table(values, simhash.pivots()), 4)
    assert len(left) < len(values)
    assert all((int(values[a]) ^ int(values[b])).bit_count() <= 4 for a, b in zip(left, right))
    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= 4

    def classes(pairs):
        label = list(range(len(values)))
        for a, b in pairs:
            if label[a] != label[b]:
                old, new = max(label[a], label[b]), min(label[a], label[b])
                label = [new if x == old else x for x in label]
        return label
    assert classes(zip(left, right)) == classes(zip(*np.nonzero(near)))


@pytest.mark.parametrize("chunk", [4, 4096])
def test_links_across_chunks(spark, monkeypatch, chunk):
    monkeypatch.setattr(simhash, "CHUNK", chunk)
    values = [x - (1 << 63) for x in [0, 1, 3, 7, 15, 31, 63, 127, 255, (1 << 64) - 1, (1 << 64) - 2]]
    links = simhash.near_links(spark.createDataFrame([(v,) for v in values], "fp long")).collect()
    assert all(((a ^ b) & ((1 << 64) - 1)).bit_count() <= 4 for a, b in links)
    label = {v: v for v in values}
    for a, b in links:
        label = {k: (label[a] if x == label[b] else x) for k, x in label.items()}
    assert len(set(label.values())) == 2


def test_keep_one(spark):
    rows = [(3, LONG), (1, LONG), (1, LONG), (2, text(60)), (2, text(80)), (None, LONG), (None, text(50)), (9, None), (8, "")]
    docs = documents(spark, rows)
    got = simhash.keep_one(docs)
    assert got.columns == docs.columns
    kept = sorted(((r.doc_id, r.text) for r in got.collect()), key=str)
    assert kept == sorted([(1, LONG), rows[3], rows[4], rows[6], (8, "")], key=str)


def test_substring_dedup(spark, tmp_path):
    got = substring_dedup.substring_dedup(stored(spark, documents(spark, ROWS), tmp_path / "d")).collect()
    first = {}
    rank = lambda i: float("inf") if i is None else i
    for i, t in ROWS:
        w = words(t)
        for s in range(len(w) - 49):
            k = tuple(w[s:s + 50])
            first[k] = min(first.get(k, rank(i)), rank(i))
    want = []
    for i, t in ROWS:
        w = words(t)
        gone = [False] * len(w)
        for s in range(len(w) - 49):
            if first[tuple(w[s:s + 50])] < rank(i):
                gone[s:s + 50] = [True] * 50
        want.append((i, " ".join(x for x, g in zip(w, gone) if not g), len(w), sum(gone)))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert sum(w[3] for w in want) > 3000


def test_every_two_positions_share_a_cover_shift():
    for i in range(31):
        for j in range(31):
            assert any((i + s) % 31 in substring_dedup.COVER and (j + s) % 31 in substring_dedup.COVER for s in range(31))


@pytest.mark.parametrize("group", [2, 1 << 15])
def test_suffix_array(spark, tmp_path, monkeypatch, group):
    monkeypatch.setattr(suffix_array, "GROUP", group)
    rows = ROWS + [(70, PASSAGE[:399]), (71, "q" + PASSAGE[:400] + "q"), (72, "w" + PASSAGE[1:402] + "w"), (73, LONG[1000:1420] * 3), (74, "z" * 401), (75, "é" * 500)]
    got = suffix_array.suffix_array_dedup(stored(spark, documents(spark, rows), tmp_path / "d")).collect()
    data = [(i, (t or "").encode()) for i, t in rows]
    count = {}
    for _, t in data:
        for s in range(len(t) - 399):
            count[t[s:s + 400]] = count.get(t[s:s + 400], 0) + 1
    want = []
    for i, t in data:
        gone = bytearray(len(t))
        for s in range(len(t) - 399):
            if count[t[s:s + 400]] > 1:
                gone[s:s + 400] = b"\1" * 400
        want.append((i, bytes(b for b, g in zip(t, gone) if not g), len(t), sum(gone), sum(1 for k in range(len(gone)) if gone[k] and (not k or not gone[k - 1]))))
    assert sorted(((r.doc_id, bytes(r.kept), *r[2:]) for r in got), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("name", ["op1_exact_dedup", "op2_source_mixing", "op3_simhash", "op5_suffix_array", "op6_substring_dedup", "op7_language_id", "op8_toxicity", "op9_line_dedup", "op10_decontamination"])
def test_empty_documents(spark, tmp_path, name):
    documents(spark, [], clashing=False).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, "some benchmark item with enough text")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert queries.QUERIES[name](spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("operator", ["substring", "suffix"])
def test_another_split_of_the_files_changes_no_row(spark, tmp_path, monkeypatch, operator):
    """Between any two stages the files are split another way, as after an executor came or went."""
    module = {"substring": substring_dedup, "suffix": suffix_array}[operator]
    run = {"substring": substring_dedup.substring_dedup, "suffix": suffix_array.suffix_array_dedup}[operator]
    docs = stored(spark, documents(spark, ROWS).repartition(11), tmp_path / "d")
    want = sorted(map(tuple, run(docs).collect()), key=str)
    usual, calls = module.materialize, []

    def changing(df, label):
        out = usual(df, label)
        calls.append(label)
        spark.conf.set("spark.sql.files.minPartitionNum", 2 if len(calls) % 2 else 9)
        return out
    monkeypatch.setattr(module, "materialize", changing)
    try:
        assert sorted(map(tuple, run(docs).collect()), key=str) == want and len(calls) > 4
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum")


def test_substring_dedup_by_text_ids(spark):
    rows = [("b", PASSAGE), ("a", PASSAGE), (None, PASSAGE), ("10", "other words")]
    got = {r.doc_id: r.n_removed for r in substring_dedup.substring_dedup(spark.createDataFrame(rows, "doc_id string, text string")).collect()}
    assert got == {"a": 0, "b": 90, None: 90, "10": 0}
