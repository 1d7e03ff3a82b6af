"""Mixing, URL filter, language, toxicity, decontamination: brute force, held-out accuracy, odd cases."""
import random

import duckdb
import numpy as np
import pytest

from helpers import documents
from tidemark.llm import components, decontaminate, langid, mixing, queries, toxicity, url_filter

RANDOM = random.Random(4)
SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_same_answer_as_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    df = queries.QUERIES[name](spark, SMALL)
    want = con.execute(queries.SQL[name])
    columns = [d[0] for d in want.description]
    assert sorted(columns) == sorted(df.columns)
    assert sorted(tuple(r[c] for c in sorted(columns)) for r in df.collect()) == sorted(tuple(r[columns.index(c)] for c in sorted(columns)) for r in want.fetchall())


def targets(sizes, weights, share=1.5, cap=2):
    """Resharing the excess round by round, as the rule is worded."""
    total, done = share * sum(sizes), {}
    while True:
        free = [i for i in range(len(sizes)) if i not in done]
        left = total - sum(done.values())
        want = {i: left * weights[i] / sum(weights[j] for j in free) for i in free}
        over = [i for i in free if want[i] > cap * sizes[i]]
        if not over:
            return [done.get(i, want.get(i)) for i in range(len(sizes))]
        done |= {i: cap * sizes[i] for i in over}


def test_mix_targets_and_copies(spark):
    rows, n = [], 0
    for source, docs in (("b", 300), ("Z", 20), ("a", 150), (None, 40), ("é", 4), ("empty", 2)):
        for _ in range(docs):
            n += 1
            rows.append((n, None if source == "empty" else "w " * RANDOM.randint(1, 60), None, source))
    rows += [(7, "again and again", None, "a"), (7, "again and again", None, "a"), (None, "no id here", None, "a")]
    docs = documents(spark, rows).withColumn("size", mixing.size_column("text"))
    mixed = mixing.mix(docs)
    got = mixed.collect()
    assert len(got) == len(rows)
    order = ["Z", "a", "b", "empty", "é", None]
    sizes = [sum(len((r[1] or "").split()) for r in rows if r[3] == s) for s in order]
    want = dict(zip(order, targets(sizes, [3, 1, 2, 3, 1, 2])))
    for r in got:
        assert r.target == pytest.approx(want[r.source]) and r.source_size == sizes[order.index(r.source)] and r.copies in (0, 1, 2)
        assert int(r.rate) <= r.copies <= -(-r.rate // 1)
    for source in ("b", "a"):
        assert sum(r["size"] * r.copies for r in got if r.source == source) == pytest.approx(want[source], rel=0.2)
    assert sorted(map(tuple, mixing.mix(docs.repartition(5)).select("doc_id", "copies").collect()), key=str) == sorted(((r.doc_id, r.copies) for r in got), key=str)
    out = mixing.emit(mixed)
    assert out.count() == sum(r.copies for r in got) and out.where("copy > copies").count() == 0


def test_components(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, 200 + i) for i in range(50)] + [(300, 300), (None, 3), (5, None), (400, 401), (401, 400)]
    got = dict(components.components(spark.createDataFrame(pairs, "a long, b long"), "a", "b").collect())
    assert got == {i: 0 for i in range(41)} | {100: 100} | {200 + i: 100 for i in range(50)} | {400: 400, 401: 400}
    assert components.components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def page(i, url, canonical=None, refresh=None):
    html = "<html><head>" + (f'<link href="{canonical}" rel="canonical">' if canonical else "")
    return i, url, html + (f"<META http-equiv='refresh' content='0; url={refresh}'>" if refresh else "") + "</head></html>"


def test_url_filter(spark):
    pages = [page(1, "http://X.NET/a"), page(2, "http://m.example.NET/en/a?q"), page(3, "https://www.example.com/de/x", refresh="/fr/y"), page(4, "https://www.example.com/fr/y"),
             page(5, "http://k.org/1", canonical="http://w.net/b&amp;c"), page(6, "http://k.org/fr/1", canonical="http://w.net/b&amp;c"), page(7, "http://k.org/2", refresh="1"),
             page(8, "http://k.org/1#part"), page(9, None), page(10, "nothing"), page(11, ""), (12, "http://net", None), page(13, "http://notnet/x"), page(14, "http://a.org/3", canonical="//a.org/4"),
             page(15, "http://a.org/4", refresh="http://k.org/1"), page(15, "http://a.org/4"), page(16, "http://k.org/5")]
    df = spark.createDataFrame([(*p, "x", "y", "z") for p in pages], "page_id long, url string, html string, rule string, node string, verdict string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.url_filter(df).collect()}
    assert url_filter.url_filter(df).count() == len(pages)
    assert got == {1: ("x.net", "/a", "net/", "block"), 2: ("m.example.net", "/en/a", "example.net/en/", "allow"), 3: ("www.example.com", "/de/x", "example.com/de/", "block"),
                   4: ("www.example.com", "/fr/y", None, "block"), 5: ("k.org", "/1", None, "block"), 6: ("k.org", "/fr/1", "org/fr/", "allow"), 7: ("k.org", "/2", None, "block"),
                   8: ("k.org", "/1", None, "block"), 9: ("", "", None, "allow"), 10: ("", "", None, "allow"), 11: ("", "", None, "allow"), 12: ("net", "", None, "allow"),
                   13: ("notnet", "/x", None, "allow"), 14: ("a.org", "/3", None, "block"), 15: ("a.org", "/4", None, "block"), 16: ("k.org", "/5", None, "allow")}
    log = spark.createDataFrame([("http://k.org/5", "http://q.net/")], "url string, target string")
    assert {r.page_id: r.verdict for r in url_filter.url_filter(df, links=log).collect()}[16] == "block"
    assert url_filter.url_filter(df.limit(0)).count() == 0
    plan = url_filter.url_filter(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_url_aliases_spelled_differently(spark):
    """Case of scheme and host, dot segments, query-only and fragment-only links: all reach the page that is meant."""
    pages = [page(1, "http://bad.net/a", canonical="HTTP://Example.ORG/p"), page(2, "http://example.org/p"), page(3, "http://worse.net/", canonical="http://b.org/q/../p"),
             page(4, "http://b.org/p"), page(5, "http://c.org/list/all?page=2", canonical="?page=1"), page(6, "http://c.org/list/all?page=1"), page(7, "http://c.org/list/?page=1"),
             page(8, "http://c.org/list/all?page=2", refresh="http://x.net/"), page(9, "http://d.org/x/y/z", canonical="./../w"), page(10, "http://D.org/x/w"), page(11, "http://d.org/x/y/z", refresh="//y.net"),
             page(12, "http://e.org/k", canonical="#top"), page(13, "http://e.org/k?u=http://x.net/"), page(14, "http://Y.net"), page(15, "http://f.org/../g", canonical="http://z.net"), page(16, "http://f.org/g#part")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r.page_id: r.verdict for r in url_filter.url_filter(df).collect()}
    blocked = {1, 2, 3, 4, 5, 6, 8, 9, 10, 11, 14, 15, 16}
    assert got == {i: "block" if i in blocked else "allow" for i in range(1, 17)}


def test_language_of_held_out_documents(spark):
    labels = dict(duckdb.sql("SELECT doc_id, lang FROM '/root/testdata/sf0.01/documents.parquet'").fetchall())
    got = queries.QUERIES["op7_language_id"](spark, "/root/testdata/sf0.01").collect()
    held = [r for r in got if r.held_out and labels[r.doc_id] is not None]
    assert len(got) == len(labels) and len(held) > 150
    assert sum(r.lang_pred == labels[r.doc_id] for r in held) / len(held) > 0.98
    assert all(0 <= r.score <= 1 for r in got)


def test_language_odd_texts(spark):
    rows = [(1, "the cat and the dog", "en"), (2, "der Hund und die Katze", "de"), (3, None, "en"), (4, "12 34 !!", "de"), (5, "the " * 30000, "en"), (None, "le chat", "fr"), (6, "x", None), (6, "x", None)]
    docs = documents(spark, rows)
    profiles = langid.learn_profiles(docs)
    assert set(profiles) == {"en", "de"}
    got = {r.doc_id: r for r in langid.predict(docs.where("doc_id is not null"), profiles).collect()}
    assert [got[i].lang_pred for i in (1, 2, 3, 4, 5)] == ["en", "de", "und", "und", "en"] and got[3].score == 0
    assert {r.lang_pred for r in langid.predict(docs, {}).collect()} == {"und"}


def test_out_of_place_ranking():
    grams, counts = langid.ngrams("Ab ab, b".encode())
    order = langid.ranked(grams, counts, 3)
    assert int(order[0]) == ord("b") and len(order) == 3


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [last := i] + [last := min(last + 1, row[j] + 1, row[j - 1] + (x != y)) for j, y in enumerate(b, 1)]
    return row[-1]


def test_levenshtein_automaton_against_distance():
    terms = ["".join(RANDOM.choices("abc", k=RANDOM.randint(1, 6))) for _ in range(60)]
    trie = toxicity.trie_of(terms)
    for _ in range(80):
        word = "".join(RANDOM.choices("abc", k=RANDOM.randint(0, 6)))
        for edits in (0, 1, 2):
            got = toxicity.intersect(toxicity.LevenshteinAutomaton(word, edits), trie)
            assert got == sorted((distance(word, t), t) for t in set(terms) if distance(word, t) <= edits)


def test_stems_meet_the_beginnings_of_words():
    stems = ["".join(RANDOM.choices("abc", k=RANDOM.randint(4, 6))) for _ in range(60)]
    trie = toxicity.trie_of(t + "*" for t in stems)
    for _ in range(60):
        word = "".join(RANDOM.choices("abc", k=RANDOM.randint(3, 9)))
        got = toxicity.intersect(toxicity.LevenshteinAutomaton(word), trie)
        least = {t: min(distance(word[:n], t) for n in range(len(word) + 1)) for t in stems}
        assert got == sorted((least[t], t + "*") for t in set(stems) if least[t] <= 1)


def test_misspellings_of_words_and_stems():
    matcher = toxicity.Model({"idiot": 5.0, "stupid*": 5.0, "oaf": 5.0, "grub*": 5.0}).matcher()
    want = {"idiot": ("idiot", 0), "idoit": ("idiot", 1), "idiott": ("idiot", 1), "idit": None, "stupidly": ("stupid*", 0), "stypidly": ("stupid*", 1), "stypid": ("stupid*", 1),
            "sutpidity": ("stupid*", 1), "sstupid": ("stupid*", 1), "tupidity": ("stupid*", 1), "oaf": ("oaf", 0), "oof": None,
            "grubs": ("grub*", 0), "grabs": None, "harmless": None, "": None}
    assert {w: matcher.term(w) for w in want} == want
    # the filter by halves loses nothing that the automaton finds
    terms = {"".join(RANDOM.choices("ab", k=RANDOM.randint(4, 7))) + RANDOM.choice(["", "*"]): 1.0 for _ in range(12)}
    matcher = toxicity.Model(terms).matcher()
    for _ in range(300):
        word = "".join(RANDOM.choices("abc", k=RANDOM.randint(5, 9)))
        if any(f in terms for f in toxicity.forms(word)):
            continue
        near = any(min(distance(word[:n], t[:-1]) for n in range(len(word) + 1)) <= 1 if t.endswith("*") else distance(word, t) <= 1
                   for t in terms if len(t.rstrip("*")) >= (6 if t.endswith("*") else 4))
        swapped = any(f in terms and len(f) >= (7 if f.endswith("*") else 5) for w in toxicity.swaps(word) for f in toxicity.forms(w))
        assert (matcher.term(word) is not None) == (near or swapped), word


@pytest.mark.parametrize("text, quoted", [
    ("they yelled \"idiot\" at him", True), ("sie rief „Idiot“ und ging", True), ("il cria « idiot » puis partit", True), ("er rief »Idiot« laut", True),
    ("he heard ‘idiot’ again", True), ("l’homme que j’ai vu est un idiot et qu’il s’en va", False), ("don't be an idiot, it's late", False),
    ("\"yes\" idiot \"no\"", False), ("« oui » idiot « non »", False), ("a 5\" pipe, idiot", False), ("idiot", False), ("you idiot “ open", False),
    ("„eins“ Idiot „zwei“", False), ("the idiot’s hat isn’t here", False), ("an idiot said so", True)])
def test_quotation_is_one_pair_of_marks(text, quoted):
    matcher = toxicity.Model({"idiot": 5.0}).matcher()
    assert [h[3] for h in matcher.hits(text.encode())] == [quoted]


def toxic_tables(spark, clashing=True):
    filler = ["".join(RANDOM.choices("aeiounrst", k=RANDOM.randint(2, 9))) for _ in range(300)]
    rows, labels = [], []
    for i in range(400):
        body = RANDOM.choices(filler, k=RANDOM.randint(15, 60))
        if toxic := i % 5 == 0:
            for term in RANDOM.sample(["vermindork", "grubling", "snotwagon"], 2):
                body.insert(RANDOM.randrange(len(body)), term)
        rows.append((i, " ".join(body)))
        labels.append((i, 0, int(toxic)))
    rows += [(900, "you are a grublinq and a vermindorc " + "so it is " * 5), (901, "they called this \"grubling\" and it said \"snotwagon\" in print"), (902, None), (903, ""), (903, ""), (904, "fine words only " * 9000)]
    labels += [(None, 0, 1), (5, 0, None), (7777, 0, 1)]
    return documents(spark, rows, clashing), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity(spark):
    docs, labels = toxic_tables(spark)
    model = toxicity.learn(docs, labels.where("doc_id is null or doc_id % 3 <> 1"))
    assert {t for t in model.weights if not t.endswith("*")} == {"vermindork", "grubling", "snotwagon"}
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    for i in range(400):
        assert got[i].predicted == int(i % 5 == 0), i
    assert got[900].predicted == 1 and got[900].n_hits == 2
    assert got[901].n_quoted == 2 and got[901].score < got[900].score
    assert got[902].score == got[903].score < 0.5 and got[904].predicted == 0 and 0 <= got[904].score <= 1
    nothing = toxicity.learn(docs, labels.where("toxic = 0"))
    assert {r.score for r in toxicity.score(docs, nothing).collect()} == {0.0}


def test_toxicity_of_held_out_documents(spark):
    labels = dict(duckdb.sql("SELECT doc_id, toxic FROM '/root/testdata/sf0.01/labels.parquet'").fetchall())
    got = queries.QUERIES["op8_toxicity"](spark, "/root/testdata/sf0.01").collect()
    held = [r for r in got if r.held_out and r.doc_id in labels]
    assert sum(r.predicted == labels[r.doc_id] for r in held) / len(held) > 0.95
    clean = [r for r in held if labels[r.doc_id] == 0]
    assert sum(r.predicted for r in clean) <= 0.01 * len(clean)


def best_edits(item, text):
    row = [0] * (len(text) + 1)
    for i, x in enumerate(item, 1):
        row = [last := i] + [last := min(last + 1, row[j] + 1, row[j - 1] + (x != y)) for j, y in enumerate(text, 1)]
    return min(row)


def edited(text, n):
    text = list(text)
    for _ in range(n):
        at, kind = RANDOM.randrange(len(text)), RANDOM.choice("sid")
        if kind == "s":
            text[at] = RANDOM.choice("abcxyzñ")
        elif kind == "i":
            text.insert(at, RANDOM.choice("abcxyzñ"))
        else:
            del text[at]
    return "".join(text)


def test_decontamination(spark):
    items = [(i, t) for i, t in duckdb.sql(f"SELECT item_id, text FROM '{SMALL}/benchmark.parquet'").fetchall()][:12]
    items += [(items[0][0] + 500, items[0][1]), (901, None), (902, ""), (903, "too short"), (904, "ñandú " * 20)]
    noise = [t for (t,) in duckdb.sql(f"SELECT text FROM '{SMALL}/documents.parquet' LIMIT 40").fetchall()]
    rows = []
    for i in range(70):
        name, item = RANDOM.choice(items[:12] + items[16:])
        rows.append((i, RANDOM.choice(noise)[:150] + "\n" + edited(item, RANDOM.randint(0, 14)).upper() + "  " + RANDOM.choice(noise)[:150]))
    rows += [(100, None), (101, ""), (102, items[1][1]), (102, items[1][1]), (None, items[1][1]), (103, noise[0] * 40 + items[2][1])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = documents(spark, rows)
    got = decontaminate.contaminated(docs, bench, block_bytes=900).collect()
    plain_items = [(i, " ".join(t.lower().split())) for i, t in items if t]
    want = []
    for i, t in rows:
        plain = decontaminate.normalise((t or "").encode())
        for name, item in plain_items:
            edits = len(item) // 20
            if item in plain or len(plain) < 2000 and best_edits(item, plain) <= edits:
                want.append((i, name, best_edits(item, plain) if len(plain) < 2000 else 0))
    assert sorted(((r.doc_id, r.item_id, r.edits) for r in got), key=str) == sorted(want, key=str)
    assert len({w[2] for w in want}) > 4
    hit = {str(w[0]) for w in want}
    left = decontaminate.decontaminate(docs, bench, block_bytes=900)
    assert left.columns == docs.columns
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted(str(i) for i, _ in rows if str(i) not in hit)
    assert decontaminate.contaminated(docs, bench.limit(0)).count() == 0 and decontaminate.decontaminate(docs, bench.limit(0)).count() == len(rows)


def test_weak_regions_are_not_reported():
    block = decontaminate.ItemBlock([(1, b"abcdefghij klmnopqrst uvwxyz 0123456789 abcdefghij klmnopqrst")], 0.05)
    assert block.find("abcdefghij klmnopqrst uvwxyz and then something else altogether") == []
    assert all(np.all(part.bound > 0) for part in block.parts)


@pytest.mark.parametrize("length", [8, 15, 16, 19, 20, 24, 31, 32, 39, 40, 47, 48, 59, 60, 63, 64, 79, 80, 99, 100, 200])
def test_full_budget_at_every_length(length):
    for _ in range(12):
        item = "".join(RANDOM.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(length))
        block = decontaminate.ItemBlock([(5, item.encode())], decontaminate.BUDGET)
        for edits in range(length // 20 + 2):
            text = list(item)
            for at in RANDOM.sample(range(1, length - 1), edits):
                text[at] = "#"
            found = block.find("some words before it " + "".join(text) + " and some behind it")
            assert [f[:1] + f[2:] for f in found] == ([(5, edits, 21, 21 + length)] if edits <= length // 20 else [])


def test_too_short_items_match_nothing():
    block = decontaminate.ItemBlock([(1, b"seven c"), (2, b""), (3, b"  EIGHT\n chr ")], decontaminate.BUDGET)
    assert [f[0] for f in block.find("seven c and eight chr")] == [3]
    assert block.find("") == [] and decontaminate.ItemBlock([], decontaminate.BUDGET).find("seven c") == []
