"""The corpus pipeline stage by stage against plain Python, and with odd inputs."""
import re

import duckdb

import corpus_pipeline
from helpers import documents
from test_dedup import fingerprint
from test_filters import toxic_tables
from tidemark.llm import decontaminate
from tidemark.session import materialize

ITEM = "a benchmark question that must not be found in any training text, whatever the case or the spacing of it is"


def tables(spark, folder, rows=None):
    docs, labels = toxic_tables(spark, clashing=False)
    if rows is not None:
        docs = documents(spark, rows, clashing=False)
    line = "this line is shared by many of the documents in the table"
    extra = [(1000 + i, f"{line}\nown words {i} {'tail%d ' % i * 20}", "en", "s1") for i in range(8)]
    copies = [(2000 + i, "one text that has copies " + " ".join(f"w{k}" for k in range(80)), "en", "s2") for i in range(4)]  # fewer than line dedup asks for
    leaks = [(3000, "before " + ITEM.upper().replace(" ", "  ") + " after", "en", None), (3001, "clean words of its own", "en", None), (None, None, None, None), (3002, "", "en", "s1")]
    docs = docs.unionByName(documents(spark, extra + copies + leaks, clashing=False)) if rows is None else docs
    docs.write.parquet(f"{folder}/documents.parquet")
    labels.write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, ITEM), (2, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return spark.read.parquet(f"{folder}/documents.parquet")


def test_stages(spark, tmp_path):
    folder = str(tmp_path)
    docs, seen = tables(spark, folder), {}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        docs = materialize(stage(spark, docs, folder), name)
        seen[name] = docs.collect()
        assert docs.columns[:len(columns)] == columns
        assert {str(r.doc_id) for r in seen[name]} <= {str(r.doc_id) for r in before}
    toxic = {i for i in range(0, 400, 5)} | {900}
    assert {r.doc_id for r in seen["toxicity"]} == ({r for r in range(400)} | {901, 902, 903, 904, None, *range(1000, 1008), *range(2000, 2004), 3000, 3001, 3002}) - toxic
    lines = {r.doc_id: r for r in seen["line_dedup"]}
    assert len(seen["line_dedup"]) == len(seen["toxicity"])
    assert all(("this line" in lines[1000 + i].text) == (i == 7) for i in range(8)) and lines[1000].n_chars == len(lines[1000].text)
    near = {r.doc_id for r in seen["simhash_near_dedup"]}
    texts = {r.doc_id: r.text or "" for r in seen["line_dedup"]}
    assert 2000 in near and not near & set(range(2001, 2004))
    for i in near:  # what stays has no twin of smaller id among what stays
        assert not any(j is not None and i is not None and j < i and (fingerprint(texts[i], 5) ^ fingerprint(texts[j], 5)).bit_count() <= corpus_pipeline.NEAR_BITS for j in near)
    assert near - {r.doc_id for r in seen["benchmark_decontamination"]} == {3000}
    mixed = seen["source_mixing"]
    assert mixed and all(len(re.findall(r"\S+", r.text or "")) == r["size"] and 1 <= r.copy <= 2 for r in mixed)
    assert len({(r.doc_id, r.copy) for r in mixed}) == len(mixed)
    again = corpus_pipeline.run(spark, folder).collect()
    assert sorted((str(r.doc_id), r.copy) for r in again) == sorted((str(r.doc_id), r.copy) for r in mixed)


def test_empty_and_tiny_inputs(spark, tmp_path):
    tables(spark, str(tmp_path / "a"), [])
    assert corpus_pipeline.run(spark, str(tmp_path / "a")).count() == 0
    tables(spark, str(tmp_path / "b"), [(None, None), (1, ""), (1, ""), (2, "one two three"), (2, "one two three")])
    assert {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path / "b")).collect()} <= {1, 2, None}


def test_small_corpus(spark):
    folder = "/root/testdata/sf0.001"
    got = corpus_pipeline.run(spark, folder).collect()
    items = [decontaminate.normalise(t.encode()) for (t,) in duckdb.sql(f"SELECT text FROM '{folder}/benchmark.parquet'").fetchall()]
    assert not any(item in decontaminate.normalise((r.text or "").encode()) for r in got for item in items)
    assert len({r.doc_id for r in got}) > 100
