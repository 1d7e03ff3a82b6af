import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators import flags, merge, quality as ql, rollups as ru, signals as sg, views as vw
from tidemark.plans import fixtures as fx

from conftest import SMALL

D = dt.date.fromisoformat


def bars(spark, rows):
    return spark.createDataFrame([("T", D(d), o, c) for d, o, c in rows], "tk STRING, d DATE, o DOUBLE, c DOUBLE")


def test_price_tail(spark):
    old = bars(spark, [("2025-01-02", 10.0, 10.5), ("2025-06-02", 12.0, 12.5), ("2025-06-03", 13.0, 13.5)])
    tail = bars(spark, [("2025-05-01", 1.0, 1.0), ("2025-06-02", 9.0, 9.0), ("2025-06-03", 13.2, 0.0), ("2025-06-04", 14.0, 14.4)])
    got = [(str(r.d), r.o, r.c) for r in merge.merge_price_tail(old, tail).orderBy("d").collect()]
    assert got == [("2025-01-02", 10.0, 10.5), ("2025-06-02", 12.0, 12.5), ("2025-06-03", 13.2, 13.5), ("2025-06-04", 14.0, 14.4)]
    assert merge.merge_price_tail(old.limit(0), tail).count() == 4


def test_price_window_trim(spark):
    b = bars(spark, [("2020-01-02", 5.0, 5.5), ("2024-01-02", 6.0, 6.5)])
    assert [str(r.d) for r in merge.price_window_trim(b, "2024-01-01").collect()] == ["2024-01-02"]
    assert merge.price_window_trim(b, "2025-01-01").count() == 2


ROWS = "acc STRING, icik STRING, pcik STRING, fd DATE, period DATE, amend INT, pos BIGINT"


def filings(spark, rows):
    return spark.createDataFrame([(a, "1", p, D(f), D(q), m, n) for a, p, f, q, m, n in rows], ROWS)


def test_amendments(spark):
    a = [("A", "9", "2025-01-02", "2024-12-31", 0, 1), ("A", "9", "2025-01-02", "2024-12-31", 0, 2), ("B", "9", "2025-01-05", "2024-12-31", 1, 1),
         ("C", "9", "2025-01-02", "2025-01-31", 0, 1), ("D", "8", "2025-01-02", "2024-12-31", 0, 1), ("E", "8", "2025-01-09", "2024-12-31", 0, 1)]
    assert sorted(r.acc for r in merge.supersede_amendments(filings(spark, a)).collect()) == ["B", "C", "E"]
    assert sorted(r.acc for r in merge.supersede_amendments(filings(spark, a), only_amendments=True).collect()) == ["B", "C", "D", "E"]
    again = filings(spark, [("C", "9", "2025-01-02", "2025-01-31", 0, 7)])
    assert [r.pos for r in merge.supersede_amendments(filings(spark, a), again).where("acc = 'C'").collect()] == [7]


def test_upsert_is_idempotent_and_order_free(spark):
    t = fx.trades(spark, SMALL)
    once = merge.upsert_shard(t.limit(0), t)
    twice = merge.upsert_shard(once, t.orderBy(F.desc("pos")))
    assert once.count() == twice.count() and once.exceptAll(twice).count() == 0
    assert merge.upsert_counts(once, t).collect()[0].added == 0
    assert ql.dataset_fingerprint(t).collect() == ql.dataset_fingerprint(t.orderBy(F.rand(3))).collect()


def test_coverage_is_conserved(spark):
    t = fx.trades(spark, SMALL)
    for mode in ("site", "engine"):
        by_level = {r.level: r.n for r in sg.signal_coverage(t, mode).groupBy("level").agg(F.sum("n").alias("n")).collect()}
        assert by_level["row"] == t.where("code = 'P'").count() and by_level["signal"] == sg.candidate_signals(t, mode).count()


def test_hot_issuer_rollups_match_plain_counts(spark):
    """A third of all rows under one issuer changes nothing but the numbers."""
    t = fx.trades(spark, SMALL).withColumn("icik", F.when(F.col("pos") % 3 == 0, F.lit("1")).otherwise(F.col("icik")))
    got = {r.issuer: (r.n, r.insiders) for r in ru.company_summary(t).collect()}
    want = {r.icik: (r.n, r.k) for r in t.groupBy("icik").agg(F.count("*").alias("n"), F.countDistinct("insider").alias("k")).collect()}
    assert got == want
    assert ru.recent_per_company(t).groupBy("issuer").count().agg(F.max("count")).collect()[0][0] <= 40


def test_cluster_window_by_brute_force(spark):
    rows = [("1", "a", "2025-01-01", 10.0), ("1", "b", "2025-01-08", 20.0), ("1", "b", "2025-01-09", 50.0), ("1", "b", "2025-01-20", 500.0),
            ("2", "a", "2025-01-01", 99.0), ("2", "a", "2025-01-02", 99.0)]
    t = spark.createDataFrame([(i, o, "P", 0, D(d), D(d), v, "T", "C", o, "A", 1) for i, o, d, v in rows],
                              "icik STRING, pcik STRING, code STRING, der INT, td DATE, fd DATE, val DOUBLE, tk STRING, co STRING, insider STRING, acc STRING, pos BIGINT")
    got = [(r.issuer, str(r.start_d), r.window_value) for r in flags.cluster_buys(t, 25.0).collect()]
    assert got == [("1", "2025-01-01", 30.0)]


def test_sampled_ranks_match_a_full_sort(spark):
    t = fx.trades(spark, SMALL)
    got = sorted((r.m, r.pick, r.t, r.val or 0.0) for r in vw.sample_rows(t).collect())
    months = {}
    for r in t.select(F.date_format("fd", "yyyy-MM").alias("m"), F.coalesce("val", F.lit(0.0)).alias("v")).collect():
        months.setdefault(r.m, []).append(r.v)
    want = []
    for m, vs in months.items():
        vs.sort(reverse=True)
        step = max(1, len(vs) // 25)
        want += [(m, "top", k, vs[k]) for k in range(min(2, len(vs)))] + [(m, "stride", k * step, vs[k * step]) for k in range(3) if k * step < len(vs)]
    assert got == sorted(want)
