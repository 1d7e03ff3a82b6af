"""Range joins by buckets against all pairs, reused tickers, and pages by continuation key."""
import datetime as dt
import random

import pytest

from tidemark.operators import asof, intervals as iv, views

D = dt.date.fromisoformat
RANDOM = random.Random(8)


def day():
    return dt.date(1975, 1, 1) + dt.timedelta(RANDOM.randrange(40_000))     # beyond both ends of the buckets


def test_in_interval_equals_all_pairs(spark):
    points = [(i, RANDOM.choice(["a", "b", None]), RANDOM.choice([day(), day(), day(), None])) for i in range(300)]
    spans = [(RANDOM.choice(["a", "b", None]), RANDOM.choice([day(), None]), RANDOM.choice([day(), None]), j) for j in range(40)]
    want = sorted((i, j) for i, k, d in points for n, a, b, j in spans if k and d and k == n and (a is None or a <= d) and (b is None or d <= b))
    p = spark.createDataFrame(points, "i int, tk string, d date")
    s = spark.createDataFrame(spans, "tk string, from_d date, to_d date, j int")
    got = iv.in_interval(p, s, "d")
    assert got.columns == ["i", "tk", "d", "j"]
    assert sorted((r.i, r.j) for r in got.collect()) == want and want
    left = iv.in_interval(p, s, "d", how="left").collect()
    assert sorted((r.i, r.j) for r in left if r.j is not None) == want and {r.i for r in left} == set(range(300))
    assert iv.in_interval(p, s.limit(0), "d").count() == 0 and iv.in_interval(p.limit(0), s, "d").count() == 0
    text = got._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text and "NestedLoop" not in text


VALIDITY = [("X", "1", None, D("2020-01-03")), ("X", "1", D("2020-01-02"), D("2020-01-04")), ("X", "2", D("2020-01-07"), None),
            ("X", "2", D("2020-01-07"), None), ("X", None, None, None), ("X", "3", D("2020-02-01"), D("2020-01-01"))]
V = "tk string, icik string, from_d date, to_d date"


def test_validity_is_merged(spark):
    got = {tuple(r) for r in iv.merged_validity(spark.createDataFrame(VALIDITY, V)).collect()}
    assert got == {("X", "1", None, D("2020-01-04")), ("X", "2", D("2020-01-07"), None)}


def test_each_issuer_is_priced_by_its_own_bars(spark):
    bars = spark.createDataFrame([(t, D(f"2020-01-{n:02d}"), float(n), float(n)) for t in ("X", "Y") for n in range(1, 11)], "tk string, d date, o double, c double")
    left = spark.createDataFrame([(1, "X", "1", D("2020-01-02")), (2, "X", "1", D("2020-01-04")), (3, "X", "2", D("2020-01-02")), (4, "X", "2", D("2020-01-08")),
                                  (5, "Y", "1", D("2020-01-04")), (6, "X", None, D("2020-01-02")), (7, None, "1", D("2020-01-02")), (8, "X", "9", D("2020-01-02")),
                                  (9, "Y", None, None)], "i int, tk string, icik string, fd date")
    validity = spark.createDataFrame(VALIDITY, V)
    entry = {r.i: (r.tk, r.entry_px, r.entry_i) for r in iv.per_issuer(asof.next_session_entry, left, bars, validity).collect()}
    assert entry == {1: ("X", 3.0, 2), 2: ("X", None, None), 3: ("X", 7.0, 0), 4: ("X", 9.0, 2), 5: ("Y", 5.0, 4), 6: ("X", None, None),
                     7: (None, None, None), 8: ("X", None, None), 9: ("Y", None, None)}
    close = {r.i: r.close_px for r in iv.per_issuer(lambda a, b: asof.close_on_or_before(a, b, "fd"), left, bars, validity).collect()}
    assert (close[2], close[3], close[4], close[5]) == (4.0, None, 8.0, 4.0)
    assert sorted((r.d.day, r.icik) for r in iv.issuer_bars(bars, validity).where("tk = 'X'").collect()) == [(n, "1") for n in range(1, 5)] + [(n, "2") for n in range(7, 11)]
    plain = iv.per_issuer(asof.next_session_entry, left, bars, validity.limit(0)).collect()
    assert {r.i: r.entry_px for r in plain}[3] == 3.0


@pytest.mark.parametrize("numeric", [True, False])
@pytest.mark.parametrize("descending", [True, False])
def test_pages_by_key_equal_pages_by_offset(spark, numeric, descending):
    rows = [(i, RANDOM.choice(["a", "B", "b", None]), RANDOM.choice([1.0, 2.5, 3.0, None]) if numeric else RANDOM.choice(["x", "X", "y", "", None])) for i in range(95)]
    df = spark.createDataFrame(rows, f"i int, t string, v {'double' if numeric else 'string'}").repartition(3)
    how = {"descending": descending, "numeric": numeric, "size": 20, "tie": ("t", "i")}
    after, seen = None, []
    for page in range(6):
        got = views.view_seek_page(df, "v", after, **how).collect()
        assert got == views.view_sort_page(df, "v", page=page, **how).collect()
        seen += [r.i for r in got]
        if got:
            after = views.seek_position(got[-1], "v", numeric=numeric, tie=how["tie"])
    assert sorted(seen) == list(range(95))


def test_a_key_of_another_length_is_refused(spark):
    with pytest.raises(ValueError):
        views.view_seek_page(spark.range(3), "id", (1,), numeric=True, tie=("id",))
