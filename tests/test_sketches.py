"""Daily sketches and the cuts made by one aggregate."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import rollups, sketches as sk
from tidemark.schemas import TRADES
from tidemark.sources import indexes


def trades(rows):
    """Trades from ids: (filing, insider, issuer, day, value)."""
    filled = {"side": "buy", "code": "P", "form": "4", "sec": "Common Stock", "tk": "", "co": "", "insider": ""}
    out = rows.select(*[rows[c] for c in ("acc", "pcik", "icik", "fd", "val")], *[F.lit(v).alias(k) for k, v in filled.items()])
    return out.select(*[(F.col(f.name) if f.name in out.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in TRADES.fields])


@pytest.fixture(scope="module")
def many(spark):
    n = spark.range(60_000)
    return trades(n.select(F.format_string("a-%d", F.col("id") % 40_000).alias("acc"), (F.col("id") % 9_000).cast("string").alias("pcik"),
                           F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 500).cast("string")).alias("icik"),
                           F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 700).cast("int")).alias("fd"), F.lit(2.5).alias("val"))).cache()


def exact(df):
    return df.agg(F.count_distinct("acc"), F.count_distinct("pcik"), F.count_distinct("icik")).first()


@pytest.mark.parametrize("start, end", [(None, None), ("2020-02-01", "2020-02-29"), ("2021-01-01", None), (None, "2020-01-01")])
def test_ranges_keep_to_the_bound(many, start, end):
    daily = sk.daily_sketches(many)
    assert daily.count() == 700
    got = sk.approx_totals(daily, start=start, end=end).first()
    want = many.where(F.lit(True) if start is None else F.col("fd") >= start).where(F.lit(True) if end is None else F.col("fd") <= end)
    assert got.n == want.count() and got.v == 2.5 * got.n
    for c, true in zip(sk.COUNTED, exact(want)):
        assert abs(got[c] - true) <= true * sk.relative_error() + 1


def test_a_table_carried_on_counts_what_both_saw_once(many):
    first, later = many.where("fd < '2021-01-01'"), many.where("fd >= '2020-12-01'")
    merged = sk.merge_sketches(sk.daily_sketches(first), sk.daily_sketches(later))
    both = sk.approx_totals(merged).first()
    for c, true in zip(sk.COUNTED, exact(many)):
        assert abs(both[c] - true) <= true * sk.relative_error() + 1
    assert both.n == first.count() + later.count()


def test_groups(many):
    by_issuer = sk.approx_totals(sk.daily_sketches(many, ["icik"]), ["icik"]).where("icik = 'hot'").first()
    hot = many.where("icik = 'hot'")
    assert by_issuer.n == hot.count() and by_issuer.issuers == 1
    assert abs(by_issuer.filings - exact(hot)[0]) <= exact(hot)[0] * sk.relative_error()


def test_blanks_nulls_and_nothing(spark):
    schema = "acc string, pcik string, icik string, fd date, val double"
    day = dt.date(2024, 3, 1)
    few = trades(spark.createDataFrame([(" ", None, "", day, None), ("x", "1", "2", day, -3.0), ("x", "1", "2", day, 3.0), ("y", "9", "8", None, 1.0)], schema))
    got = sk.approx_totals(sk.daily_sketches(few)).first()
    assert (got.n, got.v, got.filings, got.insiders, got.issuers) == (3, 6.0, 1, 1, 1)
    none = sk.approx_totals(sk.daily_sketches(few.limit(0))).first()
    assert (none.n, none.v, none.filings) == (0, 0.0, 0)


def test_cuts_equal_the_single_ones_from_one_scan(spark, many):
    rows = many.withColumn("code", F.when(F.col("pcik").cast("int") % 2 == 0, F.col("code"))).withColumn("fd", F.when(F.col("icik") != "hot", F.col("fd")))
    cuts = rollups.trade_cuts(rows)
    for cut, single in (("code", rollups.by_code(rows)), ("side", rollups.by_side(rows)), ("form", rollups.by_form(rows)), ("sec", rollups.by_security(rows))):
        assert sorted(map(tuple, cuts.where(F.col("cut") == cut).select("bucket", "n", "v").collect())) == sorted(map(tuple, single.collect()))
    months = rollups.monthly_flow(rows).select("m", "n").collect()
    assert sorted(map(tuple, cuts.where("cut = 'month'").select("bucket", "n").collect())) == sorted(map(tuple, months))
    plan = cuts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Expand") == 1


def test_index_lines_are_taken_in_the_order_of_the_files(spark, tmp_path):
    """Of lines with one accession the first of the first file stays, however large files are cut and dealt to tasks."""
    line = "{}|NAME|4|20240102|edgar/data/{}/0000000001-24-000001.txt\n"
    (tmp_path / "a.idx").write_text(line.format(1, 1))
    (tmp_path / "b.idx").write_text("".join(line.format(n, n) for n in range(2, 3000)))   # larger, hence dealt first
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        got = indexes.read_daily_index(spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r.path for r in got] == ["edgar/data/1/0000000001-24-000001.txt"]
