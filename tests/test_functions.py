import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions import calendar as cal, labels as lb, links as lk, numeric as nm


def ask(spark, values, fn, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i INT, v {kind}")
    return [r.x for r in df.select("i", fn(F.col("v")).alias("x")).orderBy("i").collect()]


def test_dates(spark):
    texts = ["15-AUG-2025", "5-JAN-2006", "2025-08-15", "15-AUG-2025 00:00:00", "", "not a date", "15-XXX-2025", "31-FEB-2025", None]
    want = [dt.date(2025, 8, 15), dt.date(2006, 1, 5), dt.date(2025, 8, 15), dt.date(2025, 8, 15)] + [None] * 5
    assert ask(spark, texts, cal.parse_sec_date) == want
    assert ask(spark, ["20250815", "2025-08-15T1", "x"], cal.compact_date) == [dt.date(2025, 8, 15)] * 2 + [None]


def test_numbers(spark):
    texts = ["1000.00", "1,234.5", "", "NULL", "n/a", "0", "NaN", "Infinity", "-Infinity", "$1,250.75", "abc", None]
    assert ask(spark, texts, nm.parse_number) == [1000.0, 1234.5, None, None, None, 0.0, None, None, None, 1250.75, None, None]


def test_relationships(spark):
    assert ask(spark, ["OFFICER|DIRECTOR", "TENPERCENTOWNER", ""], lambda c: lb.relationship_label(c, F.lit(""))) == [
        "Director/Officer", "10% Owner", "Unknown"]
    assert ask(spark, ["", "OTHER"], lambda c: lb.relationship_label(c, F.lit("note"))) == ["Other", "Other"]


@pytest.mark.parametrize("mode,titles,want", [
    ("strict", ["Common Stock", "Class A Common Stock", "American Depositary Shares", "", "Stock Option (right to buy)",
                "Restricted Stock Units", "Warrant to purchase", "Series A Preferred Stock", "Convertible Note", "Class C Capital Stock"],
     [True] * 4 + [False] * 6),
    ("lenient", ["Common Stock", "Class C Capital Stock", "American Depositary Shares", "Depositary Share", "Warrants", "Phantom Stock", ""],
     [True, True, True, False, False, False, True])])
def test_common_equity(spark, mode, titles, want):
    assert ask(spark, titles, lambda c: lb.is_common_equity(c, mode)) == want


def test_tickers(spark):
    tickers = ["BRK.B", "brk/b", "NONE", "", "A_B", "TOOLONGTICK", "1AB", "N/A"]
    assert ask(spark, tickers, lambda c: lb.valid_ticker(c, "engine")) == [True, True, False, False, True, False, False, False]
    assert ask(spark, tickers, lb.valid_ticker) == [True, True, False, False, True, False, False, False]
    assert ask(spark, ["BRK.B", " a b "], lb.normalize_ticker) == ["BRK.B", "AB"]
    assert ask(spark, ["BRK.B", "brk/b"], lb.quote_symbol) == ["BRK-B", "BRK-B"]


def test_buckets(spark):
    assert ask(spark, [5_000.0, 100_000.0, 5_000_000.0], lb.size_bucket, "double") == ["<$10k", "$50k–250k", ">$1M"]
    role = lambda title, mode="site": lambda c: lb.role_bucket(c, F.lit(title), mode)
    assert ask(spark, ["Officer"], role("Chief Executive Officer")) == ["CEO"]
    assert ask(spark, ["Officer", "Director", "10% Owner"], role("CFO")) == ["CFO", "Director", "10% owner"]
    assert ask(spark, ["Director"], role("former CEO", "engine")) == ["CEO"]
    assert ask(spark, ["0000320193", "", None], lb.company_bucket) == [320193 % 64, 0, 0]
    assert ask(spark, ["0000320193", "0000", ""], lb.strip_cik) == ["320193", "0000", ""]


def test_weekdays_by_brute_force(spark):
    days = [dt.date(2025, 1, 1) + dt.timedelta(days=k) for k in range(40)]
    rows = [(a, b) for a in days[:9] for b in days]
    df = spark.createDataFrame(rows, "a DATE, b DATE")
    got = {(r.a, r.b): r.n for r in df.select("a", "b", cal.business_days_between(F.col("a"), F.col("b")).alias("n")).collect()}
    for a, b in rows:
        want = sum(1 for k in range(1, (b - a).days + 1) if (a + dt.timedelta(days=k)).weekday() < 5)
        assert got[a, b] == want


def test_links_and_text(spark):
    url = ask(spark, ["0000320193-25-000060"], lambda c: lk.filing_url(c, F.lit("0000320193")))[0]
    assert url == "https://www.sec.gov/Archives/edgar/data/320193/000032019325000060/0000320193-25-000060-index.htm"
    assert ask(spark, ["0001214156-25-000060", ""], lambda c: lk.filing_url(c, F.lit("")))[0].split("/")[6] == "1214156"
    ok = lambda c: lk.filing_url_ok(c, F.lit("0000320193-25-000060"), F.lit("320193"))
    assert ask(spark, [url, url.replace("-index.htm", ".txt"), url.replace("/320193/", "/0000320193/"), url + "x", ""], ok) == [True, True, True, False, False]
    assert ask(spark, [1234.5, -2.0, None], lk.money_text, "double") == ["$1,234.50", "$-2.00", "not reported"]
    assert ask(spark, [1234.0, 0.25, 1234.56789], lk.shares_text, "double") == ["1,234", "0.25", "1,234.5679"]


def test_rounding_has_no_negative_zero(spark):
    assert str(ask(spark, [-0.00001], nm.r4, "double")[0]) == "0.0"
