"""Every signal keeps a status in the streamed entries."""
import datetime as dt

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SMALL
from test_oracle import TABLES, rows
from tidemark.streaming import jobs


def test_all_signals_have_a_status(spark):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    df = entry.queries()["stream_entry_statuses"](spark, SMALL)
    got, want = df.collect(), con.execute(entry.oracle_sql()["stream_entry_statuses"])
    columns = [d[0] for d in want.description]
    assert rows(df.columns, got) == rows(columns, want.fetchall())
    assert len(got) == entry.queries()["extract_signals"](spark, SMALL).count()
    assert {r.entry_rule_status for r in got} > {"verified"}


@pytest.mark.parametrize("last_bar,missing", [("2024-03-01", {"gone"}), ("2024-01-12", set())])
def test_three_statuses(spark, tmp_path, last_bar, missing):
    """By hand: A enters on the 3rd at 7; nothing trades B; C was filed on the last day."""
    day = dt.date.fromisoformat
    signals = [("in", "A", day("2024-01-02")), ("gone", "B", day("2024-01-02")), ("wait", "C", day("2024-03-01"))]
    bars = [("A", day("2024-01-03"), 7.0), ("A", day("2024-01-04"), 8.0), ("B", day("2024-01-04"), 0.0), ("Z", day(last_bar), 1.0)]
    spark.createDataFrame(signals, "id string, tk string, fd date").write.parquet(f"{tmp_path}/s")
    spark.createDataFrame(bars, "tk string, d date, o double").write.parquet(f"{tmp_path}/b")
    sig, bar = spark.read.parquet(f"{tmp_path}/s"), spark.read.parquet(f"{tmp_path}/b")
    out = jobs.stream_pending_entries(spark.readStream.schema(sig.schema).parquet(f"{tmp_path}/s"), spark.readStream.schema(bar.schema).parquet(f"{tmp_path}/b"))
    jobs.run_batches(out, str(tmp_path))
    got = {r.id: r for r in jobs.resolve_entries(sig, jobs.stored(spark, str(tmp_path), out, batches=True)).collect()}
    assert (got["in"].entry_rule_status, got["in"].entry_d, got["in"].entry_px) == ("verified", day("2024-01-03"), 7.0)
    assert {i for i, r in got.items() if r.entry_rule_status == "entry_window_missing"} == missing
    assert {i for i, r in got.items() if r.entry_rule_status == "awaiting_entry"} == {"gone", "wait"} - missing
