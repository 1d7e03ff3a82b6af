"""Disk that queries take on their way: no row per calendar day, nothing of a stored table's way, packed exports."""
import datetime as dt
import os
import time

from pyspark.sql import functions as F

from tidemark.operators import positions
from tidemark.session import materialize, setting
from tidemark.sources import shards

D = dt.date.fromisoformat
SIGNAL = ("id string, acc string, tk string, form string, amend int, fd date, td date, co string, icik string, pcik string, insider string, rel string, "
          "title string, sec string, insider_sh double, insider_val double, insider_px double, lots long")


def signals(spark, rows):
    return spark.createDataFrame([(i, i, tk, "4", 0, fd, fd, "Co", "1", "2", "Who", "Officer", "CFO", "Common Stock", 10.0, 100.0, 10.0, 1) for i, tk, fd in rows], SIGNAL)


def test_entries_without_a_row_per_calendar_day(spark):
    """Sessions three years apart; days between them are answered by a running frame, not by rows of their own."""
    bars = spark.createDataFrame([("A", D("2020-01-02"), 5.0, 5.0, 1, "x"), ("A", D("2023-01-02"), 8.0, 9.0, 1, "x"), ("B", D("2020-01-02"), 0.0, 3.0, 1, "x")],
                                 "tk string, d date, o double, c double, v long, src string")
    s = signals(spark, [("before", "A", D("2019-12-30")), ("same", "A", D("2023-01-02")), ("late", "A", D("2022-12-30")), ("far", "A", D("2020-01-02")),
                        ("undated", "A", None), ("untraded", "B", D("2019-12-30")), ("none", "C", D("2020-01-01")), ("nameless", None, D("2020-01-01"))])
    book = positions.simulate_positions(s, bars, "2023-06-30")
    assert "sequence(" not in book._jdf.queryExecution().optimizedPlan().toString()
    got = {r.id: (r.entry_rule_status, r.entry_d and str(r.entry_d), r.entry_px) for r in book.collect()}
    assert got == {"before": ("verified", "2020-01-02", 5.0), "same": ("awaiting_entry", None, None), "late": ("verified", "2023-01-02", 8.0),
                   "far": ("entry_window_missing", None, None), "undated": ("awaiting_entry", None, None), "untraded": ("awaiting_entry", None, None),
                   "none": ("no_price", None, None), "nameless": ("no_price", None, None)}


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().endswith(".data")}


def test_a_stored_table_leaves_no_shuffle_files(spark):
    before = shuffle_files(spark)
    stored = materialize(spark.range(50_000).groupBy((F.col("id") % 997).alias("k")).agg(F.count("*").alias("n")), "counts")
    for _ in range(50):                                    # they go in the background
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.2)
    assert not left and stored.count() == 997


def test_a_setting_ends_with_its_block(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    with setting(spark, name, "true"):
        assert spark.conf.get(name) == "true"
    assert spark.conf.get(name) == before


def test_json_exports_are_packed(spark, tmp_path):
    rows = spark.range(100).select("id", F.array("id").alias("nested"))
    shards.write_positions(rows, str(tmp_path / "out"))
    names = [n for n in os.listdir(tmp_path / "out") if n.startswith("part-")]
    assert names and all(n.endswith(".json.gz") for n in names)
    assert spark.read.schema(rows.schema).json(str(tmp_path / "out")).exceptAll(rows).count() == 0
