"""Pruning by year, mixed headers, number spellings, and columns that merges have to carry."""
import datetime as dt
import gzip

import pytest
from pyspark.sql import functions as F

from tidemark.functions.calendar import parse_sec_date
from tidemark.functions.numeric import parse_number
from tidemark.operators import merge, quality, rollups, signals
from tidemark.plans import fixtures
from tidemark.sources import bulk, headers, prices, shards
from tidemark.streaming import jobs, table

from conftest import SMALL

D = dt.date.fromisoformat


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filing_years_prune_folders_and_reach_the_scan(spark, tmp_path):
    shards.write_trades_by_year(fixtures.trades(spark, SMALL), str(tmp_path))
    stored = spark.read.parquet(str(tmp_path))
    one, later = rollups.filing_window(stored, target_year=1999), rollups.filing_window(stored, from_year=1999)
    for df in (one, later):
        text = plan(df)
        assert "PartitionFilters: []" not in text and "GreaterThanOrEqual(fd,1999-01-01)" in text
    assert one.count() == stored.where("year(fd) = 1999").count() > 0 and later.count() == stored.where("year(fd) >= 1999").count()
    assert "GreaterThanOrEqual(fd,1999-01-01)" in plan(signals.extract_signals(stored, from_year=1999))
    assert "LessThan(fd,2000-01-01)" in plan(quality.row_issues(stored, 1999))


def test_files_with_different_headers_below_one_folder(spark, tmp_path):
    for quarter, text in (("q1", "ACCESSION_NUMBER\tFILING_DATE\nA1\t15-AUG-2025\n"), ("q2", "FILING_DATE\tACCESSION_NUMBER\r\n16-AUG-2025\tA2\r\n")):
        (tmp_path / quarter).mkdir()
        (tmp_path / quarter / "SUBMISSION.tsv").write_bytes(text.encode())
    rows = bulk.read_bulk_tables(spark, str(tmp_path))["SUBMISSION"].collect()
    assert sorted((r.ACCESSION_NUMBER, r.FILING_DATE) for r in rows) == [("A1", "15-AUG-2025"), ("A2", "16-AUG-2025")]


def test_shards_and_bars_read_by_their_own_header(spark, tmp_path):
    """Two shards (one of them packed) and two bar files whose columns come in another order, or are missing."""
    (tmp_path / "y1.csv").write_text("acc,fd,sh,px,co\nA1,2024-01-02,10,2.5,One\n")
    (tmp_path / "y2.csv.gz").write_bytes(gzip.compress(b"px,co,acc,fd\n3.5,Two,A2,2024-01-03\n"))
    got = {r.acc: (str(r.fd), r.sh, r.px, r.co) for r in shards.read_trade_shards(spark, str(tmp_path)).collect()}
    assert got == {"A1": ("2024-01-02", 10.0, 2.5, "One"), "A2": ("2024-01-03", None, 3.5, "Two")}
    bars = tmp_path / "bars"
    bars.mkdir()
    (bars / "one.us.csv").write_text("Date,Open,High,Low,Close,Volume\n2024-01-02,1,3,1,2,10\n")
    (bars / "two.us.csv").write_text("Date,Close,Open,Low,High,Volume\n2024-01-02,5,4,4,6,20\n")
    assert sorted((r.o, r.c) for r in prices.read_bars_stooq_csv(spark, str(bars)).collect()) == [(1.0, 2.0), (4.0, 5.0)]


def test_first_lines_need_no_job(spark, tmp_path):
    paths = []
    for i in range(40):
        (tmp_path / f"f {i}.txt").write_text(f"header {i}\nrow")
        paths.append(str(tmp_path / f"f {i}.txt"))
    (tmp_path / "empty.txt").write_text("")
    jobs_before = len(spark.sparkContext.statusTracker().getJobIdsForGroup())
    lines = headers.first_lines(spark, [*paths, str(tmp_path / "empty.txt")])
    assert [lines[p] for p in paths] == [f"header {i}" for i in range(40)] and lines[str(tmp_path / "empty.txt")] == ""
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup()) == jobs_before


def test_number_and_date_spellings(spark):
    texts = ["1d", "5F", "0x1p3", "1e3", "-.5", "+7.", "$1,234.50", "NaN", "Infinity", "", "1 2", "n/a", None]
    got = [r.n for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i").select(parse_number(F.col("t")).alias("n")).collect()]
    assert got == [None, None, None, 1000.0, -0.5, 7.0, 1234.5, None, None, None, None, None, None]
    days = ["15-AUG-2025", "3-feb-2021 00:00:00", "31-FEB-2021", "12-XYZ-2021", "2025-08-15T10", "", None]
    got = [r.n for r in spark.createDataFrame([(i, t) for i, t in enumerate(days)], "i int, t string").orderBy("i").select(parse_sec_date(F.col("t")).alias("n")).collect()]
    assert got == [D("2025-08-15"), D("2021-02-03"), None, None, D("2025-08-15"), None, None]


def test_price_tail_carries_the_other_columns(spark):
    columns = "tk string, d date, o double, h double, l double, c double, v double, src string"
    old = spark.createDataFrame([("T", D("2024-01-02"), 1.0, 2.0, 0.5, 1.5, 10.0, "a"), ("T", D("2024-01-03"), 3.0, 4.0, 2.5, 3.5, 20.0, "a")], columns)
    tail = spark.createDataFrame([("T", D("2024-01-02"), 9.0, 9.0, 9.0, 9.0, 9.0, "b"), ("T", D("2024-01-03"), 0.0, 5.0, None, 3.6, 21.0, "b"), ("T", D("2024-01-04"), 6.0, 7.0, 5.0, 6.5, 30.0, "b")], columns)
    got = merge.merge_price_tail(old, tail).select(*old.columns).orderBy("d").collect()
    assert [tuple(r)[2:] for r in got] == [(1.0, 2.0, 0.5, 1.5, 10.0, "a"), (3.0, 5.0, 2.5, 3.6, 21.0, "b"), (6.0, 7.0, 5.0, 6.5, 30.0, "b")]


def test_stream_dedupe_over_batches_equals_the_batch_rule(spark, tmp_path):
    """Three batches, one of them a replay; blank and missing text are the same key, as in the batch rule."""
    rows = fixtures.trades(spark, SMALL).where("fd >= '1998-01-01' AND fd < '1998-02-01'").limit(60)
    odd = rows.withColumn("ad", F.when(F.col("pos") % 2 == 0, F.lit("")))
    for i, part in enumerate((odd, odd.withColumn("ad", F.lit(None).cast("string")), odd)):
        part.coalesce(1).write.parquet(f"{tmp_path}/in/{i}")
    stream = spark.readStream.schema(odd.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in")
    jobs.run_to_table(jobs.stream_dedupe(stream), f"{tmp_path}/out")
    got = spark.read.parquet(f"{tmp_path}/out/data")
    keys = merge.row_key(odd)
    assert got.count() == odd.select(*[k.alias(f"k{i}") for i, k in enumerate(keys)]).distinct().count()
    assert len(spark.read.json(f"{tmp_path}/out/offsets/commits").inputFiles()) >= 3


def test_content_manifest(spark):
    got = shards.content_manifest(spark.createDataFrame([(1, "é"), (2, None)], "k int, t string"), "k", "t").orderBy("k").collect()
    assert [r.bytes for r in got] == [2, 0] and got[1].sha256.startswith("e3b0c442")


def test_coverage_needs_a_ledger_that_proves_it(spark):
    trades = fixtures.trades(spark, SMALL)
    assert quality.coverage_report(trades, 1999, fixtures.AUDIT_ASOF).first().complete
    columns = "kind string, target_year int, window_from date, window_to date, label string, status string"
    good = [("window", 1999, D("1998-12-01"), D("2000-01-15"), None, None), ("quarter", None, None, None, "1999Q1", "ok"), ("daily", None, None, None, "1999-03-01", "skipped")]
    bad = [("window", 1998, D("1999-02-01"), D("2000-01-15"), None, None), ("quarter", None, None, None, "1999Q2", "absent"), ("daily", None, None, None, "1999-03-02", "failed")]
    report = lambda rows: quality.coverage_report(trades, 1999, fixtures.AUDIT_ASOF, spark.createDataFrame(rows, columns)).first()
    assert report(good).complete
    assert (report([]).complete, report([]).blockers) == (False, "ledger_missing")
    assert report(good + bad).blockers == "daily_run_failed,ledger_window_too_short,ledger_year_mismatch,quarter_not_available"


def test_stream_upsert_over_batches_equals_the_batch_upsert(spark, tmp_path):
    """Four batches over two years with corrections, an undated row and a late year; then one is replayed."""
    rows = fixtures.trades(spark, SMALL).where("fd >= '1998-12-01' AND fd < '1999-02-01'").limit(80)
    base = spark.createDataFrame(rows.collect(), rows.schema)
    parts = [base, base.where("pos % 2 = 0").withColumn("co", F.lit("second")), base.where("pos % 3 = 0").withColumn("co", F.lit("third")).withColumn("fd", F.when(F.col("fd") >= "1999-01-01", F.col("fd"))),
             base.limit(5).withColumn("acc", F.concat(F.lit("late"), "acc")).withColumn("fd", F.lit("1990-05-05").cast("date"))]
    for i, part in enumerate(parts):
        part.coalesce(1).write.parquet(f"{tmp_path}/in/{i}")
    stream = spark.readStream.schema(base.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in")
    path = f"{tmp_path}/out"
    jobs.stream_ingest_trades(stream, path)
    want = base.limit(0)
    for part in parts:
        want = merge.upsert_shard(want, part)
    state = lambda df: sorted(map(str, df.select("acc", "pos", "fd", "co").collect()))
    got = jobs.merged_trades(spark, path, base)
    assert state(got) == state(want)
    ledger = {r.batch: (r.added, r.undated) for r in spark.read.json(f"{path}/ledger").collect()}
    assert len(ledger) == 4 and ledger[0][0] > 0 and ledger[1] == (0, 0) and ledger[2][1] > 0 and ledger[3] == (5, 0)
    before = table.versions(spark, path)
    table.merge_batch(parts[3], 3, path)            # a replay of a committed batch
    assert state(jobs.merged_trades(spark, path, base)) == state(want) and table.versions(spark, path) == before
    assert {r.batch: (r.added, r.undated) for r in spark.read.json(f"{path}/ledger").collect()} == ledger
    # a batch reads the years it touches alone: other folders are not listed, and fy prunes what is
    touched = table.read(spark, path, base.schema, [1998])
    assert all("fy=1998" in f for f in touched.inputFiles()) and "PartitionFilters: [isnotnull(fy" in plan(touched) and "fy#" in plan(touched).split("PartitionFilters")[1][:40]
    # compaction is a version of the same table: the stream goes on from it, old versions stay readable until they expire
    table.compact(spark, path, base.schema)
    assert state(jobs.merged_trades(spark, path, base)) == state(want)
    more = base.limit(4).withColumn("co", F.lit("after"))
    more.coalesce(1).write.parquet(f"{tmp_path}/in/4")
    jobs.stream_ingest_trades(stream, path)
    newer = merge.upsert_shard(want, more)
    assert state(jobs.merged_trades(spark, path, base)) == state(newer)
    assert state(table.read(spark, path, base.schema, version=before[-1])) == state(want)
    assert table.expire(spark, path, keep=1) and state(jobs.merged_trades(spark, path, base)) == state(newer)
    assert table.versions(spark, path) == [before[-1] + 2]
    with pytest.raises(RuntimeError):               # a second writer of the same version
        table.commit(spark, path, table.Manifest(before[-1] + 2, 9, {}))


def test_failed_batch_leaves_the_table_as_it_was(spark, tmp_path, monkeypatch):
    base = spark.createDataFrame(fixtures.trades(spark, SMALL).limit(10).collect(), fixtures.trades(spark, SMALL).schema)
    path = str(tmp_path)
    table.merge_batch(base.limit(5), 0, path)
    with monkeypatch.context() as m:
        m.setattr(table, "commit", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            table.merge_batch(base, 1, path)
    assert jobs.merged_trades(spark, path, base).count() == merge.upsert_shard(base.limit(0), base.limit(5)).count()
    table.merge_batch(base, 1, path)
    assert jobs.merged_trades(spark, path, base).count() == merge.upsert_shard(base.limit(0), base).count()


def test_append_windows_drop_and_count_late_rows(spark, tmp_path):
    """Three batches; a row of January arrives when the watermark stands in March."""
    row = fixtures.trades(spark, SMALL).where("val IS NOT NULL AND der = 0").first().asDict()
    days = [["2024-01-02", "2024-01-02", "2024-01-05"], ["2024-03-20", "2024-01-05"], ["2024-01-02", "2024-06-01"]]
    schema = fixtures.trades(spark, SMALL).schema
    path = f"{tmp_path}/out"
    for i, part in enumerate(days):
        spark.createDataFrame([row | {"fd": D(x)} for x in part], schema).coalesce(1).write.parquet(f"{tmp_path}/in/{i}")
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in")
        out = jobs.stream_flow_windows(stream).select(F.col("window.start").cast("date").alias("d"), "code", "n", "value")
        jobs.append_windows(out, path)
    got = jobs.stored(spark, path, out)
    assert sorted((str(r.d), r.n) for r in got.collect()) == [("2024-01-02", 2), ("2024-01-05", 2), ("2024-03-20", 1)]
    arrived = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in")
    assert jobs.late_rows(arrived, got, path).first().asDict() == {"arrived": 7, "still_open": 1, "emitted": 5, "late": 1}
    assert sum(r.late_groups for r in spark.read.json(f"{path}/ledger").collect()) == 1
