"""Streamed entries in stretches of days: the same statuses in one portion and in many, and few bars per state key."""
import datetime as dt
import random

from tidemark.plans import catalog, fixtures
from tidemark.streaming import jobs

D = dt.date.fromisoformat


def test_statuses_do_not_depend_on_the_portions(spark, monkeypatch):
    rng, start = random.Random(4), D("2024-01-01")
    rows = [(f"s{i}", rng.choice(["A", "B", "C", None]), start + dt.timedelta(rng.randrange(120))) for i in range(200)]
    days = [(tk, start + dt.timedelta(day), float(rng.randrange(9))) for tk in "ABC" for day in range(125) if rng.random() < (0.1 if tk == "C" else 0.5)]
    bars = spark.createDataFrame([*days, ("A", None, 3.0), (None, start, 3.0)], "tk string, d date, o double")
    monkeypatch.setattr(catalog, "_signals", lambda s, d: spark.createDataFrame(rows, "id string, tk string, fd date"))
    monkeypatch.setattr(fixtures, "bars", lambda s, d: bars)
    got = {}
    for at_once in (1000, 60):
        monkeypatch.setattr(catalog, "BARS_AT_ONCE", at_once)
        got[at_once] = sorted(map(tuple, catalog.stream_entry_statuses(spark, "").collect()), key=str)
    passed = min(max(r[2] for r in rows), max(d for _, d, _ in days)) - dt.timedelta(1)
    want = []
    for i, tk, fd in rows:
        later = sorted((d, o) for t, d, o in days if t == tk and o > 0 and 0 < (d - fd).days <= 10)
        status = "verified" if later else "entry_window_missing" if fd + dt.timedelta(10) < passed else "awaiting_entry"
        want.append((i, tk, str(fd), status, str(later[0][0]) if later else None, later[0][1] if later else None))
    assert got[1000] == got[60] == sorted(want, key=str)
    assert len({w[3] for w in want}) == 3


def test_a_state_key_holds_the_bars_of_two_stretches(spark, tmp_path):
    """One ticker with a bar a day for 1000 days and a signal a day: the join meets some bars per signal, not all of them."""
    start = D("2020-01-01")
    spark.createDataFrame([(str(i), "A", start + dt.timedelta(i)) for i in range(1000)], "id string, tk string, fd date").write.parquet(f"{tmp_path}/s")
    spark.createDataFrame([("A", start + dt.timedelta(i), 1.0) for i in range(1000)], "tk string, d date, o double").write.parquet(f"{tmp_path}/b")
    read = lambda name: spark.readStream.schema(spark.read.parquet(f"{tmp_path}/{name}").schema).parquet(f"{tmp_path}/{name}")
    out = jobs.stream_pending_entries(read("s"), read("b"))
    q = out.writeStream.format("memory").queryName("stretches").option("checkpointLocation", f"{tmp_path}/o").trigger(availableNow=True).start()
    q.awaitTermination()
    held = max(sum(o.numRowsTotal for o in p.stateOperators) for p in q.recentProgress)
    assert held <= 1000 + 2 * 1000                         # once 8000 for the bars
    assert spark.table("stretches").where("bar_d IS NOT NULL").count() == sum(min(10, 999 - i) for i in range(1000))
