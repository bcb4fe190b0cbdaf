import os
import shutil
import tempfile
import time

import pytest
from pyspark.sql import functions as F

from shoplens import schemas
from shoplens.operators import ads
from shoplens.plans import registry
from shoplens.sources import tables as src
from shoplens.streaming import ad_stream as st

DAY = 1704067200000          # 2024-01-01 00:00:00 UTC in ms
MIN = 60_000
NOW = {"availableNow": True}
BIG = 2**60 + 1              # an id that a float cannot hold


def line(t, user, ad, prov=1, city=2):
    return f"{DAY + t} {prov} {city} {user} {ad}"


SLICES = [
    [line(0, 1, 5), line(MIN, 1, 5), line(2 * MIN, 2, 5), "garbage line", line(3 * MIN, 3, 6),
     line(4 * MIN, 9, 7)],                                  # user 1 reaches 2 -> listed at batch 0
    [line(5 * MIN, 1, 5), line(6 * MIN, 2, 5), line(7 * MIN, 3, 7), line(8 * MIN, 4, 8, 3, 4)],
    [line(9 * MIN, 2, 5), line(10 * MIN, 3, 6), line(11 * MIN, 4, 8, 3, 4), line(12 * MIN, 9, 7)],
]


def put(base, i, lines):
    d = f"{base}/source/slice{i}"
    os.makedirs(d, exist_ok=True)
    with open(f"{d}/part-0.txt", "w") as f:
        f.write("\n".join(lines) + "\n")
    time.sleep(0.05)


def advance(spark, stream):
    """One run of each query over what has come: every run is a restart."""
    stream.start_filter(st.ad_log_stream(spark, f"{stream.base}/source"), NOW).awaitTermination()
    stream.start_totals(spark, NOW).awaitTermination()
    stream.start_trend(spark, NOW).awaitTermination()


def opened(spark, threshold=2, seeds=(9,), **more):
    base = tempfile.mkdtemp(prefix="shoplens-stream-")
    return st.AdStream(base, threshold, seeds=spark.createDataFrame([(s,) for s in seeds], "user_id long"), **more)


def run(spark, slices, **more):
    stream = opened(spark, **more)
    for i, lines in enumerate(slices):
        put(stream.base, i, lines)
        advance(spark, stream)
    return stream


def tables(stream, spark):
    readers = (stream.blacklist, stream.user_click_counts, stream.ad_stat, stream.click_trend, stream.province_top3)
    return [sorted(tuple(r) for r in f(spark).collect()) for f in readers]


@pytest.fixture(scope="module")
def done(spark):
    return run(spark, SLICES)


def test_blacklist_stream_closed_form(spark, done):
    # 9 pre-listed; 1 listed in batch 0; 2 reaches exactly 2 in batch 1; 3 and 4 reach 2 in batch 2
    assert sorted(r[0] for r in done.blacklist(spark).collect()) == [1, 2, 3, 4, 9]
    upd = sorted(tuple(r) for r in done.clicks(spark, "listed").select("batch_id", "user_id").collect())
    assert upd == [(0, 1), (1, 2), (2, 3), (2, 4)]
    counts = {(r["user_id"], r["ad_id"]): r["click_count"] for r in done.user_click_counts(spark).collect()}
    # user 1's batch-1 click and user 2's batch-2 click are dropped; user 9 never counts
    assert counts == {(1, 5): 2, (2, 5): 2, (3, 6): 2, (3, 7): 1, (4, 8): 2}
    batches = sorted(tuple(r) for r in done.batches(spark).select("batch_id", "lines", "malformed", "kept").collect())
    assert batches == [(0, 6, 1, 4), (1, 4, 0, 3), (2, 4, 0, 2)]
    top = sorted(tuple(r) for r in done.province_top3(spark).collect())
    assert top == [("2024-01-01", "1", 5, 4), ("2024-01-01", "1", 6, 2), ("2024-01-01", "1", 7, 1),
                   ("2024-01-01", "3", 8, 2)]
    assert [r["value"] for r in done.clicks(spark, "malformed").collect()] == ["garbage line"]
    trend = done.click_trend(spark).filter("minute = '03'").collect()
    assert [(r["ad_id"], r["click_count"]) for r in trend] == [(6, 1)]


def test_replaying_a_batch_is_idempotent(spark, done):
    """The last batch's commit is lost, as when the driver goes after the sink's work: the batch runs again."""
    before = tables(done, spark), sorted(map(str, done.clicks(spark, "kept", "dropped", "malformed").collect()))
    for query, start in (("filter", lambda: done.start_filter(st.ad_log_stream(spark, f"{done.base}/source"), NOW)),
                         ("totals", lambda: done.start_totals(spark, NOW)), ("trend", lambda: done.start_trend(spark, NOW))):
        commits = f"{done.base}/checkpoint_{query}/commits"
        newest = max(int(f) for f in os.listdir(commits) if f.isdigit())
        for f in (f"{commits}/{newest}", f"{commits}/.{newest}.crc"):
            if os.path.exists(f):
                os.remove(f)
        start().awaitTermination()
        assert os.path.exists(f"{commits}/{newest}"), query
        after = tables(done, spark), sorted(map(str, done.clicks(spark, "kept", "dropped", "malformed").collect()))
        assert after == before, query


def test_failure_while_days_are_rewritten(spark, done, monkeypatch):
    """A batch stops at each of its tables in turn, the days gone but not yet back; the replays put them right."""
    stream = run(spark, SLICES[:2])
    put(stream.base, 2, SLICES[2])
    stream.start_filter(st.ad_log_stream(spark, f"{stream.base}/source"), NOW).awaitTermination()
    real = st.release
    for name in ("ad_stat", "user_counts", "province_top3"):
        def failing(session, paths):
            table = paths[0].split("_next")[0]
            if os.path.basename(table) == name:
                for d in os.listdir(table):                 # the overwrite had deleted the old days
                    if d.startswith("date="):
                        shutil.rmtree(f"{table}/{d}")
                raise RuntimeError("lost driver")
            real(session, paths)

        with monkeypatch.context() as m:
            m.setattr(st, "release", failing)
            with pytest.raises(Exception, match="lost driver"):
                stream.start_totals(spark, NOW).awaitTermination()
    advance(spark, stream)
    assert tables(stream, spark) == tables(done, spark)


def replayed(spark, folder, clicks):
    """``stream_ad_stat`` over clicks (event id, user): user 1 and 2 of place (4, 2), 3 of (5, 6); all on ad 5."""
    for name, rows, types in (
            ("events", [(i, "click", u, "2024-01-01 00:00:01", '{"k": 25}') for i, u in clicks],
             "event_id long, event_type string, user_id long, ts string, props string"),
            ("customer", [(1, 2), (2, 2), (3, 6), (4, 2)], "c_custkey long, c_nationkey int"),
            ("nation", [(2, 4), (6, 5)], "n_nationkey int, n_regionkey int")):
        df = spark.createDataFrame(rows, types)
        if name == "events":
            df = df.withColumn("ts", F.col("ts").cast("timestamp_ntz"))
        df.write.parquet(f"{folder}/{name}.parquet")
    found = registry.queries()["stream_ad_stat"](spark, str(folder))
    assert found.columns == ["batch_id", "date", "province", "city", "ad_id", "click_count"]
    return sorted(tuple(r) for r in found.collect())


def test_ad_stat_runs_on_from_batch_to_batch(spark, tmp_path):
    """Totals so far of the keys that a batch touches; users are listed from 2 clicks on."""
    here, there = ("2024-01-01", "4", "2", 5), ("2024-01-01", "5", "6", 5)
    assert replayed(spark, tmp_path, [(0, 1), (1, 1), (2, 3), (3, 2), (4, 1), (6, 4), (7, 3), (8, 2)]) == [
        (0, *here, 2), (0, *there, 1), (1, *here, 3), (2, *here, 5), (2, *there, 2)]


def test_ad_stat_of_a_slice_without_clicks(spark, tmp_path):
    here = ("2024-01-01", "4", "2", 5)
    assert replayed(spark, tmp_path, [(0, 1), (7, 2), (8, 4)]) == [(0, *here, 1), (2, *here, 3)]


def test_ad_stat_changes_end_in_the_table(spark, done):
    """The newest total of every key is the table's; a batch of ``totals`` over two of ``filter`` has one total a key."""
    changes = [tuple(r) for r in done.ad_stat_changes(spark).collect()]
    assert sorted({r[1:5]: r[1:] for r in sorted(changes)}.values()) == sorted(tuple(r) for r in done.ad_stat(spark).collect())
    assert sorted(changes) == [(0, "2024-01-01", "1", "2", 5, 3), (0, "2024-01-01", "1", "2", 6, 1), (1, "2024-01-01", "1", "2", 5, 4),
                               (1, "2024-01-01", "1", "2", 7, 1), (1, "2024-01-01", "3", "4", 8, 1), (2, "2024-01-01", "1", "2", 6, 2),
                               (2, "2024-01-01", "3", "4", 8, 2)]
    stream = opened(spark)
    for i, lines in enumerate(SLICES):
        put(stream.base, i, lines)
        stream.start_filter(st.ad_log_stream(spark, f"{stream.base}/source"), NOW).awaitTermination()
        if i != 1:
            stream.start_totals(spark, NOW).awaitTermination()
    assert sorted(map(tuple, stream.ad_stat_changes(spark).collect())) == [
        (0, "2024-01-01", "1", "2", 5, 3), (0, "2024-01-01", "1", "2", 6, 1), (1, "2024-01-01", "1", "2", 5, 4),
        (1, "2024-01-01", "1", "2", 7, 1), (2, "2024-01-01", "1", "2", 6, 2), (2, "2024-01-01", "3", "4", 8, 2)]


def test_days_not_touched_are_not_rewritten(spark):
    stream = run(spark, [[line(0, 1, 5)], [line(86_400_000, 2, 5)]])
    first = f"{stream.base}/ad_stat/date=2024-01-01"
    files = {f: os.stat(f"{first}/{f}").st_mtime_ns for f in os.listdir(first)}
    put(stream.base, 2, [line(86_400_000 + MIN, 3, 6)] * 3)
    advance(spark, stream)
    assert {f: os.stat(f"{first}/{f}").st_mtime_ns for f in os.listdir(first)} == files
    assert sorted(r.click_count for r in stream.ad_stat(spark).collect()) == [1, 1, 3]
    assert not [d for d in os.listdir(f"{stream.base}/ad_stat_next") if d not in ("batch_id=2",)]


def test_listed_users_leave_no_counts_and_ids_stay_exact(spark):
    lines = [line(0, BIG, BIG + 2)] * 3 + ["bad", "", "1 2"] + [line(0, BIG + 1, 1)]
    stream = run(spark, [lines, [line(MIN, BIG, 4)] * 2], threshold=3, seeds=())
    assert stream.blacklist(spark).collect() == [(BIG,)]
    assert sorted(map(tuple, stream.user_click_counts(spark).collect())) == [
        ("2024-01-01", BIG, BIG + 2, 3), ("2024-01-01", BIG + 1, 1, 1)]
    assert sorted(map(tuple, stream.batches(spark).collect())) == [(0, 7, 3, 4, 4), (1, 2, 0, 2, 0)]


def test_users_share_the_state_of_a_part(spark, done, monkeypatch):
    """Two parts hold all users' states; the results are those of a part for each user."""
    monkeypatch.setattr(st, "PARTS", 2)
    stream = opened(spark)
    for i, lines in enumerate(SLICES):
        put(stream.base, i, lines)
        query = stream.start_filter(st.ad_log_stream(spark, f"{stream.base}/source"), NOW)
        query.awaitTermination()
        rows = [p.stateOperators[0].numRowsTotal for p in query.recentProgress if p.stateOperators]
        assert rows and max(rows) <= 2
        stream.start_totals(spark, NOW).awaitTermination()
        stream.start_trend(spark, NOW).awaitTermination()
    assert tables(stream, spark) == tables(done, spark)
    told = lambda s: sorted(map(str, s.clicks(spark, "kept", "dropped", "listed", "malformed").collect()))
    assert told(stream) == told(done)


def joins_of(df):
    """Join operators of a batch plan as it ran."""
    df.collect()
    p = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    return [k for k in ("SortMergeJoin", "BroadcastHashJoin") if k in p]


def test_batch_merges_broadcast_nothing(spark):
    old = spark.createDataFrame([("2024-01-01", "1", 5, 2), ("2024-01-01", "2", 5, 1), (None, "3", 6, 1)], schemas.AD_PROVINCE_TOP3)
    new = spark.createDataFrame([("2024-01-01", "1", 5, 3), ("2024-01-01", "1", 6, 1)], schemas.AD_PROVINCE_TOP3)
    merged = st.merge_overwrite(old, new, [*ads.PROVINCE_KEYS, "ad_id"])
    assert joins_of(merged) == ["SortMergeJoin"] and merged.count() == 4
    for df in (st.top_after(old, new), st.replace_groups(old, new, ads.PROVINCE_KEYS)):
        assert joins_of(df) == ["SortMergeJoin"]


def test_users_are_not_broadcast_to_the_clicks(spark, tmp_path):
    for name, rows, types in (
            ("events", [(1, "click", 7, "2024-01-01 00:00:01", '{"k": 25}'), (2, "click", None, "2024-01-01 00:00:02", '{"k": 3}'),
                        (3, "view", 7, "2024-01-01 00:00:03", '{"k": 1}')],
             "event_id long, event_type string, user_id long, ts string, props string"),
            ("customer", [(7, 2)], "c_custkey long, c_nationkey int"), ("nation", [(2, 4)], "n_nationkey int, n_regionkey int")):
        df = spark.createDataFrame(rows, types)
        if name == "events":
            df = df.withColumn("ts", F.col("ts").cast("timestamp_ntz"))
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    lines = src.ad_log_lines(spark, str(tmp_path))
    assert "SortMergeJoin" in joins_of(lines)
    assert sorted(map(tuple, lines.collect())) == [(1, "1704067201000 4 2 7 5"), (2, "1704067202000 3")]


def test_settled_windows_do_not_change(spark):
    """Late clicks of a window still open count; those of one behind the watermark do not."""
    stream = opened(spark, threshold=100, seeds=(), delay="5 minutes")
    for i, lines in enumerate([[line(0, 1, 5), line(10 * MIN, 1, 5)], [line(0, 2, 5), line(7 * MIN, 2, 5)],
                               [line(7 * MIN, 3, 5), line(30 * MIN, 3, 5)], [line(10 * MIN, 4, 5), line(29 * MIN, 4, 5)]]):
        put(stream.base, i, lines)
        advance(spark, stream)
    got = {(r.hour, r.minute): r.click_count for r in stream.click_trend(spark).collect()}
    assert got == {("00", "00"): 1, ("00", "07"): 2, ("00", "10"): 1, ("00", "29"): 1, ("00", "30"): 1}
    assert sum(r.click_count for r in stream.ad_stat(spark).collect()) == 8      # the other tables have them all


def test_top_after_needs_only_the_rows_kept(spark):
    """Growing totals, batch by batch: the top 3 from three kept rows equals the top 3 of all totals."""
    import random
    rng = random.Random(4)
    full, kept = {}, spark.createDataFrame([], schemas.AD_PROVINCE_TOP3)
    for _ in range(4):
        new = {}
        for _ in range(25):
            k = ("2024-01-01", str(rng.randint(0, 2)), rng.randint(0, 12))
            full[k] = full.get(k, 0) + rng.randint(1, 3)
            new[k] = full[k]
        totals = spark.createDataFrame([(*k, n) for k, n in new.items()], schemas.AD_PROVINCE_TOP3)
        top = st.top_after(kept, totals)
        rows = st.replace_groups(kept, top, ads.PROVINCE_KEYS).collect()
        want = [(*k, n) for p in "012" for k, n in sorted(((k, n) for k, n in full.items() if k[1] == p), key=lambda x: (-x[1], x[0][2]))[:3]]
        assert sorted(map(tuple, rows)) == sorted(want)
        kept = spark.createDataFrame([tuple(r) for r in rows], schemas.AD_PROVINCE_TOP3)


def test_readers_before_the_first_batch(spark):
    stream = opened(spark)
    assert stream.ad_stat(spark).count() == 0 and stream.province_top3(spark).schema == schemas.AD_PROVINCE_TOP3


def test_trigger_that_keeps_up(spark):
    """Files come faster than a batch takes them: none is lost, and the listener sees the batches."""
    stream, backlog = opened(spark, threshold=10**6, seeds=()), st.Backlog()
    spark.streams.addListener(backlog)
    try:
        put(stream.base, 0, [line(0, 1, 5)])
        source = st.ad_log_stream(spark, f"{stream.base}/source", maxFilesPerTrigger=2)
        query = stream.start_filter(source, {"processingTime": "1 second"})
        for i in range(1, 9):
            put(stream.base, i, [line(i * MIN, i, 5)] * i)
        deadline = time.time() + 90
        while time.time() < deadline and sum(b[2] for b in backlog.batches) < 37:
            time.sleep(0.5)
        query.stop()
    finally:
        spark.streams.removeListener(backlog)
    assert sum(b[2] for b in backlog.batches) == 37 and len(backlog.batches) >= 4
    assert sum(r.n for r in stream.clicks(spark, "kept").collect()) == 37
    assert backlog.late(0) == backlog.batches and not backlog.late(10**6)


def test_default_trigger_is_the_batch_interval(spark):
    stream = opened(spark, seeds=())
    put(stream.base, 0, SLICES[0])
    query = stream.start_filter(st.ad_log_stream(spark, f"{stream.base}/source"))
    deadline = time.time() + 60
    while time.time() < deadline and not any(p.numInputRows for p in query.recentProgress):
        time.sleep(0.5)
    put(stream.base, 1, SLICES[1])
    while time.time() < deadline and sum(bool(p.numInputRows) for p in query.recentProgress) < 2:
        time.sleep(0.5)
    starts = [p.timestamp for p in query.recentProgress if p.numInputRows]
    query.stop()
    assert len(starts) == 2
    assert int(starts[1][17:19]) % 5 == 0                       # batches begin on the interval's marks


def test_parse_keeps_text_places_and_rejects_bad_times(spark):
    lines = ["1704067200000 Hubei Wuhan 7 3", "1704067200000 1 2 7 3 more", "9223372036854775807 1 2 3 4",
             "999999999999999 1 2 3 4", "1704067200000 1 2 x 4", "1704067200000 1 2 3", "", None]
    parsed = ads.parse_ad_log(spark.createDataFrame([(x,) for x in lines], "value string"))
    assert [r["is_valid"] for r in parsed.collect()] == [True, True, False, False, False, False, False, False]
    assert [(r["province"], r["city"], r["date"]) for r in ads.ad_events(parsed).collect()] == [
        ("Hubei", "Wuhan", "2024-01-01"), ("1", "2", "2024-01-01")]
