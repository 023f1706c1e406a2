"""The jobs as streams: golden results, restarts, parity with batch, quarantine."""

import json
import os
import random
import time

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from golden import FILES, MESSAGE, TOTALS, WINDOWS, at, message, write_files
from salesflow.operators.decode import decode_sales, good_sales
from salesflow.operators.lateness import mark_late
from salesflow.operators.running import dedupe_running_total
from salesflow.operators.windows import closed_totals, tumbling_totals
from salesflow.plans import jobs
from salesflow.plans.tables import as_messages, events_as_sales, orders_as_sales, table
from salesflow.schema import QUARANTINE, RUNNING_TOTAL, SALE, WINDOW_TOTAL, totals_table
from salesflow.sources.replay import recorded, replay
from salesflow.streaming.progress import input_rows, late_rows_dropped, wait_for_timers
from salesflow.streaming import running, sinks
from salesflow.streaming.arrival import stream_arrival_totals
from salesflow.streaming.running import read_state, stream_running_totals
from salesflow.streaming.sinks import Target, append_batch, append_stream, print_sales, read_table


def target(tmp_path, name="out", **options):
    return Target(
        str(tmp_path / name), str(tmp_path / f"{name}-checkpoint"), available_now=True, **options
    )


def messages(spark, folder):
    return replay(spark, str(folder), MESSAGE, format="json", files_per_batch=1)


def totals(spark, to):
    rows = read_table(spark, to.path, RUNNING_TOTAL).collect()
    return sorted((r.SalesId, r.ProductName, r.TotalSalesAmount) for r in rows)


def windows(df):
    start = F.unix_seconds("WindowStartTime") - F.lit(int(at(0).timestamp()))
    return sorted(tuple(r) for r in df.select("ProductName", start, "SalesAmount").collect())


def test_land(spark, tmp_path):
    write_files(tmp_path / "in", FILES)
    to = target(tmp_path)
    jobs.land_sales(messages(spark, tmp_path / "in"), to).await_termination()
    landed = read_table(spark, to.path, SALE, view="golden_sales")
    assert landed.schema.simpleString() == SALE.simpleString()
    expected = sorted((r[0], r[1], r[3]) for f in FILES for r in f)
    found = landed.select("SalesId", "ProductName", "SalesAmount").collect()
    assert sorted(map(tuple, found)) == expected
    assert spark.sql("SELECT sum(SalesAmount) FROM golden_sales").first()[0] == 8192


def test_running_totals(spark, tmp_path):
    write_files(tmp_path / "in", FILES)
    to = target(tmp_path)
    job = jobs.running_totals(messages(spark, tmp_path / "in"), to, arrival="arrival")
    job.await_termination()
    assert totals(spark, to) == TOTALS
    found = {r.ProductName: (r.last_time.timestamp(), r.total) for r in read_state(spark, to).collect()}
    assert found == {"A": (at(200).timestamp(), 428), "B": (at(5).timestamp(), 4)}


@pytest.mark.parametrize("rows_per_range", [None, 1, 2])
def test_running_totals_in_stretches(spark, tmp_path, rows_per_range):
    write_files(tmp_path / "in", FILES)
    to = target(tmp_path)
    jobs.running_totals(messages(spark, tmp_path / "in"), to, arrival="arrival", rows_per_range=rows_per_range).await_termination()
    assert totals(spark, to) == TOTALS


def test_running_totals_repeated_batch(spark, tmp_path):
    """A batch whose commit was lost runs again: same rows, same state."""
    write_files(tmp_path / "in", FILES)
    to = target(tmp_path)
    for _ in range(2):
        running_by_arrival(messages(spark, tmp_path / "in"), to).await_termination()
        assert totals(spark, to) == TOTALS
        for commit in (tmp_path / "out-checkpoint" / "commits").iterdir():
            if commit.name.strip(".").split(".")[0] == "7":
                commit.unlink()


@pytest.mark.parametrize("when", ["written", "committed"])
def test_running_totals_lost_within_a_batch(spark, tmp_path, monkeypatch, when):
    """A batch that was lost after its rows were written, or its record too, leaves nothing twice."""
    write_files(tmp_path / "in", FILES)
    to = target(tmp_path)
    commit = sinks._commit

    def fail_once(session, path, writer, batch_id, attempt):
        if batch_id == 4:
            monkeypatch.setattr(sinks, "_commit", commit)
            if when == "committed":
                commit(session, path, writer, batch_id, attempt)
            raise RuntimeError("lost")
        commit(session, path, writer, batch_id, attempt)

    monkeypatch.setattr(sinks, "_commit", fail_once)
    with pytest.raises(StreamingQueryException, match="lost"):
        running_by_arrival(messages(spark, tmp_path / "in"), to).await_termination()
    seen = totals(spark, to)
    assert seen == [t for t in TOTALS if t[0] in ("abcdfh" if when == "committed" else "abcdf")]
    running_by_arrival(messages(spark, tmp_path / "in"), to).await_termination()
    assert totals(spark, to) == TOTALS
    assert len(list((tmp_path / "out").glob("writer=*/batch_id=4/attempt=*"))) == 1


def test_readers_see_whole_batches_only(spark, tmp_path, monkeypatch):
    """What a reader finds while a batch is half written, before its record, and while it is repeated."""
    write_files(tmp_path / "in", FILES[:2])
    to = target(tmp_path)
    jobs.land_sales(messages(spark, tmp_path / "in"), to).await_termination()
    before = {"a", "b", "c", "d"}
    ids = lambda: {r.SalesId for r in read_table(spark, to.path, SALE).collect()}
    assert ids() == before
    more = read_table(spark, to.path, SALE).withColumn("SalesId", F.concat("SalesId", F.lit("2")))
    writer = next((tmp_path / "out").glob("writer=*"))
    half = writer / "batch_id=2" / "attempt=dead"
    more.limit(2).write.parquet(str(half))  # an attempt that lost its driver halfway
    assert ids() == before
    commit, seen = sinks._commit, []

    def look(*args):
        seen.append(ids())
        commit(*args)
        seen.append(ids())

    monkeypatch.setattr(sinks, "_commit", look)
    append_batch(more, 2, to)
    assert seen == [before, before | {"a2", "b2", "c2", "d2"}] and not half.exists()
    written = sorted(str(f) for f in writer.rglob("*.parquet"))
    append_batch(more, 2, to)  # repeated: not written again, nothing vanishes in between
    assert len(seen) == 2 and sorted(str(f) for f in writer.rglob("*.parquet")) == written
    assert ids() == before | {"a2", "b2", "c2", "d2"}


def test_read_of_a_table_without_committed_batches(spark, tmp_path):
    (tmp_path / "out" / sinks.COMMITS).mkdir(parents=True)
    assert read_table(spark, str(tmp_path / "out"), SALE).collect() == []


def _sales(spark, folder, number, rows):
    folder.mkdir(exist_ok=True)
    lines = [json.dumps({"SalesId": str(i), "ProductName": p, "SalesAmount": a, "seconds": t, "arrival": i}) for i, p, t, a in rows]
    (folder / f"{number}.json").write_text("\n".join(lines))
    stream = spark.readStream.schema("SalesId string, ProductName string, SalesAmount int, seconds bigint, arrival bigint").json(str(folder))
    time = F.timestamp_seconds("seconds")
    return stream.select("SalesId", "ProductName", time.alias("SalesDateTime"), "SalesAmount", time.alias("EventProcessingTime"), "arrival")


def test_an_expired_product_starts_anew(spark, tmp_path):
    for name, options, wanted in [("kept", {}, 3), ("expired", {"expire_after": "1 second"}, 2)]:
        to = Target(str(tmp_path / name), str(tmp_path / f"{name}-checkpoint"), every="200 milliseconds")
        found = lambda: {r.SalesId: r.TotalSalesAmount for r in read_table(spark, to.path, RUNNING_TOTAL).collect()}  # noqa: B023, E731
        query = stream_running_totals(_sales(spark, tmp_path / f"in-{name}", 0, [(0, "p", 100, 1)]), to, "arrival", **options)
        try:
            for number, count in [(None, 1), (1, 2)]:
                if number:
                    time.sleep(2.5)
                    _sales(spark, tmp_path / f"in-{name}", number, [(1, "p", 101, 2)])
                limit = time.monotonic() + 40
                while time.monotonic() < limit and (not (tmp_path / name).exists() or len(found()) < count):
                    time.sleep(0.2)
        finally:
            query.stop()
        assert found() == {"0": 1, "1": wanted}


def test_state_is_asked_per_page(spark, tmp_path, monkeypatch):
    """Products share entries of the state store, across micro-batches and with new products in old pages."""
    monkeypatch.setattr(running, "BUCKETS", 2)
    monkeypatch.setattr(running, "PAGES", 3)
    to, wanted = target(tmp_path), {}
    for number in range(3):
        rows = [(100 * number + i, f"p{i % (20 + 20 * number)}", 10 * number + i // 60, i) for i in range(90)]
        for _, product, seconds, amount in rows:
            last, total = wanted.get(product, (-1, 0))
            if seconds > last:
                wanted[product] = (seconds, total + amount)
        query = stream_running_totals(_sales(spark, tmp_path / "in", number, rows), to, "arrival")
        query.awaitTermination()
        assert query.lastProgress.stateOperators[0].numRowsTotal <= 6
    found = {r.ProductName: (int(r.last_time.timestamp()), r.total) for r in read_state(spark, to).collect()}
    assert found == wanted and len(found) == 60


def test_running_totals_decode_a_batch_once(spark, tmp_path, capsys):
    """State and records come from one shuffle, also for columns that the source has as they are."""
    stream = _sales(spark, tmp_path / "in", 0, [(0, "p", 100, 1), (1, "q", 101, 2), (2, "p", 99, 4)])
    query = stream_running_totals(stream, target(tmp_path), "arrival")
    query.awaitTermination()
    query.explain()
    plan = capsys.readouterr().out
    assert plan.count("ReusedExchange") == 1 and plan.count("FileScan json") == 1


def test_expiry_has_no_end(spark, tmp_path):
    with pytest.raises(ValueError, match="by the clock"):
        stream_running_totals(_sales(spark, tmp_path / "in", 0, [(0, "p", 100, 1)]), target(tmp_path), "arrival", expire_after="1 day")


@pytest.mark.parametrize("overflow, wanted", [("wrap", [2**31 - 1, -(2**31)]), ("bigint", [2**31 - 1, 2**31])])
def test_streamed_totals_overflow(spark, tmp_path, overflow, wanted):
    to = target(tmp_path)
    stream = _sales(spark, tmp_path / "in", 0, [(0, "p", 100, 2**31 - 1), (1, "p", 101, 1)])
    stream_running_totals(stream, to, "arrival", overflow=overflow, rows_per_range=1).awaitTermination()
    rows = read_table(spark, to.path, totals_table(RUNNING_TOTAL, overflow)).collect()
    assert sorted((r.SalesId, r.TotalSalesAmount) for r in rows) == [("0", wanted[0]), ("1", wanted[1])]


@pytest.mark.parametrize("seed, drift", [(1, 0), (2, 3)])
def test_staircases_of_many_batches(seed, drift):
    """Steps of each unit, whatever batches its rows come in, however often held rows are thinned."""
    import pyarrow as pa

    rng = random.Random(seed)
    rows = [(rng.choice("ab"), i // 40, i, i % 3, i * drift + rng.randrange(50), rng.randrange(-9, 9)) for i in range(400)]
    wanted = {}
    for key, unit, _, _, seconds, amount in sorted(rows, key=lambda r: r[2:4]):
        steps = wanted.setdefault((key, unit), [])
        if not steps or seconds > steps[-1][0]:
            steps.append((seconds, amount))
    rng.shuffle(rows)
    names = ["ProductName", running._RANGE, "offset", "partition", "time", "amount"]
    batches = [pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows[a : a + 30], strict=True)], names=names) for a in range(0, 400, 30)]
    held, running._HELD_ROWS = running._HELD_ROWS, 50
    try:
        out = [r for b in running._staircases("ProductName", ["offset", "partition"])(iter(batches)) for r in b.to_pylist()]
    finally:
        running._HELD_ROWS = held
    assert {(r["ProductName"], r[running._RANGE]): list(zip(r["times"], r["amounts"], strict=True)) for r in out} == wanted
    assert len(out) == len(wanted)


def test_files_per_commit(spark, tmp_path):
    write_files(tmp_path / "in", FILES)
    to = target(tmp_path, files=1)
    jobs.event_time_totals(messages(spark, tmp_path / "in"), to).await_termination()
    assert windows(read_table(spark, to.path, WINDOW_TOTAL)) == WINDOWS
    commits = len(list((tmp_path / "out-checkpoint" / "commits").glob("[0-9]*")))
    assert len(list((tmp_path / "out").glob("*.parquet"))) <= commits


def test_event_time_totals(spark, tmp_path):
    write_files(tmp_path / "in", FILES)
    to = target(tmp_path)
    job = jobs.event_time_totals(messages(spark, tmp_path / "in"), to)
    job.await_termination()
    rows = read_table(spark, to.path, WINDOW_TOTAL)
    assert windows(rows) == WINDOWS
    assert rows.select("SalesId").distinct().count() == len(WINDOWS)
    assert late_rows_dropped(job.main) == 2
    assert input_rows(job.main) == 14


def test_allowed_lateness_keeps_windows_open(spark, tmp_path):
    write_files(tmp_path / "in", FILES)
    to = target(tmp_path)
    jobs.event_time_totals(
        messages(spark, tmp_path / "in"), to, lateness="20 seconds"
    ).await_termination()
    found = windows(read_table(spark, to.path, WINDOW_TOTAL))
    # k is now on time: when it is read, the window 0-30 is open. m comes after it has closed.
    assert found == [("A", 0, 83 + 1024), *WINDOWS[1:]]


def test_refires_and_late_records(spark, tmp_path):
    """Windows fire at their end and again for late records; what comes after 20 more seconds is kept apart."""
    write_files(tmp_path / "in", FILES)
    to = target(tmp_path, late=str(tmp_path / "late"))
    job = jobs.event_time_totals(messages(spark, tmp_path / "in"), to, lateness="20 seconds", refires=True, id="deterministic")
    job.await_termination()
    rows = read_table(spark, to.path, WINDOW_TOTAL)
    # The window 0-30 of A fires with a, b and e, and again for g. k and m come after its lateness.
    assert windows(rows) == [("A", 0, 19), ("A", 0, 83), *WINDOWS[1:]]
    assert rows.select("SalesId").distinct().count() == len(WINDOWS)
    assert sorted(r.SalesId for r in read_table(spark, to.late, SALE).collect()) == ["k", "m"]
    assert late_rows_dropped(job.main) == 2


@pytest.mark.parametrize("late", [True, False])
def test_late_records_are_counted_one_by_one(spark, tmp_path, late):
    """Three late records of one key, window and task are three."""
    files = [[("a", "A", 1.0, 1)], [("b", "A", 100.0, 2)], [("c", "A", 2.0, 4), ("d", "A", 3.0, 8), ("e", "A", 4.0, 16), ("f", "A", 95.0, 32)], [("g", "A", 300.0, 1)]]
    write_files(tmp_path / "in", files)
    to = target(tmp_path, late=str(tmp_path / "late") if late else None)
    job = jobs.event_time_totals(messages(spark, tmp_path / "in"), to, refires=True)
    job.await_termination()
    assert late_rows_dropped(job.main) == 3
    assert windows(read_table(spark, to.path, WINDOW_TOTAL)) == [("A", 0, 1), ("A", 90, 34)]
    if late:
        assert sorted(r.SalesId for r in read_table(spark, to.late, SALE).collect()) == ["c", "d", "e"]


def test_late_and_counted_records_add_up(spark, tmp_path, testdata):
    """The replayed stream splits its input as the batch operator does, micro-batches being arrival batches."""
    sales = events_as_sales(table(spark, str(testdata / "sf0.001"), "events"))
    order = F.expr("EventProcessingTime + make_interval(0, 0, 0, 0, 0, 0, arrival * 7919 % 200000)")
    cuts = sales.select(F.percentile_approx(F.unix_seconds(order), [0.25, 0.5, 0.75])).first()[0]
    batch = sum((F.unix_seconds(order) > c).cast("int") for c in cuts)
    folder = tmp_path / "in"
    for number in range(4):
        part = as_messages(sales.where(batch == number)).coalesce(1)
        part.write.parquet(str(folder / f"part{number}"))
        for file in (folder / f"part{number}").glob("*.parquet"):
            os.utime(file, (1_700_000_000 + number, 1_700_000_000 + number))
    to = target(tmp_path, late=str(tmp_path / "late"))
    source = replay(spark, str(folder / "*"), MESSAGE, files_per_batch=1)
    job = jobs.event_time_totals(source, to, overflow="wrap")
    job.await_termination()
    marked = mark_late(sales.withColumn("batch", batch), "batch")
    late = {r.SalesId for r in read_table(spark, to.late, SALE).collect()}
    assert late == {r.SalesId for r in marked.where("late").collect()} and len(late) > 50
    assert late_rows_dropped(job.main) == len(late)
    clock = sales.agg(F.max("EventProcessingTime") - F.expr("interval 10 seconds")).first()[0]
    counted = tumbling_totals(marked.where("NOT late"), overflow="wrap").where(F.col("WindowEndTime") <= F.lit(clock))
    assert windows(read_table(spark, to.path, WINDOW_TOTAL)) == windows(counted)


def test_one_decoding_for_totals_and_quarantine(spark, tmp_path):
    """J4's totals and its quarantine come from one decoded table, also after a restart."""
    to = target(tmp_path, quarantine=str(tmp_path / "bad"))
    (tmp_path / "in").mkdir()
    for number, lines in enumerate([[FILES[0][0], "not json"], [FILES[7][1], "also bad"]]):
        values = [v if isinstance(v, str) else message(*v) for v in lines]
        (tmp_path / "in" / f"{number}.json").write_text("\n".join(json.dumps({"value": v, "arrival": number}) for v in values))
        job = jobs.event_time_totals(messages(spark, tmp_path / "in"), to)
        job.await_termination()
        assert input_rows(job.decoder) == 2 and input_rows(job.main) == input_rows(job.quarantine) == 2
    assert windows(read_table(spark, to.path, WINDOW_TOTAL)) == [("A", 0, 1)]
    assert sorted(r.value for r in read_table(spark, to.quarantine, QUARANTINE).collect()) == ["also bad", "not json"]
    assert spark.read.parquet(to.for_decoded().path).count() == 4


@pytest.mark.parametrize("name", ["land", "running", "windows"])
def test_restart_equals_one_run(spark, tmp_path, name):
    start, table_schema = {
        "land": (jobs.land_sales, SALE),
        "running": (lambda m, t: jobs.running_totals(m, t, arrival="arrival"), RUNNING_TOTAL),
        "windows": (lambda m, t: jobs.event_time_totals(m, t, id="deterministic"), WINDOW_TOTAL),
    }[name]
    whole, parts = target(tmp_path, "whole"), target(tmp_path, "parts")
    write_files(tmp_path / "all", FILES)
    start(messages(spark, tmp_path / "all"), whole).await_termination()

    # Stopping ends with a batch without data. Cut where that closes no window: it would put the
    # late filter of the next data batch one step ahead of an uninterrupted run.
    write_files(tmp_path / "some", FILES[:3])
    start(messages(spark, tmp_path / "some"), parts).await_termination()
    write_files(tmp_path / "some", FILES[3:], first=3)
    start(messages(spark, tmp_path / "some"), parts).await_termination()
    start(messages(spark, tmp_path / "some"), parts).await_termination()  # nothing new

    def rows(to):
        return sorted(map(repr, read_table(spark, to.path, table_schema).collect()))

    assert rows(parts) == rows(whole)


def split_files(df, folder, parts):
    """``df`` as files by arrival, one micro-batch each."""
    import os

    bounds = df.approxQuantile("arrival", [i / parts for i in range(1, parts)], 0)
    limits = [float("-inf"), *bounds, float("inf")]
    for number in range(parts):
        low, high = limits[number], limits[number + 1]
        part = df.where((F.col("arrival") > low) & (F.col("arrival") <= high))
        part.coalesce(1).write.parquet(str(folder / f"part{number}"))
        for file in (folder / f"part{number}").glob("*.parquet"):
            os.utime(file, (1_700_000_000 + number, 1_700_000_000 + number))


@pytest.mark.parametrize("key,rows_per_range", [("o_custkey", None), ("o_orderpriority", 200)])
def test_streamed_running_total_equals_batch(spark, tmp_path, testdata, key, rows_per_range):
    sales = orders_as_sales(table(spark, str(testdata / "sf0.01"), "orders"), key=key)
    split_files(as_messages(sales), tmp_path / "in", 4)
    to = target(tmp_path)
    source = replay(spark, str(tmp_path / "in" / "*"), MESSAGE, files_per_batch=1)
    jobs.running_totals(
        source, to, arrival="arrival", rows_per_range=rows_per_range
    ).await_termination()
    batch = dedupe_running_total(sales, rows_per_range=None).select(*RUNNING_TOTAL.fieldNames())
    streamed = read_table(spark, to.path, RUNNING_TOTAL)
    assert streamed.count() == batch.count() > 40
    assert streamed.exceptAll(batch).isEmpty()


def test_streamed_windows_equal_closed_batch_windows(spark, tmp_path, testdata):
    sales = events_as_sales(table(spark, str(testdata / "sf0.001"), "events"))
    split_files(as_messages(sales), tmp_path / "in", 5)
    to = target(tmp_path)
    source = replay(spark, str(tmp_path / "in" / "*"), MESSAGE, files_per_batch=1)
    jobs.event_time_totals(source, to, id="deterministic").await_termination()
    streamed = read_table(spark, to.path, WINDOW_TOTAL)
    assert tumbling_totals(sales).count() == 1000
    closed = closed_totals(sales, id="deterministic")
    assert streamed.count() == closed.count() == 999
    assert streamed.exceptAll(closed).isEmpty()


def bad_lines(folder):
    folder.mkdir()
    with open(folder / "0.json", "w") as out:
        good = '{"SalesId":"a","ProductName":"A","SalesDateTime":0,"EventProcessingTime":0}'
        for arrival, value in enumerate([good, "not json", "", "null"]):
            out.write(json.dumps({"value": value, "arrival": arrival}) + "\n")


def running_by_arrival(source, to):
    return jobs.running_totals(source, to, arrival="arrival")


JOBS = [jobs.land_sales, running_by_arrival, jobs.event_time_totals]


@pytest.mark.parametrize("start", JOBS)
def test_first_bad_message_fails_without_quarantine(spark, tmp_path, start):
    bad_lines(tmp_path / "in")
    with pytest.raises(StreamingQueryException, match="malformed sales message"):
        start(messages(spark, tmp_path / "in"), target(tmp_path)).await_termination()


@pytest.mark.parametrize("start", JOBS)
def test_quarantine(spark, tmp_path, start):
    bad_lines(tmp_path / "in")
    to = target(tmp_path, quarantine=str(tmp_path / "bad"))
    for _ in range(2):  # the second run finds nothing new
        start(messages(spark, tmp_path / "in"), to).await_termination()
        refused = read_table(spark, to.quarantine, QUARANTINE).collect()
        assert sorted((r.value, r.reason) for r in refused) == [
            ("", "empty"), ("not json", "corrupt")
        ]
    if start is not jobs.event_time_totals:  # its window is still open
        schema = SALE if start is jobs.land_sales else RUNNING_TOTAL
        assert [r.SalesId for r in read_table(spark, to.path, schema).collect()] == ["a"]


def test_arrival_totals_beside_quarantine(spark, tmp_path):
    bad_lines(tmp_path / "in")
    to = Target(
        str(tmp_path / "out"), str(tmp_path / "checkpoint"), every="500 milliseconds",
        quarantine=str(tmp_path / "bad"),
    )
    job = jobs.processing_time_totals(messages(spark, tmp_path / "in"), to, size_millis=1000)
    try:
        wait_for_timers(job.main, 60)
        job.quarantine.processAllAvailable()
    finally:
        job.stop()
    assert read_table(spark, to.quarantine, QUARANTINE).count() == 2
    rows = read_table(spark, to.path, WINDOW_TOTAL).collect()
    assert [(r.ProductName, r.SalesAmount) for r in rows] == [("A", 0)]


def test_arrival_totals_have_no_end(spark, tmp_path):
    write_files(tmp_path / "in", FILES)
    with pytest.raises(ValueError, match="close by the clock"):
        jobs.processing_time_totals(messages(spark, tmp_path / "in"), target(tmp_path))


def test_running_totals_beside_quarantine(spark, tmp_path):
    write_files(tmp_path / "in", FILES)
    to = target(tmp_path, quarantine=str(tmp_path / "bad"))
    running_by_arrival(messages(spark, tmp_path / "in"), to).await_termination()
    assert totals(spark, to) == TOTALS
    assert read_table(spark, to.quarantine, QUARANTINE).isEmpty()


def test_a_failing_quarantine_stops_the_job(spark, tmp_path):
    write_files(tmp_path / "in", FILES)
    (tmp_path / "bad").write_text("a file where the table should be")
    to = Target(
        str(tmp_path / "out"), str(tmp_path / "checkpoint"), every="1 second",
        quarantine=str(tmp_path / "bad"),
    )
    with pytest.raises(Exception):
        jobs.event_time_totals(messages(spark, tmp_path / "in"), to).await_termination()
    assert not spark.streams.active


def test_sink_refuses_other_columns(spark, tmp_path):
    write_files(tmp_path / "in", FILES[:1])
    with pytest.raises(ValueError, match="differ from the declared table"):
        append_stream(messages(spark, tmp_path / "in"), target(tmp_path), SALE)


def test_batch_operators_name_their_streaming_form(spark, tmp_path):
    write_files(tmp_path / "in", FILES[:1])
    sales = good_sales(decode_sales(messages(spark, tmp_path / "in")))
    with pytest.raises(ValueError, match="stream_running_totals"):
        dedupe_running_total(sales)
    with pytest.raises(ValueError, match="tumbling_totals"):
        closed_totals(sales)
    with pytest.raises(ValueError, match="late_rows_dropped"):
        mark_late(sales, "arrival")


def test_console(spark, tmp_path):
    write_files(tmp_path / "in", FILES[:1])
    sales = good_sales(decode_sales(messages(spark, tmp_path / "in")))
    query = print_sales(sales, str(tmp_path / "checkpoint"), every="1 second")
    query.processAllAvailable()
    query.stop()
    assert input_rows(query) == 3


def test_recorded_reads_the_same_files(spark, tmp_path):
    write_files(tmp_path / "in", FILES)
    batch = recorded(spark, str(tmp_path / "in"), MESSAGE, format="json")
    sales = good_sales(decode_sales(batch))
    found = windows(tumbling_totals(sales))
    assert found == [
        ("A", 0, 5203), ("A", 30, 680), ("A", 60, 2304), ("A", 180, 1), ("B", 0, 4)
    ]
    rows = dedupe_running_total(sales).select("SalesId", "ProductName", "TotalSalesAmount")
    assert sorted(map(tuple, rows.collect())) == TOTALS


def _land(spark, folder, rows, quarantine, checkpoint):
    (folder / "in").mkdir(exist_ok=True)
    (folder / "in" / f"{rows[0]}.json").write_text("\n".join(
        f'{{"SalesId":"{i}","ProductName":"p","SalesDateTime":1000,"SalesAmount":1,"EventProcessingTime":1000}}' for i in rows
    ))
    stream = spark.readStream.schema("value string").text(str(folder / "in"))
    refused = str(folder / "refused") if quarantine else None
    to = Target(str(folder / "table"), str(folder / checkpoint), available_now=True, quarantine=refused)
    jobs.land_sales(stream, to).await_termination()
    return sorted(int(r.SalesId) for r in read_table(spark, to.path, SALE).collect())


@pytest.mark.parametrize("order", [(False, True), (True, False)])
def test_quarantine_comes_and_goes(spark, tmp_path, order):
    assert _land(spark, tmp_path, [1, 2, 3], order[0], "c") == [1, 2, 3]
    assert _land(spark, tmp_path, [4, 5, 6], order[1], "c") == [1, 2, 3, 4, 5, 6]


def test_new_checkpoint_appends(spark, tmp_path):
    assert _land(spark, tmp_path, [1, 2], False, "c1") == [1, 2]
    assert _land(spark, tmp_path, [3], False, "c2") == [1, 1, 2, 2, 3]  # it begins from the start


def test_other_layout_is_refused(spark, tmp_path):
    spark.createDataFrame([("x",)], "value string").write.parquet(str(tmp_path / "table" / "batch_id=0"))
    with pytest.raises(ValueError, match="another layout"):
        _land(spark, tmp_path, [1], False, "c")


def test_null_keys_fail_in_arrival_windows(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"ProductName":null,"SalesAmount":3}\n{"ProductName":"a","SalesAmount":4}')
    sales = spark.readStream.schema("ProductName string, SalesAmount int").json(str(tmp_path / "in"))
    query = stream_arrival_totals(sales).writeStream.format("noop").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    with pytest.raises(Exception, match="null key"):
        query.awaitTermination()
