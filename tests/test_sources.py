"""Sources: bundles on disk, hashes, JSON lines; streams over them."""

import hashlib
import json
import time

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from quire import schema
from quire.operators import workflow
from quire.queries import streams
from quire.sources import bundles
from quire.streaming import jobs


def make(root, doc, items, pdf=b"%PDF"):
    d = root / f"{doc}.mineru_raw"
    d.mkdir(parents=True)
    (d / "content_list.json").write_text(json.dumps(items))
    (d / "layout.json").write_text(json.dumps({"pdf_info": [{"page_idx": 0, "page_size": [600, 800]}]}))
    (d / "_manifest.json").write_text(json.dumps({"source_content_hash": "sha256:" + hashlib.sha256(pdf).hexdigest()}))


def test_bundles(spark, tmp_path):
    make(tmp_path / "ws", "B.pdf", [{"type": "table"}, {"type": "table", "table_body": None, "page_idx": 1}, {"type": "text", "text": "x", "bbox": [1, 2, 3, 4]}], b"one")
    make(tmp_path / "ws", "a.pdf", [{"type": "text", "text": "y"}], b"two")
    (tmp_path / "src").mkdir()
    (tmp_path / "src" / "any.pdf").write_bytes(b"one")
    ws = str(tmp_path / "ws")
    assert [r.doc_id for r in bundles.find_bundles(spark, ws).orderBy("doc_id").collect()] == ["B.pdf", "a.pdf"]
    assert bundles.find_bundles(spark, ws, "b.P").count() == 1
    items = bundles.read_items(spark, ws, "B").orderBy("item_idx").collect()
    assert [(r.item_idx, r.has_table_body, r.page_idx) for r in items] == [(0, False, None), (1, True, 1), (2, False, None)]
    assert bundles.read_pages(spark, ws).count() == 2
    found = {r.doc_id: r.path for r in bundles.source_of(bundles.read_manifests(spark, ws), bundles.source_files(spark, str(tmp_path / "src"))).collect()}
    assert found["a.pdf"] is None and found["B.pdf"].endswith("any.pdf")


def test_jsonl(spark, tmp_path):
    (tmp_path / "events.jsonl").write_text('{"job_id": "1", "reason": "x"}\n\n{broken\n')
    rows = bundles.read_jsonl(spark, str(tmp_path / "events.jsonl"), schema.EVENTS).collect()
    assert sorted((r.job_id, r.corrupt) for r in rows if r.job_id) == [("1", None)] and [r.corrupt for r in rows if r.corrupt] == ["{broken"]


def test_stream_checks_transitions(spark, tmp_path):
    """Rows of two batches in the wrong order, a refused step, equal times, and a late one; stopped between the batches."""
    late = [("j1", 5, "2024-01-01 00:00:02", "indexed"), ("j1", 6, "2024-01-01 00:00:03", "planned"), ("j2", 7, "2024-01-01 00:00:00", "failed"), ("j1", 4, "2024-01-01 00:00:01", "parsing")]
    first = [("j1", 3, "2024-01-01 00:00:00", "candidate"), ("j3", 9, "2024-01-01 00:00:01", "parsing"), ("j3", 8, "2024-01-01 00:00:01", "candidate")]
    end = [(None, 0, "2024-01-03 00:00:00", None)]
    source, out, checkpoint = (str(tmp_path / x) for x in ("in", "out", "checkpoint"))
    with jobs.stateful(spark):
        for rows in (late, first, end, [("j9", 1, "2024-01-01 00:00:00", "lost")], end):
            spark.createDataFrame(rows, "job_id string, event_id long, at string, status string").selectExpr("job_id", "event_id", "to_timestamp(at) at", "status").coalesce(1).write.mode("append").parquet(source)
            stream = spark.readStream.schema("job_id string, event_id long, at timestamp, status string").option("maxFilesPerTrigger", 1).parquet(source)
            jobs.append(jobs.checked_transitions(stream), out, checkpoint)
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") != jobs.PROVIDER
    got = {r.event_id: (r.job_id, str(r.at), r.before, r.allowed) for r in spark.read.schema(jobs.STEPS).parquet(out).where("job_id IS NOT NULL").collect()}
    day = "2024-01-01 00:00:0"
    assert got == {3: ("j1", day + "0", None, True), 4: ("j1", day + "1", "candidate", True), 5: ("j1", day + "2", "parsing", False), 6: ("j1", day + "3", "parsing", True), 7: ("j2", day + "0", None, True), 8: ("j3", day + "1", None, True), 9: ("j3", day + "1", "candidate", True)}


def test_a_stream_stopped_and_started_again(spark, tmp_path):
    """Files one a batch, stopped after two: what waits in state and its timers are there again."""
    source, out, checkpoint = (str(tmp_path / x) for x in ("in", "out", "checkpoint"))
    rows = [(f"j{i % 3}", i, f"2024-01-01 0{i // 10}:{i % 10:02}:00", f"s{i}") for i in range(40)] + [(None, -1, "2024-01-03 00:00:00", None)]
    for a in range(0, 41, 10):
        spark.createDataFrame(rows[a : a + 10 + (a == 30)], "job_id string, event_id long, at string, status string").selectExpr("job_id", "event_id", "to_timestamp(at) at", "status").coalesce(1).write.mode("append").parquet(source)
        if a == 30:
            break
    stream = lambda: spark.readStream.schema("job_id string, event_id long, at timestamp, status string").option("maxFilesPerTrigger", 1).parquet(source)
    read = lambda: spark.read.schema(jobs.STEPS).parquet(out).where("job_id IS NOT NULL").collect()
    with jobs.stateful(spark):
        assert jobs.append(jobs.checked_transitions(stream(), transitions=None), out, checkpoint, stop_after=2) >= 1
        assert len(read()) < 40
        jobs.append(jobs.checked_transitions(stream(), transitions=None), out, checkpoint)
    got = {r.event_id: r.before for r in read()}
    assert len(read()) == 40 and got == {i: f"s{i - 3}" if i > 2 else None for i in range(40)}


def test_a_stream_that_is_not_through_is_no_result(spark, tmp_path):
    """Past its limit, or with a batch that fails, append raises and leaves no stream behind; the same checkpoint goes on."""
    source, out, checkpoint = (str(tmp_path / x) for x in ("in", "out", "checkpoint"))
    for a in range(0, 40, 10):
        spark.range(a, a + 10).coalesce(1).write.mode("append").parquet(source)

    def stream(step):
        return spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(source).select(F.udf(step, "long")("id").alias("id"))

    def slow(i):
        time.sleep(0.3)
        return i

    def broken(i):
        return i // (i < 25)

    for stop_after in (None, 4):
        with pytest.raises(TimeoutError):
            jobs.append(stream(slow), out, checkpoint, stop_after=stop_after, limit=2)
        assert not spark.streams.active
    with pytest.raises(StreamingQueryException):
        jobs.append(stream(broken), out, checkpoint)
    assert jobs.append(stream(lambda i: i), out, checkpoint) == 3
    assert sorted(r.id for r in spark.read.schema("id long").parquet(out).collect()) == list(range(40))
    assert jobs.append(stream(lambda i: i), out, f"{checkpoint}2", stop_after=9) == 3  # fewer batches than asked: read to the end


def test_event_steps_refuses_a_part(spark, tmp_path, monkeypatch):
    """Events that the watermark has dropped as late are missed, not left out of the result."""
    spark.createDataFrame([(i, i % 3, f"2024-01-{1 + i:02} 00:00:00") for i in range(30)], "event_id long, user_id long, ts string").selectExpr("event_id", "user_id", "to_timestamp(ts) ts", "'view' event_type").write.parquet(str(tmp_path / "events.parquet"))
    assert streams.event_steps(spark, str(tmp_path)).count() == 30
    arrived = streams._arrived
    monkeypatch.setattr(streams, "_arrived", lambda *a: arrived(*a[:3], a[3][::-1]) if a[3].stop < streams.WAVES else arrived(*a))
    with pytest.raises(RuntimeError):
        streams.event_steps(spark, str(tmp_path))


def test_events_without_a_time_come_first(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / x) for x in ("in", "out", "checkpoint"))
    for rows in ([("j1", 2, "2024-01-01 00:00:00", "b"), ("j1", 1, None, "a"), ("j2", 3, None, "c")], [(None, 0, "2024-01-03 00:00:00", None)]):
        spark.createDataFrame(rows, "job_id string, event_id long, at string, status string").selectExpr("job_id", "event_id", "to_timestamp(at) at", "status").coalesce(1).write.mode("append").parquet(source)
    with jobs.stateful(spark):
        stream = spark.readStream.schema("job_id string, event_id long, at timestamp, status string").parquet(source)
        jobs.append(jobs.checked_transitions(stream, transitions=None), out, checkpoint)
    got = spark.read.schema(jobs.STEPS).parquet(out).collect()
    assert {(r.event_id, r.at and str(r.at), r.before) for r in got} == {(1, None, None), (2, "2024-01-01 00:00:00", "a"), (3, None, None)}


def test_event_steps_in_another_time_zone(spark, tmp_path):
    """Events of half an hour, hours away from UTC: what waits is held against the watermark in the same zone."""
    spark.range(30).selectExpr("id event_id", "id % 3 user_id", "timestamp_ntz '2024-01-01 00:00:00' + make_dt_interval(0, 0, int(id)) ts", "concat('s', id) event_type").write.parquet(str(tmp_path / "events.parquet"))
    for zone in ("Asia/Taipei", "America/Lima"):
        try:
            spark.conf.set("spark.sql.session.timeZone", zone)
            got = {r.event_id: r.before for r in streams.event_steps(spark, str(tmp_path)).collect()}
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        assert got == {i: f"s{i - 3}" if i > 2 else None for i in range(30)}


def test_stream_windows(spark, tmp_path):
    spark.read.parquet("/root/testdata/sf0.001/events.parquet").selectExpr("CAST(ts AS timestamp) ts", "event_type", "value").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("ts timestamp, event_type string, value double").parquet(str(tmp_path / "in"))
    q = jobs.windowed_counts(stream, "ts", "event_type", "1 day", "1 hour").writeStream.format("memory").queryName("windows").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.table("windows").selectExpr("sum(n)").first()[0] == spark.read.parquet(str(tmp_path / "in")).count()


def test_recover(spark):
    js = spark.createDataFrame([("1", "a", "extracting"), ("2", "b", "repairing"), ("3", "c", "parsing"), ("4", "d", "scanning"), ("5", "e", "indexed")], "job_id string, filename string, status string")
    index = spark.createDataFrame([("a", "PROCESSED"), ("d", "pending")], "filename string, index_status string")
    assert {r.job_id: r.recovered for r in workflow.recover(js, index).collect()} == {"1": "indexed", "2": "repairing", "3": "parsing", "4": "scanning"}
    assert {r.recovered for r in workflow.recover(js, None).collect()} == {"extracting", "repairing", "parsing", "scanning"}


def test_event_log_and_append(spark, tmp_path):
    (tmp_path / "log").mkdir()
    (tmp_path / "log" / "a.json").write_text('{"event_id": "e1", "n": 1}\nnot json\n{"event_id": "e2", "n": 2}\n')
    stream = jobs.event_log(spark, str(tmp_path / "log"), "event_id string, n int")
    for _ in range(2):  # a second run finds nothing new, so each row is there once
        jobs.append_events(stream, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination(60)
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted((r.event_id or "", r.n or 0, r.corrupt or "") for r in rows) == [("", 0, "not json"), ("e1", 1, ""), ("e2", 2, "")]
    (tmp_path / "log" / "b.json").write_text('{"event_id": "e3", "n": 3}\n')
    jobs.append_events(stream, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination(60)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 4


def test_strings_at_any_depth():
    item = {"type": "text", "text": "", "_pp_original_text": "muted", "table_body": "<b>new</b>", "_pp_original_table_body": "old", "list_items": ["a", {"deep": ["b", {"type": "no", "x": "c"}]}], "img_path": "no", "n": 3, "none": None}
    assert sorted(bundles.strings_in(item)) == ["", "<b>new</b>", "a", "b", "c", "muted"]
