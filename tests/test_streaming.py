"""Structured Streaming ingest: stream = batch, resume, new files only."""

from bibflow import fixtures
from bibflow.plans import pipelines as P
from bibflow.schemas import RECORD_SCHEMA
from bibflow.session import scratch_path
from bibflow.sinks.keyed_table import KeyedTable
from bibflow.streaming.ingest import start_ingest


def test_stream_equals_batch_and_resumes(spark, sf_dir):
    records = fixtures.nested_records(spark, sf_dir)
    src = scratch_path(spark, "t-stream-src")
    first, second = records.filter("seq % 2 = 0"), records.filter("seq % 2 = 1")
    first.select("record").repartition(3).write.text(src + "/a")
    table = KeyedTable(spark, scratch_path(spark, "t-stream-table"), RECORD_SCHEMA, n_buckets=4)
    ckpt = scratch_path(spark, "t-stream-ckpt")
    start_ingest(spark, src + "/*", table, ckpt, max_files_per_trigger=1).awaitTermination()
    assert table.read().exceptAll(P.nested_pipeline(first)).count() == 0
    # Restart on the same checkpoint with nothing new: the table is unchanged.
    before = table.read().collect()
    start_ingest(spark, src + "/*", table, ckpt).awaitTermination()
    assert sorted(map(tuple, table.read().collect())) == sorted(map(tuple, before))
    # New files arrive: only they are processed, and the table equals the batch result.
    second.select("record").repartition(2).write.text(src + "/b")
    start_ingest(spark, src + "/*", table, ckpt).awaitTermination()
    expected = P.nested_pipeline(records)
    got = table.read()
    assert got.count() == expected.count()
    assert got.exceptAll(expected).count() == 0


def test_progress_listener_counts_input_rows(spark, sf_dir):
    import time

    from bibflow.streaming.progress import attach, detach

    records = fixtures.nested_records(spark, sf_dir)
    src = scratch_path(spark, "t-progress-src")
    records.select("record").repartition(3).write.text(src)
    table = KeyedTable(spark, scratch_path(spark, "t-progress-table"), RECORD_SCHEMA, n_buckets=4)
    log = attach(spark, "t-progress")
    try:
        start_ingest(spark, src, table, scratch_path(spark, "t-progress-ckpt"), max_files_per_trigger=1,
                     query_name="t-progress", layout="lines").awaitTermination()
        deadline = time.time() + 30  # progress events arrive asynchronously
        while log.total("t-progress") < records.count() and time.time() < deadline:
            time.sleep(0.5)
    finally:
        detach(spark, log)
    assert log.total("t-progress") == records.count()
    assert [b.running_total for b in log.batches][-1] == records.count()


def test_stream_quarantines_bad_lines(spark, sf_dir):
    src = scratch_path(spark, "t-q-src")
    recs = fixtures.nested_records(spark, sf_dir)
    bad = spark.createDataFrame([("{not json",), ('["an", "array"]',)], "record STRING")
    recs.select("record").unionByName(bad).repartition(2).write.text(src)
    table = KeyedTable(spark, scratch_path(spark, "t-q-table"), RECORD_SCHEMA, n_buckets=4)
    qpath = scratch_path(spark, "t-q-quarantine")
    start_ingest(spark, src, table, scratch_path(spark, "t-q-ckpt"), quarantine_path=qpath,
                 layout="lines").awaitTermination()
    q = spark.read.parquet(qpath)
    assert sorted(r.record for r in q.collect()) == sorted(['["an", "array"]', "{not json"])
    assert table.read().count() == P.nested_pipeline(recs).count()


def test_stream_admits_by_bytes_and_reports_what_it_passes_over(spark):
    import json

    import pytest

    from bibflow.sources import fs
    from bibflow.streaming.ingest import PASSED_OVER_BATCH
    from bibflow.streaming.progress import CountLog

    src = scratch_path(spark, "t-admit-src")
    line = json.dumps({"abstracts-retrieval-response": {"coredata": {"prism:doi": "10.1/x"}}})
    for n in range(6):
        fs.write_text(spark, f"{src}/2001/part{n}.json", line + "\n")
    fs.write_text(spark, f"{src}/2001/large.json", (line + "\n") * 9)  # larger than the budget by itself
    fs.write_text(spark, f"{src}/2002/_late.json", line)
    fs.write_text(spark, f"{src}/2002/.hidden", line)
    fs.touch(spark, f"{src}/2002/_MARK")
    fs.touch(spark, f"{src}/2002/empty.json")
    fs.touch(spark, f"{src}/empty.json")
    table = KeyedTable(spark, scratch_path(spark, "t-admit-table"), RECORD_SCHEMA, n_buckets=4)
    log, aside, size = CountLog(), scratch_path(spark, "t-admit-quarantine"), len(line) + 1
    start_ingest(spark, src, table, scratch_path(spark, "t-admit-ckpt"), layout="lines", quarantine_path=aside, on_batch=log,
                 max_bytes_per_trigger=2 * size).awaitTermination()
    read = [c.read for c in log.batches.values()]
    assert sum(read) == 15 and 9 in read
    assert all(c.bytes == c.read * size for c in log.batches.values())
    assert all(n <= 2 or n == 9 for n in read)
    rows = spark.read.parquet(aside).where(f"batch_id = {PASSED_OVER_BATCH}").select("file_path", "year", "error").collect()
    assert sorted((r.file_path.removeprefix("file:").removeprefix(src.removeprefix("file:")), r.year, r.error) for r in rows) == [
        ("/2002/_late.json", 2002, "hidden_name"), ("/2002/empty.json", 2002, "empty_file"), ("/empty.json", None, "empty_file")]
    with pytest.raises(ValueError, match="not by both"):
        start_ingest(spark, src, table, scratch_path(spark, "t-admit-no"), max_files_per_trigger=1, max_bytes_per_trigger=1)


def test_stream_keeps_a_batch_only_for_a_quarantine(spark, sf_dir, monkeypatch):
    """A batch that goes to the table alone passes once, uncached, with the same counts."""
    from bibflow.streaming.progress import CountLog

    kept = []
    monkeypatch.setattr(type(spark.range(1)), "persist", lambda self, *a: (kept.append(1), self)[1])
    src = scratch_path(spark, "t-uncached-src")
    records = fixtures.nested_records(spark, sf_dir)
    records.select("record").repartition(2).write.text(src)
    for layout in ("lines", "whole"):
        table, log = KeyedTable(spark, scratch_path(spark, "t-uncached-table"), RECORD_SCHEMA, n_buckets=4), CountLog()
        start_ingest(spark, src, table, scratch_path(spark, "t-uncached-ckpt"), layout=layout, on_batch=log).awaitTermination()
        assert not kept
        n = records.count()
        assert [(c.read, c.fitting) for c in log.batches.values()] == [(n, n)]
        assert table.read().count() == P.nested_pipeline(records).count()
