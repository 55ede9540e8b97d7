"""Structured Streaming ingestion of a directory of JSON files.

New files in the source directory are picked up by Spark's file source
(its checkpoint remembers which files were done), split into records,
flattened, filtered and merged into a :class:`KeyedTable` in
``foreachBatch``.  The feed carries no event time, so there is no watermark
or window: the only state is the keyed table itself.

Exactly-once: a batch is stored as a partition named by the id in the stream's
checkpoint and its number; a replayed micro-batch replaces its own.  A
later batch, of whatever stream, replaces what an earlier load stored; within
one batch the greatest ``(file_path, block, rec_pos)`` wins.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from contextlib import ExitStack

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from bibflow.operators.conform import ISSUES
from bibflow.operators.flatten import filter_records, passes_filters
from bibflow.operators.upsert import keyed_rows
from bibflow.plans.jobs import computed_once, conformed, naming_first_record, records_of, write_quarantine
from bibflow.session import setting
from bibflow.sinks.keyed_table import KeyedTable
from bibflow.sources import fs
from bibflow.sources.files import SPLIT_SCHEMA, line_rows, passed_over, read_listed_files, split_lines
from bibflow.streaming.progress import BatchCounts

# The quarantine partition of files that the stream never reads; no batch has this number.
PASSED_OVER_BATCH = -1
# Where a shuffle of a batch brings no rows, this rule drops the plan below it, and the counts observed there with it.
_EMPTY_PLANS = ("spark.sql.adaptive.optimizer.excludedRules", "org.apache.spark.sql.execution.adaptive.AQEPropagateEmptyRelation")
# The columns of Spark's binary file source.
_FILES = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"


def file_stream(spark: SparkSession, source_dir: str, max_files_per_trigger: int | None = None,
                name_glob: str | None = None, layout: str = "whole", max_bytes_per_trigger: int | None = None) -> DataFrame:
    """Streaming text of new files under ``source_dir``, its year folders included.

    ``layout="lines"``: NDJSON, one row per line with its position (splittable,
    so large files spread over tasks); ``"whole"``: one row per file with its path
    and size, not its text, for concatenated / pretty-printed / array files of any
    size, which the batch reads in ranges.
    A batch admits new files up to a count or up to a number of bytes (a file
    that is larger by itself makes a batch of its own), not both.
    """
    if max_files_per_trigger and max_bytes_per_trigger:
        raise ValueError("limit a batch by files or by bytes, not by both")
    reader = spark.readStream.option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    if layout == "lines":
        return line_rows(reader.text(source_dir))
    # The content is never asked for, so the source does not open the files.
    return reader.format("binaryFile").schema(_FILES).load(source_dir).select("path", "length")


def whole_files(batch: DataFrame) -> DataFrame:
    """The records of a batch of whole files.  The file source keeps a batch's paths on the driver; so does this."""
    paths = [r.path for r in batch.select("path").collect()]
    return read_listed_files(batch.sparkSession, paths) if paths else batch.sparkSession.createDataFrame([], SPLIT_SCHEMA)


def write_passed_over(spark: SparkSession, source_dir: str, quarantine_path: str) -> None:
    """Replace the quarantine's list of hidden and empty files by what the folder holds now."""
    passed_over(spark, source_dir).write.mode("overwrite").parquet(f"{quarantine_path}/batch_id={PASSED_OVER_BATCH}")


def upsert_batch(table: KeyedTable, feed: str = "nested", feed_rank: int = 1, layout: str = "whole",
                 quarantine_path: str | None = None, checkpoint: str | None = None,
                 on_batch: Callable[[BatchCounts], None] | None = None,
                 source_dir: str | None = None) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function: one micro-batch of files -> table.

    With ``quarantine_path`` the batch's set-aside records are written there
    (by ``batch_id``) instead of being left out silently, and with ``source_dir``
    also the files there that the stream never sees.  With ``checkpoint``
    a batch is stored once, however often it is replayed.  ``on_batch`` gets the
    batch's counts of records, observed in the job that reads them (S15).
    """
    stream_id: list[str] = []

    def writer(spark: SparkSession) -> str | None:
        if checkpoint and not stream_id:
            stream_id.append(json.loads(fs.read_text(spark, f"{checkpoint.rstrip('/')}/metadata"))["id"])
        return stream_id[0] if stream_id else None

    def run(batch: DataFrame, batch_id: int) -> None:
        name = f"{feed}-{batch_id}-{uuid.uuid4().hex[:8]}"
        counters, volume = Observation(name), Observation(f"{name}-bytes")
        # A line's end is not part of its row.
        size = F.octet_length("value").cast("long") + 1 if layout == "lines" else F.col("length")
        # Fewer splits than cores: a few files, or compressed ones, each of which one task reads; others parse the lines.
        cores = batch.sparkSession.sparkContext.defaultParallelism
        tasks = 2 * cores if layout == "lines" and batch.rdd.getNumPartitions() < cores else None
        batch = batch.observe(volume, F.sum(size).alias("bytes"))
        ok = F.col("error").isNull()

        def split() -> DataFrame:
            return split_lines(batch, tasks) if layout == "lines" else whole_files(batch)

        with naming_first_record(feed, split), ExitStack() as at_end:
            # Counted as they pass.
            rows = conformed(split(), feed, keep=["file_path", "year", "block", "rec_pos"]).observe(
                counters, F.count_if(ok).alias("ok"), F.count_if(~ok).alias("bad"),
                F.sum(F.when(ok, F.size(ISSUES))).alias("elements"), F.count_if(ok & passes_filters()).alias("kept"))
            at_end.enter_context(setting(rows.sparkSession, *_EMPTY_PLANS))
            if quarantine_path:
                # Used by the quarantine and the records.  The table alone needs no copy.
                rows = at_end.enter_context(computed_once(rows))
                # One folder per batch, so a replayed batch replaces its own rows.
                write_quarantine(rows, f"{quarantine_path}/batch_id={batch_id}")
                if source_dir:
                    write_passed_over(batch.sparkSession, source_dir, quarantine_path)
            order = [F.lit(feed_rank), *[F.col(c) for c in ("file_path", "block", "rec_pos")]]
            table.upsert(keyed_rows(filter_records(records_of(rows)), order), unique=True,
                         writer=writer(batch.sparkSession), batch=batch_id)
        if on_batch is not None:
            n = counters.get
            on_batch(BatchCounts(batch_id, n["ok"] + n["bad"], n["ok"], n["kept"], n["bad"], n["elements"] or 0, volume.get["bytes"] or 0))

    return run


def start_ingest(spark: SparkSession, source_dir: str, table: KeyedTable, checkpoint: str,
                 feed: str = "nested", feed_rank: int = 1, max_files_per_trigger: int | None = None,
                 available_now: bool = True, layout: str = "whole",
                 query_name: str | None = None, quarantine_path: str | None = None,
                 on_batch: Callable[[BatchCounts], None] | None = None,
                 max_bytes_per_trigger: int | None = None) -> StreamingQuery:
    """Start the ingest stream; with ``available_now`` it stops when the
    directory's current files are all processed.  ``query_name`` labels the
    progress events (see :mod:`bibflow.streaming.progress`).  With
    ``quarantine_path``, files that the source passes over (names beginning with
    ``_``, empty files) are listed there at the start and after every batch."""
    stream = file_stream(spark, source_dir, max_files_per_trigger, layout=layout, max_bytes_per_trigger=max_bytes_per_trigger)
    if quarantine_path:
        write_passed_over(spark, source_dir, quarantine_path)
    writer = stream.writeStream
    if query_name:
        writer = writer.queryName(query_name)
    writer = (writer
                    .foreachBatch(upsert_batch(table, feed, feed_rank, layout, quarantine_path, checkpoint, on_batch, source_dir))
                    .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()
