"""What the jobs leave on disk beside their results, and that the rows stay the same."""

import glob

from pyspark.sql import functions as F

from bibflow import fixtures
from bibflow.plans import jobs as J
from bibflow.schemas import RECORD_SCHEMA
from bibflow.session import freed_shuffles, scratch_path, shared_dir
from bibflow.sinks.keyed_table import KeyedTable, write_exploded
from bibflow.sources import fs
from bibflow.sources.files import line_rows, split_lines
from bibflow.streaming.ingest import start_ingest
from bibflow.streaming.progress import CountLog

RECORD = '{"abstracts-retrieval-response":{"coredata":{"prism:doi":"%s","subtypeDescription":"Article","prism:aggregationType":"%s"},"authors":{"author":%s}}}'


def _tree(spark):
    base = scratch_path(spark, "t-disk")
    rows = [RECORD % ("a", "Journal", '[{"author-url":"x"},{"author-url":"y"},3]'), RECORD % ("b", "Journal", "[]"),
            RECORD % ("c", "Conference Proceeding", "[]"), "{broken"]
    spark.createDataFrame([(r,) for r in rows], "value STRING").coalesce(1).write.text(f"{base}/year=2001")
    return base


def test_a_load_caches_nothing_and_removes_its_rows(spark):
    table, aside, seen = KeyedTable(spark, scratch_path(spark, "t-disk-table"), RECORD_SCHEMA, n_buckets=2), scratch_path(spark, "t-disk-aside"), []
    plain = table.upsert
    table.upsert = lambda rows, **k: (seen.append(len(spark.sparkContext._jsc.getPersistentRDDs())), plain(rows, **k))[1]
    before = len(spark.sparkContext._jsc.getPersistentRDDs())
    r = J.ingest_tree(spark, _tree(spark), table, dir_format="year={year}", layout="lines", quarantine_path=aside)
    assert (r.records_read, r.records_kept, r.quarantined, r.elements_set_aside) == (3, 2, 1, 1) and seen == [before]
    assert {x.doi: x.author_url for x in table.read().collect()} == {"a": "y", "b": None}
    assert sorted(x.error for x in J.read_quarantine(spark, aside).collect()) == ["malformed", "wrong_element"]
    assert not glob.glob(f"{shared_dir(spark).removeprefix('file:')}/bibflow-scratch/computed-rows-*")


def test_a_load_without_survivors_ends(spark):
    base = scratch_path(spark, "t-disk-none")
    spark.createDataFrame([("{broken",)], "value STRING").write.text(f"{base}/year=2001")
    table = KeyedTable(spark, scratch_path(spark, "t-disk-none-table"), RECORD_SCHEMA, n_buckets=2)
    r = J.ingest_tree(spark, base, table, dir_format="year={year}")
    assert (r.records_read, r.records_kept, r.quarantined) == (0, 0, 1) and table.read().count() == 0


def test_writes_free_their_shuffles(spark, sf_dir):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    with freed_shuffles(spark):
        assert spark.conf.get(name) == "true"
    assert spark.conf.get(name) == before
    base = fixtures.write_nested_tree(spark, sf_dir, scratch_path(spark, "t-disk-tree")).removeprefix("file:")
    files = glob.glob(f"{base}/year=*/part-*")
    years = {f.split("/")[-2] for f in files}
    assert all(f.endswith(".gz") for f in files) and len(files) <= fixtures.FILES_PER_YEAR * len(years)
    want = fixtures.nested_records(spark, sf_dir).select("record", "year")
    got = spark.read.text(base).select(F.col("value").alias("record"), "year")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_orders_are_dealt_before_they_are_rendered(spark, sf_dir):
    dealt = fixtures.nested_records(spark, sf_dir, lambda orders: orders.withColumn("third", F.col("seq") % 3).repartition("third"))
    plan = dealt._jdf.queryExecution().optimizedPlan().toString()
    assert dealt.columns == ["seq", "record", "year", "third"] and plan.index("Abstract of order") < plan.index("RepartitionByExpression")
    assert dealt.drop("third").exceptAll(fixtures.nested_records(spark, sf_dir)).count() == 0


def test_stream_files_are_compressed_and_dealt_out(spark, sf_dir):
    src = fixtures.write_nested_files(spark, sf_dir, scratch_path(spark, "t-disk-src"), 4)
    files = glob.glob(f"{src.removeprefix('file:')}/part-*")
    assert len(files) == 4 and all(f.endswith(".gz") for f in files)
    lines = line_rows(spark.read.text(src))
    whole, dealt = split_lines(lines), split_lines(lines, 6)
    assert dealt.rdd.getNumPartitions() == 6 and "REPARTITION_BY_NUM" in dealt._jdf.queryExecution().executedPlan().toString()
    assert dealt.select("file_path", "record", "error").exceptAll(whole.select("file_path", "record", "error")).count() == 0
    want = fixtures.nested_records(spark, sf_dir).select("record")
    assert dealt.where("error IS NULL").select("record").exceptAll(want).count() == 0 and dealt.count() == want.count()


def test_fan_out_begins_from_written_rows(spark):
    path, left = scratch_path(spark, "t-disk-exploded"), f"{shared_dir(spark).removeprefix('file:')}/bibflow-scratch/to-fan-out-*"
    seen = []

    def fan_out(rows, keep):
        seen.extend(glob.glob(left))
        return rows.select(*keep, F.explode(F.sequence(F.lit(1), "n")).alias("i"))

    df = spark.createDataFrame([("2001-05-01", 2), (None, 3), ("x", 1)], "publication_date STRING, n INT")
    for _ in range(2):  # the years that it holds are replaced
        write_exploded(df, path, fan_out=fan_out)
    assert len(seen) == 2 and not glob.glob(left)
    assert sorted((r.year or 0, r.i) for r in spark.read.parquet(path).collect()) == [(0, 1), (0, 1), (0, 2), (0, 3), (2001, 1), (2001, 2)]
    assert all(".zstd." in f for f in glob.glob(f"{path.removeprefix('file:')}/year=*/part-*"))


def test_batches_without_rows_or_survivors_are_counted(spark):
    src, log = scratch_path(spark, "t-disk-empty-src"), CountLog()
    for name, text in (("a", RECORD % ("a", "Journal", "[]")), ("b", "{broken"), ("c", "\n\n")):
        fs.write_text(spark, f"{src}/{name}.json", text)
    table = KeyedTable(spark, scratch_path(spark, "t-disk-empty-table"), RECORD_SCHEMA, n_buckets=2)
    start_ingest(spark, src, table, scratch_path(spark, "t-disk-empty-ckpt"), max_files_per_trigger=1, layout="lines",
                 on_batch=log).awaitTermination()
    assert sorted((c.read, c.kept, c.quarantined) for c in log.batches.values()) == [(0, 0, 0), (1, 0, 1), (1, 1, 0)]
    assert [r.doi for r in table.read().collect()] == ["a"]
