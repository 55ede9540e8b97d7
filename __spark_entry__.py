"""
DuckDB ``oracle_sql``.

Every query reads the provided tables (or data Spark derives from them) in
full; the operators themselves live in :mod:`bibflow` and take DataFrames.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bibflow import fixtures
from bibflow import functions as BF
from bibflow import oracle_sql as O
from bibflow.operators import chunks as CH
from bibflow.operators import flatten as FL
from bibflow.operators import reports as R
from bibflow.operators.conform import ISSUES, QUARANTINE_SCHEMA, quarantine_rows
from bibflow.operators.drift import schema_drift
from bibflow.operators.upsert import ORDER_COL, keyed_rows, latest_per_key, with_feed_rank
from bibflow.plans import jobs as J
from bibflow.plans import pipelines as P
from bibflow.schemas import RECORD_SCHEMA
from bibflow.session import scratch_path
from bibflow.sinks.keyed_table import KeyedTable, write_exploded
from bibflow.sources import files as SF
from bibflow.sources.listing import list_files
from bibflow.sources.ranges import read_ranges
from bibflow.streaming.ingest import start_ingest
from bibflow.streaming.progress import CountLog

# The training-data operators are an optional part of the installation.
try:
    import corpus_pipeline  # noqa: F401
    from bibflow.llm import queries as llm
except ModuleNotFoundError as e:
    if e.name not in ("corpus_pipeline", "bibflow.llm"):
        raise  # a fault inside the subpackage
    llm = None

SMOKE_DIR = "/root/testdata/sf0.001"


def q_nested_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O01 (flagship): nested feed -> one row per DOI."""
    return P.nested_pipeline(fixtures.nested_records(spark, sf_dir), order=["seq"])


def q_cross_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G03 + K05: every author x subject row of the kept records."""
    return P.exploded_rows(P.nested_relation(fixtures.nested_records(spark, sf_dir)))


def q_scraped_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scraped feed -> one row per DOI."""
    return P.scraped_pipeline(fixtures.scraped_records(spark, sf_dir), order=["seq"])


def q_merge_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K04 + O03: both feeds into one table, the scraped feed wins a DOI."""
    return P.merged_pipeline(fixtures.nested_records(spark, sf_dir),
                             fixtures.scraped_records(spark, sf_dir), order=["seq"])


def q_merge_feeds_fill_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K04 with ``fill_nulls``: a later feed's NULL does not erase a value."""
    return P.merged_pipeline(fixtures.nested_records(spark, sf_dir),
                             fixtures.scraped_records(spark, sf_dir), order=["seq"], fill_nulls=True)


def _nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.nested_relation(fixtures.nested_records(spark, sf_dir), keep=["seq"])


def _scraped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.scraped_relation(fixtures.scraped_records(spark, sf_dir), keep=["seq"])


_SCALARS = ["seq", "doi", "title", "abstract", "document_type", "source_type", "publication_date",
            "source_title", "publisher", "author_keywords", "funding_details", "ref_count",
            "open_access", "affiliation", "language", "cited_by", "status_state", "delivered_date"]


def q_flatten_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested record -> typed record-level relation."""
    r = _nested(spark, sf_dir)
    return r.select(*_SCALARS, F.size("subject_areas").alias("n_subjects"),
                    F.size("authors").alias("n_authors"))


def q_flatten_scraped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scraped record -> the same relation."""
    r = _scraped(spark, sf_dir)
    return r.select(*_SCALARS, F.size("authors").alias("n_authors"))


def q_align_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both feeds in one declared schema."""
    a = with_feed_rank(_nested(spark, sf_dir), 1).select("feed_rank", *_SCALARS)
    b = with_feed_rank(_scraped(spark, sf_dir), 2).select("feed_rank", *_SCALARS)
    return a.unionByName(b)


def q_author_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of each exploded author (records without authors kept)."""
    r = FL.explode_authors(_nested(spark, sf_dir))
    return r.select("seq", *[c.alias(n) for n, c in FL.author_fields().items()])


def q_explode_subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per subject, records without subjects kept once."""
    r = FL.explode_subjects(_nested(spark, sf_dir))
    return r.select("seq", *[c.alias(n) for n, c in FL.subject_fields().items()],
                    F.col("subject.raw").alias("subject_area"))


def q_explode_authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per author, records without authors kept once."""
    r = FL.explode_authors(_nested(spark, sf_dir))
    return r.select("seq", "doi", F.col("author.raw").alias("author_details"))


def q_key_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F01 on the scraped feed."""
    return FL.key_not_null(_scraped(spark, sf_dir)).select("seq", "doi")


def q_type_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F02 on the scraped feed (NULL types are dropped)."""
    return FL.type_agreement(_scraped(spark, sf_dir)).select("seq", "document_type", "source_type")


def q_sink_coerce(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed record columns -> table types."""
    r = _scraped(spark, sf_dir)
    coerced = FL.sink_coerce_columns()
    return r.select("seq", coerced["publication_date"].alias("publication_date"),
                    coerced["open_access"].alias("open_access"), "author_keywords", "affiliation")


def q_parse_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON text -> declared schema (no inference)."""
    ev = fixtures.table(spark, sf_dir, "events")
    return ev.select("event_id", BF.parse("props", "k INT").getField("k").alias("k"))


def _date_text(o: DataFrame):
    return (F.when(o.o_orderkey % 10 == 0, F.concat(F.lit("bad-"), o.o_orderkey.cast("string")))
             .when(o.o_orderkey % 10 == 5, F.date_format(o.o_orderdate, "yyyy-13-dd"))
             .otherwise(F.date_format(o.o_orderdate, "yyyy-MM-dd")))


def _int_text(o: DataFrame):
    key = o.o_custkey.cast("string")
    return (F.when(o.o_orderkey % 10 == 0, F.concat(F.lit("x"), key))
             .when(o.o_orderkey % 10 == 5, F.concat(key, F.lit(".0")))
             .when(o.o_orderkey % 10 == 3, F.concat(F.lit(" "), key, F.lit(" ")))
             .otherwise(key))


def q_safe_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text -> date, malformed -> NULL under ANSI mode."""
    o = fixtures.table(spark, sf_dir, "orders")
    t = o.select("o_orderkey", _date_text(o).alias("text"))
    return t.select("o_orderkey", "text", BF.safe_date("text").alias("value"))


def q_safe_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text -> int with the lenient legacy rules."""
    o = fixtures.table(spark, sf_dir, "orders")
    t = o.select("o_orderkey", _int_text(o).alias("text"))
    return t.select("o_orderkey", "text", BF.safe_int("text").alias("value"))


def q_concat_date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NULL parts skipped, all NULL gives ''."""
    o = fixtures.table(spark, sf_dir, "orders")
    gone = o.o_orderkey % 50 == 0
    y = F.when(gone, None).otherwise(F.year(o.o_orderdate).cast("string"))
    m = F.when(gone | (o.o_orderstatus == "P"), None).otherwise(F.month(o.o_orderdate).cast("string"))
    d = F.when(gone, None).otherwise(F.dayofmonth(o.o_orderdate).cast("string"))
    return o.select("o_orderkey", BF.concat_date_parts(y, m, d).alias("delivered_date"))


def q_flag_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """true/false/NULL flag -> boolean, NULL -> false."""
    o = fixtures.table(spark, sf_dir, "orders")
    flag = F.when(o.o_orderstatus == "O", F.lit("true")).when(o.o_orderstatus == "F", F.lit("false"))
    return o.select("o_orderkey", BF.flag_normalize(flag).alias("open_access"))


def _conversation_nested(c: DataFrame):
    lines = F.transform(F.split(c.text, "\n"), lambda x: F.struct(x.alias("$")))
    return F.when(c.role == "system", None).otherwise(lines)


def q_json_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested value -> JSON text, NULL -> '[]'."""
    c = fixtures.table(spark, sf_dir, "conversations")
    return c.select("conv_id", "turn", BF.json_or_empty(_conversation_nested(c)).alias("author_keywords"))


def q_json_affiliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P10: nested value -> JSON text, NULL stays NULL."""
    c = fixtures.table(spark, sf_dir, "conversations")
    nested = F.when(c.role == "system", None).otherwise(F.struct(c.role.alias("role"), c.turn.alias("turn")))
    return c.select("conv_id", "turn", BF.json_or_null(nested).alias("affiliation"))


def q_upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K01 on a keyed event feed: latest (ts, event_id) per user."""
    ev = fixtures.table(spark, sf_dir, "events")
    return latest_per_key(ev, "user_id", order=["ts", "event_id"]).select(*ev.columns)


# ------------------------------------------------------------ file readers

def _conversation_split(spark: SparkSession, sf_dir: str, layout: str, corrupt: str | None = None
                        ) -> DataFrame:
    base = fixtures.write_conversation_files(spark, sf_dir, scratch_path(spark, f"conv-{layout}"),
                                             layout, corrupt)
    if layout == "ndjson":
        return SF.read_ndjson_records(spark, f"{base}/*")
    return SF.split_files(SF.read_texts(spark, f"{base}/*"))


def _conversation_rows(split: DataFrame) -> DataFrame:
    return SF.parse_records(split, fixtures.CONVERSATION_SCHEMA, keep=()).select(
        "conv_id", "turn", "role", "text")


def q_split_concat_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of concatenated (partly pretty-printed) objects."""
    return _conversation_rows(_conversation_split(spark, sf_dir, "concat"))


# Bytes of a range in the range query: the files of the test tables then have many.
RANGE_BYTES = 1 << 16


def q_split_concat_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One large file of concatenated objects, read in ranges by many tasks."""
    base = fixtures.write_one_conversation_file(spark, sf_dir, scratch_path(spark, "conv-one"))
    found = read_ranges(spark, f"{base}/*", range_bytes=RANGE_BYTES).withColumn("year", F.lit(None).cast("int"))
    return _conversation_rows(found)


def q_json_array_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files holding one JSON array each, read by the JVM JSON reader."""
    base = fixtures.write_conversation_files(spark, sf_dir, scratch_path(spark, "conv-array"), "array")
    docs = SF.read_json_documents(spark, f"{base}/*", fixtures.CONVERSATION_SCHEMA)
    return docs.filter(F.col("error").isNull()).select("conv_id", "turn", "role", "text")


def q_ndjson_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line-delimited files, read splittable line by line."""
    return _conversation_rows(_conversation_split(spark, sf_dir, "ndjson"))


def q_quarantine_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Undecodable records are set aside, reading continues."""
    split = _conversation_split(spark, sf_dir, "concat", corrupt="record")
    return (split.groupBy(F.coalesce("error", F.lit("ok")).alias("status"))
                 .agg(F.count(F.lit(1)).alias("n")))


def q_quarantine_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file cut inside a record keeps the records before the cut."""
    status = SF.file_status(_conversation_split(spark, sf_dir, "concat", corrupt="truncate"))
    return status.groupBy("status").agg(F.count(F.lit(1)).alias("n_files"),
                                        F.sum("n_records").alias("n_records"),
                                        F.sum("n_errors").alias("n_errors"))


def _order_tree(spark: SparkSession, sf_dir: str) -> str:
    return fixtures.write_order_year_tree(spark, sf_dir, scratch_path(spark, "orders-tree"))


def _order_rows(split: DataFrame) -> DataFrame:
    rows = SF.parse_records(split, fixtures.ORDER_RECORD_SCHEMA, keep=("year",))
    return rows.select("year", "o_orderkey", "o_custkey", "o_orderstatus",
                       BF.safe_date("o_orderdate").alias("o_orderdate"), "o_orderpriority")


def q_year_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every file of every year directory, any extension."""
    base = _order_tree(spark, sf_dir)
    return _order_rows(SF.read_file_records(spark, base, dir_format=fixtures.YEAR_DIR))


def q_year_range_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``*.json`` files of a year range (only those directories are listed)."""
    base = _order_tree(spark, sf_dir)
    return _order_rows(SF.read_file_records(spark, base, years=range(1996, 2001), name_glob="*.json",
                                            dir_format=fixtures.YEAR_DIR))


def q_single_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One year."""
    base = _order_tree(spark, sf_dir)
    return _order_rows(SF.read_file_records(spark, base, years=[1997], dir_format=fixtures.YEAR_DIR))


def q_year_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected years that are missing or hold no ``*.json``."""
    base = _order_tree(spark, sf_dir)
    return R.year_audit(spark, base, 1993, 2004, "*.json", dir_format=fixtures.YEAR_DIR)


def q_file_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per year, records read and zero-byte files skipped."""
    base = _order_tree(spark, sf_dir)
    split = SF.read_file_records(spark, base, dir_format=fixtures.YEAR_DIR)
    return R.file_audit(spark, split, f"{base}/*/*")


def q_chunk_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consecutive chunks of 1000 records in event order."""
    ev = fixtures.table(spark, sf_dir, "events").select("event_id")
    return CH.assign_chunks(ev, "event_id", chunk_size=1000)


def q_chunk_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S12 + S15 over the feed's own order: year, file, position."""
    split = SF.good(SF.read_file_records(spark, _order_tree(spark, sf_dir), dir_format=fixtures.YEAR_DIR))
    chunked = CH.assign_chunks(split.select("year", "file_path", "block", "rec_pos"),
                               ["year", "file_path", "block", "rec_pos"], chunk_size=1000)
    return CH.chunk_progress(chunked, 1000)


def q_ingest_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per chunk, its size, running total and flagged ('error') count."""
    ev = fixtures.table(spark, sf_dir, "events").select("event_id", "event_type")
    chunked = CH.assign_chunks(ev, "event_id", chunk_size=1000)
    return CH.chunk_progress(chunked, 1000, flag=F.col("event_type") == "error")


def q_schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of the event properties by event type, against a declared schema of which one field is gone."""
    ev = fixtures.table(spark, sf_dir, "events")
    declared = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("ref", T.StringType())])
    return schema_drift(ev, "props", declared, "event_type")


def q_record_size_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Serialized record size per source and the chunk size it allows."""
    docs = fixtures.table(spark, sf_dir, "documents")
    return R.record_size_profile(docs, "source")


def q_record_size_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantiles of record size per source from sketches per source and language, and whether their exact
    ranks are within 1 % of the records."""
    docs = fixtures.table(spark, sf_dir, "documents")
    sizes = docs.select("source", "lang", R.serialized_size(docs).alias("bytes"))
    parts = R.size_sketches(sizes, "bytes", ["source", "lang"])
    wanted = (0.5, 0.95, 0.99)
    found = R.size_quantiles(R.merge_sketches(parts, ["source"]), wanted)
    s, n, q = F.col("s"), F.col("n_records"), F.col("quantile_bytes")
    ranked = sizes.select(F.col("source").alias("s"), "bytes").join(found, s.eqNullSafe(F.col("source"))).groupBy(
        "source", "n_records", "min_bytes", "max_bytes").agg(
        *[F.count_if(F.col("bytes") < q[i]).alias(f"below{i}") for i in range(len(wanted))],
        *[F.count_if(F.col("bytes") <= q[i]).alias(f"upto{i}") for i in range(len(wanted))])
    near = [((F.col(f"below{i}") <= (p + 0.01) * n) & (F.col(f"upto{i}") >= (p - 0.01) * n)).alias(f"p{round(p * 100)}_near")
            for i, p in enumerate(wanted)]
    return ranked.select("source", "n_records", "min_bytes", "max_bytes", *near)


def q_nested_files_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O01 from files: NDJSON year tree -> line reader -> pipeline (order: year, file, position)."""
    base = fixtures.write_nested_tree(spark, sf_dir, scratch_path(spark, "nested-tree"))
    return J.tree_pipeline(spark, base, "nested", dir_format=fixtures.YEAR_DIR, layout="lines").drop(ORDER_COL)


def q_nested_documents_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O01 from files holding one JSON array each, read by the JVM reader."""
    base = fixtures.write_nested_documents(spark, sf_dir, scratch_path(spark, "nested-docs"))
    return J.tree_pipeline(spark, base, "nested", dir_format=fixtures.YEAR_DIR,
                           layout="document").drop(ORDER_COL)


def q_quarantine_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records and list elements of the wrong type, by reason and path, and what is kept of the rest."""
    base = fixtures.write_mistyped_tree(spark, sf_dir, scratch_path(spark, "mistyped-tree"))
    rows = J.tree_rows(spark, base, "nested", dir_format=fixtures.YEAR_DIR, layout="lines")
    # Three reports on the same rows: what they need is computed once and kept, without the records' own fields.
    judged = scratch_path(spark, "mistyped-judged")
    rows.select("file_path", "year", "block", "rec_pos", "record", "error", "path", ISSUES, "doi", "document_type", "source_type",
                F.size("authors").alias("n_authors")).write.parquet(judged)
    rows = spark.read.parquet(judged)
    place = F.regexp_replace("path", r"\[\d+\]$", "[]")
    aside = quarantine_rows(rows).groupBy(F.col("error").alias("status"), place.alias("path")).agg(F.count(F.lit(1)).alias("n"))
    good = J.records_of(rows)
    kept = F.when(FL.passes_filters(), "kept").otherwise("filtered").alias("status")
    fits = good.groupBy(kept, F.lit(None).cast("string").alias("path")).agg(F.count(F.lit(1)).alias("n"))
    authors = good.agg(F.lit("authors").alias("status"), F.lit(None).cast("string").alias("path"),
                       F.coalesce(F.sum("n_authors"), F.lit(0)).alias("n"))
    return aside.unionByName(fits).unionByName(authors)


def _new_scraped_tree(spark: SparkSession, sf_dir: str) -> str:
    return fixtures.write_scraped_tree(spark, sf_dir, scratch_path(spark, "scraped-tree"))


def q_scraped_files_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O02 from files: audit, then the ``*.json`` files of 2013 to 2023, into the table."""
    table = _new_table(spark, "scraped-files-table")
    J.ingest_scraped(spark, _new_scraped_tree(spark, sf_dir), table, dir_format=fixtures.YEAR_DIR)
    return table.read()


def q_merge_files_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O03 from files: both trees into one table; the scraped feed is the later load."""
    table = _new_table(spark, "merge-files-table")
    nested = fixtures.write_nested_tree(spark, sf_dir, scratch_path(spark, "merge-nested"))
    J.ingest_both(spark, nested, _new_scraped_tree(spark, sf_dir), table, dir_format=fixtures.YEAR_DIR)
    return table.read()


def q_upsert_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A base compacted into buckets, merged with a later load without a shuffle of the base."""
    table = _new_table(spark, "compacted-table")
    _nested_load(table, spark, sf_dir)
    table.compact()
    again = P.nested_relation(fixtures.corrected_records(spark, sf_dir), keep=["seq"])
    table.upsert(keyed_rows(FL.filter_records(again), ["seq"]), unique=True)
    return _titles(table)


def q_stream_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S15 on streams: records read, kept, filtered and set aside, observed per batch; totals over the batches."""
    base = fixtures.write_mistyped_tree(spark, sf_dir, scratch_path(spark, "counted-tree"))
    table, counts = _new_table(spark, "counted-table"), CountLog()
    start_ingest(spark, base, table, scratch_path(spark, "counted-ckpt"), max_files_per_trigger=4, layout="lines",
                 on_batch=counts).awaitTermination()
    rows = spark.createDataFrame(counts.rows(), "batch_id long, n_read long, n_kept long, n_filtered long, n_quarantined long, "
                                                "n_elements long, running_total long")
    return rows.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n_read", "n_kept", "n_filtered", "n_quarantined", "n_elements")],
                    F.max("running_total").alias("running_total"))


def q_stream_admission(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S05, S12 on streams: batches within a budget of bytes; hidden and empty files are reported."""
    # Not compressed: the budget is in bytes of files, the batches' bytes are counted in text.
    base = fixtures.write_nested_tree(spark, sf_dir, scratch_path(spark, "admitted-tree"), "none")
    parts = list_files(spark, f"{base}/*").where(~F.col("name").rlike("^[._]"))
    sizes = parts.agg(F.max("size").alias("largest"), F.sum("size").alias("total")).first()
    budget = max(sizes["largest"] or 1, (sizes["total"] or 0) // 3)  # no file is larger
    fixtures.write_empty_files(spark, fixtures.write_hidden_files(spark, base))
    table, counts, aside = _new_table(spark, "admitted-table"), CountLog(), scratch_path(spark, "admitted-quarantine")
    start_ingest(spark, base, table, scratch_path(spark, "admitted-ckpt"), layout="lines", quarantine_path=aside, on_batch=counts,
                 max_bytes_per_trigger=budget).awaitTermination()
    batches = spark.createDataFrame([(c.read, c.bytes) for c in counts.batches.values()], "n_read long, bytes long")
    totals = batches.agg(F.coalesce(F.sum("n_read"), F.lit(0)).alias("n_read"), F.count_if(F.col("bytes") > budget).alias("n_over_budget"),
                         (F.count(F.lit(1)) > 1).alias("several_batches"))
    found = spark.read.schema(QUARANTINE_SCHEMA).parquet(aside).agg(
        F.count_if(F.col("error") == "hidden_name").alias("n_hidden"), F.count_if(F.col("error") == "empty_file").alias("n_empty"))
    return totals.crossJoin(found)  # one row each


def _status_counts(split: DataFrame) -> DataFrame:
    return split.groupBy(F.coalesce("error", F.lit("ok")).alias("status")).agg(F.count(F.lit(1)).alias("n"))


def q_lines_multi_object(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A line that holds two objects is set aside, never half read."""
    return _status_counts(_conversation_split(spark, sf_dir, "ndjson", corrupt="twice"))


def q_document_multi_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file with a second JSON value is set aside as a whole."""
    base = fixtures.write_conversation_files(spark, sf_dir, scratch_path(spark, "conv-append"), "array", "append")
    return _status_counts(SF.read_json_documents(spark, f"{base}/*", fixtures.CONVERSATION_SCHEMA))


def q_underscore_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files whose names Spark hides are reported."""
    base = fixtures.write_hidden_files(spark, _order_tree(spark, sf_dir))
    return _status_counts(SF.read_file_records(spark, base, dir_format=fixtures.YEAR_DIR))


def _titles(table: KeyedTable) -> DataFrame:
    return table.read(["doi", "title"])


def _nested_load(table: KeyedTable, spark: SparkSession, sf_dir: str) -> None:
    rel = P.nested_relation(fixtures.nested_records(spark, sf_dir), keep=["seq"])
    table.upsert(keyed_rows(FL.filter_records(rel), ["seq"]), unique=True)


def _new_table(spark: SparkSession, name: str) -> KeyedTable:
    return KeyedTable(spark, scratch_path(spark, name), RECORD_SCHEMA, n_buckets=16)


def q_upsert_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A later load wins, whatever its records' own order."""
    table = _new_table(spark, "reload-table")
    _nested_load(table, spark, sf_dir)
    again = P.nested_relation(fixtures.corrected_records(spark, sf_dir), keep=["seq"])
    table.upsert(keyed_rows(FL.filter_records(again), [-F.col("seq")]), unique=True)
    return _titles(table)


def _corrected_stream(spark: SparkSession, sf_dir: str, table: KeyedTable) -> None:
    src = fixtures.write_text_files(fixtures.corrected_records(spark, sf_dir), scratch_path(spark, "corrected-src"))
    start_ingest(spark, src, table, scratch_path(spark, "corrected-ckpt")).awaitTermination()


def q_upsert_batch_then_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream goes on with a table that a batch load made."""
    table = _new_table(spark, "batch-stream-table")
    _nested_load(table, spark, sf_dir)
    _corrected_stream(spark, sf_dir, table)
    return _titles(table)


def q_upsert_two_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A later stream with a checkpoint of its own wins over an earlier one's batches."""
    table = _new_table(spark, "two-streams-table")
    src = fixtures.write_nested_files(spark, sf_dir, scratch_path(spark, "first-src"), 4)
    start_ingest(spark, src, table, scratch_path(spark, "first-ckpt"), max_files_per_trigger=2, layout="lines").awaitTermination()
    _corrected_stream(spark, sf_dir, table)
    return _titles(table)


def q_exploded_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fan-out rows written by year and read back."""
    path = scratch_path(spark, "exploded")
    records = FL.filter_records(P.nested_relation(fixtures.nested_records(spark, sf_dir)))
    write_exploded(records, path, fan_out=P.exploded_rows)
    return spark.read.parquet(path).select(*[f.name for f in RECORD_SCHEMA.fields])


# --------------------------------------------------------------- streaming

def q_stream_year_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O01 as a stream over the base folder of a year tree."""
    base = fixtures.write_nested_tree(spark, sf_dir, scratch_path(spark, "stream-tree"))
    table = _new_table(spark, "stream-tree-table")
    start_ingest(spark, base, table, scratch_path(spark, "stream-tree-ckpt")).awaitTermination()
    return table.read()


def q_nested_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O01 as Structured Streaming: files -> micro-batches -> keyed table.

    The records are written as 8 files and consumed four files per trigger;
    the resulting table must equal the batch pipeline's.
    """
    src = fixtures.write_nested_files(spark, sf_dir, scratch_path(spark, "nested-src"), 8)
    table = KeyedTable(spark, scratch_path(spark, "nested-table"), RECORD_SCHEMA, n_buckets=16)
    query = start_ingest(spark, src, table, scratch_path(spark, "nested-ckpt"), feed="nested",
                         max_files_per_trigger=4, layout="lines")
    query.awaitTermination()
    return table.read()


def entry(spark: SparkSession) -> DataFrame:
    return q_nested_pipeline(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "nested_pipeline": q_nested_pipeline,
        "cross_explode": q_cross_explode,
        "scraped_pipeline": q_scraped_pipeline,
        "merge_feeds": q_merge_feeds,
        "merge_feeds_fill_nulls": q_merge_feeds_fill_nulls,
        "flatten_nested": q_flatten_nested,
        "flatten_scraped": q_flatten_scraped,
        "align_schema": q_align_schema,
        "author_fields": q_author_fields,
        "explode_subjects": q_explode_subjects,
        "explode_authors": q_explode_authors,
        "key_not_null": q_key_not_null,
        "type_agreement": q_type_agreement,
        "sink_coerce": q_sink_coerce,
        "parse_records": q_parse_records,
        "safe_date": q_safe_date,
        "safe_int": q_safe_int,
        "concat_date_parts": q_concat_date_parts,
        "flag_normalize": q_flag_normalize,
        "json_keywords": q_json_keywords,
        "json_affiliation": q_json_affiliation,
        "upsert_latest": q_upsert_latest,
        "split_concat_json": q_split_concat_json,
        "split_concat_ranges": q_split_concat_ranges,
        "json_array_docs": q_json_array_docs,
        "ndjson_docs": q_ndjson_docs,
        "quarantine_records": q_quarantine_records,
        "quarantine_files": q_quarantine_files,
        "year_scan": q_year_scan,
        "year_range_scan": q_year_range_scan,
        "single_year": q_single_year,
        "year_audit": q_year_audit,
        "file_audit": q_file_audit,
        "chunk_assign": q_chunk_assign,
        "chunk_feed": q_chunk_feed,
        "ingest_metrics": q_ingest_metrics,
        "record_size_profile": q_record_size_profile,
        "record_size_quantiles": q_record_size_quantiles,
        "schema_drift": q_schema_drift,
        "nested_stream": q_nested_stream,
        "nested_files_pipeline": q_nested_files_pipeline,
        "nested_documents_pipeline": q_nested_documents_pipeline,
        "lines_multi_object": q_lines_multi_object,
        "document_multi_value": q_document_multi_value,
        "underscore_files": q_underscore_files,
        "stream_year_tree": q_stream_year_tree,
        "upsert_reload": q_upsert_reload,
        "upsert_batch_then_stream": q_upsert_batch_then_stream,
        "upsert_two_streams": q_upsert_two_streams,
        "exploded_write": q_exploded_write,
        "quarantine_types": q_quarantine_types,
        "scraped_files_pipeline": q_scraped_files_pipeline,
        "merge_files_pipeline": q_merge_files_pipeline,
        "upsert_compacted": q_upsert_compacted,
        "stream_counts": q_stream_counts,
        "stream_admission": q_stream_admission,
    } | (llm.queries() if llm else {})


def oracle_sql() -> dict[str, str]:
    return {
        "nested_pipeline": O.nested_pipeline(),
        "cross_explode": O.cross_explode(),
        "scraped_pipeline": O.scraped_pipeline(),
        "merge_feeds": O.merge_feeds(),
        "merge_feeds_fill_nulls": O.merge_feeds_fill_nulls(),
        "flatten_nested": O.flatten_nested(),
        "flatten_scraped": O.flatten_scraped(),
        "align_schema": O.align_schema(),
        "author_fields": O.author_fields(),
        "explode_subjects": O.explode_subjects(),
        "explode_authors": O.explode_authors(),
        "key_not_null": O.key_not_null(),
        "type_agreement": O.type_agreement(),
        "sink_coerce": O.sink_coerce(),
        "parse_records": O.parse_records(),
        "safe_date": O.safe_date(),
        "safe_int": O.safe_int(),
        "concat_date_parts": O.concat_date_parts(),
        "flag_normalize": O.flag_normalize(),
        "json_keywords": O.json_keywords(),
        "json_affiliation": O.json_affiliation(),
        "upsert_latest": O.upsert_latest(),
        "split_concat_json": O.split_concat_json(),
        "split_concat_ranges": O.split_concat_json(),
        "json_array_docs": O.json_array_docs(),
        "ndjson_docs": O.ndjson_docs(),
        "quarantine_records": O.quarantine_records(),
        "quarantine_files": O.quarantine_files(),
        "year_scan": O.year_scan(),
        "year_range_scan": O.year_range_scan(),
        "single_year": O.single_year(),
        "year_audit": O.year_audit(),
        "file_audit": O.file_audit(),
        "chunk_assign": O.chunk_assign(),
        "chunk_feed": O.chunk_feed(1000),
        "ingest_metrics": O.ingest_metrics(),
        "record_size_profile": O.record_size_profile(),
        "record_size_quantiles": O.record_size_quantiles(),
        "schema_drift": O.schema_drift(),
        "nested_stream": O.nested_pipeline(),
        "nested_files_pipeline": O.nested_pipeline(),
        "nested_documents_pipeline": O.nested_pipeline(),
        "lines_multi_object": O.lines_multi_object(),
        "document_multi_value": O.document_multi_value(fixtures.CONVS_PER_FILE, fixtures.TURNS_PER_FILE),
        "underscore_files": O.underscore_files(len(fixtures.HIDDEN_FILE_YEARS)),
        "stream_year_tree": O.nested_pipeline(),
        "upsert_reload": O.corrected_titles(),
        "upsert_batch_then_stream": O.corrected_titles(),
        "upsert_two_streams": O.corrected_titles(),
        "exploded_write": O.cross_explode(),
        "quarantine_types": O.quarantine_types(),
        "scraped_files_pipeline": O.scraped_files_pipeline(),
        "merge_files_pipeline": O.merge_files_pipeline(),
        "upsert_compacted": O.corrected_titles(),
        "stream_counts": O.stream_counts(),
        "stream_admission": O.stream_admission(len(fixtures.HIDDEN_FILE_YEARS), len(fixtures.EMPTY_FILE_YEARS)),
    } | (llm.oracle_sql() if llm else {})
