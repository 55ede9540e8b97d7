"""Publication records derived from the provided TPC-H-style tables.

The provided tables hold no publication records, so each ``orders`` row is
rendered as one record of each feed (JSON text), built with Spark from the
tables so the work grows with them.  Only this module and
``__spark_entry__.py`` know table names; the operators take DataFrames.

Rules (one record per order):

* doi: NULL when ``o_orderkey % 50 = 0`` else ``10.1000/<key>``; the
  scraped feed uses prefix ``10.2000/`` for status ``P`` so that part of
  its DOIs are shared with the nested feed and part are not.
* subjects: the distinct parts of the order's lines (key, brand, name).
* authors: distinct ``l_suppkey`` of the order's lines, named from supplier.
* keywords are a plain string for every seventh order; the affiliation of
  every ninth has a member whose value is null.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bibflow.schemas import NESTED_ROOT
from bibflow.session import freed_shuffles
from bibflow.sinks.keyed_table import unsorted_partitions

# Fixed values of the derivation.
AUTHOR_URL_PREFIX = "https://example.org/author/"
DOI_PREFIX = "10.1000/"
SCRAPED_ONLY_DOI_PREFIX = "10.2000/"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def _text(c: Column) -> Column:
    return c.cast("string")


def _doc_type(o: DataFrame) -> Column:
    return F.when(o.o_orderstatus == "F", F.lit("Conference Paper")).otherwise(F.lit("Article"))


def _src_type(o: DataFrame) -> Column:
    return (F.when(o.o_orderpriority.isin("1-URGENT", "2-HIGH"), F.lit("Conference Proceeding"))
             .otherwise(F.lit("Journal")))


def _lines(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_orderkey", *more, "l_suppkey")


def _with_suppliers(lines: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    return lines.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"), "left")


def _supplier_set() -> Column:
    return F.collect_set(F.struct("l_suppkey", "s_name", "s_nationkey")).alias("sups")


def _authors() -> Column:
    return F.sort_array(F.transform("sups", lambda s: F.struct(
        F.struct(s["s_name"].alias("ce:given-name"),
                 _text(s["l_suppkey"]).alias("ce:surname")).alias("preferred-name"),
        F.concat(F.lit(AUTHOR_URL_PREFIX), _text(s["l_suppkey"])).alias("author-url"),
        F.struct(_text(s["s_nationkey"]).alias("@id")).alias("affiliation"),
        _text(s["l_suppkey"]).alias("@auid"),  # not declared either
    )))


def _order_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order: its distinct parts and suppliers, not yet rendered, and its line count.

    One shuffle of ``lineitem`` by order key, of flat rows (part key, brand,
    name; supplier key, name, nation): the joins deal an order's lines out by
    part, so sets built before that shuffle would hold one line each and cost
    more than the lines.  The nested structs are built afterwards with
    ``transform``.  The part and supplier joins are left to the planner (AQE
    broadcasts them only when their measured size is small).
    """
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_name")
    per_order = (_with_suppliers(_lines(spark, sf_dir, "l_partkey").join(part, F.col("l_partkey") == F.col("p_partkey"), "left"), spark, sf_dir)
                 .repartition("l_orderkey").groupBy("l_orderkey")
                 .agg(F.collect_set(F.struct("l_partkey", "p_brand", "p_name")).alias("parts"), _supplier_set(),
                      F.count(F.lit(1)).alias("n_lines")))
    return per_order


def _subjects() -> Column:
    return F.sort_array(F.transform("parts", lambda p: F.struct(
        _text(p["l_partkey"]).alias("@code"), p["p_brand"].alias("@abbrev"), p["p_name"].alias("$"),
        F.lit("true").alias("@_fa"))))  # a field that no schema declares


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order: sorted distinct subjects, sorted distinct authors, line count."""
    return _order_sets(spark, sf_dir).select("l_orderkey", _subjects().alias("subjects"), _authors().alias("authors"), "n_lines")


def order_authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order: the authors of :func:`order_lines` alone; parts change nothing in them and are not joined."""
    per_order = _with_suppliers(_lines(spark, sf_dir), spark, sf_dir).repartition("l_orderkey").groupBy("l_orderkey").agg(_supplier_set())
    return per_order.select("l_orderkey", _authors().alias("authors"))


def _one_or_many(arr: Column) -> Column:
    """JSON text of a list; a one-element list is written as a bare object."""
    return F.when(F.size(arr) == 1, F.to_json(arr.getItem(0))).otherwise(F.to_json(arr))


def _append_raw(obj_json: Column, **values: Column) -> Column:
    """``{...}`` + raw JSON values by key -> ``{..., "key": value}``.  The text is cut once, however many are appended, and
    as bytes: its last one is the brace, and no characters need counting."""
    body = F.substr(obj_json.cast("binary"), F.lit(1), F.octet_length(obj_json) - 1).cast("string")
    return F.concat(body, *[c for k, v in values.items() for c in (F.lit(f',"{k}":'), v)], F.lit("}"))


def _plain_or(d: DataFrame, keywords: Column) -> Column:
    """The keywords' JSON text, of every seventh order a plain string."""
    return F.when(d.o_orderkey % 7 == 0, F.concat(F.lit('"'), d.o_orderpriority, F.lit('"'))).otherwise(keywords)


def _with_null_city(d: DataFrame, affiliation: Column) -> Column:
    """The affiliation's JSON text, of every ninth order with a member whose value is null."""
    return F.when(d.o_orderkey % 9 == 0, _append_raw(affiliation, city=F.lit("null"))).otherwise(affiliation)


def nested_records(spark: SparkSession, sf_dir: str, dealt: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """One nested API response per order: ``(seq, record)``.

    ``seq`` is the arrival order used by the keyed table.  ``dealt`` repartitions
    the orders by ``seq`` and ``year`` before their records are rendered: what it
    shuffles is a part of the text.  A column that it adds is kept.
    """
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    lines = _order_sets(spark, sf_dir)
    d = o.join(lines, o.o_orderkey == lines.l_orderkey, "left").drop("l_orderkey")
    d = d.withColumns({"seq": d.o_orderkey, "year": F.year(d.o_orderdate)})
    known, d = set(d.columns), dealt(d) if dealt is not None else d
    added = [c for c in d.columns if c not in known]
    d = d.select("*", _subjects().alias("subjects"), _authors().alias("authors"))
    key = _text(d.o_orderkey)
    doi = F.when(d.o_orderkey % 50 == 0, F.lit(None)).otherwise(F.concat(F.lit(DOI_PREFIX), key))
    coredata = F.struct(
        doi.alias("prism:doi"),
        F.concat(F.lit("order "), key).alias("dc:title"),
        F.concat(F.lit("Abstract of order "), key).alias("dc:description"),
        _doc_type(d).alias("subtypeDescription"),
        _src_type(d).alias("prism:aggregationType"),
        _iso(d.o_orderdate).alias("prism:coverDate"),
        F.concat(F.lit("Journal of "), d.o_orderpriority).alias("prism:publicationName"),
        F.concat(F.lit("Publisher "), d.o_orderstatus).alias("dc:publisher"),
        _text(d.o_custkey).alias("citedby-count"),
        F.when(d.o_orderstatus == "O", F.lit("1")).otherwise(F.lit("0")).alias("openaccess"),
    )
    keywords = F.array(F.struct(d.o_orderpriority.alias("$")), F.struct(d.o_orderstatus.alias("$")))
    item = F.struct(
        F.struct(
            F.struct(d.o_orderstatus.alias("@state")).alias("ait:status"),
            F.struct(
                _text(F.year(d.o_orderdate)).alias("@year"),
                F.when(d.o_orderstatus == "P", F.lit(None))
                 .otherwise(_text(F.month(d.o_orderdate))).alias("@month"),
                _text(F.dayofmonth(d.o_orderdate)).alias("@day"),
            ).alias("ait:date-delivered"),
        ).alias("ait:process-info"),
        F.struct(F.struct(F.struct(_text(d.n_lines).alias("@refcount")).alias("bibliography"))
                 .alias("tail")).alias("bibrecord"),
        F.struct(
            F.when(d.o_orderstatus == "O",
                   F.struct(F.concat(F.lit("Agency "), _text(d.o_custkey)).alias("agency")))
            .alias("xocs:funding-list")
        ).alias("xocs:meta"),
    )
    subjects = F.coalesce(d.subjects, F.array())
    authors = F.coalesce(d.authors, F.array())
    head = F.to_json(F.struct(
        coredata.alias("coredata"),
        F.struct(subjects.alias("subject-area")).alias("subject-areas"),
        F.struct(F.lit("eng").alias("@xml:lang")).alias("language"),
        item.alias("item"),
    ))
    # ``authors.author`` is polymorphic: one author is written as a bare
    # object, several as a list, none as an empty list.
    response = _append_raw(
        head, authkeywords=F.concat(F.lit('{"author-keyword":'), _plain_or(d, F.to_json(keywords)), F.lit("}")),
        affiliation=_with_null_city(d, F.to_json(F.struct(key.alias("@id")))),
        authors=F.concat(F.lit('{"author":'), _one_or_many(authors), F.lit("}")))
    record = F.concat(F.lit(f'{{"{NESTED_ROOT}":'), response, F.lit("}"))
    return d.select("seq", record.alias("record"), "year", *added)


def scraped_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One flat scraped record per order: ``(seq, record)``.

    Every order gets a record; some values are deliberately absent or bad:
    NULL document type for every 11th order (dropped by the type filter), an
    unparseable cover date for every 13th, citation counts written as
    ``'<n>.0'`` for every 7th, no keywords for every 5th, no affiliation and
    a NULL open-access flag for status ``P``.
    """
    o = table(spark, sf_dir, "orders")
    lines = order_authors(spark, sf_dir)
    d = o.join(lines, o.o_orderkey == lines.l_orderkey, "left")
    key = _text(d.o_orderkey)
    prefix = F.when(d.o_orderstatus == "P", F.lit(SCRAPED_ONLY_DOI_PREFIX)).otherwise(F.lit(DOI_PREFIX))
    doi = F.when(d.o_orderkey % 50 == 0, F.lit(None)).otherwise(F.concat(prefix, key))
    doc_type = F.when(d.o_orderkey % 11 == 0, F.lit(None)).otherwise(_doc_type(d))
    cover = F.when(d.o_orderkey % 13 == 0, F.lit("n/a")).otherwise(_iso(d.o_orderdate))
    cited = (F.when(d.o_orderkey % 7 == 0, F.concat(_text(d.o_custkey), F.lit(".0")))
              .otherwise(_text(d.o_custkey)))
    flag = (F.when(d.o_orderstatus == "O", F.lit(True))
             .when(d.o_orderstatus == "F", F.lit(False)))
    keywords = F.when(d.o_orderkey % 5 == 0, F.lit("null")) \
                .otherwise(_plain_or(d, F.to_json(F.array(F.struct(d.o_orderpriority.alias("$"))))))
    affiliation = F.when(d.o_orderstatus == "P", F.lit("null")) \
                   .otherwise(_with_null_city(d, F.to_json(F.struct(_text(d.o_custkey).alias("@id")))))
    head = F.to_json(F.struct(
        doi.alias("prism:doi"),
        F.concat(F.lit("scraped order "), key).alias("dc:title"),
        F.concat(F.lit("Scraped abstract "), key).alias("abstract"),
        doc_type.alias("subtypeDescription"),
        _src_type(d).alias("prism:aggregationType"),
        F.concat(F.lit("Journal of "), d.o_orderpriority).alias("prism:publicationName"),
        cover.alias("prism:coverDate"),
        cited.alias("citedby-count"),
        flag.alias("openaccessFlag"),
    ))
    authors = F.coalesce(d.authors, F.array())
    record = _append_raw(head, **{"author-keyword": keywords, "affiliation": affiliation, "author": _one_or_many(authors)})
    return d.select(d.o_orderkey.alias("seq"), record.alias("record"), F.year(d.o_orderdate).alias("year"))


# ---------------------------------------------------------------- file trees
# Scratch trees are written under the shared folder (``spark.checkpoint.dir``)
# by Spark writers, then read back through :mod:`bibflow.sources.files`.

ORDER_RECORD_SCHEMA = ("o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, "
                       "o_orderdate STRING, o_orderpriority STRING")
CONVERSATION_SCHEMA = "conv_id BIGINT, turn BIGINT, role STRING, text STRING"
# Years whose directory also gets one zero-byte ``empty.json`` (fixed values).
EMPTY_FILE_YEARS = (1999, 2000)
# A file holds turns of up to CONVS_PER_FILE consecutive conversations and at
# most TURNS_PER_FILE turns of each: every group built here is bounded.
CONVS_PER_FILE = 10
TURNS_PER_FILE = 64
YEAR_DIR = "year={year}"


def write_order_year_tree(spark: SparkSession, sf_dir: str, base: str) -> str:
    """``orders`` as a year tree ``base/year=<y>/...``.

    Odd years: NDJSON ``*.json`` files; even years: pretty-printed
    concatenated objects in ``*.txt`` files (so a ``*.json`` filter sees
    only odd years).  ``EMPTY_FILE_YEARS`` get a zero-byte ``empty.json``.
    """
    from bibflow.sources import fs

    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", _iso(F.col("o_orderdate")).alias("o_orderdate"),
        "o_orderpriority", F.year("o_orderdate").alias("year"))
    fields = [c for c in o.columns if c != "year"]
    (o.filter(F.col("year") % 2 == 1)
      .write.mode("overwrite").partitionBy("year").json(base))
    (o.filter(F.col("year") % 2 == 0)
      .select(F.to_json(F.struct(*fields), {"pretty": "true"}).alias("value"), "year")
      .write.mode("append").partitionBy("year").text(base))
    for y in EMPTY_FILE_YEARS:
        fs.touch(spark, f"{base}/{YEAR_DIR.format(year=y)}/empty.json")
    return base


# Years whose directory gets a file with a name that Spark hides (fixed values).
HIDDEN_FILE_YEARS = (1997, 1998)


def write_hidden_files(spark: SparkSession, base: str) -> str:
    """One ``_late.json`` of one record in each of ``HIDDEN_FILE_YEARS``."""
    from bibflow.sources import fs

    for y in HIDDEN_FILE_YEARS:
        fs.write_text(spark, f"{base}/{YEAR_DIR.format(year=y)}/_late.json", '{"o_orderkey": -1}')
    return base


def write_empty_files(spark: SparkSession, base: str) -> str:
    """A zero-byte ``empty.json`` in each of ``EMPTY_FILE_YEARS``."""
    from bibflow.sources import fs

    for y in EMPTY_FILE_YEARS:
        fs.touch(spark, f"{base}/{YEAR_DIR.format(year=y)}/empty.json")
    return base


def corrected_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third nested record again, with a corrected title."""
    recs = nested_records(spark, sf_dir).filter("seq % 3 = 0")
    return recs.withColumn("record", F.replace("record", F.lit('"dc:title":"order '), F.lit('"dc:title":"corrected order ')))


# Files of a year's feed, however large the feed: batches of a stream admitted by files grow with it, not their number.
FILES_PER_YEAR = 8


def _by_year(records: DataFrame) -> DataFrame:
    """The rows of each year dealt to ``FILES_PER_YEAR`` tasks by ``seq``."""
    return records.repartition("year", F.pmod(F.xxhash64("seq"), F.lit(FILES_PER_YEAR)))


def _write_year_lines(records: DataFrame, base: str, compression: str) -> None:
    with unsorted_partitions(records.sparkSession), freed_shuffles(records.sparkSession):
        records.select("record", "year").write.mode("overwrite").option("compression", compression).partitionBy("year").text(base)


def write_nested_tree(spark: SparkSession, sf_dir: str, base: str, compression: str = "gzip") -> str:
    """The nested feed as a year tree (``year=<publication year>``), one
    record per line.  Compressed files take a tenth of the text's disk."""
    _write_year_lines(nested_records(spark, sf_dir, _by_year), base, compression)
    return base


def write_text_files(records: DataFrame, path: str) -> str:
    """Records as compressed files of lines, one per task."""
    with freed_shuffles(records.sparkSession):
        records.select("record").write.option("compression", "gzip").text(path)
    return path


def write_nested_files(spark: SparkSession, sf_dir: str, path: str, n_files: int) -> str:
    """The nested feed as ``n_files`` files of lines."""
    return write_text_files(nested_records(spark, sf_dir, lambda orders: orders.repartition(n_files)), path)


def write_mistyped_tree(spark: SparkSession, sf_dir: str, base: str) -> str:
    """The nested feed as a year tree of lines, of every 20 records four changed: a string
    for ``coredata`` (1), another root key (2), a string before two or more authors (3), a list for the root (4)."""
    recs = nested_records(spark, sf_dir, _by_year)
    kind, r = F.col("seq") % 20, F.col("record")
    put = lambda old, new: F.replace(r, F.lit(old), F.lit(new))
    changed = (F.when(kind == 1, put('"coredata":{', '"coredata":"bad","core":{'))
                .when(kind == 2, F.concat(F.lit('{"other":'), r, F.lit("}")))
                .when(kind == 3, put('"author":[{', '"author":["str",{'))
                .when(kind == 4, F.lit(f'{{"{NESTED_ROOT}":[1]}}')).otherwise(r))
    _write_year_lines(recs.select(changed.alias("record"), "year"), base, "gzip")
    return base


# The scraped tree's years are the orders' years so much later (fixed value).
SCRAPED_YEAR_SHIFT = 16
_SCRAPED_FILE = ("`prism:doi` STRING, `dc:title` STRING, abstract STRING, subtypeDescription STRING, `prism:aggregationType` STRING, "
                 "`prism:publicationName` STRING, `prism:coverDate` STRING, `author-keyword` VARIANT, "
                 "`citedby-count` STRING, openaccessFlag BOOLEAN, affiliation VARIANT, "
                 "author ARRAY<STRUCT<`preferred-name`: STRUCT<`ce:given-name`: STRING, `ce:surname`: STRING>, `author-url`: STRING, "
                 "affiliation: STRUCT<`@id`: STRING>, `@auid`: STRING>>")


def write_scraped_tree(spark: SparkSession, sf_dir: str, base: str) -> str:
    """The scraped feed as a year tree of ``*.json`` files; every tenth record goes to a ``*.txt`` file instead."""
    recs = scraped_records(spark, sf_dir).withColumn("year", F.col("year") + SCRAPED_YEAR_SHIFT)
    listed = F.regexp_replace("record", r'"author":(\{.*\})\}$', r'"author":[$1]}')  # a bare object as a list of one
    with freed_shuffles(spark):
        (recs.where("seq % 10 <> 0").select(F.from_json(listed, _SCRAPED_FILE).alias("r"), "year").select("r.*", "year")
            .write.mode("overwrite").partitionBy("year").json(base))
        recs.where("seq % 10 = 0").select("record", "year").write.mode("append").partitionBy("year").text(base)
    return base


# Records per JSON-array file in ``write_nested_documents`` (bounds each group).
RECORDS_PER_DOCUMENT = 2048


def write_nested_documents(spark: SparkSession, sf_dir: str, base: str) -> str:
    """The nested feed as a year tree of files that each hold one JSON array
    of at most ``RECORDS_PER_DOCUMENT`` consecutive records."""
    block = F.floor(F.col("seq") / RECORDS_PER_DOCUMENT)
    recs = nested_records(spark, sf_dir, lambda orders: orders.withColumn("block", block).repartition("year", "block"))
    docs = (recs.groupBy("year", "block")
                .agg(F.sort_array(F.collect_list(F.struct("seq", "record"))).alias("items"))
                .select("year", F.concat(F.lit("["),
                                         F.array_join(F.transform("items", lambda x: x["record"]), ",\n"),
                                         F.lit("]")).alias("value")))
    with freed_shuffles(spark):
        docs.write.mode("overwrite").option("maxRecordsPerFile", 1).option("compression", "gzip").partitionBy("year").text(base)
    return base


def write_one_conversation_file(spark: SparkSession, sf_dir: str, base: str) -> str:
    """``conversations`` as one file of objects, odd turns pretty-printed, written by one task."""
    fields = F.struct("conv_id", "turn", "role", "text")
    c = table(spark, sf_dir, "conversations")
    obj = F.when(F.col("turn") % 2 == 1, F.to_json(fields, {"pretty": "true"})).otherwise(F.to_json(fields))
    c.select(obj.alias("value")).coalesce(1).write.mode("overwrite").option("lineSep", " ").text(base)
    return base


def write_conversation_files(spark: SparkSession, sf_dir: str, base: str, layout: str,
                             corrupt: str | None = None) -> str:
    """``conversations`` as JSON files.

    File key: ``(conv_id div CONVS_PER_FILE, turn div TURNS_PER_FILE)``.
    ``layout``: ``concat`` (objects one after another, odd turns
    pretty-printed), ``array`` (one JSON array) or ``ndjson``.
    ``corrupt``: ``record`` makes every record of each tenth conversation
    undecodable but balanced; ``truncate`` cuts each tenth file (file group
    divisible by 10) inside its last record; ``append`` puts a second value
    after the text of each tenth file; ``twice`` writes each record of a tenth
    conversation twice, side by side.
    """
    fields = F.struct("conv_id", "turn", "role", "text")
    c = table(spark, sf_dir, "conversations").withColumn("obj", F.to_json(fields))
    if layout == "concat":
        c = c.withColumn("obj", F.when(F.col("turn") % 2 == 1, F.to_json(fields, {"pretty": "true"}))
                                 .otherwise(F.col("obj")))
    if corrupt == "record":
        # '{"broken" "conv_id":...}' is balanced but not valid JSON.
        c = c.withColumn("obj", F.when(F.col("conv_id") % 10 == 0,
                                       F.concat(F.lit('{"broken" '), F.expr("substring(obj, 2)")))
                                 .otherwise(F.col("obj")))
    if corrupt == "twice":
        c = c.withColumn("obj", F.when(F.col("conv_id") % 10 == 0, F.concat("obj", F.lit(" "), "obj")).otherwise(F.col("obj")))
    group = F.floor(F.col("conv_id") / CONVS_PER_FILE)
    parts = (c.select(group.alias("file_group"), F.floor(F.col("turn") / TURNS_PER_FILE).alias("part"),
                      F.struct("conv_id", "turn", "obj").alias("item"))
              .groupBy("file_group", "part")
              .agg(F.sort_array(F.collect_list("item")).alias("items"))
              .withColumn("objs", F.transform("items", lambda x: x.getField("obj"))))
    if layout == "array":
        parts = parts.withColumn("value", F.concat(F.lit("["), F.array_join("objs", ",\n"), F.lit("]")))
    else:
        parts = parts.withColumn("value", F.array_join("objs", "\n"))
    if corrupt == "append":
        parts = parts.withColumn("value", F.when(F.col("file_group") % 10 == 0, F.concat("value", F.lit('\n{"conv_id": -1}')))
                                           .otherwise(F.col("value")))
    if corrupt == "truncate":
        keep_len = (F.length("value") - F.ceil(F.length(F.element_at("objs", -1)) / 2)).cast("int")
        parts = parts.withColumn("value", F.when(F.col("file_group") % 10 == 0,
                                                 F.col("value").substr(F.lit(1), keep_len))
                                           .otherwise(F.col("value")))
    (parts.select("value").write.mode("overwrite").option("maxRecordsPerFile", 1).text(base))
    return base
