"""Readers for year-organised trees of JSON files.

Layout: ``<base>/<year>/<file>``; a year directory may also be named
``year=<year>`` (as Spark's partitioned writers name it).  Files may have any
extension or none (S04) and hold one object, an array, NDJSON or
concatenated/pretty-printed objects.

Three ways in, all fully distributed:

* :func:`read_range_records` - any layout, files of any size: a task holds a
  range of a file (:mod:`bibflow.sources.ranges`), never a whole large file.
  The jobs and streams read trees of unknown layout this way.
* :func:`read_file_records` - whole files (``wholetext``), each split into
  records by :mod:`bibflow.sources.json_text` inside ``mapInPandas``.  One
  file is one task input, so this suits per-record / per-shard files only.
* :func:`read_ndjson_records` - true NDJSON, read line by line; files are
  split across tasks like any text source, so very large files scale.

All return ``(file_path, year, block, rec_pos, record, error)`` rows, where
``(file_path, block, rec_pos)`` orders records as they appear in the file;
rows with an error are the quarantine (S10/S11), the rest go to
``from_json``.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from bibflow.functions.json import is_one_value
from bibflow.session import ship_package
from bibflow.sources import fs
from bibflow.sources.json_text import split_records
from bibflow.sources.listing import list_files, name_matches, split_pattern
from bibflow.sources.ranges import read_ranges

SPLIT_SCHEMA = "file_path STRING, year INT, block BIGINT, rec_pos BIGINT, record STRING, error STRING"

# Years the scraped feed is read from (fixed values: 2013 to 2023 inclusive).
SCRAPED_YEARS = range(2013, 2024)

# A year directory is named ``2019`` or ``year=2019`` (fixed pattern).
YEAR_IN_PATH = r"/(?:year=)?(\d{4})/[^/]*$"

_OUT_BATCH = 4096


def year_of(path_col: Column) -> Column:
    """Year directory of a file path; NULL when the directory is not a year."""
    y = F.regexp_extract(path_col, YEAR_IN_PATH, 1)
    return F.when(y == "", None).otherwise(y.cast("int"))


def year_paths(base: str, years: Iterable[int] | None, name_glob: str = "*",
               dir_format: str = "{year}") -> str:
    """A single Hadoop glob over the requested year directories.

    Building the path from the years (instead of filtering a derived
    column) means unrequested years are never listed or opened.
    """
    base = base.rstrip("/")
    if years is None:
        return f"{base}/*/{name_glob}"
    dirs = ",".join(dir_format.format(year=y) for y in years)
    return f"{base}/{{{dirs}}}/{name_glob}"


def read_texts(spark: SparkSession, pattern: str, name_glob: str | None = None) -> DataFrame:
    """Whole files under a glob as ``(file_path, year, value)``.

    Hidden files (``.x``, ``_x``, see :func:`hidden_files`) and zero-byte
    files are skipped by Spark's file index.  An empty match yields an empty frame, not an error.
    """
    reader = spark.read
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    try:
        df = reader.text(pattern, wholetext=True)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], "file_path STRING, year INT, value STRING")
    return df.select(F.col("_metadata.file_path").alias("file_path"),
                     year_of(F.col("_metadata.file_path")).alias("year"), "value")


def _split_partition(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    cols: dict[str, list] = {"file_path": [], "year": [], "block": [], "rec_pos": [], "record": [],
                             "error": []}

    def flush() -> pd.DataFrame:
        out = pd.DataFrame(cols)
        out["year"] = out["year"].astype("Int32")
        out["block"] = out["block"].astype("int64")
        out["rec_pos"] = out["rec_pos"].astype("int64")
        for v in cols.values():
            v.clear()
        return out

    for pdf in batches:
        for path, year, text in zip(pdf["file_path"], pdf["year"], pdf["value"]):
            y = None if pd.isna(year) else int(year)
            for pos, rec, err in split_records(text):
                cols["file_path"].append(path)
                cols["year"].append(y)
                cols["block"].append(0)
                cols["rec_pos"].append(pos)
                cols["record"].append(rec)
                cols["error"].append(err)
                if len(cols["record"]) >= _OUT_BATCH:
                    yield flush()
    if cols["record"]:
        yield flush()


def split_files(texts: DataFrame) -> DataFrame:
    """``(file_path, year, value)`` -> one row per record or error."""
    ship_package(texts.sparkSession)
    return texts.select("file_path", "year", "value").mapInPandas(_split_partition, SPLIT_SCHEMA)


def hidden_files(spark: SparkSession, base: str, years: Iterable[int] | None = None, name_glob: str = "*",
                 dir_format: str = "{year}") -> DataFrame:
    """Files of the tree whose names start with ``_``, as quarantine rows (``hidden_name``).

    Spark's file index never opens such names.  They are found in the listing
    of the year folders, which executors make; empty marker files are left out.
    """
    folders, _ = split_pattern(year_paths(base, years, "*", dir_format))
    found = list_files(spark, folders).where(F.col("name").startswith("_") & (F.col("size") > 0) & name_matches(name_glob))
    return found.select("file_path", year_of(F.col("file_path")).alias("year"), F.lit(0).cast("long").alias("block"),
                        F.lit(0).cast("long").alias("rec_pos"), F.lit(None).cast("string").alias("record"), F.lit("hidden_name").alias("error"))


def passed_over(spark: SparkSession, source_dir: str) -> DataFrame:
    """Files in a stream's folder and its subfolders that the file source never delivers, as quarantine rows.

    ``hidden_name``: the name starts with ``_`` (empty marker files are left out);
    ``empty_file``: zero bytes.  Names that start with a dot are meant to be skipped.
    """
    base = source_dir.rstrip("/")
    found = list_files(spark, base).unionByName(list_files(spark, f"{base}/*")).where(~F.col("name").startswith("."))
    error = F.when(F.col("name").startswith("_"), F.when(F.col("size") > 0, "hidden_name")).when(F.col("size") == 0, "empty_file")
    none = F.lit(None).cast("string")
    return found.select("file_path", year_of(F.col("file_path")).alias("year"), F.lit(0).cast("long").alias("block"),
                        F.lit(0).cast("long").alias("rec_pos"), none.alias("record"), error.alias("error"),
                        none.alias("path")).where("error IS NOT NULL")


def read_file_records(spark: SparkSession, base: str, years: Iterable[int] | None = None,
                      name_glob: str = "*", dir_format: str = "{year}",
                      require_base: bool = True) -> DataFrame:
    """All records of the year tree.

    ``years=None`` scans every year directory (S01); a list restricts the
    listing to those years (S02, S03); ``name_glob="*.json"`` keeps only JSON
    names (S02).  A missing base directory is one explicit error.
    """
    if require_base and not fs.exists(spark, base):
        raise FileNotFoundError(f"base directory does not exist: {base}")
    texts = read_texts(spark, year_paths(base, years, "*", dir_format), name_glob=name_glob)
    return split_files(texts).unionByName(hidden_files(spark, base, years, name_glob, dir_format))


def read_range_records(spark: SparkSession, base: str, years: Iterable[int] | None = None, name_glob: str = "*",
                       dir_format: str = "{year}", require_base: bool = True, range_bytes: int | None = None) -> DataFrame:
    """:func:`read_file_records` for files of any size: each is read in ranges by many tasks."""
    if require_base and not fs.exists(spark, base):
        raise FileNotFoundError(f"base directory does not exist: {base}")
    try:
        found = read_ranges(spark, year_paths(base, years, "*", dir_format), None if name_glob == "*" else name_glob, range_bytes)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        found = spark.createDataFrame([], "file_path STRING, block BIGINT, rec_pos BIGINT, record STRING, error STRING")
    found = found.select("file_path", year_of(F.col("file_path")).alias("year"), "block", "rec_pos", "record", "error")
    return found.unionByName(hidden_files(spark, base, years, name_glob, dir_format))


def line_rows(df: DataFrame) -> DataFrame:
    """Text lines (line-mode text source, batch or stream) with their file
    position: ``(file_path, year, block, value)``."""
    return df.select(F.col("_metadata.file_path").alias("file_path"),
                     year_of(F.col("_metadata.file_path")).alias("year"),
                     F.col("_metadata.file_block_start").alias("block"),
                     "value")


def split_lines(lines: DataFrame, tasks: int | None = None) -> DataFrame:
    """``(file_path, year, block, value)`` lines -> split rows.

    ``tasks`` deals the numbered lines out to so many tasks, for files that come in
    few splits (a compressed file is one).

    Blank lines are skipped; a line that is not exactly one JSON object (junk,
    several values, text after the object) is a ``malformed`` quarantine row
    as a whole, and reading continues with the next line.  ``rec_pos`` increases with the line
    order inside one split (``block``); it depends on how splits are packed
    into tasks.
    """
    rec = F.trim(F.col("value"))
    out = lines.filter(rec != "").select(
        "file_path", "year", "block",
        F.monotonically_increasing_id().alias("rec_pos"),
        rec.alias("record"))
    if tasks:
        out = out.repartition(tasks, "rec_pos")
    is_object = F.col("record").startswith("{") & is_one_value(F.col("record"))
    return out.withColumn("error", F.when(is_object, F.lit(None).cast("string"))
                                    .otherwise(F.lit("malformed")))


def read_ndjson_records(spark: SparkSession, pattern: str, name_glob: str | None = None) -> DataFrame:
    """Line-delimited JSON, split across tasks (S09 for true NDJSON)."""
    reader = spark.read
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    try:
        lines = reader.text(pattern)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], SPLIT_SCHEMA)
    return split_lines(line_rows(lines))


def read_tree_records(spark: SparkSession, base: str, years: Iterable[int] | None = None,
                      name_glob: str = "*", dir_format: str = "{year}", layout: str = "whole",
                      require_base: bool = True) -> DataFrame:
    """A year tree in one of two layouts: ``whole`` (any JSON layout per file, of any
    size: read in ranges, see :mod:`bibflow.sources.ranges`; ``ranges`` is
    another name for it) or ``lines`` (NDJSON, splittable)."""
    if layout in ("whole", "ranges"):
        return read_range_records(spark, base, years, name_glob, dir_format, require_base)
    if require_base and not fs.exists(spark, base):
        raise FileNotFoundError(f"base directory does not exist: {base}")
    return read_ndjson_records(spark, year_paths(base, years, "*", dir_format),
                               name_glob=None if name_glob == "*" else name_glob).unionByName(
        hidden_files(spark, base, years, name_glob, dir_format))


def one_path(path: str) -> str:
    """A file's path as a glob that matches it alone."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def read_listed_files(spark: SparkSession, paths: Sequence[str], range_bytes: int | None = None) -> DataFrame:
    """:func:`read_range_records` over files named one by one (at least one)."""
    found = read_ranges(spark, [one_path(p) for p in paths], range_bytes=range_bytes)
    return found.select("file_path", year_of(F.col("file_path")).alias("year"), "block", "rec_pos", "record", "error")


def read_json_documents(spark: SparkSession, pattern: str, schema: T.StructType | str,
                        name_glob: str | None = None) -> DataFrame:
    """Files that each hold one JSON array or one object (S08), JVM only.

    Each file is read whole and parsed once with ``from_json`` against an
    array of the declared schema: an array yields its elements, a single
    object yields itself; this path measured about ten times faster than
    Spark's ``multiLine`` JSON reader on the test trees.  A file that does not
    parse as a whole, text after the first value included, becomes one
    ``malformed_file`` row (its text as ``record``) and an element that is not
    an object a ``not_object`` row.  Returns the schema's columns plus
    ``file_path``, ``year``, ``block``, ``rec_pos`` (position in the file) and
    ``error``.
    """
    st = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    rows = read_document_structs(spark, pattern, st, name_glob)
    return rows.select(*[F.col("doc").getField(f.name).alias(f.name) for f in st.fields],
                       "file_path", "year", "block", "rec_pos", "record", "error")


def read_document_structs(spark: SparkSession, pattern: str, st: T.StructType, name_glob: str | None = None,
                          doubt: Callable[[Column], Column] | None = None) -> DataFrame:
    """The rows of :func:`read_json_documents` with the parsed struct in ``doc``.

    With ``doubt`` (a condition on the parsed struct) also ``variant``: the
    elements as VARIANT, in files where the condition holds for some element.
    """
    texts = read_texts(spark, pattern, name_glob)
    # A second value makes the file malformed; the parser alone would stop after the first.
    text = F.trim(F.regexp_replace("value", "^\\uFEFF", ""))
    parsed = texts.select("file_path", "year", "value", F.when(
        is_one_value(text), F.from_json(text, T.ArrayType(st), {"mode": "PERMISSIVE"})).alias("docs"))
    item = lambda doc, variant, record: F.struct(doc.alias("doc"), variant.alias("variant"), record.alias("record"))
    none = F.lit(None).cast("variant")
    if doubt is None:
        items = F.transform("docs", lambda d: item(d, none, F.lit(None).cast("string")))
    else:
        as_variant = F.try_parse_json(text)
        parsed = parsed.withColumn("variants", F.when(F.exists("docs", lambda d: F.coalesce(doubt(d), F.lit(True))), F.coalesce(
            F.try_variant_get(as_variant, "$", "array<variant>"), F.array(as_variant))).otherwise(F.array().cast("array<variant>")))
        items = F.transform(F.arrays_zip("docs", "variants"), lambda z: item(z["docs"], z["variants"], F.lit(None).cast("string")))
    # Everything an element needs stands in the element: what is kept beside the
    # generator is copied for every row.  A file that does not parse is one element.
    whole = F.array(item(F.lit(None).cast(st), none, F.col("value")))
    rows = parsed.select("file_path", "year", F.posexplode(F.when(F.col("docs").isNull(), whole).otherwise(items)).alias("rec_pos", "e"))
    rows = rows.select("file_path", "year", "rec_pos", "e.doc", "e.variant", "e.record")
    error = (F.when(F.col("record").isNotNull(), F.lit("malformed_file"))
              .when(F.col("doc").isNull(), F.lit("not_object")))
    out = rows.select("doc", "file_path", "year", F.lit(0).cast("long").alias("block"),
                      F.when(F.col("record").isNull(), F.col("rec_pos")).cast("long").alias("rec_pos"), "record", error.alias("error"), "variant")
    return out if doubt is not None else out.drop("variant")


def good(split: DataFrame) -> DataFrame:
    return split.filter(F.col("error").isNull()).drop("error")


def quarantine(split: DataFrame) -> DataFrame:
    """Records set aside, with the reason."""
    return split.filter(F.col("error").isNotNull())


def file_status(split: DataFrame) -> DataFrame:
    """Per file: records kept, errors, and a status.

    ``truncated`` when the file ended inside a record (the records before
    it are kept), ``partial`` when some records were set aside, else ``ok``.
    """
    err = F.col("error")
    agg = split.groupBy("file_path", "year").agg(
        F.count_if(err.isNull()).alias("n_records"),
        F.count_if(err.isNotNull()).alias("n_errors"),
        F.max(F.coalesce(err == "unterminated", F.lit(False))).alias("truncated"))
    return agg.withColumn(
        "status",
        F.when(F.col("truncated"), "truncated").when(F.col("n_errors") > 0, "partial").otherwise("ok"),
    ).drop("truncated")


def parse_records(split: DataFrame, schema, keep: Sequence[str] = ("file_path", "year", "block", "rec_pos")
                  ) -> DataFrame:
    """Kept records -> declared schema columns."""
    parsed = good(split).select(*keep, F.from_json("record", schema, {"mode": "PERMISSIVE"}).alias("r"))
    return parsed.select(*keep, "r.*")
