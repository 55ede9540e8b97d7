"""Record flattening, filtering and the author x subject fan-out.

The typed *record-level* relation (one row per record, subjects and authors
still as arrays) is the pivot of the engine: both feeds are projected into
it, filters run on it before any row multiplication, and the table rows are
produced from it either by the full fan-out (:func:`cross_explode`) or by
picking one subject and one author per record (:mod:`bibflow.operators.upsert`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bibflow import schemas
from bibflow.functions.json import json_or_empty, json_or_null, json_path, with_elements, without_nulls
from bibflow.functions.scalars import (
    concat_date_parts,
    flag_as_int,
    null_struct,
    safe_date,
    safe_int,
    typed_null,
)

# Values the type-agreement filter compares against (fixed values).
CONFERENCE_PAPER = "Conference Paper"
CONFERENCE_PROCEEDING = "Conference Proceeding"

RECORD_LEVEL_NAMES = [n for n, _ in schemas.RECORD_LEVEL_TYPED]


# Where a feed's lists stand in its records, and the type of their elements.
NESTED_LISTS = {
    "subject_areas": ((schemas.NESTED_ROOT, "subject-areas", "subject-area"), schemas.SUBJECT_AREA),
    "authors": ((schemas.NESTED_ROOT, "authors", "author"), schemas.AUTHOR),
}
SCRAPED_LISTS = {"authors": (("author",), schemas.AUTHOR)}

_BAD = "__bad_"


def _keep(df: DataFrame, keep: Sequence[str]) -> list[Column]:
    return [F.col(k) for k in keep]


def _with_lists(df: DataFrame, rec: str, lists: dict, issues: str | None) -> tuple[DataFrame, list[Column]]:
    """The feed's lists as typed columns, and the ``issues`` column (path, value of every element left out)."""
    raw = {}
    for name, (path, element) in lists.items():
        c = F.col(rec)
        for key in path:
            c = c.getField(key)
        raw[name] = (c, element)
    df = with_elements(df, raw, schemas.RAW, _BAD)
    if not issues:
        return df, []
    found = []
    for name, (path, _) in lists.items():
        at = F.lit(json_path(path) + "[")
        found.append(F.transform(F.coalesce(_BAD + name, F.array().cast("array<struct<pos:int,value:string>>")), lambda b: F.struct(
            F.concat(at, b["pos"].cast("string"), F.lit("]")).alias("path"), b["value"].alias("value"))))  # noqa: B023
    # A one-row generator, so that a filter on the issues does not repeat the comparison.
    once = F.struct(*lists, F.concat(*found).alias(issues))
    return df.withColumn("__lists", F.array(once)).drop(*lists).select("*", F.inline("__lists")), [F.col(issues)]


def flatten_nested(df: DataFrame, rec: str = "rec", keep: Sequence[str] = (), issues: str | None = None) -> DataFrame:
    """Nested API record (parsed struct column ``rec``) -> record-level relation.

    Deep paths are resolved with ``getField`` so keys holding ``:`` ``@``
    ``$`` ``-`` need no quoting (P01); columns listed in ``keep`` ride along
    (P03); nested values declared as text become JSON text without NULL
    members, plain values JSON strings (P13).  List elements of another type than declared are left out;
    ``issues`` names a column that holds their paths and values.
    """
    df, issue_cols = _with_lists(df, rec, NESTED_LISTS, issues)
    r = F.col(rec).getField(schemas.NESTED_ROOT)
    core = r.getField("coredata")
    item = r.getField("item")
    proc = item.getField("ait:process-info")
    delivered = proc.getField("ait:date-delivered")
    return df.select(
        *_keep(df, keep),
        core.getField("prism:doi").alias("doi"),
        core.getField("dc:title").alias("title"),
        core.getField("dc:description").alias("abstract"),
        core.getField("subtypeDescription").alias("document_type"),
        core.getField("prism:aggregationType").alias("source_type"),
        safe_date(core.getField("prism:coverDate")).alias("publication_date"),
        core.getField("prism:publicationName").alias("source_title"),
        core.getField("dc:publisher").alias("publisher"),
        json_or_null(r.getField("authkeywords").getField("author-keyword"), raw_text=True)
        .alias("author_keywords"),
        json_or_null(item.getField("xocs:meta").getField("xocs:funding-list"), raw_text=True)
        .alias("funding_details"),
        safe_int(item.getField("bibrecord").getField("tail").getField("bibliography")
                 .getField("@refcount")).alias("ref_count"),
        safe_int(core.getField("openaccess")).alias("open_access"),
        json_or_null(r.getField("affiliation"), raw_text=True).alias("affiliation"),
        r.getField("language").getField("@xml:lang").alias("language"),
        safe_int(core.getField("citedby-count")).alias("cited_by"),
        proc.getField("ait:status").getField("@state").alias("status_state"),
        concat_date_parts(delivered.getField("@year"), delivered.getField("@month"),
                          delivered.getField("@day")).alias("delivered_date"),
        "subject_areas", "authors", *issue_cols,
    )


def flatten_scraped(df: DataFrame, rec: str = "rec", keep: Sequence[str] = (), issues: str | None = None) -> DataFrame:
    """Flat scraped record -> the same record-level relation.

    Flat names are renamed (P04); fields the feed lacks become typed NULLs
    (P11); the missing subject list becomes one subject whose fields are all
    NULL (P12), so each record still yields rows after the fan-out.
    ``issues`` as in :func:`flatten_nested`.
    """
    df, issue_cols = _with_lists(df, rec, SCRAPED_LISTS, issues)
    r = F.col(rec)
    return df.select(
        *_keep(df, keep),
        r.getField("prism:doi").alias("doi"),
        r.getField("dc:title").alias("title"),
        r.getField("abstract").alias("abstract"),
        r.getField("subtypeDescription").alias("document_type"),
        r.getField("prism:aggregationType").alias("source_type"),
        safe_date(r.getField("prism:coverDate")).alias("publication_date"),
        r.getField("prism:publicationName").alias("source_title"),
        typed_null(T.StringType()).alias("publisher"),
        json_or_empty(r.getField("author-keyword"), raw_text=True).alias("author_keywords"),
        typed_null(T.StringType()).alias("funding_details"),
        typed_null(T.IntegerType()).alias("ref_count"),
        flag_as_int(r.getField("openaccessFlag")).alias("open_access"),
        json_or_null(r.getField("affiliation"), raw_text=True).alias("affiliation"),
        typed_null(T.StringType()).alias("language"),
        safe_int(r.getField("citedby-count")).alias("cited_by"),
        typed_null(T.StringType()).alias("status_state"),
        typed_null(T.StringType()).alias("delivered_date"),
        F.array(null_struct(schemas.SUBJECT_ELEMENT)).alias("subject_areas"),
        "authors", *issue_cols,
    )


def key_not_null(df: DataFrame, key: str = "doi") -> DataFrame:
    """the key must be present (an empty string passes)."""
    return df.filter(F.col(key).isNotNull())


def type_agreement_predicate(doc_type: str = "document_type",
                             src_type: str = "source_type") -> Column:
    """conference paper in a proceeding, or neither.

    Three-valued logic is kept on purpose: a NULL on either side makes both
    branches NULL, so the row is dropped.
    """
    d, s = F.col(doc_type), F.col(src_type)
    both = (d == CONFERENCE_PAPER) & (s == CONFERENCE_PROCEEDING)
    neither = (d != CONFERENCE_PAPER) & (s != CONFERENCE_PROCEEDING)
    return both | neither


def type_agreement(df: DataFrame) -> DataFrame:
    return df.filter(type_agreement_predicate())


def passes_filters() -> Column:
    """F01 + F02 as one predicate."""
    return F.col("doi").isNotNull() & type_agreement_predicate()


def filter_records(df: DataFrame) -> DataFrame:
    """F01 + F02, applied before any fan-out."""
    return df.filter(passes_filters())


def explode_subjects(df: DataFrame, src: str = "subject_areas", out: str = "subject") -> DataFrame:
    """One row per subject, records without subjects kept once."""
    return df.withColumn(out, F.explode_outer(src)).drop(src)


def explode_authors(df: DataFrame, src: str = "authors", out: str = "author") -> DataFrame:
    """One row per author, records without authors kept once."""
    return df.withColumn(out, F.explode_outer(src)).drop(src)


def cross_explode(df: DataFrame) -> DataFrame:
    """``max(1,#subjects) x max(1,#authors)`` rows per record.

    Two chained single-generator steps.  Both generators in one ``select``
    trips an analyzer bug on declared-schema input in Spark 4.1.
    """
    return explode_authors(explode_subjects(df))


def render_elements(df: DataFrame, subjects: str = "subject_areas", authors: str = "authors") -> DataFrame:
    """Nested texts of the list elements as the table holds them, rendered once per element.

    Applied before the fan-out, which repeats every element; the rows then go to
    :func:`to_table_rows` with ``rendered=True``.
    """
    def rendered(element: Column, fields: T.StructType, texts: dict) -> Column:
        return F.when(element.isNotNull(), F.struct(*[texts.get(f.name, lambda c: c)(element.getField(f.name)).alias(f.name) for f in fields]))

    raw = {schemas.RAW: without_nulls}
    author = {**raw, "affiliation": lambda c: json_or_null(c, raw_text=True)}
    return df.withColumns({
        subjects: F.transform(subjects, lambda s: rendered(s, schemas.SUBJECT_ELEMENT, raw)),
        authors: F.transform(authors, lambda a: rendered(a, schemas.AUTHOR_ELEMENT, author))})


def subject_fields(subject: str = "subject") -> dict[str, Column]:
    s = F.col(subject)
    return {
        "subject_code": s.getField("@code"),
        "subject_name": s.getField("$"),
        "subject_abbrev": s.getField("@abbrev"),
    }


def author_fields(author: str = "author", rendered: bool = False) -> dict[str, Column]:
    """Fields of one exploded author; ``rendered`` as in :func:`to_table_rows`."""
    a = F.col(author)
    name = a.getField("preferred-name")
    return {
        "author_given_name": name.getField("ce:given-name"),
        "author_surname": name.getField("ce:surname"),
        "author_url": a.getField("author-url"),
        "author_affiliation": a.getField("affiliation") if rendered else json_or_null(a.getField("affiliation"), raw_text=True),
    }


def sink_coerce_columns() -> dict[str, Column]:
    """Typed record columns -> table types (date text, boolean flag)."""
    return {
        "publication_date": F.date_format("publication_date", "yyyy-MM-dd"),
        "open_access": F.col("open_access").cast(T.BooleanType()),
    }


def to_table_rows(df: DataFrame, subject: str = "subject", author: str = "author",
                  keep: Sequence[str] = (), rendered: bool = False) -> DataFrame:
    """Record-level columns + one subject + one author -> the 26 table columns.

    Subject and author are stored as JSON text with all their fields but the NULL
    ones (K03); a subject whose fields are all NULL is ``{}``.  ``rendered=True``:
    both come from :func:`render_elements`.
    """
    whole = (lambda c: c) if rendered else without_nulls
    by_name = {**subject_fields(subject), **author_fields(author, rendered), **sink_coerce_columns()}
    by_name["author_details"] = whole(F.col(author).getField(schemas.RAW))
    by_name["subject_area"] = F.when(F.col(subject).isNotNull(), F.coalesce(whole(F.col(subject).getField(schemas.RAW)), F.lit("{}")))
    cols = [by_name[n].alias(n) if n in by_name else F.col(n) for n in schemas.RECORD_NAMES]
    return df.select(*_keep(df, keep), *cols)
