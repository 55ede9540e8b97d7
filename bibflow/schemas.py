"""Declared schemas.

Records are never schema-inferred: the outcome of a run must not depend on
which records happen to share a batch.  Fields that arrive either as one
object or as a list of objects are declared ``STRING`` so the JSON reader
keeps their raw text; :func:`bibflow.functions.json.as_array` turns that text
into an array afterwards (a bare object becomes a one-element array).
"""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


# Root key of one API response in the nested feed (fixed value).
NESTED_ROOT = "abstracts-retrieval-response"

SUBJECT_AREA = _struct(("@code", S), ("@abbrev", S), ("$", S))

PREFERRED_NAME = _struct(("ce:given-name", S), ("ce:surname", S))

# ``affiliation`` inside an author may be one object or many: raw JSON text.
AUTHOR = _struct(("preferred-name", PREFERRED_NAME), ("author-url", S), ("affiliation", S))

# An element of a record's lists: the declared fields, then the element's whole
# JSON text, which also holds the fields that are not declared.
RAW = "raw"
SUBJECT_ELEMENT = T.StructType([*SUBJECT_AREA.fields, T.StructField(RAW, S)])
AUTHOR_ELEMENT = T.StructType([*AUTHOR.fields, T.StructField(RAW, S)])

SUBJECT_AREAS_TYPE = T.ArrayType(SUBJECT_ELEMENT)
AUTHORS_TYPE = T.ArrayType(AUTHOR_ELEMENT)

NESTED_RESPONSE = _struct(
    ("coredata", _struct(
        ("prism:doi", S),
        ("dc:title", S),
        ("dc:description", S),
        ("subtypeDescription", S),
        ("prism:aggregationType", S),
        ("prism:coverDate", S),
        ("prism:publicationName", S),
        ("dc:publisher", S),
        ("citedby-count", S),
        ("openaccess", S),
    )),
    ("authkeywords", _struct(("author-keyword", S))),
    ("subject-areas", _struct(("subject-area", S))),
    ("authors", _struct(("author", S))),
    ("language", _struct(("@xml:lang", S))),
    ("affiliation", S),
    ("item", _struct(
        ("ait:process-info", _struct(
            ("ait:status", _struct(("@state", S))),
            ("ait:date-delivered", _struct(("@year", S), ("@month", S), ("@day", S))),
        )),
        ("bibrecord", _struct(("tail", _struct(("bibliography", _struct(("@refcount", S))))))),
        ("xocs:meta", _struct(("xocs:funding-list", S))),
    )),
)

# One record of the nested feed.
NESTED_RECORD = _struct((NESTED_ROOT, NESTED_RESPONSE))

# One record of the scraped (flat) feed.
SCRAPED_RECORD = _struct(
    ("prism:doi", S),
    ("dc:title", S),
    ("abstract", S),
    ("subtypeDescription", S),
    ("prism:aggregationType", S),
    ("prism:publicationName", S),
    ("prism:coverDate", S),
    ("author-keyword", S),
    ("citedby-count", S),
    ("openaccessFlag", S),
    ("affiliation", S),
    ("author", S),
)

# The common relation, in table (sink) types: dates and nested values are
# text, the flag is boolean.  Column order is the table's.
RECORD_COLUMNS: list[tuple[str, T.DataType]] = [
    ("doi", S),
    ("title", S),
    ("abstract", S),
    ("document_type", S),
    ("source_type", S),
    ("publication_date", S),
    ("source_title", S),
    ("publisher", S),
    ("author_keywords", S),
    ("subject_code", S),
    ("subject_name", S),
    ("subject_abbrev", S),
    ("author_given_name", S),
    ("author_surname", S),
    ("author_url", S),
    ("author_affiliation", S),
    ("author_details", S),
    ("funding_details", S),
    ("ref_count", T.IntegerType()),
    ("open_access", T.BooleanType()),
    ("affiliation", S),
    ("language", S),
    ("cited_by", T.IntegerType()),
    ("status_state", S),
    ("delivered_date", S),
    ("subject_area", S),
]

RECORD_SCHEMA = T.StructType([T.StructField(n, t, True) for n, t in RECORD_COLUMNS])
RECORD_NAMES = [n for n, _ in RECORD_COLUMNS]

# Record-level (pre-explode) relation: the table columns that do not come
# from a subject or an author, in typed form, plus the two arrays.
RECORD_LEVEL_TYPED: list[tuple[str, T.DataType]] = [
    ("doi", S),
    ("title", S),
    ("abstract", S),
    ("document_type", S),
    ("source_type", S),
    ("publication_date", T.DateType()),
    ("source_title", S),
    ("publisher", S),
    ("author_keywords", S),
    ("funding_details", S),
    ("ref_count", T.IntegerType()),
    ("open_access", T.IntegerType()),
    ("affiliation", S),
    ("language", S),
    ("cited_by", T.IntegerType()),
    ("status_state", S),
    ("delivered_date", S),
    ("subject_areas", SUBJECT_AREAS_TYPE),
    ("authors", AUTHORS_TYPE),
]
