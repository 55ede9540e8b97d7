"""Filters and the fan-out."""

import itertools

from pyspark.sql import functions as F

from bibflow.operators import flatten as FL
from bibflow.plans import pipelines as P


def test_type_agreement_nine_null_combinations(spark):
    vals = ["Conference Paper", "Article", None]
    srcs = ["Conference Proceeding", "Journal", None]
    rows = list(itertools.product(vals, srcs))
    df = spark.createDataFrame(rows, "document_type STRING, source_type STRING")
    kept = {tuple(r) for r in FL.type_agreement(df).collect()}
    assert kept == {("Conference Paper", "Conference Proceeding"), ("Article", "Journal")}


def test_key_not_null_keeps_empty_string(spark):
    df = spark.createDataFrame([("",), (None,), ("x",)], "doi STRING")
    assert sorted(r[0] for r in FL.key_not_null(df).collect()) == ["", "x"]


NESTED = ('{"abstracts-retrieval-response":{"coredata":{"prism:doi":"%s","subtypeDescription":"Article",'
          '"prism:aggregationType":"Journal"},"subject-areas":{"subject-area":%s},"authors":{"author":%s}}}')


def test_zero_subjects_zero_authors_and_object_vs_array(spark):
    recs = [
        (1, NESTED % ("d1", "[]", "[]")),
        (2, NESTED % ("d2", '{"@code":"7"}', '{"preferred-name":{"ce:surname":"s"}}')),
        (3, NESTED % ("d3", '[{"@code":"1"},{"@code":"2"}]',
                      '[{"author-url":"u1"},{"author-url":"u2"},{"author-url":"u3"}]')),
    ]
    df = spark.createDataFrame(recs, "seq LONG, record STRING")
    rows = P.exploded_rows(P.nested_relation(df, keep=["seq"]), keep=["seq"])
    counts = {r[0]: r[1] for r in rows.groupBy("seq").count().collect()}
    assert counts == {1: 1, 2: 1, 3: 6}
    one = rows.filter("seq = 2").first()
    assert one["subject_code"] == "7" and one["author_surname"] == "s"
    empty = rows.filter("seq = 1").first()
    assert empty["subject_area"] is None and empty["author_details"] is None


def test_filter_before_explode_equals_filter_after(spark, sf_dir):
    from bibflow import fixtures
    rel = P.nested_relation(fixtures.nested_records(spark, sf_dir), keep=["seq"])
    before = FL.to_table_rows(FL.cross_explode(FL.filter_records(rel)), keep=["seq"])
    after = FL.to_table_rows(FL.cross_explode(rel), keep=["seq"]).filter(
        F.col("doi").isNotNull() & FL.type_agreement_predicate())
    assert before.exceptAll(after).count() == 0 and after.exceptAll(before).count() == 0
