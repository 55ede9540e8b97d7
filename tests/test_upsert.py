"""Keyed latest-per-DOI: the pre-explode shortcut equals brute force."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from bibflow import fixtures
from bibflow.operators.flatten import cross_explode, filter_records, to_table_rows
from bibflow.operators.upsert import latest_per_key, upsert_records
from bibflow.plans import pipelines as P


def test_pick_before_explode_equals_explode_then_rank(spark, sf_dir):
    rel = filter_records(P.nested_relation(fixtures.nested_records(spark, sf_dir), keep=["seq"]))
    fast = upsert_records(rel, order=["seq"])
    ex = cross_explode(rel)
    w = Window.partitionBy("doi").orderBy(F.col("seq").desc(), F.col("subject").desc(),
                                          F.col("author").desc())
    brute = to_table_rows(ex.withColumn("rn", F.row_number().over(w)).filter("rn = 1"))
    assert fast.count() == brute.count()
    assert fast.exceptAll(brute).count() == 0


def test_latest_per_key_total_order(spark):
    df = spark.createDataFrame([(1, 1, 5, "a"), (1, 2, 1, "b"), (1, 2, 3, "c"), (2, None, 1, "d"),
                                (2, 0, 0, "e")], "k INT, ts INT, id INT, v STRING")
    got = {r.k: r.v for r in latest_per_key(df, "k", ["ts", "id"]).collect()}
    assert got == {1: "c", 2: "e"}


def test_later_feed_wins_shared_doi(spark):
    nested = ('{"abstracts-retrieval-response":{"coredata":{"prism:doi":"x","dc:title":"from nested",'
              '"subtypeDescription":"Article","prism:aggregationType":"Journal"}}}')
    flat = '{"prism:doi":"x","dc:title":"from scraped","subtypeDescription":"Article","prism:aggregationType":"Journal"}'
    a = spark.createDataFrame([(1, nested)], "seq LONG, record STRING")
    b = spark.createDataFrame([(1, flat)], "seq LONG, record STRING")
    out = P.merged_pipeline(a, b).collect()
    assert len(out) == 1 and out[0]["title"] == "from scraped"


def test_plan_has_partial_aggregation(spark, sf_dir):
    rel = filter_records(P.nested_relation(fixtures.nested_records(spark, sf_dir), keep=["seq"]))
    plan = upsert_records(rel, order=["seq"])._jdf.queryExecution().executedPlan().toString()
    # max_by is split into a map-side partial and a final aggregate around the
    # shuffle, so a hot DOI is reduced before it is shuffled.
    assert plan.count("Aggregate") >= 2


def test_fill_nulls_keeps_earlier_values(spark):
    nested = ('{"abstracts-retrieval-response":{"coredata":{"prism:doi":"x","dc:title":"n","dc:publisher":"P",'
              '"subtypeDescription":"Article","prism:aggregationType":"Journal"},'
              '"subject-areas":{"subject-area":{"@code":"9"}}}}')
    flat = '{"prism:doi":"x","dc:title":"s","subtypeDescription":"Article","prism:aggregationType":"Journal"}'
    a = spark.createDataFrame([(1, nested)], "seq LONG, record STRING")
    b = spark.createDataFrame([(1, flat)], "seq LONG, record STRING")
    whole = P.merged_pipeline(a, b).first()
    filled = P.merged_pipeline(a, b, fill_nulls=True).first()
    assert whole["title"] == "s" and whole["publisher"] is None and whole["subject_code"] is None
    assert filled["title"] == "s" and filled["publisher"] == "P" and filled["subject_code"] == "9"


def test_hot_doi_holding_a_third_of_records(spark, sf_dir):
    """One DOI shared by a third of all records: still one row, the latest."""
    recs = fixtures.nested_records(spark, sf_dir)
    hot = F.regexp_replace("record", r'"prism:doi":"[^"]*"', '"prism:doi":"10.9999/hot"')
    skewed = recs.withColumn("record", F.when(F.col("seq") % 3 == 0, hot).otherwise(F.col("record")))
    rel = filter_records(P.nested_relation(skewed, keep=["seq"]))
    fast = upsert_records(rel, order=["seq"])
    w = Window.partitionBy("doi").orderBy(F.col("seq").desc(), F.col("subject").desc(),
                                          F.col("author").desc())
    brute = to_table_rows(cross_explode(rel).withColumn("rn", F.row_number().over(w)).filter("rn = 1"))
    assert fast.filter("doi = '10.9999/hot'").count() == 1
    assert fast.count() == brute.count() and fast.exceptAll(brute).count() == 0
    n_hot = rel.filter("doi = '10.9999/hot'").count()
    assert n_hot > rel.count() / 4
    plan = fast._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan


def test_fill_nulls_shuffles_rows_once_without_the_order_per_column(spark):
    """Before the shuffle nothing is aggregated per column (each buffer would carry the whole order); results follow the order."""
    from bibflow.operators.upsert import latest_per_key

    rows = [("a", 1, "x" * 50, "old", None, 1), ("a", 2, "y", None, "b2", None), ("a", 2, "z", "new", None, None),
            (None, 1, "n", None, None, 5), (None, 3, "m", "null key", None, None), ("b", 7, "q", None, None, None)]
    df = spark.createDataFrame(rows, "k STRING, seq INT, text STRING, c STRING, d STRING, e INT")
    got = latest_per_key(df, "k", ["seq", "text"], columns=["c", "d", "e", "text"], fill_nulls=["c", "d", "e"])
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [("a", "new", "b2", 1, "z"), (None, "null key", None, 5, "m"), ("b", None, None, None, "q")], key=str)
    plan = got._jdf.queryExecution().sparkPlan().toString()
    shuffled = got._jdf.queryExecution().executedPlan().toString().split("Exchange", 1)[1]
    assert "max_by" in plan and "max_by" not in shuffled.split("== Initial Plan ==")[0]
