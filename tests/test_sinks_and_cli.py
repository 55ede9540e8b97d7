"""K05 raw-row write and the command line ingest."""

import json

from bibflow import fixtures
from bibflow.plans import pipelines as P
from bibflow.session import scratch_path
from bibflow.schemas import RECORD_SCHEMA
from bibflow.sinks.keyed_table import KeyedTable, write_exploded


def test_write_exploded_partitions_by_year(spark, sf_dir):
    rows = P.exploded_rows(P.nested_relation(fixtures.nested_records(spark, sf_dir)))
    path = scratch_path(spark, "t-k05")
    write_exploded(rows, path)
    back = spark.read.parquet(path)
    assert back.count() == rows.count()
    years = {r.year for r in back.select("year").distinct().collect()}
    assert years and all(1990 < y < 2010 for y in years)
    assert back.filter("year = 1997").count() == rows.filter("publication_date LIKE '1997-%'").count()


def test_cli_ingest_both_feeds(spark, sf_dir, capsys):
    from bibflow.__main__ import main
    nested = fixtures.write_nested_tree(spark, sf_dir, scratch_path(spark, "t-cli-nested"))
    table = scratch_path(spark, "t-cli-table")
    main(["ingest", "--nested", nested, "--table", table, "--buckets", "4"])
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    expected = P.nested_pipeline(fixtures.nested_records(spark, sf_dir))
    assert out["nested"]["records_kept"] == expected.count()
    got = KeyedTable(spark, table, RECORD_SCHEMA).read()
    assert got.exceptAll(expected).count() == 0


def test_ingest_tree_quarantine_rerun_is_idempotent(spark):
    import os
    import tempfile

    from bibflow.plans.jobs import ingest_tree
    from bibflow.schemas import RECORD_SCHEMA
    from bibflow.sinks.keyed_table import KeyedTable

    base = tempfile.mkdtemp(prefix="bibflow-q-")
    os.makedirs(os.path.join(base, "2015"))
    rec = ('{"abstracts-retrieval-response":{"coredata":{"prism:doi":"d","subtypeDescription":"Article",'
           '"prism:aggregationType":"Journal"}}}')
    with open(os.path.join(base, "2015", "a.json"), "w") as f:
        f.write(rec + '{"broken" "x"}' + rec.replace('"d"', '"e"'))
    table = KeyedTable(spark, scratch_path(spark, "t-q-tbl"), RECORD_SCHEMA, n_buckets=2)
    qpath = scratch_path(spark, "t-q-path")
    for _ in range(2):
        res = ingest_tree(spark, base, table, "nested", quarantine_path=qpath)
    assert (res.records_read, res.records_kept, res.quarantined) == (2, 2, 1)
    assert spark.read.parquet(qpath).count() == 1
    assert sorted(r.doi for r in table.read().collect()) == ["d", "e"]


def test_document_layout_equals_whole_layout(spark, sf_dir):
    """Per-record / array files through the JVM reader give the same table."""
    from pyspark.sql import functions as F

    from bibflow.operators.upsert import ORDER_COL
    from bibflow.plans.jobs import tree_pipeline

    recs = fixtures.nested_records(spark, sf_dir)
    base = scratch_path(spark, "t-docs")
    # One JSON array of records per (year, key bucket) file.
    (recs.groupBy("year", (F.col("seq") % 16).alias("g"))
         .agg(F.concat(F.lit("["), F.array_join(F.collect_list("record"), ","), F.lit("]")).alias("value"))
         .select("value", "year").write.option("maxRecordsPerFile", 1).partitionBy("year").text(base))
    docs = tree_pipeline(spark, base, "nested", layout="document").drop(ORDER_COL)
    whole = tree_pipeline(spark, base, "nested", layout="whole").drop(ORDER_COL)
    expected = P.nested_pipeline(recs)
    assert docs.count() == expected.count()
    assert docs.exceptAll(expected).count() == 0 and whole.exceptAll(docs).count() == 0


def test_ingest_tree_document_layout_counters(spark, sf_dir):
    import os
    import tempfile

    from bibflow.plans.jobs import ingest_tree
    from bibflow.schemas import RECORD_SCHEMA
    from bibflow.sinks.keyed_table import KeyedTable

    base = tempfile.mkdtemp(prefix="bibflow-doc-")
    os.makedirs(os.path.join(base, "2015"))
    rec = ('{"abstracts-retrieval-response":{"coredata":{"prism:doi":"%s","subtypeDescription":"%s",'
           '"prism:aggregationType":"Journal"}}}')
    for name, text in [("a.json", "[%s,%s]" % (rec % ("d", "Article"), rec % ("e", "Conference Paper"))),
                       ("b.json", rec % ("f", "Article")), ("c.json", "[{broken")]:
        with open(os.path.join(base, "2015", name), "w") as f:
            f.write(text)
    table = KeyedTable(spark, scratch_path(spark, "t-doc-tbl"), RECORD_SCHEMA, n_buckets=2)
    res = ingest_tree(spark, base, table, "nested", layout="document")
    assert (res.records_read, res.records_kept, res.quarantined) == (3, 2, 1)
    assert sorted(r.doi for r in table.read().collect()) == ["d", "f"]


def test_write_exploded_shuffles_the_records_not_their_fan_out(spark):
    """Only what stands before the fan-out is shuffled, and no task sorts its rows; the rows are those of the plain fan-out."""
    author = '{"preferred-name":{"ce:given-name":"g%d"},"affiliation":{"@id":"%d","city":null}}'
    text = ('{"abstracts-retrieval-response":{"coredata":{"prism:doi":"d%d","subtypeDescription":"Article","prism:aggregationType":'
            '"Journal","prism:coverDate":"%d-01-02"},"subject-areas":{"subject-area":[{"@code":"1","x":null},null]},"authors":{"author":[%s]}}}')
    records = [(text % (n, 1990 + n % 3, ",".join(author % (k, k) for k in range(n))),) for n in range(6)]
    kept = P.nested_relation(spark.createDataFrame(records, "record STRING"))
    seen = []

    def fan_out(df, keep):
        seen.append(df._jdf.queryExecution().optimizedPlan().toString())
        return P.exploded_rows(df, keep=keep)

    path = scratch_path(spark, "t-k05-records")
    write_exploded(kept, path, fan_out=fan_out)
    assert "RepartitionByExpression" in seen[0] and "explode" not in seen[0]
    back = spark.read.parquet(path).select(*[f.name for f in RECORD_SCHEMA.fields])
    want = P.exploded_rows(kept)
    assert back.count() == want.count() == 2 * (1 + 1 + 2 + 3 + 4 + 5)
    assert back.exceptAll(want).count() == 0
    assert {r.author_affiliation for r in back.collect()} == {None, *('{"@id":"%d"}' % k for k in range(5))}
