"""What the record pipelines move and compute per record, told from their plans, and that the rows stay the same."""

from pyspark.sql import functions as F

from bibflow import fixtures
from bibflow.operators.upsert import ORDER_COL, keyed_rows
from bibflow.plans import pipelines as P
from bibflow.schemas import RECORD_NAMES, RECORD_SCHEMA
from bibflow.session import scratch_path
from bibflow.sinks.keyed_table import KeyedTable


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _records(spark, rows):
    rel = '{"abstracts-retrieval-response":{"coredata":{"prism:doi":"%s","dc:title":"%s"},"authors":{"author":[%s]}}}'
    data = [(seq, rel % (doi, title, ",".join('{"author-url":"%s"}' % a for a in authors))) for seq, doi, title, authors in rows]
    return P.nested_relation(spark.createDataFrame(data, "seq LONG, record STRING"), keep=["seq"])


def test_reduction_takes_subject_and_author_from_the_order(spark):
    records = _records(spark, [(1, "a", "old", ["z"]), (2, "a", "new", ["x", "y"]), (3, "b", "only", []), (None, "b", "no place", ["q"])])
    out = keyed_rows(records, ["seq"])
    assert out.columns == [ORDER_COL, *RECORD_NAMES]
    assert {r.doi: (r.title, r.author_url, r[ORDER_COL].seq) for r in out.collect()} == {"a": ("new", "y", 2), "b": ("only", None, 3)}
    shuffled = next(x for x in out._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Aggregate [doi" in x)
    assert "max_by(" in shuffled and "subject, subject" not in shuffled, shuffled


def test_reduction_orders_by_columns_and_expressions(spark):
    records = _records(spark, [(1, "a", "first", ["u"]), (2, "a", "second", ["u"]), (2, "a", "second", ["v"])])
    assert [(r.title, r.author_url) for r in keyed_rows(records, ["seq"]).collect()] == [("second", "v")]
    assert [r.title for r in keyed_rows(records, [F.lit(1), -F.col("seq")]).collect()] == ["first"]


def test_raw_members_are_appended_by_bytes(spark):
    df = spark.createDataFrame([('{"a":"é\U0001f600}"}',), ("{}",), (None,)], "o STRING")
    out = df.select(fixtures._append_raw(F.col("o"), k=F.lit("[1]")).alias("t"))
    assert [r.t for r in out.collect()] == ['{"a":"é\U0001f600}","k":[1]}', '{,"k":[1]}', None]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "octet_length" in plan and " length(" not in plan, plan


def _tables(spark):
    """Repeated lines, an order without lines, keys that are null, that no part or supplier has, or that two have."""
    d = scratch_path(spark, "growth")
    put = lambda name, rows, schema: spark.createDataFrame(rows, schema).write.parquet(f"{d}/{name}.parquet")
    put("lineitem", [(1, 10, 7), (1, 10, 7), (1, 11, 8), (2, 12, None), (2, None, 9), (None, 10, 7)], "l_orderkey LONG, l_partkey LONG, l_suppkey LONG")
    put("part", [(10, "B", "n10"), (11, "B", "n11"), (11, "C", "n11"), (None, "D", "none")], "p_partkey LONG, p_brand STRING, p_name STRING")
    put("supplier", [(7, "s7", 1), (8, "s8", None), (8, "s8", 2)], "s_suppkey LONG, s_name STRING, s_nationkey INT")
    return d


def test_lines_are_grouped_after_their_shuffle(spark):
    lines = fixtures.order_lines(spark, _tables(spark))
    shuffled = _plan(lines).split("REPARTITION_BY_COL")
    got = {r.l_orderkey: r for r in lines.collect()}
    assert [(s["@code"], s["@abbrev"]) for s in got[1].subjects] == [("10", "B"), ("11", "B"), ("11", "C")]
    assert {k: r.n_lines for k, r in got.items()} == {1: 6, 2: 2, None: 1}
    assert len(shuffled) == 2 and "partial_collect_set" in shuffled[0] and "Aggregate" not in shuffled[1], shuffled


def test_authors_alone_need_no_parts(spark):
    d = _tables(spark)
    authors = fixtures.order_authors(spark, d)
    assert authors.exceptAll(fixtures.order_lines(spark, d).select("l_orderkey", "authors")).count() == 0 and authors.count() == 3
    spark.createDataFrame([(1, 5, "O", "2001-02-03", "1-URGENT"), (3, 5, "P", "2001-02-03", "5-LOW")],
                          "o_orderkey LONG, o_custkey LONG, o_orderstatus STRING, o_orderdate STRING, o_orderpriority STRING").select(
        "*", F.lit(1.0).alias("o_totalprice")).withColumn("o_orderdate", F.to_timestamp("o_orderdate")).write.parquet(f"{d}/orders.parquet")
    records = fixtures.scraped_records(spark, d)
    assert "p_partkey" not in _plan(records)
    assert sorted((r.seq, r.record.count('"@auid"')) for r in records.collect()) == [(1, 3), (3, 0)]


def test_table_reads_the_columns_asked_for(spark):
    table = KeyedTable(spark, scratch_path(spark, "t-columns"), RECORD_SCHEMA, n_buckets=2)
    assert table.read(["title"]).columns == ["title"] and table.read(["title"]).count() == 0
    table.upsert(keyed_rows(_records(spark, [(1, "a", "a1", ["u"]), (2, "b", "b1", [])]), ["seq"]), unique=True)
    table.upsert(keyed_rows(_records(spark, [(1, "a", "a2", [])]), ["seq"]), unique=True)
    for _ in range(2):
        some = table.read(["title", "doi"])
        assert some.columns == ["title", "doi"] and sorted(map(tuple, some.collect())) == [("a2", "a"), ("b1", "b")]
        assert [r.title for r in table.read(["title"]).orderBy("title").collect()] == ["a2", "b1"]
        assert "author_details" not in _plan(some) and some.exceptAll(table.read().select("title", "doi")).count() == 0
        table.compact()
        table.upsert(keyed_rows(_records(spark, [(1, "a", "a2", [])]), ["seq"]), unique=True)
