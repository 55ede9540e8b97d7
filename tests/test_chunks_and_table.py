"""Chunk ids against brute force; keyed table upserts."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bibflow import fixtures
from bibflow.operators.chunks import assign_chunks, chunk_progress
from bibflow.operators.upsert import ORDER_COL
from bibflow.schemas import RECORD_SCHEMA
from bibflow.session import scratch_path
from bibflow.sinks.keyed_table import KeyedTable
from bibflow.sources import fs


def test_assign_chunks_equals_global_row_number(spark, sf_dir):
    ev = fixtures.table(spark, sf_dir, "events").select("event_id")
    got = assign_chunks(ev, "event_id", chunk_size=70, n_parts=7)
    brute = ev.withColumn("position", F.row_number().over(Window.orderBy("event_id"))) \
              .withColumn("chunk_id", F.floor((F.col("position") - 1) / 70))
    assert got.exceptAll(brute).count() == 0 and got.count() == brute.count()
    prog = {r.chunk_id: (r.chunk_size, r.running_total) for r in chunk_progress(got, 70).collect()}
    n = ev.count()
    assert prog[max(prog)][1] == n and all(v[0] == 70 for k, v in prog.items() if k < max(prog))


def test_chunks_over_several_columns_of_any_type(spark):
    rows = [(2015 - k % 3, f"file{k * 7 % 5}", k) for k in range(500)]
    df = spark.createDataFrame(rows, "year int, path string, pos long").repartition(6)
    got = {(r.year, r.path, r.pos): (r.position, r.chunk_id) for r in assign_chunks(df, ["year", "path", "pos"], 64).collect()}
    assert got == {row: (i + 1, i // 64) for i, row in enumerate(sorted(rows))}
    assert assign_chunks(df.limit(0), ["year", "path"], 64).count() == 0


def _rows(spark, items):
    cols = [f.name for f in RECORD_SCHEMA.fields]
    data = [tuple([doi, title] + [None] * (len(cols) - 2) + [(rank,)]) for doi, title, rank in items]
    schema = T.StructType([*RECORD_SCHEMA.fields,
                           T.StructField(ORDER_COL, T.StructType([T.StructField("r", T.IntegerType())]))])
    return spark.createDataFrame(data, schema)


def test_keyed_table_later_load_wins_and_rerun_is_idempotent(spark):
    table = KeyedTable(spark, scratch_path(spark, "t-keyed"), RECORD_SCHEMA, n_buckets=4)
    table.upsert(_rows(spark, [("a", "a1", 1), ("b", "b1", 1)]))
    batch2 = _rows(spark, [("a", "a2", 2), ("c", "c2", 2), ("b", "b0", 0)])
    table.upsert(batch2)
    first = {r.doi: r.title for r in table.read().collect()}
    assert first == {"a": "a2", "b": "b0", "c": "c2"}  # a later load wins, whatever its own order
    table.upsert(batch2)
    assert {r.doi: r.title for r in table.read().collect()} == first


def test_keyed_table_fill_nulls(spark):
    table = KeyedTable(spark, scratch_path(spark, "t-keyed-fill"), RECORD_SCHEMA, n_buckets=4,
                       fill_nulls=True)
    table.upsert(_rows(spark, [("a", "a1", 1)]))
    table.upsert(_rows(spark, [("a", None, 2), ("b", "b2", 2)]))
    assert {r.doi: r.title for r in table.read().collect()} == {"a": "a1", "b": "b2"}


def _titles(table):
    return {r.doi: r.title for r in table.read().collect()}


def test_stored_bucket_count_holds(spark):
    path = scratch_path(spark, "t-keyed-buckets")
    items = [(f"d{k}", f"t{k}", 1) for k in range(20)]
    first = KeyedTable(spark, path, RECORD_SCHEMA, n_buckets=4)
    first.upsert(_rows(spark, items))
    first.compact()
    other = KeyedTable(spark, path, RECORD_SCHEMA, n_buckets=8)
    other.upsert(_rows(spark, [(d, t + "x", 1) for d, t, _ in items]))
    other.compact()
    assert other.buckets() == 4
    assert sorted(r.title for r in other.read().collect()) == sorted(t + "x" for _, t, _ in items)


def test_empty_table_and_empty_load(spark):
    table = KeyedTable(spark, scratch_path(spark, "t-keyed-empty"), RECORD_SCHEMA, n_buckets=4)
    assert not table.exists() and table.read().count() == 0
    table.compact()
    table.upsert(_rows(spark, []))
    assert table.exists() and table.read().columns == [f.name for f in RECORD_SCHEMA.fields] and table.read().count() == 0
    table.compact()
    assert table.read().count() == 0


@pytest.mark.parametrize("compacted", [False, True])
def test_replayed_stream_batch_keeps_its_place(spark, compacted):
    table = KeyedTable(spark, scratch_path(spark, "t-keyed-replay"), RECORD_SCHEMA, n_buckets=4)
    table.upsert(_rows(spark, [("a", "a1", 1)]), writer="s", batch=0)
    table.upsert(_rows(spark, [("a", "a2", 1)]))
    if compacted:
        table.compact()
    table.upsert(_rows(spark, [("a", "a1", 1)]), writer="s", batch=0)  # a replay
    assert _titles(table) == {"a": "a2"}
    if compacted:
        table.compact()
    table.upsert(_rows(spark, [("a", "a3", 1)]), writer="other", batch=0)
    assert _titles(table) == {"a": "a3"}


def test_load_that_dies_leaves_the_table(spark):
    import os

    table = KeyedTable(spark, scratch_path(spark, "t-keyed-crash"), RECORD_SCHEMA, n_buckets=4)
    table.upsert(_rows(spark, [("a", "a1", 1), ("b", "b1", 1)]))
    bad = _rows(spark, [("a", "a2", 2)]).withColumn("title", F.raise_error(F.lit("no")).cast("string"))
    with pytest.raises(Exception, match="no"):
        table.upsert(bad)
    local = table.path.removeprefix("file:")
    os.makedirs(f"{local}/loads/load=9/origin=x/_temporary")  # a driver that died while writing
    assert _titles(table) == {"a": "a1", "b": "b1"}
    table.upsert(_rows(spark, [("a", "a2", 2)]))
    assert _titles(table) == {"a": "a2", "b": "b1"}


def test_writers_that_race_lose_nothing(spark, monkeypatch):
    """A load that ends while a compaction runs, and one that takes the same number, are both read."""
    path = scratch_path(spark, "t-keyed-race")
    one, two = (KeyedTable(spark, path, RECORD_SCHEMA, n_buckets=2) for _ in range(2))
    one.upsert(_rows(spark, [("a", "a1", 1)]))
    merged, raced = one._merged, []

    def slow(*args):
        if not raced:
            raced.append(1)
            two.upsert(_rows(spark, [("b", "b2", 1), ("a", "a2", 1)]))
        return merged(*args)

    monkeypatch.setattr(one, "_merged", slow)
    one.compact()
    assert _titles(two) == {"a": "a2", "b": "b2"}
    real = fs.children
    monkeypatch.setattr(fs, "children", lambda *a: [])  # sees no other load: number 1 again
    one.upsert(_rows(spark, [("c", "c3", 1)]))
    monkeypatch.setattr(fs, "children", real)
    assert _titles(two) == {"a": "a2", "b": "b2", "c": "c3"}
    two.compact()
    two.compact()
    assert _titles(one) == {"a": "a2", "b": "b2", "c": "c3"}


def test_compaction_runs_by_itself_and_removes_what_it_replaced(spark):
    import os

    path = scratch_path(spark, "t-keyed-clean")
    table = KeyedTable(spark, path, RECORD_SCHEMA, n_buckets=2, compact_after=2)
    for k in range(12):
        table.upsert(_rows(spark, [("a", f"a{k}", k), (f"k{k}", f"t{k}", k)]), writer="s", batch=k)
    assert _titles(table) == {"a": "a11"} | {f"k{k}": f"t{k}" for k in range(12)}
    local = path.removeprefix("file://").removeprefix("file:")
    live = [d for d in os.listdir(f"{local}/loads") if os.listdir(f"{local}/loads/{d}")]
    assert len(live) <= 7 and len([d for d in os.listdir(f"{local}/base")]) <= 2


def test_base_is_not_shuffled(spark):
    table = KeyedTable(spark, scratch_path(spark, "t-keyed-plan"), RECORD_SCHEMA, n_buckets=8)
    table.upsert(_rows(spark, [(f"d{k}", f"t{k}", 1) for k in range(50)]))
    table.compact()
    table.upsert(_rows(spark, [(f"d{k}", f"u{k}", 1) for k in range(40, 60)]))
    plan = table.read()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1, plan
    assert sorted(_titles(table).items()) == sorted([(f"d{k}", f"{'u' if k >= 40 else 't'}{k}") for k in range(60)])


def test_fill_nulls_over_compactions(spark):
    table = KeyedTable(spark, scratch_path(spark, "t-keyed-fill2"), RECORD_SCHEMA, n_buckets=2, fill_nulls=True)
    table.upsert(_rows(spark, [("a", "a1", 1), ("b", "b1", 1)]))
    table.compact()
    table.upsert(_rows(spark, [("a", None, 2)]))
    assert _titles(table) == {"a": "a1", "b": "b1"}
    table.compact()
    table.upsert(_rows(spark, [("a", "a3", 3), ("b", None, 3), (None, "no key", 3)]))
    assert _titles(table) == {"a": "a3", "b": "b1"}
