"""Nothing a feed holds is lost unreported: every record is read or set aside, and empty loads finish."""

import os
import tempfile
import time

import pytest
from pyspark.sql import functions as F

from bibflow.functions import safe_int
from bibflow.plans.jobs import ingest_both, ingest_tree
from bibflow.schemas import RECORD_SCHEMA
from bibflow.session import scratch_path
from bibflow.sinks.keyed_table import KeyedTable
from bibflow.sources import files as SF
from bibflow.sources.json_text import split_records

REC = ('{"abstracts-retrieval-response":{"coredata":{"prism:doi":"%s","dc:title":"%s","subtypeDescription":"Article",'
       '"prism:aggregationType":"%s"}}}')


def tree(files: dict[str, str]) -> str:
    base = tempfile.mkdtemp(prefix="bibflow-tree-")
    for name, text in files.items():
        os.makedirs(os.path.dirname(os.path.join(base, name)), exist_ok=True)
        with open(os.path.join(base, name), "w") as f:
            f.write(text)
    return base


def counts(split):
    return {r.status: r["n"] for r in split.groupBy(F.coalesce("error", F.lit("ok")).alias("status")).agg(F.count("*").alias("n")).collect()}


def test_lines_that_are_not_one_object_are_set_aside(spark):
    lines = ['{"a":1}', '{"a":1}{"b":2}', '{"a":1} {"b":2}', '{"a":1},{"b":2}', '{"c":3} trailing', '["x"]', '{"d":"]["}', "", '{"e":{"f":[1]}}']
    base = tree({"2015/a.json": "\n".join(lines)})
    split = SF.read_tree_records(spark, base, layout="lines")
    assert sorted(r.record for r in SF.good(split).collect()) == ['{"a":1}', '{"d":"]["}', '{"e":{"f":[1]}}']
    assert counts(split) == {"ok": 3, "malformed": 5}
    assert counts(SF.read_tree_records(spark, base, layout="whole"))["ok"] == 10  # the splitter reads them all


def test_documents_with_a_second_value_are_set_aside(spark):
    base = tree({"a.json": '{"id":1}', "b.json": '{"id":1}{"id":2}', "c.json": '[{"id":1}][{"id":2}]', "d.json": ' [{"id":3},null]\n',
                 "g.json": '[{"id":3},5]', "e.json": '[{"id":1}] x', "f.json": '{"id":7} \n'})
    docs = SF.read_json_documents(spark, f"{base}/*", "id INT")
    assert {(os.path.basename(r.file_path), r.id, r.error) for r in docs.collect() if r.error != "malformed_file"} == {
        ("a.json", 1, None), ("d.json", 3, None), ("d.json", None, "not_object"), ("f.json", 7, None)}
    bad = [r for r in docs.collect() if r.error == "malformed_file"]
    assert sorted(os.path.basename(r.file_path) for r in bad) == ["b.json", "c.json", "e.json", "g.json"]
    assert all(r.record for r in bad)


@pytest.mark.parametrize("layout", ["whole", "lines"])
def test_hidden_names_are_reported(spark, layout):
    base = tree({"2015/a.json": '{"a":1}', "2015/_z.json": '{"b":2}', "2015/_SUCCESS": "", "2016/_y.txt": '{"c":3}'})
    assert counts(SF.read_tree_records(spark, base, layout=layout)) == {"ok": 1, "hidden_name": 2}
    assert counts(SF.read_tree_records(spark, base, name_glob="*.json", layout=layout)) == {"ok": 1, "hidden_name": 1}
    assert counts(SF.read_tree_records(spark, base, years=[2016], layout=layout)) == {"hidden_name": 1}


@pytest.mark.parametrize("layout", ["whole", "lines", "document"])
def test_loads_without_survivors_finish(spark, layout):
    table = KeyedTable(spark, scratch_path(spark, f"t-none-{layout}"), RECORD_SCHEMA, n_buckets=2)
    filtered = tree({"2015/a.json": REC % ("d", "t", "Conference Proceeding")})
    malformed = tree({"2015/a.json": "{broken"})
    nothing = tree({"2015/empty.json": ""})
    q = scratch_path(spark, f"t-none-q-{layout}")
    results = [ingest_tree(spark, b, table, "nested", layout=layout, quarantine_path=q) for b in (filtered, malformed, nothing)]
    assert [(r.records_read, r.records_kept, r.quarantined) for r in results] == [(1, 0, 0), (0, 0, 1), (0, 0, 0)]
    assert table.exists() and table.read().count() == 0


def test_both_feeds_and_reload(spark):
    nested = tree({"2015/a.json": REC % ("d", "old", "Journal") + REC % ("e", "kept", "Journal")})
    flat = ('[{"prism:doi":"d","dc:title":"scraped","subtypeDescription":"Article","prism:aggregationType":"Journal"},'
            '{"prism:doi":"x","dc:title":"out of range"}]')
    scraped = tree({"2014/a.json": flat, "2014/b.txt": flat, "2030/c.json": flat})
    table = KeyedTable(spark, scratch_path(spark, "t-both"), RECORD_SCHEMA, n_buckets=2)
    out = ingest_both(spark, nested, scraped, table)
    assert (out["nested"].records_kept, out["scraped"].records_read, out["scraped"].records_kept) == (2, 2, 1)
    assert {r.doi: r.title for r in table.read().collect()} == {"d": "scraped", "e": "kept"}
    ingest_tree(spark, tree({"2013/z.json": REC % ("e", "corrected", "Journal")}), table, "nested")
    assert {r.doi: r.title for r in table.read().collect()} == {"d": "scraped", "e": "corrected"}


def test_safe_int_takes_decimals_only(spark):
    texts = ["12", " 7 ", "12.0", "-3.9", "+5", ".5", "12d", "12f", "1e3", "0x1p3", "", "x", "99999999999", "1.2.3", None, "NaN", "00012"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(safe_int("t")).collect()] == [12, 7, 12, -3, 5, 0] + [None] * 10 + [12]


def test_splitter_is_linear_on_bad_input_and_survives_deep_nesting():
    good = '{"a": 1, "b": {"c": [1,2,3]}, "t": "some text here with {braces}"}\n'
    times = {}
    for name, text in (("good", good), ("bad", good.replace("3]", "]")), ("junk", "junk " + good)):
        for n in (4000, 16000):
            start = time.perf_counter()
            list(split_records(text * n))
            times[name, n] = time.perf_counter() - start
    assert times["bad", 16000] < 8 * times["bad", 4000] + 0.2 and times["junk", 16000] < 8 * times["junk", 4000] + 0.2
    bomb = '{"x":' + "[" * 100_000 + "]" * 100_000 + "}"
    assert [e for _, _, e in split_records('{"a":1}' + bomb + '{"b":2}')] == [None, "malformed", None]
    assert [e for _, _, e in split_records('{"a":1} 5 "x{y" true {"b":tru} [1,{"c":2}] nope {"d":4}')] == [
        None, "not_object", "not_object", "not_object", "malformed", "not_object", None, "malformed", None]
