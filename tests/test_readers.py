"""File-tree readers on hand-made trees (any extension, hidden, empty)."""

import os
import tempfile

from bibflow.operators import reports as R
from bibflow.session import scratch_path
from bibflow.sources import files as SF


def make_tree():
    base = tempfile.mkdtemp(prefix="bibflow-tree-")
    def put(rel, text):
        p = os.path.join(base, rel)
        os.makedirs(os.path.dirname(p), exist_ok=True)
        with open(p, "w", encoding="utf-8") as f:
            f.write(text)
    put("2014/a.json", '[{"id":1},{"id":2}]')
    put("2014/noext", '{"id":3}\n{"id":4}')
    put("2015/b.data.txt", '{\n "id": 5\n}{"id":"}"}')
    put("2015/.hidden.json", '{"id":99}')
    put("2015/empty.json", "")
    put("2016/c.json", '{"id":7}{"id":')
    put("notayear/d.json", '{"id":8}')
    return base


def test_scan_all_years_any_extension(spark):
    base = make_tree()
    split = SF.read_file_records(spark, base)
    rows = SF.parse_records(split, "id STRING", keep=("year",)).collect()
    got = sorted(((r.year or 0), r.id) for r in rows)
    assert got == sorted([(2014, "1"), (2014, "2"), (2014, "3"), (2014, "4"), (2015, "5"),
                          (2015, "}"), (2016, "7"), (0, "8")])
    errs = SF.quarantine(split).collect()
    assert [(e.year, e.error) for e in errs] == [(2016, "unterminated")]


def test_year_filter_and_glob(spark):
    base = make_tree()
    split = SF.read_file_records(spark, base, years=[2014, 2015], name_glob="*.json")
    ids = sorted(r.id for r in SF.parse_records(split, "id STRING").collect())
    assert ids == ["1", "2"]


def test_missing_base_is_one_error(spark):
    import pytest
    with pytest.raises(FileNotFoundError):
        SF.read_file_records(spark, "/nonexistent/base/dir")


def test_file_status(spark):
    base = make_tree()
    st = {os.path.basename(r.file_path): r.status for r in SF.file_status(SF.read_file_records(spark, base)).collect()}
    assert st["c.json"] == "truncated" and st["a.json"] == "ok"


def test_year_audit_and_empty_files(spark):
    base = make_tree()
    audit = {r.year: r.status for r in R.year_audit(spark, base, 2013, 2016).collect()}
    assert audit == {2013: "missing", 2014: "ok", 2015: "ok", 2016: "ok"}
    empties = R.empty_files(spark, f"{base}/*/*").collect()
    assert [os.path.basename(e.file_path) for e in empties] == ["empty.json"]


def test_ndjson_lines_quarantine(spark):
    base = tempfile.mkdtemp(prefix="bibflow-nd-")
    with open(os.path.join(base, "x.json"), "w") as f:
        f.write('{"id":1}\n\n{"id": bad}\n{"id":3}\n')
    split = SF.read_ndjson_records(spark, f"{base}/*")
    assert sorted(r.id for r in SF.parse_records(split, "id INT", keep=()).collect()) == [1, 3]
    assert SF.quarantine(split).count() == 1


def test_json_documents_native_reader(spark):
    base = tempfile.mkdtemp(prefix="bibflow-docs-")
    for name, text in [("a.json", '[{"id":1},{"id":2}]'), ("b.json", '{"id":3}'), ("c.json", '[{"id":4},')]:
        with open(os.path.join(base, name), "w") as f:
            f.write(text)
    docs = SF.read_json_documents(spark, f"{base}/*", "id INT")
    assert sorted(r.id for r in docs.filter("error IS NULL").collect()) == [1, 2, 3]
    # A count prunes the scan to the error flag: must not hit Spark's
    # corrupt-record-only restriction.
    assert docs.filter("error IS NULL").count() == 3
    bad = docs.filter("error IS NOT NULL").collect()
    assert len(bad) == 1 and bad[0].file_path.endswith("c.json")


def test_split_files_array_layout(spark):
    base = tempfile.mkdtemp(prefix="bibflow-arr-")
    with open(os.path.join(base, "a.json"), "w") as f:
        f.write('[{"id":1},\n {"id":2}, "x"]')
    split = SF.split_files(SF.read_texts(spark, f"{base}/*"))
    assert sorted((r.rec_pos, r.error) for r in split.collect()) == [(0, None), (1, None), (2, "not_object")]


def test_all_years_ok(spark):
    base = make_tree()
    assert R.all_years_ok(R.year_audit(spark, base, 2014, 2016)).first().all_ok is True
    assert R.all_years_ok(R.year_audit(spark, base, 2013, 2016)).first().all_ok is False


def test_lines_layout_tree_with_year_and_name_filter(spark):
    base = tempfile.mkdtemp(prefix="bibflow-lines-")
    for rel, text in [("2014/a.json", '{"id":1}\n{"id":2}\n'), ("2014/b.txt", '{"id":3}\n'),
                      ("2015/c.json", '{"id":4}\nnot json\n'), ("2016/d.json", '{"id":5}\n')]:
        os.makedirs(os.path.dirname(os.path.join(base, rel)), exist_ok=True)
        with open(os.path.join(base, rel), "w") as f:
            f.write(text)
    split = SF.read_tree_records(spark, base, years=[2014, 2015], name_glob="*.json", layout="lines")
    assert sorted(r.id for r in SF.parse_records(split, "id INT").collect()) == [1, 2, 4]
    assert [r.year for r in SF.quarantine(split).collect()] == [2015]
    rows = SF.parse_records(split, "id INT").orderBy("file_path", "block", "rec_pos").collect()
    assert [r.id for r in rows] == [1, 2, 4]


def test_requested_years_partly_or_wholly_missing(spark):
    base = make_tree()
    split = SF.read_file_records(spark, base, years=[2010, 2014, 2030])
    assert sorted(r.id for r in SF.parse_records(split, "id STRING").collect()) == ["1", "2", "3", "4"]
    assert SF.read_file_records(spark, base, years=[1990, 1991]).count() == 0
    assert SF.read_tree_records(spark, base, years=[1990], layout="lines").count() == 0
    assert SF.year_paths(base, [2014, 2015]).endswith("/{2014,2015}/*")


def test_json_documents_empty_array_and_positions(spark):
    base = tempfile.mkdtemp(prefix="bibflow-docs2-")
    for name, text in [("a.json", '[{"id":1},{"id":2},{"id":3}]'), ("b.json", "[]"), ("c.json", "{bad")]:
        with open(os.path.join(base, name), "w") as f:
            f.write(text)
    docs = SF.read_json_documents(spark, f"{base}/*", "id INT")
    rows = sorted((os.path.basename(r.file_path), r.rec_pos, r.id, r.error) for r in docs.collect())
    assert rows == [("a.json", 0, 1, None), ("a.json", 1, 2, None), ("a.json", 2, 3, None),
                    ("c.json", None, None, "malformed_file")]


def test_feed_trees_hold_a_bounded_number_of_files(spark):
    """The number of a year's files, so of a stream's batches, does not grow with the tasks that make the feed."""
    from pyspark.sql import functions as F

    from bibflow import fixtures

    records = spark.range(0, 20000, 1, 40).select(F.col("id").alias("seq"), F.col("id").cast("string").alias("record"), (1990 + F.col("id") % 3).cast("int").alias("year"))
    base = scratch_path(spark, "t-bounded")
    fixtures._by_year(records).select("record", "year").write.partitionBy("year").text(base)
    files = spark.read.text(base).select("_metadata.file_path", "value", "year")
    per_year = {r.year: (r.n, r.rows) for r in files.groupBy("year").agg(
        F.countDistinct("file_path").alias("n"), F.count("value").alias("rows")).collect()}
    assert set(per_year) == {1990, 1991, 1992} and sum(rows for _, rows in per_year.values()) == 20000
    assert all(1 <= n <= fixtures.FILES_PER_YEAR for n, _ in per_year.values())
