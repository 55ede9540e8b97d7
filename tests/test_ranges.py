"""Files read in ranges give the records that the splitter gives on the whole text."""

import json
import os
import random
import tempfile

import numpy as np
import pytest

from bibflow.sources import ranges as R
from bibflow.sources.files import read_range_records, read_texts, split_files
from bibflow.sources.json_text import split_part, split_records


def some_text(rng, n, pretty=True):
    def value(depth):
        kind = rng.randrange(6)
        if kind == 0:
            return "".join(rng.choices('ab{}[]"\\,: é\n\t', k=rng.randint(0, 12)))
        if kind == 1 and depth:
            return [value(depth - 1) for _ in range(rng.randint(0, 3))]
        if kind == 2 and depth:
            return {"".join(rng.choices('k"}\\', k=3)): value(depth - 1) for _ in range(rng.randint(0, 3))}
        return rng.choice([1, -2.5, True, None, "x" * rng.randint(0, 40)])

    out = ""
    for _ in range(n):
        rec = {"id": rng.randrange(1000), "v": value(3)}
        out += json.dumps(rec, indent=rng.choice([None, 2]) if pretty else None, ensure_ascii=rng.random() < 0.5)
        out += rng.choice(["", "\n", " ", ",\n", "\r\n\r\n"])
    return out


def test_maps_compose_to_the_map_of_the_whole():
    rng = random.Random(1)
    for _ in range(300):
        text = "".join(rng.choices('{}[]"\\\\a ,\n', k=rng.randint(1, 60))).encode()
        whole = R.state_map(text)
        cuts = sorted(rng.choices(range(len(text) + 1), k=3))
        total = R.state_map(b"")
        for a, b in zip([0, *cuts], [*cuts, len(text)]):
            total = R.then(total, R.state_map(text[a:b]))
        assert total == whole
        for (s, e), move in whole.items():  # against a walk, byte by byte
            for start in (0, 1, 2, 5):
                inside, escaped, depth, odd = s, e, start, False
                for c in text:
                    if not inside and depth == 0 and not R._AT_ZERO[c]:
                        odd = True
                    if escaped:
                        escaped = 0
                        if not inside:
                            depth = max(0, depth + int(R._STEP[c]))
                        continue
                    if c == 0x5C:
                        escaped = 1
                    elif c == 0x22:
                        inside ^= 1
                    elif not inside:
                        depth = max(0, depth + int(R._STEP[c]))
                if not odd:
                    assert (move.s, move.e) == (inside, escaped)
                    assert max(start, -move.m) + move.d == depth and not start <= move.o


def tree(files):
    base = tempfile.mkdtemp(prefix="bibflow-ranges-")
    os.makedirs(f"{base}/2015")
    for name, text in files.items():
        with open(f"{base}/2015/{name}", "wb") as f:
            f.write(text if isinstance(text, bytes) else text.encode())
    return base


def in_order(rows):
    return [(os.path.basename(r.file_path), r.record, r.error) for r in sorted(rows, key=lambda r: (r.file_path, r.block, r.rec_pos))]


@pytest.mark.parametrize("range_bytes", [200, 4096])
def test_ranges_equal_the_whole_text(spark, range_bytes):
    rng = random.Random(range_bytes)
    files = {f"f{k}.json": some_text(rng, 40) for k in range(4)}
    files |= {"one.json": '{"a":1}', "long.json": json.dumps({"t": "x}{\\\"" * 700, "u": [{}] * 300}) * 2, "blank.json": " \n" * 300,
              "bom.json": b"\xef\xbb\xbf" + some_text(rng, 20).encode(), "bad.json": some_text(rng, 9) + '{"broken" "x"}' + some_text(rng, 9),
              "array.json": json.dumps([{"k": k, "s": "}{"} for k in range(60)] + [5]), "junk.json": some_text(rng, 9) + ' "x{y" nope ' + some_text(rng, 9),
              "stray.json": some_text(rng, 9) + "}" + some_text(rng, 9) + "]", "arrays.json": "[" + ",".join(['{"z":1}'] * 90) + "]" + some_text(rng, 5)}
    base = tree(files)
    got = read_range_records(spark, base, range_bytes=range_bytes)
    want = split_files(read_texts(spark, f"{base}/*/*"))
    assert in_order(got.collect()) == in_order(want.collect())
    assert {r.year for r in got.collect()} == {2015}


def test_file_that_ends_in_a_record(spark):
    rng = random.Random(9)
    whole, cut = some_text(rng, 30), '{"last":"' + "y{" * 500
    base = tree({"cut.json": whole + cut, "mid.json": '{"a":1}{"b":{"c":1 ' + whole})
    rows = read_range_records(spark, base, range_bytes=300).collect()
    good = in_order([r for r in rows if r.error is None])
    assert good == [("cut.json", t, e) for _, t, e in split_records(whole)] + [("mid.json", '{"a":1}', None)]
    bad = in_order([r for r in rows if r.error])
    assert {e for _, _, e in bad} == {"unterminated"}
    assert "".join(t for f, t, _ in bad if f == "cut.json").strip(" \r\n,") == cut
    assert "".join(t for f, t, _ in bad if f == "mid.json") == '{"b":{"c":1 ' + whole


def test_many_tasks_share_one_file(spark):
    base = tree({"big.json": some_text(random.Random(3), 400, pretty=False)})
    found = read_range_records(spark, base, range_bytes=2000)
    assert found.where("error IS NULL").select("block").distinct().count() > 5
    assert found.count() == 400


def test_parts_of_any_size_equal_the_whole():
    rng = random.Random(5)
    texts = [some_text(rng, 12), json.dumps([{"a": 1}, 5, "x", None, {"b": [1, 2]}]) + '{"c":1} nope {"d":2}', "[1, 22, 333", '{"a":1}[{"b":2}', "[]", "[[1],2]"]
    for text in texts:
        want = [(t, e) for _, t, e in split_records(text)]
        for size in (1, 3, 10, 50):
            got, rest, opened = [], "", False
            for k in range(0, len(text), size):
                values, rest, opened = split_part(rest + text[k:k + size], opened, k + size >= len(text), len(got))
                got += values
            if '"a":1}[{"b"' not in text and "333" not in text:  # an open array's own row holds what was not taken yet
                assert got == want, (text, size)
            assert [v for v in got if v[1] is None] == [v for v in want if v[1] is None]


def test_split_range_cuts_at_records():


    assert R._split_range(b'x"} {"a":1} {"b":', 1, 0, 1) == (b'x"}', b' {"a":1}', b' {"b":')
    assert R._split_range(b"abc", 1, 0, 2) == (b"abc", b"", b"")
    assert np.array_equal(R._outside(np.frombuffer(b'a"b\\"c"d', np.uint8), 0, 0)[0], [1, 1, 0, 0, 0, 0, 0, 1])


def test_whole_trees_and_streams_never_hold_a_large_file(spark, monkeypatch):
    """Trees and streams of unknown layout are read in ranges, whatever the size and the name of a file."""
    import json

    from bibflow.plans import jobs
    from bibflow.schemas import RECORD_SCHEMA
    from bibflow.session import scratch_path
    from bibflow.sinks.keyed_table import KeyedTable
    from bibflow.sources import files, fs
    from bibflow.streaming.ingest import start_ingest
    from bibflow.streaming.progress import CountLog

    monkeypatch.setattr(R, "RANGE_BYTES", 1 << 12)
    monkeypatch.setattr(files, "_split_partition", None)  # the splitter of whole texts
    record = lambda n: json.dumps({"abstracts-retrieval-response": {"coredata": {
        "prism:doi": f"10.1/{n}", "dc:title": 't{"' * 20, "subtypeDescription": "Article", "prism:aggregationType": "Journal"}}}, indent=n % 2 or None)
    base, text = scratch_path(spark, "t-large-files"), "\n".join(record(n) for n in range(400))
    fs.write_text(spark, f"{base}/2015/a [1]{{b}} c.json", text)
    fs.write_text(spark, f"{base}/2015/a 1b c.json", "[" + record(400) + "]")
    largest = files.read_tree_records(spark, base).groupBy("file_path", "block").count().agg({"count": "max"}).first()[0]
    assert largest < 100  # so the large file was read in several ranges
    table = KeyedTable(spark, scratch_path(spark, "t-large-table"), RECORD_SCHEMA, n_buckets=2)
    got = jobs.ingest_tree(spark, base, table)
    assert (got.records_read, got.records_kept, got.quarantined) == (401, 401, 0)
    streamed, log = KeyedTable(spark, scratch_path(spark, "t-large-stream"), RECORD_SCHEMA, n_buckets=2), CountLog()
    start_ingest(spark, base, streamed, scratch_path(spark, "t-large-ckpt"), max_files_per_trigger=1, on_batch=log).awaitTermination()
    assert sorted(c.read for c in log.batches.values()) == [1, 400]
    assert sum(c.bytes for c in log.batches.values()) == len(text) + len(record(400)) + 2
    assert table.read().exceptAll(streamed.read()).count() == 0 and streamed.read().count() == 401
