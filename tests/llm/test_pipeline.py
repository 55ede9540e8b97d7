"""The corpus pipeline, stage by stage, against plain Python on the fixture; the entry point without this subpackage."""

import os
import re
import subprocess
import sys
from collections import Counter, defaultdict

import corpus_pipeline
from bibflow.llm import quality_rules
from tests.llm.test_operators import WORD, brute_base, brute_components, brute_print, brute_targets, check_sequences

COLS = ["doc_id", "text", "lang", "source", "n_chars"]


def read(spark, tmp_path, name, frame):
    path = f"file://{tmp_path}/{name}"
    frame.write.parquet(path)
    return spark.read.parquet(path)


def test_stages(spark, docs, rows, tmp_path):
    docs = read(spark, tmp_path, "in", docs.select(*COLS, "text_"))
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "line_dedup", "near_duplicates", "mixing", "packing"]

    kept = read(spark, tmp_path, "1", stages["quality_rules"](spark, docs, None))
    verdict = Counter((r["doc_id"], r["text"]) for r in kept.collect())
    good = Counter((r["doc_id"]) for r in quality_rules.quality_rules(docs).collect() if r["qr_kept"])
    assert kept.columns == docs.columns and Counter(i for i, _ in verdict.elements()) == good
    assert not any(brute_base(t)[5] for _, t in verdict)

    lines = read(spark, tmp_path, "2", stages["line_dedup"](spark, kept, None))
    assert lines.columns == docs.columns and lines.count() == kept.count()
    before = {(r["doc_id"]): r["text"] for r in kept.collect()}
    after = lines.collect()
    assert any(r["text"] != before[r["doc_id"]] for r in after if r["doc_id"] is not None)
    assert all(r["n_chars"] == len(r["text"]) for r in after)
    # No line vanishes from the corpus.
    assert {x for t in before.values() for x in t.split("\n")} <= {x for r in after for x in r["text"].split("\n")} | {""}

    unique = read(spark, tmp_path, "3", stages["near_duplicates"](spark, lines, None))
    prints = [brute_print(r["text"]) for r in after]
    root = brute_components(len(after), [(i, j) for i in range(len(after)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4])
    groups = defaultdict(list)
    for i, r in enumerate(after):
        groups[root[i]].append(r["doc_id"])
    names = Counter(min((x for x in v if x is not None), default=None) for v in groups.values())
    assert unique.columns == docs.columns and Counter(r["doc_id"] for r in unique.collect()) == names

    mixed = read(spark, tmp_path, "4", stages["mixing"](spark, unique, None))
    sizes, taken = Counter(), Counter()
    for r in unique.collect():
        sizes[r["source"]] += len(WORD.findall(r["text"]))
    for r in mixed.collect():
        taken[r["source"]] += len(WORD.findall(r["text"]))
    target = brute_targets(dict(sizes))
    longest = {s: max(len(WORD.findall(r["text"])) for r in unique.collect() if r["source"] == s) for s in sizes}
    assert mixed.columns == docs.columns and all(abs(taken[s] - target[s]) <= longest[s] / 2 + 1 for s in sizes)
    whole = Counter((r["doc_id"], r["text"]) for r in unique.collect())
    assert all(n <= 2 * whole[k] for k, n in Counter((r["doc_id"], r["text"]) for r in mixed.collect()).items())  # no text is cut

    packed = stages["packing"](spark, mixed, None).collect()
    assert Counter(r["doc_id"] for r in packed if r["piece"] == 0) == Counter(r["doc_id"] for r in mixed.collect())
    check_sequences([(r["sequence_id"], r["offset"], r["length"]) for r in packed], 2048)


def test_run_chains_the_stages(spark, docs, tmp_path):
    docs.select(*COLS).write.parquet(f"file://{tmp_path}/documents.parquet")
    out = corpus_pipeline.run(spark, f"file://{tmp_path}")
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and out.count() > 0


def test_empty_corpus(spark, empty, tmp_path):
    empty.select(*COLS).write.parquet(f"file://{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, f"file://{tmp_path}").count() == 0


def test_entry_without_the_subpackage(tmp_path):
    root = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))
    for name in ("__spark_entry__.py", "bibflow"):
        subprocess.run(["cp", "-r", f"{root}/{name}", str(tmp_path)], check=True)
    os.rename(tmp_path / "bibflow" / "llm", tmp_path / "gone")
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), any(re.match('op[0-9]', x) for x in q), e.oracle_sql().keys() <= q.keys())"
    out = subprocess.run([sys.executable, "-B", "-c", f"import re; {code}"], cwd=tmp_path, env=os.environ | {"PYTHONPATH": str(tmp_path)},
                         capture_output=True, text=True, check=True)
    assert re.search(r"\d\d False True", out.stdout), out.stdout
