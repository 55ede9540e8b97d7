"""License scan, source divergence and centroid clustering against plain Python."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from bibflow.llm import centroid_clustering as cc
from bibflow.llm import license_scan as ls
from bibflow.llm import source_divergence as sv

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key(value):
    return (value is not None, value)


# ---------------------------------------------------------------- license scan

def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))


def brute_scan(text):
    """Base places by comparing words; notices by all diagonals of equal word pairs."""
    w = words_of(text)
    places, labels, best = [], set(), 0.0
    for t in ls.BASE:
        for i in range(len(w) - len(t.words) + 1):
            if w[i:i + len(t.words)] == t.words:
                places.append((i, t.label))
                best = 1.0
    for t in ls.NOTICES:
        diagonals = defaultdict(list)
        for j in range(len(t.words) - 1):
            for i in range(len(w) - 1):
                if w[i:i + 2] == t.words[j:j + 2]:
                    diagonals[i - j].append(j)
        for d, hits in diagonals.items():
            n = lambda e: len(diagonals.get(d + e, ()))
            if max(n(-1), n(-2)) >= len(hits) or max(n(1), n(2)) > len(hits):
                continue
            at = [(e, j) for e in range(d - 2, d + 3) for j0 in diagonals.get(e, ()) for j in (j0, j0 + 1)]
            covered, found = {j for _, j in at}, {e + j for e, j in at}
            score = min(len(covered), len(found)) / (len(t.words) + max(found) - min(found) + 1 - len(found))
            if score >= ls.MIN_SCORE and set(t.keys) <= covered:
                labels.add(t.label)
                best = max(best, score)
    base = {x for _, x in places}
    starts = [i for i, _ in places]
    return (len(w), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)),
            ",".join(sorted(base | labels)), best)


NOTICES = [
    "Text before. Licensed under the Apache License, Version 2.0. Text after",
    "Licensed under the famous Apache License, Version 2.0",  # a word more
    "Licensed under Apache License Version 2.0",  # a word less
    "Licensed under the Apache License, Version 1.1",  # another version
    "Licensed under CC BY-NC 4.0.", "Licensed under CC BY-ND 4.0.", "Licensed under CC BY-XX 4.0.",
    "ALL RIGHTS RESERVED all rights reserved; all rights, Reserved", "the general\npublic\tlicense of cc-by",
    "This work is licensed under the GNU General Public License, version 3.",
    "GNU Lesser General Public License", "Permission is hereby granted, free of any charge, to any person obtaining a copy of this software",
    "É all rights reserved É", "allrights reserved", "cc by " * 500, "general public " * 300 + "license", "Released under the MIT License.\n" * 40,
    "released under the\x00mit license", "Ärights all ÀLL rights reserved",
]


def test_scan_equals_brute_force(spark, rows):
    texts = [r[1] for r in rows] + NOTICES
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id int, text string, ls_labels string, row int").repartition(4)
    out = ls.scan_licenses(df)
    assert out.columns[:3] == ["doc_id", "ls_labels", "row"]
    got = {r[0]: tuple(r)[3:10] for r in out.collect()}
    for i, t in enumerate(texts):
        assert got[i] == brute_scan(t), t


def test_scan_names_licenses(spark):
    df = spark.createDataFrame([(t,) for t in NOTICES[:12]], "text string")
    labels = [r.ls_labels for r in ls.scan_licenses(df.coalesce(1)).collect()]
    assert sorted(labels) == sorted(["apache-2.0", "apache-2.0", "apache-2.0", "", "cc-by,cc-by-nc-4.0", "cc-by,cc-by-nd-4.0", "cc-by",
                                     "reserved", "cc-by,gpl", "gpl,gpl-3.0", "gpl,lgpl", "mit"])
    spans = [r.ls_spans for r in ls.scan_licenses(df.limit(1)).collect()][0]
    assert [(s["first"], s["last"], s["label"], s["score"]) for s in spans] == [(2, 9, "apache-2.0", 1.0)]


def test_scan_empty_table(spark, empty):
    assert ls.scan_licenses(empty).count() == 0


def test_scan_stays_in_the_jvm(spark, docs):
    plan = ls.gram_hits(docs, [*ls.BASE, *ls.NOTICES])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


# ---------------------------------------------------------- source divergence

def brute_divergence(rows, min_docs=3, top=200):
    """rows: (text, lang, source)."""
    df, counts, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(UPPER))
        df[lang].update(set(terms))
        counts[lang, source].update(terms)
    out = set()
    for lang in {g[0] for g in groups}:
        kept = sorted(t for t, n in df[lang].items() if n >= min_docs)
        sources = sorted(s for x, s in groups if x == lang)
        total = {s: sum(counts[lang, s][t] for t in kept) for s in sources}
        share = lambda c, n: 1 + 10**9 * (c + 1) // (n + len(kept))
        p = {s: [share(counts[lang, s][t], total[s]) for t in kept] for s in sources}
        q = [share(sum(counts[lang, s][t] for s in sources), sum(total.values())) for t in kept]
        for s in sources:
            pairs = sorted(((-sum((a - b) ** 2 // b for a, b in zip(p[s], p[o])), o.encode(), o) for o in sources if o != s))
            out |= {(lang, s, "pair", o, -v, i + 1) for i, (v, _, o) in enumerate(pairs)}
            terms = sorted((-((a - b) ** 2 // b), t.encode(), t) for t, a, b in zip(kept, p[s], q) if counts[lang, s][t] and a > b)
            out |= {(lang, s, "term", t, -v, i + 1) for i, (v, _, t) in enumerate(terms[:top])}
    return out


@pytest.mark.parametrize("group_terms, entries", [(sv.GROUP_TERMS, sv.MAX_ENTRIES), (7, 50)])
def test_divergence_equals_brute_force(spark, rows, docs, monkeypatch, group_terms, entries):
    monkeypatch.setattr(sv, "GROUP_TERMS", group_terms)
    monkeypatch.setattr(sv.fold, "__defaults__", (entries,))
    got = [tuple(r) for r in sv.source_divergence(docs, top=15).collect()]
    assert len(got) == len(set(got))
    assert set(got) == brute_divergence([(r[1], r[2], r[3]) for r in rows], top=15)


def test_divergence_odd_groups(spark):
    rows = [("É É à", "x", "a"), ("É à", "x", "b"), ("É à à z", "x", None), (None, "x", "c"), ("once only", "y", "a"), ("", "y", "b"),
            ("Ab aB ab", None, "a"), ("ab", None, "a"), ("AB", None, "b")]
    df = spark.createDataFrame(rows, "text string, lang string, source string")
    got = {tuple(r) for r in sv.source_divergence(df).collect()}
    assert got == brute_divergence(rows)
    assert ("y", "a", "pair", "b", 0, 1) in got


def test_divergence_empty_table(spark, empty):
    assert sv.source_divergence(empty).count() == 0


def test_long_texts_are_folded_in_pieces(monkeypatch):
    rng = random.Random(3)
    text = " ".join("".join(rng.choices("abcÉ", k=rng.randint(1, 60))) for _ in range(300)) + "." + "q" * 200 + "."
    whole = sv.term_counts(text.encode())
    for piece in (1, 2, 7, 64, 5000):
        monkeypatch.setattr(sv, "_PIECE", piece)
        assert sv.term_counts(text.encode()) == whole


def test_shares_are_exact():
    rng = random.Random(5)
    counts = [rng.randrange(10**rng.randint(1, 15)) for _ in range(500)]
    totals = [c + 1 + rng.randrange(10**rng.randint(1, 15)) for c in counts]
    got = sv.parts_of(np.array(counts), np.array(totals))
    assert got.tolist() == [1 + 10**9 * (c + 1) // t for c, t in zip(counts, totals)]


def test_blocks_of_sources(monkeypatch):
    names = [f"s{i}" for i in range(9)]
    rng = random.Random(1)
    stripes = [{s: rng.randint(1, 9) for s in rng.sample(names, rng.randint(1, 9))} for _ in range(40)]
    total = {s: sum(x.get(s, 0) for x in stripes) for s in names}
    totals = pa.table({"lang": ["x"] * 9, "source": names, "v": [40] * 9, "n": [total[s] for s in names]})
    table = pa.table({"lang": ["x"] * 40, "term": [f"t{i}" for i in range(40)], "sources": [list(s) for s in stripes],
                      "counts": [list(s.values()) for s in stripes]})
    order = lambda t: sorted(map(str, t.to_pylist()))
    whole = order(sv.emit(totals, table))
    monkeypatch.setattr(sv, "_SOURCES_AT_ONCE", 2)
    monkeypatch.setattr(sv, "_CELLS", 30)
    assert order(sv.emit(totals, table)) == whole


# --------------------------------------------------------- centroid clustering

def brute_clusters(rows, k=8, rounds=10, dims=64):
    kept = [(i, [math.floor(1024 * float(np.float32(v))) for v in e]) for i, e in rows
            if e is not None and len(e) == dims and all(v is not None and math.isfinite(v) for v in e)]
    digest = lambda i: hashlib.sha256(f"3:{'' if i is None else i}".encode()).hexdigest()
    cent = [x for _, x in sorted(kept, key=lambda r: (digest(r[0]), r[1]))[:k]]

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), j) for j, c in enumerate(cent))

    for _ in range(rounds):
        members = defaultdict(list)
        for _, x in kept:
            members[nearest(x)[1]].append(x)
        cent = [[sum(col) // len(members[j]) for col in zip(*members[j])] if members[j] else c for j, c in enumerate(cent)]
    found = [(i, *nearest(x)) for i, x in kept]
    inertia = Counter()
    for _, d, j in found:
        inertia[j] += d
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cent]
    return sorted(((i, j, d, inertia[j], sum(inertia.values()), names[j]) for i, d, j in found), key=lambda r: (key(r[0]), r[1:]))


def clustered(df, **kw):
    out = cc.cluster_vectors(df, **kw).select("vec_id", "cc_cluster", "cc_distance", "cc_cluster_inertia", "cc_inertia", "cc_centroid_sha256")
    return sorted((tuple(r) for r in out.collect()), key=lambda r: (key(r[0]), r[1:]))


def vectors(n, dims=64, centres=6):
    rng = random.Random(11)
    mid = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(centres)]
    rows = [(i, [float(np.float32(m + rng.gauss(0, 0.2))) for m in mid[i % centres]]) for i in range(n)]
    same = rows[3][1]
    rows += [(n + i, same) for i in range(40)] + [(5, rows[5][1]), (5, rows[6][1]), (None, rows[7][1]), (None, rows[8][1])]
    return rows + [(9001, None), (9002, []), (9003, [0.0] * 63), (9004, [0.0] * 63 + [None]), (9005, [0.0] * 63 + [float("nan")]),
                   (9006, [0.0] * 63 + [float("inf")]), (9007, [-0.0] * 64)]


def test_clusters_equal_brute_force(spark):
    rows = vectors(300)
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id bigint, embedding array<float>, cc_components string").repartition(4)
    assert clustered(df) == brute_clusters(rows)
    assert cc.cluster_vectors(df).columns[:2] == ["vec_id", "cc_components"]


def test_few_vectors_and_none(spark):
    schema = "vec_id bigint, embedding array<float>"
    rows = vectors(9)[:3]
    assert clustered(spark.createDataFrame(rows, schema)) == brute_clusters(rows)
    same = [(i, rows[0][1]) for i in range(12)]
    assert clustered(spark.createDataFrame(same, schema)) == brute_clusters(same)
    assert clustered(spark.createDataFrame([], schema)) == []


def test_components_out_of_range_raise(spark):
    df = spark.createDataFrame([(1, [1e30] * 64)], "vec_id bigint, embedding array<float>")
    with pytest.raises(Exception, match="beyond"):
        cc.cluster_vectors(df).collect()


def test_pivots_skip_measurements_but_change_nothing(spark):
    rng = np.random.default_rng(2)
    centres = rng.integers(-4000, 4000, (8, 64))
    x = centres[rng.integers(0, 8, 3000)] + rng.integers(-300, 300, (3000, 64))
    x = np.concatenate([x, (centres[:1] + centres[1:2]) // 2])
    pivots = cc.choose_pivots(x[:64], cc.PIVOTS)
    cluster, distance, checked = cc.assign(x, cc.pivot_distances(x, pivots), centres, pivots)
    every = ((x[:, None] - centres) ** 2).sum(axis=2)
    assert (cluster == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()
    assert checked.mean() < 4


def test_bounds_never_exceed_distances():
    rng = np.random.default_rng(4)
    for scale in (3, 1000, cc.MAX_COMPONENT):
        x, c, p = (rng.integers(-scale, scale + 1, (n, 64)) for n in (500, 12, 5))
        x[:12], c[:5] = c, p  # points that coincide
        between, near = cc.pivot_distances(p, p), cc.pivot_distances(x, p)
        for j, e in enumerate(cc.pivot_distances(c, p)):
            exact = [sum((int(a) - int(b)) ** 2 for a, b in zip(r, c[j])) for r in x]
            assert all(b <= d for b, d in zip(cc.lower_bounds(near, e, between).tolist(), exact))
