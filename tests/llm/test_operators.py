"""Every operator against a brute-force version on a fixture with nulls, empty and long texts, copies and clashes."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from bibflow.llm import exact_dedup, line_dedup, mixing, packing, quality_rules, simhash, suffix_dedup, token_counts
from bibflow.llm.common import components
from bibflow.llm.queries import vocabulary_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary_path())


def bag(rows):
    return Counter(map(tuple, rows))


# ---- token counts ----

def test_token_counts(docs, rows, empty, tokenizer):
    out = token_counts.count_tokens(docs, vocabulary_path()).collect()
    want = bag((r[0], len((r[1] or "").encode()), len(tokenizer.encode(r[1] or "", add_special_tokens=False).ids)) for r in rows)
    assert bag((r["doc_id"], r["tc_n_bytes"], r["tc_n_tokens"]) for r in out) == want
    assert all(r["tc_over_limit"] == (r["tc_n_tokens"] > 512) for r in out)
    assert token_counts.count_tokens(empty, vocabulary_path()).count() == 0


def test_token_counts_random_strings_and_windows(tokenizer, monkeypatch):
    import random

    rng = random.Random(3)
    letters = [*" \n\t' strevmld1é.!中٣", "　", "\x85", "\x1c", "'re", "'ll", "  ", "<|endoftext|>", " the", "👍"]
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 60))) for _ in range(3000)]
    want = [len(e.ids) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert token_counts.count_texts(texts, vocabulary_path()).tolist() == want
    monkeypatch.setattr(token_counts, "WINDOW", 500)
    monkeypatch.setattr(token_counts, "LANE", 64)
    assert token_counts.count_texts(texts, vocabulary_path()).tolist() == want
    long = "".join(texts)
    assert token_counts.count_texts([long], vocabulary_path())[0] == len(tokenizer.encode(long, add_special_tokens=False).ids)
    monkeypatch.setattr(token_counts, "MAX_STATES", 50)
    token_counts._LOADED.clear()
    assert token_counts.count_texts(texts, vocabulary_path()).tolist() == want
    token_counts._LOADED.clear()


# ---- quality rules ----

def brute_base(text):
    words = WORD.findall(text or "")
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    grams = Counter(zip(words, words[1:], words[2:]))
    covered = {k + j for k in range(len(words) - 2) if grams[tuple(words[k:k + 3])] > 1 for j in range(3)}
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered), n < 50 or 100 * len(covered) > 50 * n)


def test_quality_base_counts(docs, rows, empty):
    out = quality_rules.quality_rules(docs).collect()
    got = bag((r["doc_id"], *(r["qr_" + c] for c in quality_rules.BASE), r["qr_base_failed"]) for r in out)
    assert got == bag((r[0], *brute_base(r[1])) for r in rows)
    assert not any(r["qr_kept"] and r["qr_base_failed"] for r in out)
    kept = {r["doc_id"] for r in out if r["qr_kept"]}
    assert len(kept) > 40  # clean prose stays
    symbols = next(r[0] for r in rows if (r[1] or "").startswith("###"))
    assert symbols not in kept
    assert quality_rules.quality_rules(empty).count() == 0
    again = quality_rules.filter_documents(docs)
    assert again.columns == docs.columns
    assert bag(r["doc_id"] for r in out if r["qr_kept"]) if False else sorted(
        str(r["doc_id"]) for r in out if r["qr_kept"]) == sorted(str(r["doc_id"]) for r in again.collect())


def test_quality_thresholds_follow_the_group(spark):
    rows = [(i, "abcde " * 5 + " ".join(f"w{i}x{j}" for j in range(60)), "en", "a") for i in range(150)]
    rows += [(200 + i, " ".join(f"verylongcompoundword{i}x{j}" for j in range(60)), "de", "b") for i in range(150)]
    rows += [(500, rows[200][1], "en", "a")]
    out = {r["doc_id"]: r["qr_kept"] for r in quality_rules.quality_rules(
        spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")).collect()}
    assert out[200] and not out[500]  # the same text is normal in one group and an outlier in the other


def test_quality_cutoffs_come_from_the_data(spark):
    plain = lambda i, n: " ".join(f"w{i:04}x{j}" for j in range(100)) + "#" * n
    rows = [(i, plain(i, i % 41), "en", "code") for i in range(400)] + [(1000 + i, plain(1000 + i, 0), "en", "prose") for i in range(400)]
    rows += [(2000, plain(2000, 40), "en", "code"), (2001, plain(2001, 40), "en", "prose"), (2002, plain(2002, 600), "en", "code")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    out = {r["doc_id"]: r["qr_kept"] for r in quality_rules.quality_rules(df).collect()}
    assert out.pop(2000) and not out.pop(2001) and not out.pop(2002) and all(out.values())
    base = quality_rules.with_base(df, prefix="qr_")
    cut = {r["source"]: r["symbols_hi"] for r in quality_rules.thresholds(base, prefix="qr_").collect()}
    assert cut["prose"] == 3 * quality_rules.ROUNDING and cut["code"] > 2 * cut["prose"]


def test_sketch_merges_and_bounds_error(spark):
    values = [int(1.3 ** (k % 37)) + k for k in range(3000)]
    df = spark.createDataFrame([(v,) for v in values], "v bigint")
    buckets = [r[0] for r in df.select(quality_rules.sketch_bucket(F.col("v"))).collect()]
    for v, b in zip(values, buckets):
        edge = int(quality_rules.SKETCH_GAMMA ** b)
        assert v <= edge + 1 and edge <= v * quality_rules.SKETCH_GAMMA + 1


# ---- simhash ----

def brute_print(text):
    words = WORD.findall((text or "").translate({i: i + 32 for i in range(65, 91)}))
    if not words:
        return 0
    grams = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    votes = [0] * 64
    for g in grams:
        h = xxhash.xxh64_intdigest(g.encode(), 42)
        for b in range(64):
            votes[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * votes[b] > len(grams))


def brute_components(n, linked):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for a, b in linked:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    return [find(i) for i in range(n)]


def test_simhash(docs, rows, empty, monkeypatch):
    prints = [brute_print(r[1]) for r in rows]
    root = brute_components(len(rows), [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4])
    least = defaultdict(list)
    for i, r in enumerate(rows):
        least[root[i]].append(r[0])
    names = {k: min((x for x in v if x is not None), default=None) for k, v in least.items()}
    want = bag((r[0], f"{prints[i]:016x}", names[root[i]]) for i, r in enumerate(rows))
    for tile in (4096, 2):  # 2: every shared block is split into pairs of tiles
        monkeypatch.setattr(simhash, "TILE", tile)
        out = simhash.near_duplicates(docs).collect()
        assert bag((r["doc_id"], r["sh_fingerprint"], r["sh_component"]) for r in out) == want
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert Counter(ids) == Counter(names.values())
    assert simhash.near_duplicates(empty).count() == 0


def test_spanning_links_and_every_choice_of_pieces(spark):
    rng = np.random.default_rng(0)
    centers = rng.integers(0, 2**64, 4, dtype=np.uint64)
    one = lambda: np.uint64(1) << rng.integers(0, 64, 300).astype(np.uint64)
    a = np.unique(np.concatenate([centers[rng.integers(0, 4, 300)] ^ one() ^ one(), rng.integers(0, 2**64, 200, dtype=np.uint64)]))
    near = [(i, j) for i in range(len(a)) for j in range(i) if int(a[i] ^ a[j]).bit_count() <= 4]
    want = brute_components(len(a), near)
    place = {int(v): i for i, v in enumerate(a)}
    x, y = simhash.links(a, a, 4)
    assert brute_components(len(a), [(place[int(p)], place[int(q)]) for p, q in zip(x, y)]) == want
    for k in (1, 2, 3, 4):  # pigeonhole: each link shares a block under some choice
        choices = [sum(((1 << n) - 1) << f for f, n in c) for c in simhash._pieces(k, 4)]
        assert all(any(int(a[i] ^ a[j]) & m == 0 for m in choices) for i, j in near)


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1001), (2000, 2000)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 301)} | {1001: 1000}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---- mixing ----

def brute_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: [3, 1, 2][i % 3] for i, s in enumerate(names)}
    left, capped, target = 1.5 * sum(sizes.values()), set(), {}
    while True:
        total = sum(weight[s] for s in names if s not in capped)
        share = {s: left * weight[s] / total for s in names if s not in capped}
        over = {s for s in share if share[s] >= 2 * sizes[s]}
        if not over:
            return target | share
        for s in over:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        capped |= over
        if len(capped) == len(names):
            return target


def test_mixing(docs, rows, empty):
    out = mixing.mix(docs).collect()
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len(WORD.findall(r[1] or ""))
    target = brute_targets(dict(sizes))
    assert bag((r["doc_id"], r["mix_size"]) for r in out) == bag((r[0], len(WORD.findall(r[1] or ""))) for r in rows)
    taken = Counter()
    for r in out:
        assert r["mix_source_size"] == sizes[r["source"]] and r["mix_target"] == pytest.approx(target[r["source"]])
        assert 0 <= r["mix_taken"] <= 2 * r["mix_size"]
        taken[r["source"]] += r["mix_taken"]
    assert all(abs(taken[s] - target[s]) <= 1 for s in sizes)
    assert bag((r["doc_id"], r["mix_taken"]) for r in mixing.mix(docs.repartition(3)).collect()) == bag(
        (r["doc_id"], r["mix_taken"]) for r in out)
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    words = Counter()
    for r in mixed.collect():
        words[r["source"]] += len(WORD.findall(r["text"] or ""))
    longest = {s: max(len(WORD.findall(r[1] or "")) for r in rows if r[3] == s) for s in sizes}
    assert all(abs(words[s] - taken[s]) <= longest[s] / 2 for s in sizes)  # texts stay whole
    assert mixing.mix(empty).count() == 0


# ---- line dedup ----

def test_line_dedup(docs, rows, empty):
    spread, first = defaultdict(set), {}
    trim = lambda x: x.strip(" \t\n\x0b\x0c\r")
    for r in rows:
        for line in (r[1] or "").split("\n"):
            spread[trim(line)].add(r[3])
            if r[0] is not None:
                first[trim(line)] = min(first.get(trim(line), r[0]), r[0])
    gone = {x for x, s in spread.items() if len(s) >= line_dedup.MIN_SITES and x}
    assert gone
    want = Counter()
    for r in rows:
        kept, seen = [], set()
        for line in (r[1] or "").split("\n"):
            x = trim(line)
            if x in gone and (r[0] != first.get(x) or x in seen):
                continue
            seen.add(x)
            kept.append(line)
        want[(r[0], None if r[1] is None else "\n".join(kept), len((r[1] or "").split("\n")) - len(kept))] += 1
    out = line_dedup.dedup_lines(docs).collect()
    assert bag((r["doc_id"], r["text"], r["ld_removed"]) for r in out) == want
    assert line_dedup.dedup_lines(empty).count() == 0


# ---- suffix dedup ----

def brute_cut(texts, n=200):
    seen = Counter(t[k:k + n] for t in texts for k in range(len(t) - n + 1))
    for t in texts:
        marks = bytearray(len(t))
        for k in range(len(t) - n + 1):
            if seen[t[k:k + n]] > 1:
                marks[k:k + n] = b"\1" * n
        yield (len(t), sum(marks), len(re.findall(b"\1+", bytes(marks))),
               hashlib.sha256(bytes(c for c, m in zip(t, marks) if not m)).hexdigest())


def test_suffix_dedup(docs, rows, empty, monkeypatch):
    want = bag((r[0], *x) for r, x in zip(rows, brute_cut([(r[1] or "").encode() for r in rows])))

    def got():
        return bag((r["doc_id"], r["sd_n_bytes"], r["sd_n_removed"], r["sd_n_spans"], r["sd_kept_sha256"])
                   for r in suffix_dedup.dedup_strings(docs).collect())

    assert got() == want
    monkeypatch.setattr(suffix_dedup, "SORT_LIMIT", 1)  # every shared minimizer counts single windows
    assert got() == want
    assert suffix_dedup.dedup_strings(empty).count() == 0


def test_sorted_stretches_against_windows():
    import random

    rng = random.Random(5)
    core = bytes(rng.choices(b"abcd", k=suffix_dedup.GRAM))
    pool_l = [bytes(rng.choices(b"ab", k=160)) for _ in range(4)]
    pool_r = [bytes(rng.choices(b"ab", k=360)) for _ in range(4)]
    for m in (3, 40):
        items = {}
        for _ in range(m):
            left, right = rng.choice(pool_l), rng.choice(pool_r)
            cut_l, cut_r = rng.randint(0, 160), rng.randint(0, 200)
            left = bytes(rng.choices(b"ab", k=160 - cut_l)) + left[160 - cut_l:]
            right = right[:cut_r] + bytes(rng.choices(b"ab", k=360 - cut_r))
            offset, windows = rng.randint(0, 160), rng.randint(1, 161)
            windows = min(windows, offset + 1)
            items[(left[160 - offset:] + core + right)[:windows + 199], offset, windows] = None
        made = [suffix_dedup.Stretch(*k) for k in items]
        suffix_dedup.mark_repeated(made)
        # Windows correspond at equal distance from the minimizer only.
        seen = Counter((s.data[x:x + 200], s.offset - x) for s in made for x in range(s.windows))
        for s in made:
            assert [seen[s.data[x:x + 200], s.offset - x] > 1 for x in range(s.windows)] == [bool(v) for v in s.marks]


def test_hash_collisions_are_verified(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "_same", lambda a, i, b, j, n: True)  # every comparison collides
    a = suffix_dedup.Stretch(b"x" * 100 + b"m" * 40 + b"y" * 160, 100, 101)
    b = suffix_dedup.Stretch(b"x" * 100 + b"m" * 40 + b"y" * 70 + b"z" * 90, 100, 101)
    suffix_dedup.mark_repeated([a, b])
    assert [x for x, v in enumerate(a.marks) if v] == list(range(11))


def test_large_groups_are_dealt_out_by_sides(spark, monkeypatch):
    import random

    rng = random.Random(4)
    say = lambda n: "".join(rng.choices("abcdefgh", k=n))
    phrase, long = say(90), say(330)
    texts = [say(300) + phrase + say(300) for _ in range(30)]
    texts += [say(150) + long[k:k + 200 + 4 * k] + say(150) for k in range(30)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)
    want = bag((k, *x) for k, x in enumerate(brute_cut([t.encode() for t in texts])))
    groups = []
    by_sides = suffix_dedup._by_sides

    def spy(pieces):
        groups.append((pieces.groupBy("h").count().agg(F.max("count")).first()[0],
                       by_sides(pieces).groupBy("h").count().agg(F.min("count")).first()[0]))
        return by_sides(pieces)

    monkeypatch.setattr(suffix_dedup, "_by_sides", spy)
    for limit in (2, 12):
        monkeypatch.setattr(suffix_dedup, "SORT_LIMIT", limit)
        assert bag(map(tuple, suffix_dedup.dedup_strings(docs).collect())) == want
    assert groups and all(a > b for a, b in groups)


def test_largest_sorted_group_fits_its_memory():
    import random
    import tracemalloc

    rng = random.Random(2)
    core = rng.randbytes(suffix_dedup.GRAM)
    texts = [rng.randbytes(160) + core + rng.randbytes(160) for _ in range(500)]
    suffix_dedup.mark_repeated([suffix_dedup.Stretch(t, 160, 161) for t in texts[:20]])  # tables made once
    tracemalloc.start()
    suffix_dedup.mark_repeated([suffix_dedup.Stretch(t, 160, 161) for t in texts])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak / len(texts) * suffix_dedup.SORT_LIMIT <= 1 << 27


# ---- packing ----

def test_packing(docs, rows, empty, tokenizer):
    out = packing.pack(docs, vocabulary_path()).collect()
    ids = [np.array([*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 0], "<u4") for r in rows]
    want = Counter()
    for r, x in zip(rows, ids):
        for k, (s, n) in enumerate(packing.cut(len(x), 2048)):
            want[(r[0], k, s, n, zlib.crc32(x[s:s + n].tobytes()))] += 1
    assert bag((r["doc_id"], r["pk_piece"], r["pk_start"], r["pk_length"], r["pk_ids_crc32"]) for r in out) == want
    check_sequences([(r["pk_sequence_id"], r["pk_offset"], r["pk_length"]) for r in out], 2048)
    assert packing.pack(empty, vocabulary_path()).count() == 0


def check_sequences(places, capacity):
    by = defaultdict(list)
    for s, o, n in places:
        by[s].append((o, n))
    for v in by.values():
        at = 0
        for o, n in sorted(v):
            assert o == at
            at += n
        assert at <= capacity
    return len(by)


@pytest.mark.parametrize("seed", range(150))
def test_plan_against_the_optimum(seed):
    import random

    rng = random.Random(seed)
    capacity = rng.choice([10, 17, 30])
    items = [rng.randint(1, capacity) for _ in range(rng.randint(1, 11))]
    rows = packing.plan_rows(Counter(items), capacity)
    used = Counter()
    places = []
    for length, start, n, seq, offset in rows:
        assert start == used[length]
        used[length] += n
        places += [(seq + k, offset, length) for k in range(n)]
    assert used == Counter(items)
    n = check_sequences(places, capacity)
    # Dominance keeps an optimum: after reduction, an exact search over the rest gives the optimum.
    plan = packing.Plan(Counter(items), capacity)
    plan.reduce()
    rest = sorted((s for s, c in plan.left.items() for _ in range(c)), reverse=True)
    assert plan.sequences + optimum(rest, capacity) == optimum(sorted(items, reverse=True), capacity)
    assert n <= optimum(sorted(items, reverse=True), capacity) + 1


def optimum(items, capacity):
    best = [len(items)]

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for k in sorted(set(bins)):
            if k + items[i] <= capacity:
                j = bins.index(k)
                go(i + 1, [*bins[:j], k + items[i], *bins[j + 1:]])
        go(i + 1, [*bins, items[i]])

    go(0, [])
    return best[0] if items else 0


# ---- exact dedup ----

def test_exact_dedup(docs, rows, empty):
    groups = defaultdict(list)
    for r in rows:
        groups[r[1] or ""].append(r[0])
    for old in (F.col("doc_id") < 30, F.lit(False), F.lit(True)):
        out = exact_dedup.dedup(docs, old).collect()
        assert len(out) == len(rows)
        kept = Counter()
        for r in out:
            kept[r["ed_text_sha256"]] += r["ed_kept"]
        assert set(kept.values()) == {1}  # one row of each group
        want = bag((i, max((x for x in v if x is not None), default=None), len(v), hashlib.sha256(t.encode()).hexdigest())
                   for t, v in groups.items() for i in v)
        assert bag((r["doc_id"], r["ed_keep_id"], r["ed_group_size"], r["ed_text_sha256"]) for r in out) == want
        assert all(r["doc_id"] == r["ed_keep_id"] for r in out if r["ed_kept"])
    assert exact_dedup.dedup(empty, F.lit(True)).count() == 0


def test_perfect_hash_is_minimal_and_rejects_nonmembers():
    for n in (1, 2, 3, 50, 5000):
        digests = np.frombuffer(b"".join(hashlib.sha256(f"{n} {k}".encode()).digest() for k in range(n)), np.uint8).reshape(-1, 32)
        seeds, slot = exact_dedup.build_hash(digests)
        assert sorted(slot.tolist()) == list(range(n))
        assert (exact_dedup.find_slots(digests, seeds, n) == slot).all()
        other = np.frombuffer(b"".join(hashlib.sha256(f"no {k}".encode()).digest() for k in range(100)), np.uint8).reshape(-1, 32)
        held = np.empty_like(digests)
        held[slot] = digests
        assert not (held[exact_dedup.find_slots(other, seeds, n)] == other).all(axis=1).any()


def test_exact_dedup_buckets_hold_the_batch(docs, rows, monkeypatch):
    largest = []
    look_up = exact_dedup.look_up

    def spy(index, batch, buckets):
        largest.append(exact_dedup._distinct(batch, buckets).groupBy("bucket").count().agg(F.max("count")).first()[0])
        return look_up(index, batch, buckets)

    monkeypatch.setattr(exact_dedup, "BUCKET_DIGESTS", 8)
    monkeypatch.setattr(exact_dedup, "look_up", spy)
    sizes = Counter(r[1] or "" for r in rows)
    for old in (F.lit(False), F.col("doc_id") == 5):  # no history, a history of one row
        out = exact_dedup.dedup(docs, old).collect()
        assert Counter(r["ed_group_size"] for r in out) == Counter(sizes[r[1] or ""] for r in rows)
    assert max(largest) <= 3 * 8


def test_encoder_survives_long_white_space(tokenizer):
    encoder = packing.Encoder(vocabulary_path())
    text = "a" + " " * 2_000_000 + "b"
    ids = np.frombuffer(encoder.encode(text), "<u4").tolist()
    assert ids == tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("run, names", [
    (quality_rules.quality_rules, ["qr_n_words", "__l", "qr_kept"]), (quality_rules.filter_documents, ["qr_row", "__s"]),
    (line_dedup.dedup_lines, ["ld_gone", "ld_lines", "LD_once"]), (mixing.mix, ["mix_size", "mix_taken", "__source"]),
    (mixing.mixed_documents, ["mix_copy", "mix_hash"]), (simhash.keep_one, ["sh_a", "wa", "sh_n"])])
def test_names_of_own_columns_may_be_taken(docs, run, names):
    plain = docs.select("doc_id", "text", "lang", "source")
    extra = plain.select("*", *[F.lit(f"v{i}").alias(n) for i, n in enumerate(names)])
    want, got = run(plain), run(extra)
    assert set(names) <= set(got.columns) and len({c.lower() for c in got.columns}) == len(got.columns)
    assert all(tuple(r) == tuple(f"v{i}" for i in range(len(names))) for r in got.select(*[f"`{n}`" for n in names]).distinct().collect())
    others = [c for c in got.columns if c not in names]
    assert bag(got.select(*others).collect()) == bag(want.collect())
