"""Removal of repeated byte strings by a hash-compared suffix sort.

A byte goes when some string of ``MATCH`` bytes that covers it starts at two or
more places of the corpus.  Every such window of a text is assigned to its
minimizer, the ``GRAM``-byte string in it with the least hash (leftmost on a
tie): equal windows have equal minimizers at the same place, so all windows to
compare share a minimizer.  Consecutive windows with the same minimizer form a
*stretch* - the bytes of all of them, at most twice ``MATCH``.

1. Tasks read whole texts and emit one short row per stretch: minimizer hash,
   hash of the stretch, text and place.  Equal stretches of one Arrow batch are
   combined first, so a frequent passage is a row per batch, not per document.
2. Rows meet by minimizer.  Stretches that occur twice are repeated as a whole;
   those that only share the minimizer with others may be repeated in part.
   Minimizers that a frequent-items sketch finds very common are dealt out by
   stretch as well.
3. For the second kind, the bytes are fetched and the suffixes that begin at the
   minimizer are sorted: a merge sort whose comparisons find the common
   extension by binary search on prefix polynomial hashes.  Neighbours' common
   extensions bound the windows to the right, equal prefix hashes those to the
   left; every match is verified on the bytes.
4. Repeated windows are joined per text into maximal runs, cut out, and the rest
   hashed.

Texts are shuffled once (one row per distinct text and task) into a table bucketed
by text, which steps 1, 3 and 4 read without moving it again; equal texts are one
text in all steps and, being repeats of each other, go as a whole if they are
long enough.  Null text is empty: nothing to remove.  Rows that repeat count as
places of their own; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import uuid
from array import array
from collections import defaultdict
from collections.abc import Iterator
from functools import cmp_to_key
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bibflow.llm.common import materialize, scratch, text_of
from bibflow.session import ship_package

MATCH = 200
GRAM = 40
#: Bytes of a text that are hashed at a time.
BLOCK = 1 << 20
PAIRWISE = 12
#: Memory for the stretches of one minimizer that one task compares by sorting, and what one stretch takes there at most.
SORT_BYTES = 1 << 27
STRETCH_BYTES = 8_000
#: Stretches of one minimizer that are sorted; beyond, they are dealt out by the bytes on either side of it, and where
#: that is not enough, windows are counted by hash one by one.
SORT_LIMIT = SORT_BYTES // STRETCH_BYTES
#: A minimizer with this share of all rows is dealt out by stretch.
HOT_SHARE = 1e-4
HOT_KEYS = 1000
HOT_PARTS = 64
BASE = 0x9E3779B97F4A7C15
_U = np.uint64


def _powers(first: int, n: int) -> np.ndarray:
    out = np.full(n, first & (2**64 - 1), _U)
    out[0] = 1
    return np.multiply.accumulate(out)


class Hasher:
    """Prefix polynomial hashes modulo 2**64 of up to ``n`` bytes."""

    def __init__(self, n: int) -> None:
        self.power, self.inverse = _powers(BASE, n + 1), _powers(pow(BASE, -1, 2**64), n + 1)

    def prefix(self, data: bytes) -> np.ndarray:
        c = np.frombuffer(data, np.uint8).astype(_U) + _U(1)
        out = np.zeros(len(c) + 1, _U)
        np.cumsum(c * self.power[:len(c)], out=out[1:])
        return out

    def part(self, prefix: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of [begin, end), independent of where they are."""
        return (prefix[end] - prefix[begin]) * self.inverse[begin]


def scramble(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(32))) * _U(0xD6E8FEB86659FD93)
    h = (h ^ (h >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return h ^ (h >> _U(32))


_HASHER: list[Hasher] = []


def hasher() -> Hasher:
    if not _HASHER:
        _HASHER.append(Hasher(BLOCK + 2 * MATCH))
    return _HASHER[0]


def stretches(data: bytes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per block of a text: (minimizer hash, stretch hash, first window, windows, minimizer's offset in the stretch)."""
    w = MATCH - GRAM + 1
    hs = hasher()
    for at in range(0, len(data) - MATCH + 1, BLOCK):
        block = data[at:at + BLOCK + MATCH - 1]
        p = hs.prefix(block)
        n = len(block)
        i = np.arange(n - GRAM + 1)
        h = scramble(hs.part(p, i, i + GRAM))
        # The place in the low bits makes the least key the leftmost of equal hashes.
        key = (h & _U(0xFFFFFFFFFF000000)) | i.astype(_U)
        m = len(key)
        rows = -(-m // w)
        pad = np.full(rows * w, _U(2**64 - 1))
        pad[:m] = key
        pad = pad.reshape(rows, w)
        before = np.minimum.accumulate(pad, axis=1).ravel()
        after = np.minimum.accumulate(pad[:, ::-1], axis=1)[:, ::-1].ravel()
        k = m - w + 1
        place = (np.minimum(after[:k], before[w - 1:w - 1 + k]) & _U(0xFFFFFF)).astype(np.int64)
        cut = np.flatnonzero(np.diff(place)) + 1
        lo, hi = np.concatenate([[0], cut]), np.concatenate([cut, [k]])
        yield h[place[lo]], scramble(hs.part(p, lo, hi + MATCH - 1) + (hi - lo).astype(_U)), at + lo, hi - lo, place[lo] - lo


# A stretch's place and shape in one long: first window (44 bits), windows - 1 and minimizer offset (8 bits each).
def pack(first: np.ndarray, windows: np.ndarray, offset: np.ndarray) -> np.ndarray:
    return (first << 16) | ((windows - 1) << 8) | offset


def unpack(v: int) -> tuple[int, int, int]:
    return v >> 16, (v >> 8 & 255) + 1, v & 255


# ---- comparing the stretches of one minimizer ------------------------------------------------------------------------

class Stretch:
    """Bytes around a minimizer at ``offset``; its windows begin at 0 .. windows - 1."""

    __slots__ = ("data", "offset", "windows", "prefix", "marks")

    def __init__(self, data: bytes, offset: int, windows: int) -> None:
        self.data, self.offset, self.windows = data, offset, windows
        self.prefix = array("Q", hasher().prefix(data).tobytes())  # 8 bytes each, read as Python numbers
        self.marks = bytearray(windows)


_MASK = 2**64 - 1
_POWERS: list[int] = []


def _same(a: Stretch, i: int, b: Stretch, j: int, n: int) -> bool:
    """Whether a[i:i+n] and b[j:j+n] have equal polynomial hashes."""
    x, y = a.prefix[i + n] - a.prefix[i], b.prefix[j + n] - b.prefix[j]
    return ((x - y) if i == j else (x * _POWERS[j - i] - y) if j > i else (x - y * _POWERS[i - j])) & _MASK == 0


def right_extension(a: Stretch, b: Stretch) -> int:
    """Common bytes from the minimizer on: binary search on hashes, then checked on the bytes."""
    lo, hi = 0, min(len(a.data) - a.offset, len(b.data) - b.offset)
    while lo < hi:
        mid = (lo + hi + 1) // 2
        lo, hi = (mid, hi) if _same(a, a.offset, b, b.offset, mid) else (lo, mid - 1)
    while a.data[a.offset:a.offset + lo] != b.data[b.offset:b.offset + lo]:  # a collision
        lo -= 1
    return lo


def left_extension(a: Stretch, b: Stretch) -> int:
    lo, hi = 0, min(a.offset, b.offset)
    while lo < hi:
        mid = (lo + hi + 1) // 2
        lo, hi = (mid, hi) if _same(a, a.offset - mid, b, b.offset - mid, mid) else (lo, mid - 1)
    while a.data[a.offset - lo:a.offset] != b.data[b.offset - lo:b.offset]:
        lo -= 1
    return lo


def _compare(a: Stretch, b: Stretch) -> int:
    n = right_extension(a, b)
    x, y = a.data[a.offset + n:a.offset + n + 1], b.data[b.offset + n:b.offset + n + 1]
    return (x > y) - (x < y)


def mark_repeated(items: list[Stretch]) -> None:
    """Mark in each of the (distinct) stretches the windows that some other one has as well."""
    if not _POWERS:
        _POWERS.extend(hasher().power[:2 * MATCH + 1].tolist())
    items = sorted(items, key=cmp_to_key(_compare))  # a merge sort
    if len(items) <= PAIRWISE:
        for k, a in enumerate(items):
            for b in items[k + 1:]:
                right = right_extension(a, b)
                left = left_extension(a, b) if right + min(a.offset, b.offset) >= MATCH else 0
                if left + right >= MATCH:  # windows that begin ``left`` to ``MATCH - right`` bytes before the minimizer
                    for s in (a, b):
                        first, last = s.offset - left, min(s.offset - MATCH + right, s.windows - 1)
                        for x in range(max(first, 0), last + 1):
                            s.marks[x] = 1
        return
    common = np.array([0] + [right_extension(a, b) for a, b in zip(items, items[1:])])
    offset, windows = np.array([s.offset for s in items]), np.array([s.windows for s in items])
    width = max(len(s.data) for s in items) + 1
    prefix = np.zeros((len(items), width), _U)
    for k, s in enumerate(items):
        prefix[k, :len(s.prefix)] = s.prefix
    hs = hasher()
    row = np.arange(len(items))
    open_pairs: dict[int, tuple[int, int, int]] = {}  # stretch -> (partner, least and greatest bytes left of the minimizer)

    def close(k: int) -> None:
        partner, lo, hi = open_pairs.pop(k)
        a, b = items[k], items[partner]
        if a.data[a.offset - hi:a.offset - lo + MATCH] != b.data[b.offset - hi:b.offset - lo + MATCH]:
            raise ArithmeticError("hash collision")
        for x in range(a.offset - hi, a.offset - lo + 1):
            a.marks[x] = 1

    try:
        for left in range(int(offset.max()) + 1):
            # Windows ``left`` bytes before the minimizer need MATCH - left common bytes to its right: a run of the sorted order.
            at = offset - left
            ok = np.flatnonzero((at >= 0) & (at < windows))
            if len(ok) < 2:
                continue
            run = np.cumsum(common < MATCH - left)[ok]
            h = (prefix[row[ok], offset[ok]] - prefix[row[ok], at[ok]]) * hs.inverse[at[ok]]
            order = np.lexsort((h, run))
            same = (run[order][1:] == run[order][:-1]) & (h[order][1:] == h[order][:-1])
            for p in np.flatnonzero(same).tolist():
                a, b = int(ok[order[p]]), int(ok[order[p + 1]])
                for x, y in ((a, b), (b, a)):
                    got = open_pairs.get(x)
                    if got is not None and got[0] == y and got[2] >= left - 1:
                        open_pairs[x] = (y, got[1], left)
                    elif got is None or got[2] < left:
                        if got is not None:
                            close(x)
                        open_pairs[x] = (y, left, left)
        for k in list(open_pairs):
            close(k)
    except ArithmeticError:  # compare the windows' bytes themselves
        seen: dict[bytes, list[tuple[Stretch, int]]] = defaultdict(list)
        for s in items:
            s.marks = bytearray(s.windows)
            for x in range(s.windows):
                seen[s.data[x:x + MATCH]].append((s, x))
        for places in seen.values():
            if len(places) > 1:
                for s, x in places:
                    s.marks[x] = 1


def runs_of(marks: bytearray) -> Iterator[tuple[int, int]]:
    """Maximal runs [a, b) of marked windows."""
    a = marks.find(1)
    while a >= 0:
        b = marks.find(0, a)
        b = len(marks) if b < 0 else b
        yield a, b
        a = marks.find(1, b)


# ---- Spark ----------------------------------------------------------------------------------------------------------

STATE_COVERED, STATE_ALONE, STATE_TWICE, STATE_OPEN = 0, 1, 2, 3
ROWS = "h bigint, c bigint, t1 bigint, t2 bigint, v bigint, state tinyint"


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64), pa.int64())


def _emit_stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per stretch; within a batch, equal stretches are covered and only one of them goes on as STATE_TWICE."""
    for batch in batches:
        parts, ids = [], []
        for t1, t2, text in zip(batch.column("t1").to_pylist(), batch.column("t2").to_pylist(), batch.column("text"), strict=True):
            for h, c, first, windows, offset in stretches(text.as_py().encode()):
                parts.append((h, c, pack(first, windows, offset)))
                ids.append((t1, t2, len(h)))
        if not parts:
            continue
        h, c, v = (np.concatenate(x) for x in zip(*parts))
        n = [x[2] for x in ids]
        t1, t2 = (np.repeat(np.array([x[k] for x in ids], np.int64), n) for k in (0, 1))
        order = np.lexsort((c, h))
        equal = np.zeros(len(h) + 1, bool)
        equal[1:-1] = (h[order][1:] == h[order][:-1]) & (c[order][1:] == c[order][:-1])
        state = np.where(equal[:-1], STATE_COVERED, np.where(equal[1:], STATE_TWICE, STATE_OPEN)).astype(np.int8)
        yield pa.RecordBatch.from_arrays([_long(h[order]), _long(c[order]), pa.array(t1[order]), pa.array(t2[order]),
                                          pa.array(v[order]), pa.array(state)], names=["h", "c", "t1", "t2", "v", "state"])


def _resolve(hot: frozenset[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by (h, c): decide which stretches occur twice; only rows of shared minimizers go on.

        Whatever the size of a group, only one stretch is held: the first of a
        minimizer waits until a second one shows that it is shared.
        """
        out: list[tuple] = []
        waiting: list[tuple] | None = None  # rows of the first stretch of the current minimizer
        last_h = shared = None
        current: list[tuple] = []  # first row of the current stretch
        twice = False

        def end_stretch() -> Iterator[tuple]:
            nonlocal waiting, shared
            if not current:
                return
            row = (*current[0][:5], STATE_TWICE if twice else STATE_ALONE)
            if shared:
                yield row
            elif waiting is None:
                waiting = [row]
            else:
                shared = True
                yield from waiting
                yield row
                waiting = None

        def end_minimizer() -> Iterator[tuple]:
            if waiting and waiting[0][5] == STATE_TWICE:  # alone with its minimizer, but repeated
                yield (*waiting[0][:5], STATE_COVERED)

        def flush() -> pa.RecordBatch:
            cols = list(zip(*out))
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in cols[:5]] + [pa.array(cols[5], pa.int8())],
                                              names=["h", "c", "t1", "t2", "v", "state"])

        key = None
        for batch in batches:
            for row in zip(*(batch.column(x).to_pylist() for x in ("h", "c", "t1", "t2", "v", "state"))):
                if (row[0], row[1]) != key:
                    out.extend(end_stretch())
                    if row[0] != last_h:
                        out.extend(end_minimizer())
                        last_h, waiting, shared = row[0], None, row[0] in hot
                    key, twice = (row[0], row[1]), row[5] == STATE_TWICE
                    current[:] = [row]
                elif row[2:5] != current[0][2:5]:
                    twice = True
                    out.append((*row[:5], STATE_COVERED))
                if len(out) >= 20_000:
                    yield flush()
        out.extend(end_stretch())
        out.extend(end_minimizer())
        if out:
            yield flush()

    return run


PIECES = "h bigint, t1 bigint, t2 bigint, v bigint, data binary"
COVER = "t1 bigint, t2 bigint, a bigint, b bigint"


def _fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[tuple] = []
        for t1, t2, text, places in zip(*(batch.column(x) for x in ("t1", "t2", "text", "places"))):
            data, t1, t2 = text.as_py().encode(), t1.as_py(), t2.as_py()
            for p in places.as_py():
                first, windows, _ = unpack(p["v"])
                out.append((p["h"], t1, t2, p["v"], data[first:first + windows + MATCH - 1]))
                if len(out) >= 20_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _PIECE_TYPES)], names=_PIECE_NAMES)
                    out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _PIECE_TYPES)], names=_PIECE_NAMES)


_PIECE_NAMES = ["h", "t1", "t2", "v", "data"]
_PIECE_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]


def _compare_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches sorted by minimizer: the repeated windows of each as covered byte ranges."""
    rows = (r for batch in batches for r in zip(*(batch.column(x).to_pylist() for x in _PIECE_NAMES)))
    out: list[tuple] = []
    for _, group in groupby(rows, key=lambda r: r[0]):
        distinct: dict[tuple[bytes, int], tuple[Stretch, list]] = {}
        for _, t1, t2, v, data in group:
            first, windows, offset = unpack(v)
            got = distinct.get((data, offset))
            if got is None:
                got = distinct[data, offset] = (Stretch(data, offset, windows), [])
            got[1].append((t1, t2, first))
        if len(distinct) > 1:
            mark_repeated([s for s, _ in distinct.values()])
        for s, places in distinct.values():
            if len(set(places)) > 1:
                s.marks = bytearray(b"\1") * s.windows
            for a, b in runs_of(s.marks):
                out += [(t1, t2, first + a, first + b - 1 + MATCH) for t1, t2, first in set(places)]
        if len(out) >= 20_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["t1", "t2", "a", "b"])
            out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["t1", "t2", "a", "b"])


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every window of the stretches of an oversized group by itself: two hashes and its place."""
    for batch in batches:
        for h, t1, t2, v, data in zip(*(batch.column(x).to_pylist() for x in _PIECE_NAMES)):
            first, windows, _ = unpack(v)
            digests = [hashlib.blake2b(data[x:x + MATCH], digest_size=16).digest() for x in range(windows)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(digests, pa.binary()), pa.array([t1] * windows, pa.int64()), pa.array([t2] * windows, pa.int64()),
                 pa.array(range(first, first + windows), pa.int64())], names=["d", "t1", "t2", "a"])


def _by_sides(pieces: DataFrame) -> DataFrame:
    """``pieces`` with ``h`` replaced by keys of the bytes next to the minimizer, up to two rows per stretch.

    A window has ``MATCH - GRAM`` bytes besides its minimizer, so at least half of
    them on one side: stretches with a common window agree in that side's key.
    """
    half = (MATCH - GRAM) // 2
    offset = F.col("v").bitwiseAND(F.lit(255)).cast("int")
    left = F.when(offset >= half, F.xxhash64("h", F.lit(0), F.substring("data", offset - half + 1, F.lit(half))))
    right = F.when(F.octet_length("data") - offset - GRAM >= half,
                   F.xxhash64("h", F.lit(1), F.substring("data", offset + GRAM + 1, F.lit(half))))
    keys = F.explode(F.array_compact(F.array(left, right)))
    return pieces.select(keys.alias("h"), *_PIECE_NAMES[1:])


CUT = "t1 bigint, t2 bigint, n_removed bigint, n_spans bigint, kept_sha256 string"


def _merge(ranges: list[tuple[int, int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for t1, t2, text, ranges in zip(*(batch.column(x) for x in ("t1", "t2", "text", "ranges"))):
            data, spans = text.as_py().encode(), _merge([(r["a"], r["b"]) for r in ranges.as_py()])
            digest, at = hashlib.sha256(), 0
            for a, b in spans:
                digest.update(data[at:a])
                at = b
            digest.update(data[at:])
            out.append((t1.as_py(), t2.as_py(), sum(b - a for a, b in spans), len(spans), digest.hexdigest()))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string() if k == 4 else pa.int64()) for k, c in enumerate(zip(*out))],
                                             names=["t1", "t2", "n_removed", "n_spans", "kept_sha256"])


def hot_minimizers(rows: DataFrame) -> frozenset[int]:
    """At most ``HOT_KEYS`` minimizers with more than ``HOT_SHARE`` of all rows, by a mergeable frequent-items sketch."""
    got = rows.agg(F.count("*").alias("n"), F.expr(f"approx_top_k(h, {HOT_KEYS}, {HOT_KEYS * 10})").alias("top")).first()
    return frozenset(x["item"] for x in got["top"] or () if x["count"] > max(1000, HOT_SHARE * got["n"]))


def _stored_by_text(texts: DataFrame) -> str:
    """Name of a table of the distinct (t1, t2, text), bucketed by t1 and t2.

    It has as many buckets as shuffles have partitions, so a task of the shuffle that finds the distinct texts writes whole buckets.
    """
    spark = texts.sparkSession
    name = f"suffix_texts_{uuid.uuid4().hex}"
    (texts.groupBy("t1", "t2").agg(F.first("text").alias("text")).write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "t1", "t2")
     .format("parquet").option("path", scratch(spark, name)).saveAsTable(name))
    return name


def dedup_strings(docs: DataFrame, text: str = "text") -> DataFrame:
    """Every row of ``docs`` without its text, plus sd_n_bytes, sd_n_removed, sd_n_spans, sd_kept_sha256."""
    ship_package(docs.sparkSession)
    others = [c for c in docs.columns if c != text]
    t = text_of(text)
    ids = [F.xxhash64(t).alias("t1"), F.xxhash64(F.lit(7), t).alias("t2")]
    rows = materialize(docs.select(*[docs[c].alias(f"c{k}") for k, c in enumerate(others)], F.octet_length(t).cast("bigint").alias("n"),
                                   F.sha2(t, 256).alias("sha"), *ids), "texts")
    stored = _stored_by_text(docs.where(F.octet_length(t) >= MATCH).select(*ids, t.alias("text")))
    distinct = docs.sparkSession.table(stored)
    found = materialize(distinct.mapInArrow(_emit_stretches, ROWS), "stretches")
    hot = hot_minimizers(found)
    part = F.when(F.col("h").isin(list(hot)), F.pmod("c", F.lit(HOT_PARTS))).otherwise(0) if hot else F.lit(0)
    shared = (found.where(F.col("state") != STATE_COVERED).withColumn("p", part).repartition("h", "p")
              .sortWithinPartitions("h", "c").drop("p").mapInArrow(_resolve(hot), ROWS))
    shared = materialize(shared, "shared-stretches")

    open_rows = shared.where(F.col("state").isin(STATE_ALONE, STATE_TWICE))
    places = open_rows.groupBy("t1", "t2").agg(F.collect_list(F.struct("h", "v")).alias("places"))
    pieces = distinct.join(places, ["t1", "t2"]).select("t1", "t2", "text", "places").mapInArrow(_fetch, PIECES)
    large = open_rows.groupBy("h").agg(F.count("*").alias("m")).where(F.col("m") > SORT_LIMIT).select("h")
    cover = pieces
    ranges = []
    if not large.isEmpty():
        large = materialize(large, "large-groups")
        pieces = materialize(pieces, "stretch-bytes")
        sides = materialize(_by_sides(pieces.join(large, "h", "left_semi").select(*_PIECE_NAMES)), "sides")
        still = materialize(sides.groupBy("h").agg(F.count("*").alias("m")).where(F.col("m") > SORT_LIMIT).select("h"), "large-sides")
        windows = materialize(sides.join(still, "h", "left_semi").select(*_PIECE_NAMES).dropDuplicates(["t1", "t2", "v"])
                              .mapInArrow(_windows, "d binary, t1 bigint, t2 bigint, a bigint"), "windows")
        again = windows.groupBy("d").agg(F.min(F.struct("t1", "t2", "a")).alias("x"), F.max(F.struct("t1", "t2", "a")).alias("y"))
        again = again.where("x <> y").select("d")
        ranges.append(windows.join(again, "d").select("t1", "t2", "a", (F.col("a") + MATCH).alias("b")))
        cover = pieces.join(large, "h", "left_anti").select(*_PIECE_NAMES).unionByName(
            sides.join(still, "h", "left_anti").select(*_PIECE_NAMES))
    ranges.append(cover.repartition("h").sortWithinPartitions("h").mapInArrow(_compare_groups, COVER))
    first, windows_n = F.shiftright("v", 16), F.shiftright("v", 8).bitwiseAND(F.lit(255)) + 1
    whole = found.where(F.col("state") != STATE_OPEN).unionByName(shared.where(F.col("state") != STATE_ALONE))
    ranges.append(whole.select("t1", "t2", first.alias("a"), (first + windows_n - 1 + MATCH).alias("b")))
    covered = ranges[0]
    for r in ranges[1:]:
        covered = covered.unionByName(r)
    covered = covered.groupBy("t1", "t2").agg(F.collect_list(F.struct("a", "b")).alias("ranges"))
    cut = materialize(distinct.join(covered, ["t1", "t2"]).select("t1", "t2", "text", "ranges").mapInArrow(_cut, CUT), "cut-texts")
    docs.sparkSession.sql(f"DROP TABLE {stored}")  # the name only: the files are in the shared folder

    copies = rows.groupBy("t1", "t2").agg(F.count("*").alias("copies")).where("copies > 1")
    notes = materialize(cut.join(copies, ["t1", "t2"], "full_outer").select(
        F.col("t1").alias("x1"), F.col("t2").alias("x2"), "copies", "n_removed", "n_spans", "kept_sha256"), "text-notes")
    df = rows.join(notes, (F.col("t1") == F.col("x1")) & (F.col("t2") == F.col("x2")), "left")
    gone = F.coalesce((F.col("copies") > 1) & (F.col("n") >= MATCH), F.lit(False))
    nothing = hashlib.sha256().hexdigest()
    return df.select(*[F.col(f"c{k}").alias(c) for k, c in enumerate(others)], F.col("n").alias("sd_n_bytes"),
                     F.when(gone, F.col("n")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("sd_n_removed"),
                     F.when(gone, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("bigint").alias("sd_n_spans"),
                     F.when(gone, F.lit(nothing)).otherwise(F.coalesce("kept_sha256", "sha")).alias("sd_kept_sha256"))
