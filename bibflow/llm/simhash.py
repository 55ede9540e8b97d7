"""SimHash near-duplicates by tiled exact comparison.

Texts are fingerprinted in tasks; only distinct fingerprints are compared.
Comparison units are tiles: arrays of fingerprints, xor-ed and bit-counted with
numpy, tile pairs whose population counts differ by more than the radius left
out.  Which tiles can hold a link at all follows from the pigeonhole rule: cut
into ``radius + k`` pieces, two linked fingerprints share at least ``k`` whole
pieces, so every choice of ``k`` pieces deals the fingerprints into blocks and
each link lies inside a block.  ``k`` grows with the number of fingerprints so
that blocks stay small; every choice is exact.  A block of more than
``TILE`` fingerprints is split by population count and hash into tiles that
are compared as separate pairs, so no task holds more than two tiles.

A dense tile pair emits a spanning set of its links, not all of them; the
components of all links come from :func:`bibflow.llm.common.components`.

Null text counts as empty: fingerprint zero, linked like any other.  Repeated
rows get the same fingerprint and component.  Null ids are larger than any id
when a component is named; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from bibflow.llm.common import clash_free, components, materialize, text_of
from bibflow.session import ship_package

SEED = 42
SHINGLE_WORDS = 4
RADIUS = 4
BITS = 64
TILE = 4096
#: Fingerprints per block that ``k`` aims at, if they were spread evenly.
BLOCK_AIM = 1024
VOTE_ROWS = 1 << 16
EDGES = "a long, b long"


def fingerprint(text: str, words: int = SHINGLE_WORDS) -> int:
    """The 64-bit fingerprint of one text; bytes.lower and bytes.split are A-Z and the six separators only."""
    import xxhash

    parts = text.encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return 0
    n = max(1, len(parts) - words + 1)
    joined = b" ".join(parts)
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(sizes + 1) - 1
    begins = (ends - sizes)[:n].tolist()
    ends = ends[min(words, len(parts)) - 1:].tolist()
    votes = np.zeros(BITS, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, VOTE_ROWS):
        h = np.array([digest(joined[a:b], SEED) for a, b in zip(begins[at:at + VOTE_ROWS], ends[at:at + VOTE_ROWS], strict=True)], "<u8")
        votes += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > n, bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, text: str = "text", words: int = SHINGLE_WORDS) -> DataFrame:
    """The other columns of ``docs`` as c0, c1, ... and sh_bits (the fingerprint as a signed long)."""
    ship_package(docs.sparkSession)
    others = [c for c in docs.columns if c != text]
    plain = docs.select(text_of(text).alias("text"), *[docs[c].alias(f"c{k}") for k, c in enumerate(others)])
    schema = StructType([StructField(f"c{k}", docs.schema[c].dataType) for k, c in enumerate(others)]
                        + [StructField("sh_bits", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = np.array([fingerprint(t, words) for t in batch.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([*(batch.column(f"c{k}") for k in range(len(others))),
                                              pa.array(bits.view(np.int64))], names=[f.name for f in schema.fields])

    return plain.mapInArrow(run, schema)


def links(a: np.ndarray, b: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links (left, right) between tiles of unsigned fingerprints; ``a is b`` compares a tile with itself."""
    left, right = [], []
    order = np.argsort(np.bitwise_count(b), kind="stable")
    b2, pop_b = b[order], np.bitwise_count(b[order]).astype(np.int16)
    near = np.zeros((len(a), len(b2)), bool)
    pop_a = np.bitwise_count(a).astype(np.int16)
    for i in range(0, len(a), 256):
        rows = slice(i, i + 256)
        lo = np.searchsorted(pop_b, pop_a[rows].min() - radius)
        hi = np.searchsorted(pop_b, pop_a[rows].max() + radius, side="right")
        near[rows, lo:hi] = np.bitwise_count(a[rows, None] ^ b2[None, lo:hi]) <= radius
    if near.sum() <= 8 * (len(a) + len(b2)):
        i, j = np.nonzero(near)
        left, right = a[i], b2[j]
        keep = left != right
        return left[keep], right[keep]
    # Many links: label both sides with the least fingerprint they reach inside this pair of tiles.
    la, lb = a.copy(), b2.copy()
    worst = np.uint64(2**64 - 1)
    while True:
        before = (la.copy(), lb.copy())
        for i in range(0, len(a), 256):
            part = near[i:i + 256]
            la[i:i + 256] = np.minimum(la[i:i + 256], np.where(part, lb[None], worst).min(axis=1))
            lb = np.minimum(lb, np.where(part, la[i:i + 256, None], worst).min(axis=0))
        if (la == before[0]).all() and (lb == before[1]).all():
            break
    left, right = np.concatenate([a, b2]), np.concatenate([la, lb])
    keep = left != right
    return left[keep], right[keep]


def _pieces(k: int, radius: int) -> list[list[tuple[int, int]]]:
    """Every choice of ``k`` of the ``radius + k`` pieces, a piece as (first bit, bits)."""
    m = radius + k
    cuts = [BITS * i // m for i in range(m + 1)]
    return [list(c) for c in combinations([(a, b - a) for a, b in zip(cuts, cuts[1:])], k)]


def _block_key(bits: Column, choice: list[tuple[int, int]]) -> Column:
    mask = 0
    for first, n in choice:
        mask |= ((1 << n) - 1) << first
    return bits.bitwiseAND(F.lit(mask - 2**64 if mask >= 2**63 else mask))


def choose_k(n: int, radius: int) -> int:
    k = 1
    while k < 4 and n >> (BITS * k // (radius + k)) > BLOCK_AIM:
        k += 1
    return k


def _unsigned(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


def linked(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Spanning links (a, b) among distinct fingerprints (one long column, sh_bits)."""
    ship_package(prints.sparkSession)
    choices = _pieces(choose_k(prints.count(), radius), radius)
    blocks = prints.select(F.posexplode(F.array(*[_block_key(F.col("sh_bits"), c) for c in choices])).alias("t", "key"), "sh_bits")
    large = materialize(blocks.groupBy("t", "key").agg(F.count("*").alias("n")).where(F.col("n") > TILE)
                        .select(F.col("t").alias("lt"), F.col("key").alias("lkey"), "n"), "large-blocks")
    mark = blocks.join(large, (F.col("t") == F.col("lt")) & (F.col("key") == F.col("lkey")), "left")
    small = mark.where("n IS NULL").select("t", "key", "sh_bits")

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            t, key = batch.column("t").to_numpy(), batch.column("key").to_numpy()
            bits = _unsigned(batch.column("sh_bits"))
            if held is not None:
                t, key, bits = (np.concatenate(x) for x in zip(held, (t, key, bits)))
            cut = np.flatnonzero((t[1:] != t[:-1]) | (key[1:] != key[:-1])) + 1
            cut = np.concatenate([[0], cut])
            yield from found(bits, cut)
            held = (t[cut[-1]:], key[cut[-1]:], bits[cut[-1]:])  # the last block may go on
        if held is not None:
            yield from found(held[2], np.array([0, len(held[2])]))

    def found(bits: np.ndarray, cut: np.ndarray) -> Iterator[pa.RecordBatch]:
        a, b = [], []
        for i, j in zip(cut[:-1], cut[1:]):
            if j - i > 1:
                x, y = links(bits[i:j], bits[i:j], radius)
                if len(x):
                    a.append(x)
                    b.append(y)
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a).view(np.int64)), pa.array(np.concatenate(b).view(np.int64))],
                                             names=["a", "b"])

    edges = small.repartition("t", "key").sortWithinPartitions("t", "key").mapInArrow(within, EDGES)

    # Large blocks: tiles by population count and hash, then pairs of tiles.
    tiled = mark.where("n IS NOT NULL").select(
        "t", "key", "sh_bits", F.bit_count("sh_bits").alias("pop"),
        F.pmod(F.xxhash64("sh_bits"), F.ceil(F.col("n") / TILE)).alias("part"))
    tiles = tiled.groupBy("t", "key", "pop", "part").agg(F.count("*").alias("size"))
    one, two = tiles.alias("x"), tiles.alias("y")
    pairs = materialize(one.join(two, [F.col("x.t") == F.col("y.t"), F.col("x.key") == F.col("y.key"),
                                       F.col("y.pop") - F.col("x.pop") <= radius,
                                       F.struct("x.pop", "x.part") <= F.struct("y.pop", "y.part")])
                        .select("x.t", "x.key", F.col("x.pop").alias("p1"), F.col("x.part").alias("q1"),
                                F.col("y.pop").alias("p2"), F.col("y.part").alias("q2"))
                        .withColumn("pair", F.monotonically_increasing_id()), "tile-pairs")
    sides = [tiled.join(pairs.select("t", "key", F.col(f"p{s}").alias("pop"), F.col(f"q{s}").alias("part"), "pair",
                                     F.lit(s).alias("side")), ["t", "key", "pop", "part"]).select("pair", "side", "sh_bits")
             for s in (1, 2)]

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((p, s, v) for batch in batches for p, s, v in zip(
            batch.column("pair").to_pylist(), batch.column("side").to_pylist(), _unsigned(batch.column("sh_bits")).tolist()))
        for _, group in groupby(rows, key=lambda r: r[0]):
            tile = {1: [], 2: []}
            for _, s, v in group:
                tile[s].append(v)
            a, b = links(np.array(tile[1], np.uint64), np.array(tile[2], np.uint64), radius)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    return edges.unionByName(sides[0].unionByName(sides[1]).repartition("pair").sortWithinPartitions("pair")
                             .mapInArrow(across, EDGES))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS,
                    radius: int = RADIUS) -> DataFrame:
    """Every row of ``docs`` without its text, plus sh_fingerprint (hex), sh_component (smallest id reachable) and
    sh_root (a fingerprint that names the component where ids are null)."""
    others = [c for c in docs.columns if c != text]
    rows = materialize(with_fingerprint(docs, text, words), "fingerprints")
    prints = materialize(rows.select("sh_bits").distinct(), "distinct-fingerprints")
    roots = components(linked(prints, radius)).select(F.col("node").alias("f"), "root")
    prints = prints.join(roots, F.col("sh_bits") == F.col("f"), "left").select("sh_bits", F.coalesce("root", "sh_bits").alias("root"))
    key = f"c{others.index(doc_id)}"
    # Ids are summed per fingerprint first, so a large group of copies is one row from each task.
    ids = rows.groupBy("sh_bits").agg(F.min(key).alias("m")).join(prints, "sh_bits")
    names = ids.groupBy("root").agg(F.min("m").alias("sh_component"))
    members = materialize(ids.select("sh_bits", "root").join(names, "root").select(F.col("sh_bits").alias("f"), "sh_component", F.col("root").alias("sh_root")),
                          "fingerprint-components")
    named = rows.join(members, F.col("sh_bits") == F.col("f"))
    return named.select(*[F.col(f"c{k}").alias(c) for k, c in enumerate(others)],
                        F.lower(F.lpad(F.hex("sh_bits"), 16, "0")).alias("sh_fingerprint"), "sh_component", "sh_root")


@clash_free("sh_", "wa", "wb", "wi", "f")
def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS,
             radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` that name their component; of rows that share that id, one stays.

    Rows are recognised by id and text hash; the decisions are shuffled, and
    the texts once, at every size (the winners grow with the corpus).
    """
    t = text_of(text)
    marks = [F.xxhash64(t).alias("sh_a"), F.xxhash64(F.lit(7), t).alias("sh_b")]
    found = near_duplicates(docs.select(F.col(f"`{doc_id}`").alias("sh_id"), F.col(f"`{text}`").alias("sh_text"), *marks),
                            "sh_id", "sh_text", words, radius)
    named = found.where(F.col("sh_id").eqNullSafe(F.col("sh_component")))
    winners = named.groupBy("sh_root").agg(F.min(F.struct("sh_a", "sh_b", "sh_id")).alias("w")).select("w.*")
    same = named.groupBy("sh_a", "sh_b", "sh_id").agg(F.count("*").alias("sh_n"))
    winners = materialize(winners.join(same.select(F.col("sh_a").alias("xa"), F.col("sh_b").alias("xb"), F.col("sh_id").alias("xi"), "sh_n"),
                                       (F.col("sh_a") == F.col("xa")) & (F.col("sh_b") == F.col("xb")) & F.col("sh_id").eqNullSafe(F.col("xi")))
                          .select(F.col("sh_a").alias("wa"), F.col("sh_b").alias("wb"), F.col("sh_id").alias("wi"), "sh_n"), "component-winners")
    rows = docs.select("*", *marks)
    kept = rows.join(winners.hint("shuffle_hash"), (F.col("sh_a") == F.col("wa")) & (F.col("sh_b") == F.col("wb"))
                     & F.col(f"`{doc_id}`").eqNullSafe(F.col("wi")))
    single = kept.where("sh_n = 1")
    again = kept.where("sh_n > 1").withColumn("sh_k", F.row_number().over(Window.partitionBy("wa", "wb", "wi").orderBy("sh_a")))
    cols = [F.col(f"`{c}`") for c in docs.columns]
    return single.select(*cols).unionByName(again.where("sh_k = 1").select(*cols))
