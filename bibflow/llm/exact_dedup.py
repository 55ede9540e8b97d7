"""Exact deduplication against a history through minimal perfect hashes.

The distinct digests of the history are dealt into buckets by digest prefix, so
many that neither history nor batch has more than about ``BUCKET_DIGESTS``
digests in one; each bucket gets a minimal perfect hash
(hash and displace) and one index row whose slots hold, in slot order, the full
digests, the winners' locators and the group sizes.  A batch is summed per
digest first, each sum is sent to its bucket, hashed to its slot and compared
with the full digest there: members join that group, nonmembers are grouped on
their own.  Only digests and ids are ever shuffled.

Null text counts as empty.  Ids are 64-bit; the least one stands for null inside.  The row with the largest id stays (null is smaller
than any id); among rows with that same id the one read last stays, so each
group keeps exactly one row.  An empty history or batch is fine.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bibflow.llm.common import materialize, text_of
from bibflow.session import ship_package

BUCKET_DIGESTS = 16_384
KEYS_PER_GROUP = 4
NO_ID = -2**63
INDEX_SCHEMA = ("bucket int, m int, seeds array<int>, digests binary, winner_id array<bigint>, "
                "winner_row array<bigint>, sizes array<bigint>")
FOUND_COLUMNS = ["digest", "keep_id", "keep_row", "group_size", "member"]
FOUND_SCHEMA = "digest binary, keep_id bigint, keep_row bigint, group_size bigint, member boolean"


def _hashes(digests: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Three independent 63-bit hashes from the bytes of (n, 32) digests; the first 4 bytes chose the bucket."""
    words = digests[:, 4:28].copy().view("<u8")
    return words[:, 0] >> np.uint64(1), words[:, 1] >> np.uint64(1), words[:, 2] >> np.uint64(1)


def build_hash(digests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(seeds, slot of each digest) of a minimal perfect hash over distinct (n, 32) digests.

    Groups are placed largest first; a seed is tried until all of a group's
    slots are free.  A group of one takes any free slot, stored as ``-slot - 1``.
    """
    m = len(digests)
    h0, h1, h2 = _hashes(digests)
    r = max(1, -(-m // KEYS_PER_GROUP))
    group = (h0 % np.uint64(r)).astype(np.int64)
    seeds, slot, used = np.zeros(r, np.int32), np.zeros(m, np.int64), np.zeros(m, bool)
    order = np.argsort(group, kind="stable")
    starts = np.searchsorted(group[order], np.arange(r + 1))
    sizes = np.diff(starts)
    for g in np.argsort(-sizes, kind="stable"):
        if sizes[g] < 2:
            break
        keys = order[starts[g]:starts[g + 1]]
        a, b = (h1[keys] % np.uint64(m)).astype(np.int64), (h2[keys] | np.uint64(1)).astype(np.uint64)
        for seed in range(1, 2**31 - 1):
            at = (a + ((b * np.uint64(seed)) >> np.uint64(33)).astype(np.int64)) % m
            if not used[at].any() and len(set(at.tolist())) == len(at):
                seeds[g], slot[keys], used[at] = seed, at, True
                break
    free = iter(np.flatnonzero(~used).tolist())
    for g in np.flatnonzero(sizes == 1):
        at = next(free)
        seeds[g], slot[order[starts[g]]] = -at - 1, at
    return seeds, slot


def find_slots(digests: np.ndarray, seeds: np.ndarray, m: int) -> np.ndarray:
    """The slot of each digest; meaningless for nonmembers until the slot's digest is compared."""
    h0, h1, h2 = _hashes(digests)
    seed = seeds[(h0 % np.uint64(len(seeds))).astype(np.int64)].astype(np.int64)
    spread = (((h2 | np.uint64(1)) * np.maximum(seed, 0).astype(np.uint64)) >> np.uint64(33)).astype(np.int64)
    return np.where(seed < 0, -seed - 1, ((h1 % np.uint64(m)).astype(np.int64) + spread) % m)


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint8).reshape(-1, 32)


def _build(pdf: pd.DataFrame) -> pd.DataFrame:
    digests = _matrix(pdf["digest"])
    seeds, slot = build_hash(digests)
    at = np.argsort(slot)
    pick = lambda c: pdf[c].iloc[at].tolist()
    return pd.DataFrame([{"bucket": int(pdf["bucket"].iloc[0]), "m": len(digests), "seeds": seeds.tolist(),
                          "digests": digests[at].tobytes(), "winner_id": pick("id"), "winner_row": pick("row"),
                          "sizes": pick("n")}])


def _look_up(index: pd.DataFrame, batch: pd.DataFrame) -> pd.DataFrame:
    """Groups of one bucket: the index's own, updated by the members of the batch, and nonmembers as they are."""
    new = batch[["digest", "id", "row", "n"]].set_axis(FOUND_COLUMNS[:4], axis=1).assign(member=False)
    if not len(index):
        return new
    row = index.iloc[0]
    held = np.frombuffer(row["digests"], np.uint8).reshape(-1, 32)
    ids, rows, sizes = (np.array(row[c], np.int64) for c in ("winner_id", "winner_row", "sizes"))
    if len(new):
        digests = _matrix(new["digest"])
        slots = find_slots(digests, np.asarray(row["seeds"], np.int32), int(row["m"]))
        member = (held[slots] == digests).all(axis=1)  # byte check
        s = slots[member]  # each digest is there once, so are its slots
        i, r, n = (new[c].to_numpy(np.int64)[member] for c in FOUND_COLUMNS[1:4])
        wins = (i > ids[s]) | ((i == ids[s]) & (r > rows[s]))
        ids[s], rows[s] = np.where(wins, i, ids[s]), np.where(wins, r, rows[s])
        sizes[s] += n
        new = new[~member]
    groups = pd.DataFrame(dict(zip(FOUND_COLUMNS, ([d.tobytes() for d in held], ids, rows, sizes, True))))
    return pd.concat([groups, new], ignore_index=True) if len(new) else groups


def _distinct(rows: DataFrame, buckets: int) -> DataFrame:
    """One row per digest: its winner (id, row), its count and its bucket."""
    return rows.groupBy("digest").agg(
        F.max(F.struct("id", "row")).alias("w"), F.count("*").alias("n")).select(
        "digest", F.col("w.id").alias("id"), F.col("w.row").alias("row"), "n",
        (F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("bigint") % buckets).cast("int").alias("bucket"))


def build_index(history: DataFrame, buckets: int) -> DataFrame:
    """The index table of a history of (digest, id, row): one row per bucket, written to the shared folder."""
    ship_package(history.sparkSession)
    return materialize(_distinct(history, buckets).groupBy("bucket").applyInPandas(_build, INDEX_SCHEMA), "mph-index")


def look_up(index: DataFrame, batch: DataFrame, buckets: int) -> DataFrame:
    """All groups of history and batch (digest, keep_id, keep_row, group_size, member)."""
    ship_package(batch.sparkSession)
    return (index.groupBy("bucket").cogroup(_distinct(batch, buckets).groupBy("bucket"))
            .applyInPandas(_look_up, FOUND_SCHEMA))


def dedup(docs: DataFrame, historical: Column, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row of ``docs`` without its text, plus ed_keep_id, ed_group_size, ed_kept, ed_text_sha256.

    Rows where ``historical`` holds form the index; all others (null included)
    are the batch that is looked up in it.
    """
    others = [F.col(f"`{c}`").alias(f"c_{c}") for c in docs.columns if c != text]
    rows = materialize(docs.select(
        *others, F.unhex(F.sha2(text_of(text), 256)).alias("digest"), F.coalesce(F.col(f"`{doc_id}`").cast("bigint"), F.lit(NO_ID)).alias("id"),
        F.monotonically_increasing_id().alias("row"), F.coalesce(historical, F.lit(False)).alias("old")), "digests")
    keys = rows.select("digest", "id", "row", "old")
    # The rows of the larger side; its distinct digests are no more.
    n = max([r["count"] for r in keys.groupBy("old").count().collect()], default=0)
    buckets = max(1, -(-n // BUCKET_DIGESTS))
    index = build_index(keys.where("old"), buckets)
    groups = look_up(index, keys.where("NOT old"), buckets)
    return rows.join(groups, "digest").select(
        *[F.col(f"`c_{c}`").alias(c) for c in docs.columns if c != text],
        F.nullif(F.col("keep_id"), F.lit(NO_ID)).alias("ed_keep_id"), F.col("group_size").alias("ed_group_size"),
        (F.col("row") == F.col("keep_row")).alias("ed_kept"), F.lower(F.hex("digest")).alias("ed_text_sha256"))
