"""Best-fit packing of tokenized documents into fixed-length sequences.

1. Tasks tokenize whole texts, cut documents longer than a sequence (the first
   piece takes the remainder, so all others are full) and number the pieces of
   each length within the task.  The piece table is written once.
2. Packing only depends on how many pieces of each length there are: at most
   ``CAPACITY`` counts, whatever the corpus holds.  On these counts the
   Martello-Toth dominance criterion fixes sets of one, two or three pieces
   that are at least as good as any alternative for the longest piece left;
   what remains is packed by best fit decreasing.  The plan is a short table:
   which ranks of a length go to which run of sequences at which offset.
3. A piece's rank within its length is its number in the task plus the counts
   of earlier tasks, so no length, however common, is sorted in one task.  A
   join with the plan gives sequence and offset.

Null text is empty (the separator alone is its one piece); repeated rows are
separate documents; null ids are kept; an empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import json
import os
import sys
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from bibflow.llm.common import materialize
from bibflow.llm.token_counts import byte_letters
from bibflow.session import ship_package

CAPACITY = 2048
END_OF_DOCUMENT = 0
# Fixed value: how a byte-level file of this kind splits a text.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PIECE_FIELDS = [("piece", IntegerType()), ("start", LongType()), ("length", LongType()), ("ids_crc32", LongType()),
                ("task", IntegerType()), ("number", LongType())]


class Encoder:
    """Ids of whole texts, as little-endian 32-bit integers, of a byte-level BPE file of the tokenizers library.

    Where the file's merges are in the order of their ids (checked here) the
    same vocabulary is run by tiktoken, which gives the same ids several times
    faster; texts with strings of special tokens, and files whose merges are in
    another order, go to tokenizers itself.
    """

    def __init__(self, path: str) -> None:
        if sys.byteorder != "little":
            raise RuntimeError("ids are kept as little-endian 32-bit integers")
        # One thread: a task has one core, and each thread of a pool would hold memory of its own.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        letters = byte_letters()
        ranks = {bytes(letters[c] for c in t): i for t, i in model["vocab"].items() if t not in self.special}
        merged = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
        self.fast = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}) \
            if merged == sorted(merged) else None

    def encode(self, text: str) -> bytes:
        if self.fast is None or any(s in text for s in self.special):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        try:
            return self.fast.encode_to_numpy(text).tobytes()
        except ValueError:  # a run of white space so long that the pattern gives up; the library has no such limit
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


_ENCODERS: dict[str, Encoder] = {}


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` ids."""
    if n <= capacity:
        return [(0, n)]
    first = n % capacity or capacity
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def pieces_of(docs: DataFrame, path: str, text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: the other columns of ``docs`` as c0, c1, ..., then ``PIECE_FIELDS``."""
    ship_package(docs.sparkSession)
    others = [c for c in docs.columns if c != text]
    plain = docs.select(docs[text].cast("string").alias("text"), *[docs[c].alias(f"c{k}") for k, c in enumerate(others)])
    schema = StructType([StructField(f"c{k}", docs.schema[c].dataType) for k, c in enumerate(others)]
                        + [StructField(n, t) for n, t in PIECE_FIELDS])
    end = END_OF_DOCUMENT.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _ENCODERS.get(path) or _ENCODERS.setdefault(path, Encoder(path))
        task, numbers = TaskContext.get().partitionId(), Counter()
        for batch in batches:
            row, out = [], [[] for _ in PIECE_FIELDS]
            for i, text in enumerate(batch.column("text")):
                ids = encoder.encode(text.as_py() or "") + end
                for k, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                    row.append(i)
                    crc = zlib.crc32(memoryview(ids)[4 * start:4 * (start + length)])
                    for column, v in zip(out, (k, start, length, crc, task, numbers[length]), strict=True):
                        column.append(v)
                    numbers[length] += 1
            take = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f"c{k}").take(take) for k in range(len(others))),
                 *(pa.array(v, pa.int32() if isinstance(t, IntegerType) else pa.int64())
                   for v, (_, t) in zip(out, PIECE_FIELDS, strict=True))], names=[f.name for f in schema.fields])

    return materialize(plain.mapInArrow(run, schema), "pieces")


class Plan:
    """Packing by counts: how many pieces of each length go into which runs of sequences."""

    def __init__(self, counts: dict[int, int], capacity: int) -> None:
        self.capacity, self.left = capacity, Counter({k: v for k, v in counts.items() if v})
        self.used: Counter = Counter()  # ranks given out by length
        self.rows: list[tuple[int, int, int, int, int]] = []  # length, from rank, count, first sequence, offset
        self.sequences = 0

    def put(self, length: int, n: int, sequence: int, offset: int) -> None:
        self.rows.append((length, self.used[length], n, sequence, offset))
        self.used[length] += n

    def fix(self, lengths: list[int], n: int) -> None:
        """``n`` new sequences, each holding one piece of every given length."""
        offset = 0
        for s in lengths:
            self.put(s, n, self.sequences, offset)
            self.left[s] -= n
            offset += s
        self.sequences += n

    def reduce(self) -> None:
        """Martello-Toth: fix dominating sets, for each length from the longest on, until it has none."""
        sizes = sorted(k for k, v in self.left.items() if v)
        order = list(sizes)
        while order:
            j = order[-1]
            if not self.left[j]:
                order.pop()
                continue
            room = self.capacity - j
            have = lambda s: self.left[s] - (s == j)  # noqa: E731  pieces beside this one

            def largest(limit: int) -> int | None:
                at = bisect.bisect_right(sizes, limit) - 1
                while at >= 0 and have(sizes[at]) < 1:
                    at -= 1
                return sizes[at] if at >= 0 else None

            n = self.left[j]
            best = largest(room)
            chosen: list[int] | None = None
            if best is None:
                chosen = [j]
            else:
                small = [s for s in sizes[:4] for _ in range(min(have(s), 3))][:3]
                times = lambda s: n // 2 if s == j else min(n, self.left[s])
                if best == room or len(small) < 2 or small[0] + small[1] > room:
                    # One more piece fits at most, or it fills the sequence: true as well once pieces get fewer.
                    chosen, n = [j, best], times(best)
                elif len(small) < 3 or sum(small) > room:
                    pair = self._best_pair(sizes, room, have)
                    if pair is not None and best >= pair[0] + pair[1]:
                        chosen, n = [j, best], times(best)
                    else:
                        # {j, best, other}: a pair beside j has its larger piece at most best and its smaller at most other.
                        need = Counter([j, best])
                        fits = [s for s in sizes if s <= room - best and self.left[s] > need[s]]
                        if fits and fits[-1] >= self._largest_second(sizes, room, have):
                            need[fits[-1]] += 1
                            chosen, n = [j, best, fits[-1]], min(self.left[s] // c for s, c in need.items())
            if chosen is None:
                order.pop()
                continue
            self.fix(chosen, n)
            sizes = [s for s in sizes if self.left[s] > 0]

    @staticmethod
    def _largest_second(sizes: list[int], room: int, have) -> int:
        """The largest smaller piece of any two that fit into ``room`` together."""
        out, above = 0, None
        for s in reversed(sizes):
            n = have(s)
            if n < 1:
                continue
            partner = s if n > 1 else above
            if partner is not None and s + partner <= room:
                return s
            above = s
        return out

    @staticmethod
    def _best_pair(sizes: list[int], room: int, have) -> tuple[int, int] | None:
        best, lo, hi = None, 0, bisect.bisect_right(sizes, room) - 1
        while lo <= hi:
            a, b = sizes[lo], sizes[hi]
            if a + b > room or have(b) < 1:
                hi -= 1
            elif have(a) < 1 or (a == b and have(a) < 2):
                lo += 1
            else:
                if best is None or a + b > sum(best):
                    best = (a, b)
                lo += 1
        return best

    def best_fit(self) -> None:
        """Best fit decreasing on what is left; open sequences are runs by room left."""
        open_runs: dict[int, list[tuple[int, int]]] = {}  # room -> [(first sequence, count)]
        rooms: list[int] = []

        def add(room: int, run: tuple[int, int]) -> None:
            if room:
                if room not in open_runs:
                    bisect.insort(rooms, room)
                open_runs.setdefault(room, []).append(run)

        for s in sorted((k for k, v in self.left.items() if v), reverse=True):
            n = self.left[s]
            while n:
                at = bisect.bisect_left(rooms, s)
                if at < len(rooms):
                    room = rooms[at]
                    first, count = open_runs[room].pop()
                    if not open_runs[room]:
                        del open_runs[room]
                        rooms.pop(at)
                    k = min(n, count)
                    if k < count:
                        add(room, (first + k, count - k))
                    self.put(s, k, first, self.capacity - room)
                    add(room - s, (first, k))
                else:
                    each = self.capacity // s  # new sequences filled with this length
                    k = n // each
                    if k:
                        for i in range(each):
                            self.put(s, k, self.sequences, i * s)
                        add(self.capacity - each * s, (self.sequences, k))
                        self.sequences += k
                        n -= k * each
                    if n and not k:
                        for i in range(n):
                            self.put(s, 1, self.sequences, i * s)
                        add(self.capacity - n * s, (self.sequences, 1))
                        self.sequences += 1
                        n = 0
                    continue
                n -= k
            self.left[s] = 0


def plan_rows(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    plan = Plan(counts, capacity)
    plan.reduce()
    plan.best_fit()
    return plan.rows


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` plus sequence_id and offset."""
    spark = pieces.sparkSession
    by_task = materialize(pieces.groupBy("task", "length").agg(F.count("*").alias("n")), "piece-counts")
    # At most ``capacity`` rows reach the driver, whatever the input.
    counts = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = spark.createDataFrame(plan_rows(counts, capacity) or [], "p_length long, p_from long, p_n long, p_seq long, p_off long")
    before = F.sum("n").over(Window.partitionBy("length").orderBy("task")) - F.col("n")
    offsets = materialize(by_task.select(F.col("task").alias("o_task"), F.col("length").alias("o_length"), before.alias("o_n")),
                          "piece-offsets")
    # The offsets grow with tasks and lengths: shuffled at every size, never broadcast.
    ranked = pieces.join(offsets.hint("shuffle_hash"), (pieces["task"] == F.col("o_task")) & (pieces["length"] == F.col("o_length")))
    ranked = ranked.withColumn("rank", F.col("number") + F.col("o_n"))
    placed = ranked.join(F.broadcast(plan), (F.col("length") == F.col("p_length")) & (F.col("rank") >= F.col("p_from"))
                         & (F.col("rank") < F.col("p_from") + F.col("p_n")))
    return placed.select(*pieces.columns, (F.col("p_seq") + F.col("rank") - F.col("p_from")).alias("sequence_id"),
                         F.col("p_off").alias("offset"))


def pack(docs: DataFrame, path: str, text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: all other columns of ``docs``, then pk_piece, pk_start, pk_length, pk_ids_crc32,
    pk_sequence_id, pk_offset.  ``path`` is the vocabulary file, the same on every executor."""
    others = [c for c in docs.columns if c != text]
    out = place(pieces_of(docs, path, text, capacity), capacity)
    return out.select(*[F.col(f"c{k}").alias(c) for k, c in enumerate(others)],
                      *[F.col(c).alias("pk_" + c) for c in ("piece", "start", "length", "ids_crc32", "sequence_id", "offset")])
