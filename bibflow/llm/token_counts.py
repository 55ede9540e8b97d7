"""Token counts by finite-state transducers compiled from a byte-level BPE vocabulary.

Two deterministic transducers replace the tokenizer.

* The *splitter* works on character classes and marks where pre-tokens begin.
  A block of texts is cut into chunks of ``LANE`` characters.  Every chunk
  yields its state map (end state for each of the 12 entry states); the maps
  compose associatively, so a parallel prefix scan over the chunks gives every
  chunk's true entry state, and a second pass marks the starts.
* The *counter* works on the bytes of a pre-token.  A state holds the last
  bytes that can still be part of a token and, for each of them, the last
  token and the relative token count of the merge result up to there.  Each
  transition carries the number of tokens that the byte adds (it may be zero or
  negative, as a byte can join earlier tokens).  States are determinised on
  demand and kept up to ``MAX_STATES``; a pre-token's count is the sum along
  its path.

The prefix property of merge-ordered BPE makes this exact: the encoding of a
prefix ending in token ``t`` is the encoding of what precedes ``t`` plus ``t``,
and ``t`` is the one suffix that stays apart from the token before it.

Null text counts as empty (0 bytes, 0 tokens).  Strings of special tokens are
one token each.  Other columns pass through; an empty table gives an empty
result.  Memory is bounded by one Arrow batch plus the capped tables; a long
text is split in windows that begin at pre-token starts.
"""

from __future__ import annotations

import json
import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from bibflow.llm.common import clean_name
from bibflow.session import ship_package

LANE = 512
#: Characters of a chunk that are always run for all entry states.
HEAD = 24
WINDOW = 1 << 20
MAX_STATES = 300_000
MAX_MEMO = 500_000
TOKEN_LIMIT = 512

# Character classes of the splitter.
OTHER_LETTER, SINGLE, RV, ELL, E, NUMBER, SPACE, BLANK, QUOTE, SYMBOL, CUT = range(11)
# States: after a cut, in a run of letters/numbers/symbols, after a quote that
# opened a pre-token, after quote + r/v, after quote + l, after a contraction,
# and in a run of one or of more white-space characters that ends in a space
# (S) or in another one (B).
START, LET, NUM, SYM, QUO, QUO_RV, QUO_L, SHORT, S1, B1, S2, B2 = range(12)
# White space of the pre-tokenizer's pattern.
WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


def class_table() -> np.ndarray:
    out = np.full(sys.maxunicode + 1, SYMBOL, np.uint8)
    kinds = {"L": OTHER_LETTER, "N": NUMBER}
    for i in range(sys.maxunicode + 1):
        k = kinds.get(unicodedata.category(chr(i))[0])
        if k is not None:
            out[i] = k
    for chars, k in (("stmd", SINGLE), ("rv", RV), ("l", ELL), ("e", E), ("'", QUOTE)):
        out[[ord(c) for c in chars]] = k
    out[WHITE] = BLANK
    out[0x20] = SPACE
    return out


def splitter_tables() -> tuple[np.ndarray, np.ndarray]:
    """(next state, marks) by class * 12 + state; mark 1: a pre-token begins here, 2: one began a character earlier."""
    step = np.zeros((11, 12), np.uint8)
    mark = np.zeros((11, 12), np.uint8)
    letters = {OTHER_LETTER, SINGLE, RV, ELL, E}

    def plain(state: int, cls: int) -> tuple[int, int]:
        if cls in letters:
            return LET, int(state not in (LET, S1))
        if cls == NUMBER:
            return NUM, int(state not in (NUM, S1))
        if cls == SYMBOL:
            return SYM, int(state not in (SYM, QUO, S1))
        if cls == QUOTE:
            return (SYM, 0) if state in (SYM, QUO, S1) else (QUO, 1)
        if cls == CUT:
            return START, 1
        if state in (S1, B1, S2, B2):
            return (S2 if cls == SPACE else B2), 0
        return (S1 if cls == SPACE else B1), 1

    for cls in range(11):
        for state in range(12):
            after, m = plain(state, cls)
            white = cls in (SPACE, BLANK, CUT)
            if state == QUO and cls in letters:
                after, m = {SINGLE: (SHORT, 0), RV: (QUO_RV, 0), ELL: (QUO_L, 0)}.get(cls, (LET, 1))
            elif state in (QUO_RV, QUO_L):
                if cls == (E if state == QUO_RV else ELL):
                    after, m = SHORT, 0
                else:  # no contraction: the letter after the quote began a pre-token
                    after, m = plain(LET, cls)
                    m |= 2
            elif state == S2 and not white:
                after, m = plain(S1, cls)
                m |= 2
            elif state == B2 and not white:
                after, m = plain(B1, cls)
                m |= 2
            step[cls, state], mark[cls, state] = after, m
    return step.ravel(), mark.ravel()


class Splitter:
    def __init__(self) -> None:
        self.classes = class_table()
        self.step, self.mark = splitter_tables()

    def starts(self, codes: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        """Where pre-tokens begin; ``cuts`` are positions that separate texts (each a pre-token of its own)."""
        n = len(codes)
        lanes = -(-n // LANE)
        cls = np.full(lanes * LANE, CUT, np.uint8)
        cls[:n] = self.classes[codes]
        cls[cuts] = CUT
        base = np.ascontiguousarray(cls.reshape(lanes, LANE).T).astype(np.int16) * 12
        maps = np.tile(np.arange(12, dtype=np.int16), (lanes, 1))
        for row in base[:HEAD]:  # all chunks at once, one character at a time
            maps = self.step[row[:, None] + maps].astype(np.int16)
        marks = np.empty((LANE, lanes), np.uint8)
        # After a few characters nearly every chunk is in one state whatever it was entered with.
        done = (maps == maps[:, :1]).all(axis=1)
        self._run(base, marks, HEAD, np.flatnonzero(done), maps, 1)
        self._run(base, marks, HEAD, np.flatnonzero(~done), maps, 12)
        width = 1
        while width < lanes:  # prefix scan: maps[i] becomes the composition of the maps up to i
            maps[width:] = np.take_along_axis(maps[width:], maps[:-width].copy(), axis=1)
            width *= 2
        state = np.zeros(lanes, np.int16)
        state[1:] = maps[:-1, START]
        for k in range(LANE):
            if k == HEAD:  # chunks that had converged here are marked already
                rest = np.flatnonzero(~done)
                if not len(rest):
                    break
                state, base = state[rest], base[:, rest]
            at = base[k] + state
            if k < HEAD:
                marks[k] = self.mark[at]
            else:
                marks[k, rest] = self.mark[at]
            state = self.step[at].astype(np.int16)
        marks = marks.T.ravel()
        begins = (marks & 1).astype(bool)
        begins[:-1] |= (marks[1:] & 2).astype(bool)
        return np.flatnonzero(begins[:n])

    def _run(self, base: np.ndarray, marks: np.ndarray, first: int, lanes: np.ndarray, maps: np.ndarray, states: int) -> None:
        """Complete the state maps of ``lanes``; with one state left, mark as well."""
        if not len(lanes):
            return
        own, at = base[:, lanes], maps[lanes, :states]
        out = np.empty((LANE - first, len(lanes)), np.uint8)
        for k in range(first, LANE):
            i = own[k][:, None] + at
            if states == 1:
                out[k - first] = self.mark[i[:, 0]]
            at = self.step[i].astype(np.int16)
        maps[lanes] = at
        if states == 1:
            marks[first:, lanes] = out

    def pieces(self, texts: list[str]) -> Iterator[tuple[list[str], np.ndarray]]:
        """Blocks of (pre-tokens, index of the text each belongs to), in order."""
        todo, size = [], 0
        for i, t in enumerate(texts):
            if len(t) > WINDOW:
                if todo:
                    yield self._block(todo)
                    todo, size = [], 0
                yield from self._long(i, t)
                continue
            todo.append((i, t))
            size += len(t) + 1
            if size >= WINDOW:
                yield self._block(todo)
                todo, size = [], 0
        if todo:
            yield self._block(todo)

    def _block(self, todo: list[tuple[int, str]]) -> tuple[list[str], np.ndarray]:
        joined = "\n".join(t for _, t in todo) + "\n"
        ends = np.cumsum([len(t) + 1 for _, t in todo]) - 1
        begin = self.starts(np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32), ends)
        own = np.searchsorted(ends, begin)
        stop = np.append(begin[1:], len(joined))
        real = begin != ends[own]
        begin, stop, own = begin[real].tolist(), stop[real].tolist(), own[real]
        return [joined[a:b] for a, b in zip(begin, stop, strict=True)], np.array([i for i, _ in todo])[own]

    def _long(self, i: int, text: str) -> Iterator[tuple[list[str], np.ndarray]]:
        """A long text in windows; each ends before its last pre-token, which the next one starts with."""
        at, width = 0, WINDOW
        while at < len(text):
            part = text[at:at + width]
            last = at + len(part) == len(text)
            begin = self.starts(np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32), np.zeros(0, np.int64))
            # The last marks of a window that is cut off may still change.
            if not last:
                begin = begin[begin < len(part) - 4]
                if len(begin) < 2:
                    width *= 2
                    continue
            stop = np.append(begin[1:], len(part)).tolist()
            begin = begin.tolist()
            if not last:
                begin, stop = begin[:-1], stop[:-1]
            yield [part[a:b] for a, b in zip(begin, stop, strict=True)], np.full(len(begin), i)
            at, width = at + stop[-1], WINDOW


def byte_letters() -> dict[str, int]:
    """The printable letter that the vocabulary file writes for each byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class Counter:
    """The counting transducer of a vocabulary file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        raw = lambda s: bytes(letters[c] for c in s)
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.tokens = {raw(t): i for t, i in spec["model"]["vocab"].items() if t not in self.special}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.rank = {(raw(a), raw(b)): k for k, (a, b) in enumerate(pairs)}
        self.prefixes = {t[:k] for t in self.tokens for k in range(1, len(t) + 1)}
        self.apart: dict[tuple[bytes, bytes], bool] = {}
        self._reset()

    def _reset(self) -> None:
        # state: (live suffix, last token at each of its positions, token counts there relative to the end)
        first = (b"", (b"",), (0,))
        self.ids, self.states, self.moves = {first: 0}, [first], {}

    def merge(self, data: bytes) -> list[bytes]:
        parts = [data[i:i + 1] for i in range(len(data))]
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: self.rank.get((parts[i], parts[i + 1]), 1 << 30))
            if (parts[best], parts[best + 1]) not in self.rank:
                break
            parts[best:best + 2] = [parts[best] + parts[best + 1]]
        return parts

    def stays_apart(self, a: bytes, b: bytes) -> bool:
        if not a:
            return True
        got = self.apart.get((a, b))
        if got is None:
            if len(self.apart) > MAX_MEMO:
                self.apart.clear()
            got = self.apart[a, b] = self.merge(a + b) == [a, b]
        return got

    def _move(self, state: int, byte: int) -> tuple[int, int]:
        live, last, counts = self.states[state]
        grown = live + bytes((byte,))
        for k in range(len(grown)):  # longest suffix first
            token = grown[k:]
            # Position k of the live suffix is where this token would begin.
            if token in self.tokens and self.stays_apart(last[k], token):
                break
        else:
            raise ValueError("the vocabulary has no token for a byte")
        added = counts[k] + 1
        last, counts = (*last, token), (*counts, added)
        cut = 0
        while cut < len(grown) and grown[cut:] not in self.prefixes:
            cut += 1
        key = (grown[cut:], last[cut:], tuple(c - added for c in counts[cut:]))
        if key not in self.ids:
            self.ids[key] = len(self.states)
            self.states.append(key)
        got = self.moves[state << 8 | byte] = (self.ids[key], added)
        return got

    def count(self, data: bytes) -> int:
        if len(self.states) > MAX_STATES:
            self._reset()
        state = total = 0
        moves = self.moves
        for byte in data:
            got = moves.get(state << 8 | byte)
            if got is None:
                got = self._move(state, byte)
            state = got[0]
            total += got[1]
        return total


class Memo(dict):
    """Counts of pre-tokens seen lately."""

    def __init__(self, counter: Counter) -> None:
        super().__init__()
        self.counter = counter

    def __missing__(self, piece: str) -> int:
        n = self.counter.count(piece.encode("utf-8", "surrogatepass"))
        if len(piece) <= 64:
            if len(self) > MAX_MEMO:
                self.clear()
            self[piece] = n
        return n


_LOADED: dict[str, tuple[Splitter, Memo]] = {}


def loaded(path: str) -> tuple[Splitter, Memo]:
    """The transducers of a file, kept for the life of a Python worker."""
    if path not in _LOADED:
        _LOADED[path] = (Splitter(), Memo(Counter(path)))
    return _LOADED[path]


def split_special(texts: list[str], special: list[str]) -> tuple[list[str], list[int], list[list[str]]]:
    """(segments without special strings, text of each segment, the special strings found in each text)."""
    segments, owner, found = [], [], []
    for i, t in enumerate(texts):
        rest, hits = [t], []
        for s in special:
            if s in t:
                cut = []
                for r in rest:
                    bits = r.split(s)
                    hits += [s] * (len(bits) - 1)
                    cut += bits
                rest = cut
        segments += rest
        owner += [i] * len(rest)
        found.append(hits)
    return segments, owner, found


def count_texts(texts: list[str], path: str) -> np.ndarray:
    splitter, memo = loaded(path)
    segments, owner, found = split_special(texts, memo.counter.special)
    own = np.array(owner, np.int64)
    out = np.array([len(x) for x in found], np.int64)
    for pieces, at in splitter.pieces(segments):
        counts = np.fromiter(map(memo.__getitem__, pieces), np.int64, len(pieces))
        np.add.at(out, own[at], counts) if len(texts) < 2 else out.__iadd__(
            np.bincount(own[at], counts, len(texts)).astype(np.int64))
    return out


def count_tokens(docs: DataFrame, path: str, text: str = "text", limit: int = TOKEN_LIMIT) -> DataFrame:
    """``docs`` with its text replaced by tc_n_bytes, tc_n_tokens, tc_over_limit (a ``_`` is added where a name is taken).

    ``path`` is the vocabulary file, found under the same path on every executor.
    """
    ship_package(docs.sparkSession)
    others = [c for c in docs.columns if c != text]
    names = [clean_name(others, c) for c in ("tc_n_bytes", "tc_n_tokens", "tc_over_limit")]
    plain = docs.select(docs[text].cast("string").alias("text"), *[docs[c].alias(f"c{k}") for k, c in enumerate(others)])
    schema = StructType([StructField(f"c{k}", docs.schema[c].dataType) for k, c in enumerate(others)]
                        + [StructField("b", LongType()), StructField("n", LongType()), StructField("o", BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            n = count_texts(texts, path)
            sizes = [len(t.encode("utf-8", "surrogatepass")) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f"c{k}") for k in range(len(others))), pa.array(sizes, pa.int64()), pa.array(n, pa.int64()),
                 pa.array(n > limit)], names=[f.name for f in schema.fields])

    return plain.mapInArrow(run, schema).toDF(*others, *names)
