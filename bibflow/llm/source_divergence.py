"""Divergence between the sources of each language, from stripes folded in the mappers.

* Every partition folds its whole documents into hash stripes, term -> (document
  frequency, count by source), per language.  A table that holds
  ``MAX_ENTRIES`` counts is handed to Spark's shuffle and begun anew, so memory
  is bounded whatever the partition holds.
* Stripes are merged by (language, term).  A term's stripes are at most one per
  hand-over, each with at most one count per source, so a frequent term is no
  hot key.  Terms in fewer than ``min_docs`` documents of the language go.
* The merged stripes of a language are dealt to groups of about ``GROUP_TERMS``
  terms.  Each group gets the language's totals and emits divergences directly:
  partial sums for every pair of sources, and the terms that stand out, of
  which only the ``top`` of the group can be among the ``top`` of all.

All arithmetic is on whole numbers.  A document frequency counts rows; null
text, language or source count as empty.  Groups without any term have their
rows; a language without kept terms has divergence 0 throughout; an empty table
gives an empty result.  Only the three named columns are read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bibflow.llm.common import materialize, text_of

MIN_DOCS = 3
TOP = 200
MAX_ENTRIES = 400_000
GROUP_TERMS = 8192
#: Parts of a probability.
SCALE = 1_000_000_000

_OUT_ROWS = 20_000
_CELLS = 1 << 21
_SOURCES_AT_ONCE = 512
_PIECE = 1 << 22
#: Bytes of terms to themselves (A-Z in lower case), all others to a space.
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
_STRIPE = pa.schema([("lang", pa.string()), ("term", pa.string()), ("df", pa.int64()),
                     ("sources", pa.list_(pa.string())), ("counts", pa.list_(pa.int64()))])
STRIPE_SCHEMA = "lang string, term string, df long, sources array<string>, counts array<long>"
EMIT_SCHEMA = "lang string, source string, part string, item string, value long"
_EMIT = pa.schema([("lang", pa.string()), ("source", pa.string()), ("part", pa.string()), ("item", pa.string()), ("value", pa.int64())])


def term_counts(text: bytes) -> Counter:
    """Terms of one whole text; a very long one is folded piece by piece, cut between terms."""
    counts: Counter = Counter()
    at = 0
    while at < len(text):
        end = at + _PIECE
        piece = text[at:end].translate(_FOLD)
        if end < len(text):
            cut = piece.rfind(b" ")
            while cut < 0 and end < len(text):  # one term longer than a piece
                piece += text[end:end + _PIECE].translate(_FOLD)
                end += _PIECE
                cut = piece.rfind(b" ") if end < len(text) else len(piece)
            piece = piece[:cut]
        counts.update(piece.split())
        at += max(len(piece), 1)
    return counts


def _stripes(table: dict[str, dict[bytes, dict]]) -> Iterator[pa.RecordBatch]:
    """The stripes of a table as batches; ``None`` among the keys of a stripe holds the document frequency."""
    for lang, terms in table.items():
        items = iter(terms.items())
        while chunk := [kv for _, kv in zip(range(_OUT_ROWS), items)]:
            df = [s.pop(None) for _, s in chunk]
            yield pa.RecordBatch.from_arrays([
                pa.array([lang] * len(chunk), pa.string()), pa.array([t for t, _ in chunk], pa.binary()).cast(pa.string()),
                pa.array(df, pa.int64()), pa.array([list(s) for _, s in chunk], pa.list_(pa.string())),
                pa.array([list(s.values()) for _, s in chunk], pa.list_(pa.int64()))], schema=_STRIPE)


def fold(batches: Iterable[pa.RecordBatch], max_entries: int = MAX_ENTRIES) -> Iterator[pa.RecordBatch]:
    """(lang, source, text as bytes) rows -> stripes; the empty term's stripe names the sources that occur."""
    table: dict[str, dict[bytes, dict]] = {}
    entries = 0
    for batch in batches:
        for lang, source, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
            terms = table.setdefault(lang, {})
            for term, n in [(b"", 0), *term_counts(text).items()]:
                stripe = terms.get(term)
                if stripe is None:
                    terms[term] = {None: 1, source: n}
                    entries += 1
                else:
                    stripe[None] += 1
                    if source in stripe:
                        stripe[source] += n
                    else:
                        stripe[source] = n
                        entries += 1
            if entries >= max_entries:
                yield from _stripes(table)
                table, entries = {}, 0
    yield from _stripes(table)


def merged_stripes(docs: DataFrame, text: str, lang: str, source: str, min_docs: int) -> DataFrame:
    """Rows (lang, term, sources, counts): kept terms, and the empty term with all sources of a language."""
    named = docs.select(text_of(f"`{lang}`"), text_of(f"`{source}`"), text_of(f"`{text}`").cast("binary"))
    folded = named.mapInArrow(fold, STRIPE_SCHEMA)
    # Dealt by term once; both groupings below need no further exchange.
    dealt = folded.repartition("lang", "term")
    entries = dealt.select("lang", "term", F.explode(F.arrays_zip(
        F.concat("sources", F.array(F.lit(None).cast("string"))), F.concat("counts", F.array("df")))).alias("e"))
    entries = entries.select("lang", "term", F.col("e")["0"].alias("source"), F.col("e")["1"].alias("n"))
    summed = entries.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"))
    stripes = summed.groupBy("lang", "term").agg(
        F.max(F.when(F.col("source").isNull(), F.col("n"))).alias("df"),
        F.collect_list(F.when(F.col("source").isNotNull(), F.struct("source", "n"))).alias("s"))
    return stripes.where((F.col("df") >= min_docs) | (F.col("term") == "")).select(
        "lang", "term", F.col("s")["source"].alias("sources"), F.col("s")["n"].alias("counts"))


def parts_of(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(SCALE * (count + 1) / total), exact by long division (total below 9e15)."""
    whole, rest = np.divmod(count + 1, total)
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, total)
        whole = whole * 1000 + digit
    return whole + 1


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / q); p and q are at most SCALE + 1, so the square fits 64 bits."""
    d = p - q
    return d * d // q


def emit(totals: pa.Table, stripes: pa.Table, top: int = TOP) -> pa.Table:
    """Partial pair sums and outstanding terms of one group of merged stripes of one language."""
    if stripes.num_rows == 0 or totals.num_rows == 0:
        return _EMIT.empty_table()
    lang = totals["lang"][0].as_py()
    order = pc.sort_indices(totals["source"])
    names = totals["source"].take(order).combine_chunks()
    n_terms = totals["v"][0].as_py()
    size = totals["n"].take(order).to_numpy().astype(np.int64) + n_terms
    n_src, all_size = len(names), int(size.sum()) - (len(names) - 1) * n_terms
    terms = stripes["term"].combine_chunks()
    lists = stripes["sources"].combine_chunks()
    column = pc.index_in(lists.flatten(), names).to_numpy().astype(np.int64)
    count = stripes["counts"].combine_chunks().flatten().to_numpy().astype(np.int64)
    row = np.repeat(np.arange(len(terms)), pc.list_value_length(lists).to_numpy())
    in_lang = parts_of(_sum_by(row, count, len(terms)), np.int64(all_size))

    out = []
    # Terms above the language's share: only entries with a count.
    p = parts_of(count, size[column])
    q = in_lang[row]
    pick = np.flatnonzero((count > 0) & (p > q))
    value = divergence(p[pick], q[pick])
    place = np.argsort(_bytes_order(terms))  # place of a term among the group's terms in byte order
    chosen = np.lexsort((place[row[pick]], -value, column[pick]))
    col = column[pick][chosen]
    within = np.arange(len(col)) - np.searchsorted(col, col)
    chosen = chosen[within < top]
    out.append(pa.table([pa.array([lang] * len(chosen), pa.string()), names.take(pa.array(column[pick][chosen])),
                         pa.array(["term"] * len(chosen), pa.string()), terms.take(pa.array(row[pick][chosen])),
                         pa.array(value[chosen])], schema=_EMIT))

    # Pairs: dense blocks of few terms and at most _SOURCES_AT_ONCE sources against all.
    step = max(1, _CELLS // max(n_src, 1))
    begin = np.searchsorted(row, np.arange(0, len(terms) + step, step))
    for lo in range(0, n_src, _SOURCES_AT_ONCE):
        hi = min(lo + _SOURCES_AT_ONCE, n_src)
        sums = np.zeros((hi - lo, n_src), np.int64)
        for k in range(len(begin) - 1):
            a, b = begin[k], begin[k + 1]
            height = min(step, len(terms) - k * step)
            if height <= 0:
                break
            dense = np.zeros((n_src, height), np.int64)
            dense[column[a:b], row[a:b] - k * step] = count[a:b]
            dense = parts_of(dense, size[:, None])
            for i in range(lo, hi):
                sums[i - lo] += divergence(dense[i], dense).sum(axis=1)
        left, right = np.divmod(np.arange((hi - lo) * n_src), n_src)
        off = left + lo != right
        out.append(pa.table([pa.array([lang] * int(off.sum()), pa.string()), names.take(pa.array(left[off] + lo)),
                             pa.array(["pair"] * int(off.sum()), pa.string()), names.take(pa.array(right[off])),
                             pa.array(sums.reshape(-1)[off])], schema=_EMIT))
    return pa.concat_tables(out)


def _sum_by(key: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(n, np.int64)
    np.add.at(out, key, value)
    return out


def _bytes_order(terms: pa.Array) -> np.ndarray:
    return pc.sort_indices(terms.cast(pa.binary())).to_numpy()


def source_divergence(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
                      min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """Rows (sv_lang, sv_source, sv_part, sv_item, sv_value, sv_rank); see the module docstring."""
    spark = docs.sparkSession
    stripes = materialize(merged_stripes(docs, text, lang, source, min_docs), "merged-stripes")
    kept = stripes.where("term <> ''")
    groups = stripes.where("term = ''").select("lang", F.explode("sources").alias("source"))
    per_lang = kept.groupBy("lang").agg(F.count("*").alias("v"))
    counted = kept.select("lang", F.explode(F.arrays_zip("sources", "counts")).alias("e")).groupBy(
        "lang", F.col("e")["sources"].alias("source")).agg(F.sum(F.col("e")["counts"]).alias("n"))
    totals = materialize(groups.join(per_lang, "lang", "left").join(counted, ["lang", "source"], "left").select(
        "lang", "source", F.coalesce("v", F.lit(0)).alias("v"), F.coalesce("n", F.lit(0)).alias("n")), "stripe-totals")
    # A language with many terms is dealt to as many groups; each gets the totals of the language once.
    deal = F.floor((F.col("v") + GROUP_TERMS - 1) / GROUP_TERMS).cast("int")
    sizes = totals.groupBy("lang").agg(F.max(deal).alias("deals"))
    keyed = kept.join(sizes, "lang").select("lang", F.pmod(F.xxhash64("term"), F.col("deals")).cast("int").alias("g"),
                                            "term", "sources", "counts")
    spread = totals.where("v > 0").select("lang", F.explode(F.sequence(F.lit(0), deal - 1)).alias("g"), "source", "v", "n")
    emitted = materialize(spread.groupBy("lang", "g").cogroup(keyed.groupBy("lang", "g")).applyInArrow(
        lambda t, s: emit(t, s, top), EMIT_SCHEMA), "divergences")
    pairs = emitted.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    # Groups of a language without kept terms have no stripes; their pairs are zero.
    bare = totals.where("v = 0").select("lang", "source")
    zero = bare.alias("a").join(bare.alias("b"), (F.col("a.lang") == F.col("b.lang")) & (F.col("a.source") != F.col("b.source")))
    zero = zero.select("a.lang", "a.source", F.lit("pair").alias("part"), F.col("b.source").alias("item"), F.lit(0).cast("long").alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), F.asc("item")))
    ranked_pairs = pairs.unionByName(zero).withColumn("rank", rank)
    ranked_terms = emitted.where("part = 'term'").withColumn("rank", rank).where(F.col("rank") <= top)
    return ranked_pairs.unionByName(ranked_terms).toDF("sv_lang", "sv_source", "sv_part", "sv_item", "sv_value", "sv_rank")
