"""Line deduplication by distinct-site spread.

A line (white space trimmed, not blank) that occurs on
``MIN_SITES`` or more distinct sites is boilerplate.  Each line hash that occurs
in so many documents gets a HyperLogLog sketch of its sites, merged by aggregation; estimates clearly
beyond the threshold decide, lines whose estimate lies within ``MARGIN`` of it
get an exact distinct count.  Boilerplate is removed from every document but
stays once, in the document with the smallest id that has it, so no passage
vanishes from the corpus.

All DataFrame expressions.  Null text counts as empty and stays null when
nothing is removed; a null site is a site; null ids never hold the copy that
stays unless all of them are null; rows that share an id are treated alike; an
empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bibflow.llm.common import clash_free, clean_name, materialize, text_of

MIN_SITES = 10
SKETCH_LG_K = 8
MARGIN = max(1, math.ceil(MIN_SITES * 4 * 1.04 / math.sqrt(2**SKETCH_LG_K)))  # four standard errors
_WHITE = " \t\n\x0b\x0c\r"


def _key(line: Column) -> Column:
    """128 hash bits of a trimmed line; null for blank lines."""
    t = F.btrim(line, F.lit(_WHITE))
    return F.when(t != "",
                  F.struct(F.xxhash64(t).alias("a"), F.xxhash64(F.lit(1), t).alias("b")))


def _keys(text: Column) -> Column:
    return F.transform(F.split(text, "\n"), _key)


def boilerplate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", site: str = "source") -> tuple[DataFrame, DataFrame]:
    """(lines, spread): all line occurrences (key, id, site) once per document, and the
    boilerplate (key, first id).  Both are written tables without texts."""
    lines = materialize(docs.select(
        F.col(f"`{doc_id}`").alias("id"), F.xxhash64(F.col(f"`{site}`"), F.col(f"`{site}`").isNull()).alias("site"),
        F.explode(F.array_distinct(_keys(text_of(text)))).alias("k")).where("k IS NOT NULL").select("k.a", "k.b", "id", "site"), "lines")
    # Fewer occurrences than sites are too few: most lines are unique and never get a sketch.
    often = materialize(lines.groupBy("a", "b").agg(F.count("*").alias("n"), F.min("id").alias("first"))
                        .where(F.col("n") >= MIN_SITES).select("a", "b", "first"), "frequent-lines")
    spread = (lines.select("a", "b", "site").join(often, ["a", "b"]).groupBy("a", "b")
              .agg(F.hll_sketch_agg("site", F.lit(SKETCH_LG_K)).alias("s"), F.min("first").alias("first")))
    spread = materialize(spread.select("a", "b", "first", F.hll_sketch_estimate("s").alias("sites"))
                         .where(F.col("sites") >= MIN_SITES - MARGIN), "line-spread")
    sure = spread.where(F.col("sites") > MIN_SITES + MARGIN).select("a", "b", "first")
    near = spread.where(F.col("sites") <= MIN_SITES + MARGIN)
    exact = (lines.join(near.select("a", "b", "first"), ["a", "b"]).groupBy("a", "b", "first", "site").agg(F.lit(1))
             .groupBy("a", "b", "first").agg(F.count("*").alias("n")).where(F.col("n") >= MIN_SITES).select("a", "b", "first"))
    return lines, materialize(sure.unionByName(exact), "boilerplate")


def _hits(lines: DataFrame, spread: DataFrame) -> DataFrame:
    """Per document id the boilerplate keys it loses wholly (gone) and those it keeps once (once)."""
    hit = lines.select("a", "b", "id").join(spread, ["a", "b"])
    here = F.col("id").eqNullSafe(F.col("first"))
    key = F.struct("a", "b")
    return hit.groupBy("id").agg(F.collect_set(F.when(~here, key)).alias("gone"),
                                 F.collect_set(F.when(here, key)).alias("once"))


@clash_free("ld_")
def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", site: str = "source") -> DataFrame:
    """``docs`` with boilerplate lines removed from the text, plus ld_lines and ld_removed (counts of lines)."""
    hits = _hits(*boilerplate(docs, doc_id, text, site))
    hits = materialize(hits.select(F.col("id").alias("ld_id"), F.col("gone").alias("ld_gone"), F.col("once").alias("ld_once")), "line-hits")
    # The hits grow with the corpus: shuffled at every size, never broadcast.
    df = docs.join(hits.hint("shuffle_hash"), docs[doc_id].eqNullSafe(F.col("ld_id")), "left")
    t = text_of(text)
    line, kept = clean_name(docs.columns, "ld_line"), clean_name(docs.columns, "ld_kept")
    hit = F.col("ld_gone").isNotNull()
    df = df.withColumn(line, F.when(hit, F.split(t, "\n")))
    keys = clean_name(docs.columns, "ld_keys")
    df = df.withColumn(keys, F.transform(F.col(line), _key))
    df = df.withColumn(kept, F.filter(F.col(line), lambda x, i: ~(
        F.coalesce(F.array_contains(F.col("ld_gone"), F.get(F.col(keys), i)), F.lit(False)) |
        (F.coalesce(F.array_contains(F.col("ld_once"), F.get(F.col(keys), i)), F.lit(False)) &
         (F.array_position(F.col(keys), F.get(F.col(keys), i)) != i + 1)))))
    new = F.when(hit, F.array_join(kept, "\n")).otherwise(F.col(f"`{text}`"))
    n = F.size(F.split(t, "\n"))
    return df.select(*[(new if c == text else F.col(f"`{c}`")).alias(c) for c in docs.columns],
                     n.alias("ld_lines"), F.when(hit, F.size(line) - F.size(kept)).otherwise(0).alias("ld_removed"))
