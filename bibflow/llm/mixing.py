"""Mixing sources to target weights without sorting the corpus.

1. Sizes are summed by source; targets come from one row per source by water
   filling (a source never gets more than ``MAX_COPIES`` times its size, what
   is cut off is shared again by weight).
2. A source takes ``floor(target / size)`` whole copies of every document and
   fills the rest by a budget on a fixed hash of the document.  Sizes are
   summed by (source, hash bucket); the bucket where the running sum crosses
   the budget is the boundary, and only that bucket is split further, level
   after level of ``LEVEL_BITS`` hash bits.
3. Documents below the nested threshold get one more copy, those above none;
   the few in the last boundary bucket are taken in hash order and the one
   that crosses the budget is taken in part.

Only histograms and one row per source are shuffled; document rows are just
filtered.  The hash covers id and text, so reruns agree.  Null text is empty
(size 0, taken 0); null source is a source, sorted last; repeated rows are
separate documents; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bibflow.llm.common import clash_free, clean_name, materialize, text_of, word_count

WEIGHTS = [3, 1, 2]
SHARE = 1.5
MAX_COPIES = 2
LEVEL_BITS = 12
LEVELS = 3


def document_hash(doc_id: Column, text: Column) -> Column:
    return F.xxhash64(doc_id, text)


def _bucket(h: Column, level: int) -> Column:
    """The ``level``-th group of hash bits, highest first."""
    return F.shiftrightunsigned(F.shiftleft(h, LEVEL_BITS * level), 64 - LEVEL_BITS).cast("int")


def targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size) -> plus weight, target.  One row per source.

    The windows run over one row per source, in one task.
    """
    everything = Window.partitionBy(F.lit(0))
    w = F.element_at(F.array(*map(F.lit, WEIGHTS)),
                     ((F.row_number().over(everything.orderBy(F.col("source").asc_nulls_last())) - 1) % len(WEIGHTS) + 1).cast("int"))
    df = sizes.withColumn("weight", w).withColumn("cap", F.lit(MAX_COPIES) * F.col("source_size"))
    # Sources reach their cap in the order of cap / weight.
    by_cap = everything.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    order = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    df = df.withColumns({
        "place": F.row_number().over(by_cap),
        "all": F.sum("source_size").over(everything),
        "full": F.coalesce(F.sum("cap").over(order), F.lit(0)),
        "rest_weight": F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(order), F.lit(0)),
    })
    df = df.withColumn("level", (SHARE * F.col("all") - F.col("full")) / F.col("rest_weight"))
    # The water level is the first one (in that order) that leaves its source below its cap.
    df = df.withColumn("water", F.min(F.when(F.col("cap") > F.col("weight") * F.col("level"),
                                             F.struct("place", "level"))).over(everything)["level"])
    return df.select("source", "source_size", "weight", F.coalesce(
        F.least(F.col("cap").cast("double"), F.col("weight") * F.col("water")), F.col("cap").cast("double")).alias("target"))


def plan(skinny: DataFrame) -> DataFrame:
    """Thresholds from (source, size, h): one row per source.

    ``copies`` whole copies for all, ``b0``, ``b1``, ... the boundary bucket of each
    level and ``rest`` the budget that is left inside the last one.
    """
    sizes = skinny.groupBy("source").agg(F.sum("size").alias("source_size"))
    cut = targets(sizes).withColumn("copies", F.when(F.col("source_size") > 0, F.least(
        F.lit(MAX_COPIES), F.floor(F.round("target") / F.col("source_size")))).otherwise(0).cast("long"))
    cut = cut.withColumn("rest", F.round("target").cast("long") - F.col("copies") * F.col("source_size"))
    cut = materialize(cut, "mix-targets")
    for level in range(LEVELS):
        c = cut.select(F.col("source").alias("cs"), "rest", *[f"b{k}" for k in range(level)])
        inside = skinny.join(c, skinny["source"].eqNullSafe(F.col("cs")))
        for k in range(level):
            inside = inside.where(_bucket(F.col("h"), k) == F.col(f"b{k}"))
        hist = (inside.groupBy("source", _bucket(F.col("h"), level).alias("bucket"))
                .agg(F.sum("size").alias("n"), F.max("rest").alias("rest")))
        before = F.sum("n").over(Window.partitionBy("source").orderBy("bucket")) - F.col("n")
        cross = (hist.withColumn("before", before)
                 .where((F.col("before") <= F.col("rest")) & (F.col("rest") < F.col("before") + F.col("n")))
                 .select(F.col("source").alias("cs"), F.col("bucket").alias(f"b{level}"),
                         (F.col("rest") - F.col("before")).alias("rest2")))
        # No crossing: the budget is zero or nothing is left; -1 puts everything above the threshold.
        cut = materialize(cut.join(cross, cut["source"].eqNullSafe(F.col("cs")), "left").select(
            *[cut[x] for x in cut.columns if x != "rest"], F.coalesce(f"b{level}", F.lit(-1)).alias(f"b{level}"),
            F.coalesce("rest2", F.lit(0)).alias("rest")), f"mix-cut{level}")
    return cut


def apply_plan(frame: DataFrame, cut: DataFrame, source: str, size: str, h: str) -> DataFrame:
    """``frame`` plus mix_source_size, mix_target, mix_taken."""
    c = cut.select(*[F.col(x).alias(f"__{x}") for x in cut.columns])
    rows = frame.join(c, frame[source].eqNullSafe(F.col("__source")))
    key = F.struct(*[_bucket(F.col(h), k).alias(f"k{k}") for k in range(LEVELS)])
    bound = F.struct(*[F.col(f"__b{k}").alias(f"k{k}") for k in range(LEVELS)])
    base = F.col("__copies") * F.col(size)
    cols = [F.col(f"`{x}`") for x in frame.columns]

    def out(df: DataFrame, extra: Column) -> DataFrame:
        return df.select(*cols, F.col("__source_size").alias("mix_source_size"), F.col("__target").alias("mix_target"),
                         (base + extra).cast("long").alias("mix_taken"))

    plain = out(rows.where(key != bound), F.when(key < bound, F.col(size)).otherwise(0))
    ids = [F.col(f"`{x}`") for x, t in frame.dtypes if not t.startswith("map")]
    before = F.sum(size).over(Window.partitionBy("__source").orderBy(F.col(h), *ids).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)) - F.col(size)
    leaf = rows.where(key == bound).withColumn("__before", before)
    return plain.unionByName(out(leaf, F.greatest(F.lit(0), F.least(F.col(size), F.col("__rest") - F.col("__before")))))


@clash_free("mix_")
def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """One row per document, text left out: its other columns plus mix_size,
    mix_source_size, mix_target, mix_taken.  Texts are read once."""
    others = [F.col(f"`{c}`") for c in docs.columns if c != text]
    t = text_of(text)
    skinny = materialize(docs.select(*others, word_count(t).alias("mix_size"),
                                     document_hash(F.col(f"`{doc_id}`"), t).alias("mix_hash")), "mix-sizes")
    cut = plan(skinny.select(F.col(source).alias("source"), F.col("mix_size").alias("size"), F.col("mix_hash").alias("h")))
    return apply_plan(skinny, cut, source, "mix_size", "mix_hash").drop("mix_hash")


@clash_free("mix_")
def mixed_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The mix as documents: each row once per copy taken, texts whole.

    The one document per source that crosses its budget is taken once more if at
    least half of its words are within the budget, so a source's words come
    within half of that document of its target.
    """
    t = text_of(text)
    frame = docs.withColumns({"mix_size": word_count(t), "mix_hash": document_hash(F.col(f"`{doc_id}`"), t)})
    skinny = materialize(frame.select(F.col(source).alias("source"), F.col("mix_size").alias("size"),
                                      F.col("mix_hash").alias("h")), "mix-sizes")
    rows = apply_plan(frame, plan(skinny), source, "mix_size", "mix_hash").where("mix_taken > 0")
    copy = clean_name(rows.columns, "mix_copy")
    n = F.floor((2 * F.col("mix_taken") + F.col("mix_size")) / (2 * F.col("mix_size")))
    rows = rows.where(n > 0).withColumn(copy, F.explode(F.sequence(F.lit(1), n)))
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns])
