"""Quality rules with adaptive thresholds.

Fixed base rules reject texts that are too short or mostly repeated.  All other
cutoffs are learned: each metric gets a mergeable quantile sketch per
(lang, source) - a log-bucket histogram, so merging is adding counts and every
quantile has a relative error of at most ``SKETCH_GAMMA - 1`` - and a text is
rejected when a metric lies ``reach`` times as far beyond the sketch's tail quantile
as that lies from the median: above ``high + reach * (high - q50)`` or below
``low - reach * (q50 - low)``, the difference being at least ``ROUNDING`` and the
sketch's own error.  Texts
with odd words or symbols come in shares of several percent, so those two metrics
take the 10 % tails, which such texts don't reach; repetition is a matter of degree
and has a long tail in good text, so it takes the 1 % tail.  A group with fewer than
``MIN_GROUP`` texts uses the merged sketch of its language, and that of all
texts when the language is as small.

Everything runs as DataFrame expressions.  Null text counts as empty (no words,
base_failed); null lang or source is a group of its own; repeated rows are
judged like any other; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bibflow.llm.common import WORD_CHAR, clash_free, clean_name, materialize, text_of, words_of

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SKETCH_GAMMA = 1.02
MIN_GROUP = 100
#: Share of the texts in a tail, and how far beyond it a text may lie, by metric.
TAIL = {"word_len": (0.1, 3), "symbols": (0.1, 3), "dup_lines": (0.01, 1), "repeats": (0.01, 1)}
#: Thousandths; one in a hundred is no evidence.
ROUNDING = 10
#: Metrics where an unusually small value is a fault as well.
TWO_SIDED = {"word_len"}

METRICS = list(TAIL)
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def with_base(docs: DataFrame, text: str = "text", prefix: str = "") -> DataFrame:
    """``docs`` plus the base counts (names prefixed by ``prefix``) and ``<prefix>n_lines``."""
    p = prefix or "_"
    t, w, ln, wh, dup = (clean_name(docs.columns, f"{p}{x}") for x in ("t", "w", "ln", "wh", "dup"))
    keep = docs.columns
    df = docs.withColumn(t, text_of(text))
    df = df.withColumns({
        w: words_of(F.col(t)),
        ln: F.filter(F.split(F.col(t), "\n"), lambda x: x.rlike(WORD_CHAR)),
    })
    df = df.withColumn(wh, F.transform(F.col(w), lambda x: F.xxhash64(x)))
    # Windows of three words as 64-bit hashes; sorting a long array is a primitive sort.
    df = df.withColumn(wh, F.when(F.size(w) >= 3, F.transform(
        F.sequence(F.lit(0), F.size(w) - 3),
        lambda i: F.xxhash64(F.get(F.col(wh), i), F.get(F.col(wh), i + 1), F.get(F.col(wh), i + 2))))
        .otherwise(F.array().cast("array<bigint>")))
    df = df.withColumn(dup, F.size(wh) > F.size(F.array_distinct(wh)))
    pairs = clean_name(docs.columns, f"{p}pairs")
    # Only texts with some repeated window sort (hash, position) pairs.
    df = df.withColumn(pairs, F.when(F.col(dup), F.sort_array(F.transform(
        F.col(wh), lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    df = df.withColumn(pairs, F.when(F.col(dup), F.sort_array(F.transform(F.filter(
        F.col(pairs), lambda x, j: (F.get(F.col(pairs), j - 1)["h"] == x["h"]) |
        F.coalesce(F.get(F.col(pairs), j + 1)["h"] == x["h"], F.lit(False))), lambda x: x["i"]))))
    covered = F.aggregate(
        F.col(pairs), F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(F.lit(3), i - a["last"])).alias("n")),
        lambda a: a["n"])
    return df.select(
        *[F.col(f"`{c}`") for c in keep],
        F.size(w).cast("long").alias(prefix + "n_words"),
        F.char_length(F.array_join(w, "")).cast("long").alias(prefix + "word_chars"),
        (F.size(F.split(F.col(t), r"[#*$%&|<>]", -1)) - 1).cast("long").alias(prefix + "n_symbols"),
        (F.size(ln) - F.size(F.array_distinct(ln))).cast("long").alias(prefix + "n_dup_lines"),
        F.when(F.col(dup), covered).otherwise(F.lit(0)).cast("long").alias(prefix + "n_repeat_words"),
        F.size(ln).cast("long").alias(prefix + "n_lines"))


def base_failed(prefix: str = "") -> Column:
    n = F.col(prefix + "n_words")
    return (n < MIN_WORDS) | (100 * F.col(prefix + "n_repeat_words") > MAX_REPEAT_PERCENT * n)


def metrics(prefix: str = "") -> dict[str, Column]:
    """Integer metrics in thousandths; only asked of texts with words."""
    c = lambda n: F.col(prefix + n)
    n = F.greatest(c("n_words"), F.lit(1))
    per = lambda a, b: F.floor(1000 * a / b).cast("long")
    return {"word_len": per(c("word_chars"), n), "symbols": per(c("n_symbols"), F.greatest(c("word_chars"), F.lit(1))),
            "dup_lines": per(c("n_dup_lines"), c("n_lines") + 4), "repeats": per(c("n_repeat_words"), n)}


def sketch_bucket(v: Column) -> Column:
    return F.when(v <= 0, 0).otherwise(1 + F.floor(F.log(v) / F.lit(math.log(SKETCH_GAMMA)))).cast("int")


def sketch_value(b: Column) -> Column:
    """Upper edge of a bucket, rounded to a whole thousandth."""
    return F.when(b <= 0, 0).otherwise(F.floor(F.pow(F.lit(SKETCH_GAMMA), b))).cast("long")


def thresholds(base: DataFrame, lang: str = "lang", source: str = "source", prefix: str = "") -> DataFrame:
    """One row per (lang, source): ``<metric>_lo`` and ``<metric>_hi``.

    ``base`` has the base counts.  Texts that fail the base rules don't count.
    The shuffle carries one row per group, metric and sketch bucket (about a
    thousand buckets at most per sketch), summed map-side first.
    """
    ok = base.where(~base_failed(prefix))
    named = F.explode(F.array(*[F.struct(F.lit(k).alias("metric"), sketch_bucket(v).alias("bucket"))
                                for k, v in metrics(prefix).items()]))
    sketch = materialize(
        ok.select(F.col(lang).alias("lang"), F.col(source).alias("source"), named.alias("m"))
        .groupBy("lang", "source", "m.metric", "m.bucket").agg(F.count("*").alias("n")), "quality-sketch")

    def fences(keys: list[str]) -> DataFrame:
        merged = sketch.groupBy(*keys, "metric", "bucket").agg(F.sum("n").alias("n"))
        by = [*keys, "metric"]
        # The whole sketch of a group is a bounded array: cumulative counts by bucket.
        arr = merged.groupBy(*by).agg(F.sum("n").alias("total"),
                                      F.sort_array(F.collect_list(F.struct("bucket", "n"))).alias("s"))

        def at(q: Column) -> Column:
            need = F.ceil(F.col("total") * q)
            found = F.aggregate(
                "s", F.struct(F.lit(0).cast("long").alias("c"), F.lit(None).cast("int").alias("b")),
                lambda a, x: F.struct((a["c"] + x["n"]).alias("c"),
                                      F.when(a["b"].isNotNull(), a["b"]).when(a["c"] + x["n"] >= need, x["bucket"]).alias("b")),
                lambda a: a["b"])
            return sketch_value(found)

        given = lambda x: F.create_map(*[F.lit(v) for k in METRICS for v in (k, x(*TAIL[k]))])[F.col("metric")]
        arr = arr.withColumns({"low": at(given(lambda t, _: t)), "mid": at(F.lit(0.5)), "high": at(given(lambda t, _: 1 - t)),
                               "reach": given(lambda _, r: r)})
        wide = lambda a, b: F.col("reach") * F.greatest(F.col(a) - F.col(b), F.lit(ROUNDING), F.floor(F.col("mid") * (SKETCH_GAMMA - 1)))
        arr = arr.select(*by, "total", (F.col("low") - wide("mid", "low")).alias("lo"), (F.col("high") + wide("high", "mid")).alias("hi"))
        return arr.groupBy(*keys).agg(
            F.max("total").alias("total"),
            *[F.max(F.when(F.col("metric") == k, F.col(s))).alias(f"{k}_{s}") for k in METRICS for s in ("lo", "hi")])

    cols = [f"{k}_{s}" for k in METRICS for s in ("lo", "hi")]
    by_group, by_lang, overall = fences(["lang", "source"]), fences(["lang"]), fences([])
    g = by_group.alias("g").join(by_lang.alias("l"), F.col("g.lang").eqNullSafe(F.col("l.lang")), "left")
    g = g.join(F.broadcast(overall).alias("o"), F.lit(True), "left")  # one row
    pick = lambda c: (F.when(F.col("g.total") >= MIN_GROUP, F.col(f"g.{c}"))
                      .when(F.col("l.total") >= MIN_GROUP, F.col(f"l.{c}")).otherwise(F.col(f"o.{c}")))
    return materialize(g.select(F.col("g.lang").alias("lang"), F.col("g.source").alias("source"),
                                *[pick(c).alias(c) for c in cols]), "quality-thresholds")


def judge(base: DataFrame, limits: DataFrame, lang: str = "lang", source: str = "source", prefix: str = "") -> DataFrame:
    """``base`` plus ``<prefix>base_failed`` and ``<prefix>kept`` (joined filtering).

    ``limits`` is a written table with one row per group, so the planner knows
    its size and broadcasts it only below its own threshold.
    """
    lim = limits.select(F.col("lang").alias("__l"), F.col("source").alias("__s"),
                        *[F.col(c).alias(f"__{c}") for c in limits.columns if c not in ("lang", "source")])
    ok = F.lit(True)
    for k, v in metrics(prefix).items():
        ok = ok & (F.col(f"__{k}_hi").isNull() | (v <= F.col(f"__{k}_hi")))
        if k in TWO_SIDED:
            ok = ok & (F.col(f"__{k}_lo").isNull() | (v >= F.col(f"__{k}_lo")))
    joined = base.join(lim, base[lang].eqNullSafe(F.col("__l")) & base[source].eqNullSafe(F.col("__s")), "left")
    return joined.select(*[F.col(f"`{c}`") for c in base.columns], base_failed(prefix).alias(prefix + "base_failed"),
                         (~base_failed(prefix) & ok).alias(prefix + "kept"))


@clash_free("qr_")
def quality_rules(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """Every row of ``docs`` without its text, plus base counts, ``base_failed`` and ``kept``."""
    others = [c for c in docs.columns if c != text]
    base = materialize(with_base(docs, text, "qr_").select(*[F.col(f"`{c}`") for c in others],
                                                          *["qr_" + c for c in [*BASE, "n_lines"]]), "quality-base")
    return judge(base, thresholds(base, lang, source, "qr_"), lang, source, "qr_")


@clash_free("qr_")
def filter_documents(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """The rows of ``docs`` that the rules keep, all columns as they were.

    Texts are scanned twice (once for the sketches, once for the verdict)
    rather than shuffled.
    """
    # The counter keeps the optimizer from moving the filter, and with it copies of the counting, below the projections.
    base = with_base(docs, text, "qr_").withColumn("qr_row", F.monotonically_increasing_id())
    counts = with_base(docs, text, "qr_").select(F.col(lang).alias("lang"), F.col(source).alias("source"),
                                                 *["qr_" + c for c in [*BASE, "n_lines"]])
    limits = thresholds(materialize(counts, "quality-base"), "lang", "source", "qr_")
    return judge(base, limits, lang, source, "qr_").where("qr_kept AND qr_row >= 0").select(
        *[F.col(f"`{c}`") for c in docs.columns])
