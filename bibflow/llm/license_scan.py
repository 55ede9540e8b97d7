"""License scans by diagonal voting.

Notices and phrases are short word sequences, the templates.  Every document's
rolling word k-grams are hashed and joined to the template positions that hold
the same gram (the words themselves are compared as well, so a hash collision
is no hit).  A hit at document word ``p`` and template word ``t`` votes for the
diagonal ``p - t``: all hits of one undisturbed copy lie on one diagonal, and an
inserted or missing word moves the rest of the copy to a neighbouring one.
Votes are summed by (document, template, diagonal); a diagonal with most votes
among its neighbours within ``SLACK`` takes their hits over, and the merged span
is verified: its score is the number of template words that its hits cover,
divided by the template's words plus the words in between that no hit covers.
A span holds its label if the score reaches ``MIN_SCORE`` and every key word of
the template (the version, the variant) is covered.  Base phrases must match
word by word, on one diagonal, and every such place counts.

All DataFrame expressions; the only joined side that is broadcast is the
template table, one row per gram of the fixed list.  Each document's own row
travels through the same pass as its hits (as a last gram that is null), so
texts are read once and never shuffled.

Null text counts as empty: no words, no labels, score 0.  Repeated rows are
scanned each for itself, columns of any name are passed through, an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bibflow.llm.common import materialize, text_of

#: Separators of words: all ASCII but digits and small letters.
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GRAM = 2
SLACK = 2
MIN_SCORE = 0.8
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Template(NamedTuple):
    """A label and its words; key words carry a ``*`` in front.  ``exact``: a base phrase."""

    label: str
    text: str
    exact: bool = False

    @property
    def words(self) -> list[str]:
        return [w.lstrip("*") for w in self.text.split()]

    @property
    def keys(self) -> list[int]:
        return [i for i, w in enumerate(self.text.split()) if w.startswith("*")]


#: Fixed phrases and labels of the base rule.
BASE = [
    Template("cc-by", "cc by", True),
    Template("gpl", "general public license", True),
    Template("reserved", "all rights reserved", True),
]

#: Fixed notices of common public licenses.
NOTICES = [
    Template("agpl", "gnu *affero general public license"),
    Template("apache-2.0", "licensed under the *apache license version *2 *0"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    Template("bsl-1.0", "*boost software license version *1 *0"),
    Template("cc-by-4.0", "creative commons attribution *4 *0 international license"),
    Template("cc-by-nc-4.0", "licensed under cc by *nc *4 *0"),
    Template("cc-by-nc-4.0", "creative commons attribution *noncommercial *4 *0 international license"),
    Template("cc-by-nd-4.0", "licensed under cc by *nd *4 *0"),
    Template("cc-by-sa-4.0", "licensed under cc by *sa *4 *0"),
    Template("cc-by-sa-4.0", "creative commons attribution *sharealike *4 *0 international license"),
    Template("cc0-1.0", "*cc0 1 0 universal public domain dedication"),
    Template("epl-2.0", "*eclipse public license *version *2 *0"),
    Template("gfdl", "gnu *free *documentation license"),
    Template("gpl-2.0", "gnu *general *public license version *2"),
    Template("gpl-3.0", "gnu *general *public license version *3"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    Template("lgpl", "gnu *lesser general public license"),
    Template("mit", "released under the *mit license"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    Template("mpl-2.0", "*mozilla public license *version *2 *0"),
    Template("ofl-1.1", "sil *open *font license version *1 *1"),
    Template("unlicense", "this is free and unencumbered software released into the public domain"),
]


def lowered(text: Column) -> Column:
    """``text`` with A-Z alone in lower case (the plain function where the text is ASCII)."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, _UPPER, _LOWER))


def license_words(text: Column) -> Column:
    return F.filter(F.split(lowered(text), NO_WORD), lambda w: w != "")


def _gram(words: Column, at: Column) -> Column:
    return F.xxhash64(*[F.get(words, at + i) for i in range(GRAM)])


def template_grams(spark: SparkSession, templates: Sequence[Template]) -> DataFrame:
    """One row per gram of every template: hash, its words, template number and position."""
    rows = [(n, i, *t.words[i:i + GRAM]) for n, t in enumerate(templates) for i in range(len(t.words) - GRAM + 1)]
    names = [f"w{i}" for i in range(GRAM)]
    df = spark.createDataFrame(rows, "template int, at int, " + ", ".join(f"{w} string" for w in names))
    return df.withColumn("hash", F.xxhash64(*names))


def gram_hits(docs: DataFrame, templates: Sequence[Template], text: str = "text") -> DataFrame:
    """One pass over the texts: rows (row, others, n_words) per document and (row, template, diagonal, at) per hit."""
    others = F.struct(F.lit(0).alias("z"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns) if c != text])
    df = docs.select(F.monotonically_increasing_id().alias("row"), others.alias("others"),
                     license_words(text_of(f"`{text}`")).alias("words"))
    n = F.size("words")
    grams = F.when(n >= GRAM, F.transform(F.sequence(F.lit(0), n - GRAM), lambda i: _gram(F.col("words"), i))).otherwise(
        F.array().cast("array<bigint>"))
    df = df.select("row", "others", "words", F.posexplode(F.concat(grams, F.array(F.lit(None).cast("bigint")))).alias("p", "h"))
    same = F.col("h") == F.col("hash")
    for i in range(GRAM):
        same &= F.get(F.col("words"), F.col("p") + i) == F.col(f"w{i}")
    joined = df.join(F.broadcast(template_grams(docs.sparkSession, templates)), same, "left")
    own = F.col("h").isNull()
    return joined.where(own | F.col("template").isNotNull()).select(
        "row", F.when(own, F.col("others")).alias("others"), F.when(own, F.size("words").cast("long")).alias("n_words"),
        "template", (F.col("p") - F.col("at")).alias("diagonal"), "at")


def spans(hits: DataFrame, templates: Sequence[Template]) -> DataFrame:
    """Verified spans (row, label, exact, first, last, score) of the rows of :func:`gram_hits`."""
    spark = hits.sparkSession
    shape = F.broadcast(spark.createDataFrame(
        [(n, t.label, t.exact, len(t.words), t.keys) for n, t in enumerate(templates)],
        "template int, label string, exact boolean, size int, keys array<int>"))
    votes = hits.where("template IS NOT NULL").groupBy("row", "template", "diagonal").agg(
        F.count("*").alias("votes"), F.collect_list(F.col("at")).alias("ats"))
    by = Window.partitionBy("row", "template").orderBy("diagonal")
    near = by.rangeBetween(-SLACK, SLACK)
    merged = votes.withColumns({
        "before": F.max("votes").over(by.rangeBetween(-SLACK, -1)),
        "after": F.max("votes").over(by.rangeBetween(1, SLACK)),
        "near": F.collect_list(F.struct("diagonal", "ats")).over(near)}).join(shape, "template")
    whole = F.col("exact") & (F.col("votes") == F.col("size") - GRAM + 1)
    peak = ~F.col("exact") & (F.col("votes") > F.coalesce("before", F.lit(0))) & (F.col("votes") >= F.coalesce("after", F.lit(0)))
    reach = lambda a: F.flatten(F.transform(a, lambda t: F.sequence(t, t + GRAM - 1)))
    covered = F.array_distinct(F.flatten(F.transform("near", lambda d: reach(d["ats"]))))
    places = F.array_distinct(F.flatten(F.transform("near", lambda d: F.transform(reach(d["ats"]), lambda t: t + d["diagonal"]))))
    found = merged.where(whole | peak).withColumns({"covered": covered, "places": places})
    first, last = F.array_min("places"), F.array_max("places")
    between = last - first + 1 - F.size("places")
    score = F.least(F.size("covered"), F.size("places")) / (F.col("size") + between)
    found = found.select(
        "row", "label", "exact", "keys", "covered",
        F.when(F.col("exact"), F.col("diagonal")).otherwise(first).cast("long").alias("first"),
        F.when(F.col("exact"), F.col("diagonal") + F.col("size") - 1).otherwise(last).cast("long").alias("last"),
        F.when(F.col("exact"), F.lit(1.0)).otherwise(score).alias("score"))
    return found.where(F.col("exact") | ((F.col("score") >= MIN_SCORE) & (F.size(F.array_except("keys", "covered")) == 0))).drop(
        "keys", "covered")


def scan_licenses(docs: DataFrame, text: str = "text", templates: Sequence[Template] = (*BASE, *NOTICES)) -> DataFrame:
    """Every row of ``docs`` without its text, plus
    ``ls_n_words``, ``ls_n_base`` (places of base phrases), ``ls_first_word`` and ``ls_last_word`` (their smallest and
    greatest start), ``ls_base_labels``, ``ls_labels``, ``ls_score`` (of the best span) and ``ls_spans``."""
    names = [c for c in docs.columns if c != text]
    hits = materialize(gram_hits(docs, templates, text), "license-hits")
    start = F.when(F.col("exact"), F.col("first"))
    joined = lambda c: F.array_join(F.sort_array(F.collect_set(c)), ",")
    per_row = spans(hits, templates).groupBy("row").agg(
        F.count_if("exact").alias("n_base"), F.min(start).alias("first_word"), F.max(start).alias("last_word"),
        joined(F.when(F.col("exact"), F.col("label"))).alias("base_labels"), joined(F.col("label")).alias("labels"),
        F.max("score").alias("score"), F.sort_array(F.collect_list(F.struct("first", "last", "label", "score"))).alias("spans"))
    # Both sides are without texts; the planner knows the size of the written one.
    out = hits.where("others IS NOT NULL").select("row", "others", "n_words").join(per_row, "row", "left")
    positions = [i for i, c in enumerate(docs.columns) if c != text]
    return out.select(
        *[F.col("others").getField(f"c{i}").alias(c) for i, c in zip(positions, names)],
        F.col("n_words").alias("ls_n_words"), F.coalesce("n_base", F.lit(0)).cast("long").alias("ls_n_base"),
        F.col("first_word").alias("ls_first_word"), F.col("last_word").alias("ls_last_word"),
        F.coalesce("base_labels", F.lit("")).alias("ls_base_labels"), F.coalesce("labels", F.lit("")).alias("ls_labels"),
        F.coalesce("score", F.lit(0.0)).alias("ls_score"), F.col("spans").alias("ls_spans"))
