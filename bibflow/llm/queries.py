"""The registered queries of this subpackage: thin digests of the operators' outputs."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bibflow.llm import (centroid_clustering, exact_dedup, html_wrappers, license_scan, line_dedup, mixing, oracles, packing,
                         quality_rules, simhash, source_divergence, suffix_dedup, token_counts, warc)
from bibflow.llm.common import table

VOCABULARY = "byte_bpe_50k.json"


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document."""
    out = token_counts.count_tokens(table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary_path())
    return out.toDF("doc_id", "n_bytes", "n_tokens", "over_limit")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and verdict of every document."""
    out = quality_rules.quality_rules(table(spark, sf_dir, "documents"))
    return out.select("doc_id", *[F.col("qr_" + c).alias(c) for c in
                                  ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")])


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    out = simhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.col("sh_fingerprint").alias("fingerprint"), F.col("sh_component").alias("component_id"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document."""
    out = mixing.mix(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"),
                      F.col("mix_target").alias("target"), F.col("mix_taken").alias("taken"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines removed from every document and the digest of what is left."""
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.col("ld_lines").cast("long").alias("n_lines"), F.col("ld_removed").cast("long").alias("n_removed"),
                      F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document loses to repeated strings and the digest of the rest."""
    out = suffix_dedup.dedup_strings(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.toDF("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where every piece of every document goes."""
    out = packing.pack(table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary_path())
    return out.toDF("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to archives and read back."""
    manifest = warc.write_archives(warc.classify(table(spark, sf_dir, "pages")))
    chunks = warc.read_archives(manifest, data=False)
    return chunks.where("last").select("page_id", "payload_bytes", F.col("sha1_so_far").alias("payload_digest"),
                                       "record_type", "refers_to")


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The older half of the ids as history, the rest as the batch looked up in it; every row is returned."""
    docs = table(spark, sf_dir, "documents")
    middle = docs.agg(F.expr("(min(doc_id) + max(doc_id)) / 2")).first()[0]
    out = exact_dedup.dedup(docs, F.col("doc_id") <= F.lit(middle))
    return out.select("doc_id", *[F.col("ed_" + c).alias(c) for c in ("keep_id", "group_size", "kept", "text_sha256")])


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    out = html_wrappers.main_texts(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return out.toDF("page_id", "url", "text", "n_chars")


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and notices of every document."""
    out = license_scan.scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", *[F.col("ls_" + c).alias(c) for c in (
        "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")])


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergence of every source from the others of its language, and the terms that stand out."""
    out = source_divergence.source_divergence(table(spark, sf_dir, "documents"))
    return out.toDF("lang", "source", "part", "item", "value", "rank")


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster of every whole vector."""
    out = centroid_clustering.cluster_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return out.select("vec_id", *[F.col("cc_" + c).alias(c) for c in (
        "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")])


def op2_sql() -> str:
    q = quality_rules
    metric = {"word_len": "1000 * word_chars / n_words", "symbols": "1000 * n_symbols / greatest(word_chars, 1)",
              "dup_lines": "1000 * n_dup_lines / (n_lines + 4)", "repeats": "1000 * n_repeat_words / n_words"}
    values = " UNION ALL ".join(
        f"SELECT doc_id, lang, source, '{k}' AS metric, CAST(floor({v}) AS BIGINT) AS v, {q.TAIL[k][0]} AS tail, {q.TAIL[k][1]} AS reach, "
        f"{'true' if k in q.TWO_SIDED else 'false'} AS both_sides FROM f WHERE NOT base_failed" for k, v in metric.items())

    def fences(name: str, keys: str) -> str:
        by = f"{keys}, metric" if keys else "metric"
        pick = f"SELECT {by}, max(total) AS total, max(reach) AS reach, "
        value = "CASE WHEN {0} <= 0 THEN 0 ELSE floor(pow(" + str(q.SKETCH_GAMMA) + ", {0})) END"
        quant = ", ".join(f"min(CASE WHEN cum >= ceil(total * {x}) THEN bucket END) AS b{n}" for n, x in (("low", "tail"), ("mid", "0.5"), ("high", "(1 - tail)")))
        return f"""{name}_c AS (SELECT {by}, bucket, tail, reach, sum(count(*)) OVER (PARTITION BY {by} ORDER BY bucket) AS cum,
              sum(count(*)) OVER (PARTITION BY {by}) AS total FROM s GROUP BY {by}, bucket, tail, reach),
        {name}_q AS ({pick}{quant} FROM {name}_c GROUP BY {by}),
        {name} AS (SELECT *, {value.format('blow')} AS low, {value.format('bmid')} AS mid,
            {value.format('bhigh')} AS high FROM {name}_q)"""

    upper = lambda a: f"{a}.high + {a}.reach * greatest({a}.high - {a}.mid, {q.ROUNDING}, floor({a}.mid * {q.SKETCH_GAMMA - 1!r}))"
    lower = lambda a: f"{a}.low - {a}.reach * greatest({a}.mid - {a}.low, {q.ROUNDING}, floor({a}.mid * {q.SKETCH_GAMMA - 1!r}))"
    limit = lambda edge: ("CASE WHEN g.total >= {0} THEN {1} WHEN l.total >= {0} THEN {2} ELSE {3} END".format(
        q.MIN_GROUP, *map(edge, "glo")))
    return rf"""
WITH d AS (SELECT doc_id, lang, source, coalesce(text, '') AS t,
             regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0b\x0c\r]+') AS w FROM documents),
g3 AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
       FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3)),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM (
          SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM g3) WHERE c > 1) GROUP BY doc_id),
ln AS (SELECT doc_id, count(*) AS n, count(*) - count(DISTINCT x) AS dup FROM (
         SELECT doc_id, unnest(string_split(t, chr(10))) AS x FROM d) WHERE regexp_matches(x, '[^ \t\n\x0b\x0c\r]') GROUP BY doc_id),
f0 AS (SELECT d.doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words, length(array_to_string(w, '')) AS word_chars,
        length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(ln.dup, 0) AS n_dup_lines,
        coalesce(rep.n, 0) AS n_repeat_words, coalesce(ln.n, 0) AS n_lines
       FROM d LEFT JOIN rep USING (doc_id) LEFT JOIN ln USING (doc_id)),
f AS (SELECT *, n_words < {q.MIN_WORDS} OR 100 * n_repeat_words > {q.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM f0),
v AS ({values}),
s AS (SELECT *, CASE WHEN v <= 0 THEN 0 ELSE 1 + CAST(floor(ln(v) / {math.log(q.SKETCH_GAMMA)!r}) AS INTEGER) END AS bucket FROM v),
{fences("g", "lang, source")},
{fences("l", "lang")},
{fences("o", "")},
out AS (SELECT DISTINCT s.doc_id FROM s
        JOIN g ON g.lang IS NOT DISTINCT FROM s.lang AND g.source IS NOT DISTINCT FROM s.source AND g.metric = s.metric
        JOIN l ON l.lang IS NOT DISTINCT FROM s.lang AND l.metric = s.metric
        JOIN o ON o.metric = s.metric
        WHERE s.v > {limit(upper)} OR (s.both_sides AND s.v < {limit(lower)}))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM out) AS kept
FROM f
"""


OP5_SQL = rf"""
WITH lines AS (
    SELECT doc_id, source, i, line, trim(line, E' \\t\\n\\x0b\\x0c\\r') AS t FROM (
        SELECT doc_id, source, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents)),
cand AS (SELECT * FROM lines WHERE t <> ''),
spread AS (SELECT t, min(doc_id) AS first FROM cand GROUP BY t
           HAVING count(DISTINCT source) + max(CASE WHEN source IS NULL THEN 1 ELSE 0 END) >= {line_dedup.MIN_SITES}),
marked AS (
    SELECT l.doc_id, l.i, l.line, CASE WHEN s.t IS NULL THEN 0 WHEN l.doc_id <> s.first THEN 1
        WHEN row_number() OVER (PARTITION BY l.doc_id, l.t ORDER BY l.i) > 1 THEN 1 ELSE 0 END AS gone
    FROM lines l LEFT JOIN spread s ON l.t = s.t)
SELECT doc_id, count(*) AS n_lines, CAST(sum(gone) AS BIGINT) AS n_removed,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE gone = 0), '')) AS text_sha256
FROM marked GROUP BY doc_id
"""

OP8_SQL = f"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, octet_length(payload) AS n, sha1(payload) AS digest, sha256(payload) AS s FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY s) AS top FROM d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN n >= {warc.MIN_REVISIT} AND page_id <> top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= {warc.MIN_REVISIT} AND page_id <> top THEN top END AS refers_to
FROM m
"""

OP9_SQL = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""


def queries() -> dict:
    import corpus_pipeline

    return {
        "op1_token_counts": op1_token_counts,
        "op2_quality_rules": op2_quality_rules,
        "op3_simhash": op3_simhash,
        "op4_mixing": op4_mixing,
        "op5_line_dedup": op5_line_dedup,
        "op6_suffix_dedup": op6_suffix_dedup,
        "op7_packing": op7_packing,
        "op8_warc": op8_warc,
        "op9_exact_dedup": op9_exact_dedup,
        "op10_html_extraction": op10_html_extraction,
        "op11_license_scan": op11_license_scan,
        "op12_source_divergence": op12_source_divergence,
        "op13_centroid_clustering": op13_centroid_clustering,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_quality_rules": op2_sql(),
        "op5_line_dedup": OP5_SQL,
        "op8_warc": OP8_SQL,
        "op9_exact_dedup": OP9_SQL,
        "op11_license_scan": oracles.license_scan(),
        "op12_source_divergence": oracles.source_divergence(),
        "op13_centroid_clustering": oracles.centroid_clustering(),
    }
