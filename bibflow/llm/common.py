"""Helpers shared by the training-data operators.

``materialize`` is the only lineage cut: a Parquet table under the folder that
the cluster names in ``spark.checkpoint.dir``.  It survives lost executors, and
its file size gives the planner a real size for choosing a broadcast join.
"""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: One separator run; a word is a maximal run of anything else.
SPACE_RUN = r"[\x20\x09-\x0D]+"
WORD_CHAR = r"[^\x20\x09-\x0D]"


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared folder as a URI; one of our own only if unset (tests)."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        base = "file://" + tempfile.mkdtemp(prefix="llm-shared-")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that is never used twice."""
    return f"{shared_root(spark)}/llm-scratch/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(col: str) -> Column:
    """The text with null read as empty."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    """Array of the words of ``text`` (JVM only)."""
    return F.filter(F.split(text, SPACE_RUN), lambda w: w != "")


def word_count(text: Column) -> Column:
    """Number of words without keeping them: separator runs plus one, less empty ends."""
    parts = F.size(F.split(F.concat(F.lit(" "), text, F.lit(" ")), SPACE_RUN))
    return F.when(text.rlike(WORD_CHAR), parts - 2).otherwise(0).cast("long")


def clean_name(taken: list[str], name: str) -> str:
    """``name``, or a variant that no column of ``taken`` has (any letter case)."""
    used = {c.lower() for c in taken}
    while name.lower() in used:
        name += "_"
    return name


def clash_free(prefix: str, *names: str):
    """For operators ``f(docs, ...)`` whose own columns begin with ``prefix`` or ``__`` (or are among ``names``).

    Columns of ``docs`` with such names go through under other names and get
    their own back in the result; a result column that would share a name with
    one of them gets a ``_`` behind it.  Other inputs are passed on as they are.
    """
    def wrap(f):
        @functools.wraps(f)
        def run(docs: DataFrame, *args, **kwargs) -> DataFrame:
            own = lambda c: c.lower().startswith((prefix, "__")) or c.lower() in names
            other = {c: f"input{i}_column" for i, c in enumerate(docs.columns) if own(c)}
            if not other:
                return f(docs, *args, **kwargs)
            named = lambda a: other.get(a, a) if isinstance(a, str) else a
            out = f(docs.toDF(*[other.get(c, c) for c in docs.columns]), *map(named, args), **{k: named(v) for k, v in kwargs.items()})
            back = {v: k for k, v in other.items()}
            return out.toDF(*[back[c] if c in back else clean_name(list(other), c) for c in out.columns])

        return run

    return wrap


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of undirected ``edges`` (a, b): rows (node, root), root the smallest node.

    Alternates the large-star and small-star steps: each round is two group-bys
    whose rows are edges, never a whole component in one record, and ends with a
    table in the shared folder.  Star groups are formed by a join on the
    per-node minimum, so a node with very many neighbours needs no list.
    """
    def star(e: DataFrame, large: bool) -> DataFrame:
        if large:  # every node sees all neighbours; larger ones move to the minimum
            both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
            least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
            return (both.where("b > a").join(least, "a")
                    .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct())
        # edges point from larger a to smaller b; the rest of a's neighbours move to the minimum
        least = e.groupBy("a").agg(F.min("b").alias("m"))
        moved = e.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        return moved.unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()

    cur = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                      .distinct(), "edges")
    before = None
    for _ in range(max_rounds):
        cur = materialize(star(star(cur, large=True)
                               .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
                               large=False), "stars")
        now = cur.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not converge")
    return cur.select(F.col("a").alias("node"), F.col("b").alias("root"))
