"""Schema drift (S13): the fields that records really hold, against the declared schema.

Every record's text is read as VARIANT; the members of the declared objects
become (path, kind) pairs, counted per group with map-side combine, so the
shuffle carries a row per group, path and kind.  A kind is one of the JSON
kinds: object, array, string, number, boolean, null.

Status of a pair: ``declared`` (the declared type reads it; text fields read
every kind, null fits all), ``changed`` (a declared path of another kind) or
``new``; a declared path that no record of a group has is ``absent`` with a NULL
kind.  Text that is not JSON, or no object, is counted under path ``$``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bibflow.functions.json import json_path
from bibflow.operators.conform import nested_paths


def kind_of(v: Column) -> Column:
    """JSON kind of a VARIANT; ``malformed`` for NULL."""
    name = F.regexp_extract(F.schema_of_variant(v), "^[A-Z]+", 0)
    return (F.when(v.isNull(), "malformed").when(name == "OBJECT", "object").when(name == "ARRAY", "array").when(name == "STRING", "string")
             .when(name == "BOOLEAN", "boolean").when(name == "VOID", "null").otherwise("number"))


def declared_kinds(schema: T.StructType, above: tuple[str, ...] = ()) -> dict[str, str]:
    """Path -> JSON kind that the declared type reads ('any' for text)."""
    out: dict[str, str] = {}
    for f in schema.fields:
        path = (*above, f.name)
        t = f.dataType
        out[json_path(path)] = ("object" if isinstance(t, T.StructType) else "array" if isinstance(t, T.ArrayType) else
                                "number" if isinstance(t, T.NumericType) else "boolean" if isinstance(t, T.BooleanType) else "any")
        if isinstance(t, T.StructType):
            out |= declared_kinds(t, path)
    return out


def members(variant: str, path: str) -> Column:
    """(path, kind) of every member of the object at ``path``; none where there is no object."""
    entries = F.map_entries(F.try_variant_get(variant, path, "map<string,variant>"))
    return F.coalesce(F.transform(entries, lambda e: F.struct(
        F.concat(F.lit(f"{path}['"), e["key"], F.lit("']")).alias("path"), kind_of(e["value"]).alias("kind"))),
        F.array().cast("array<struct<path:string,kind:string>>"))


def schema_drift(df: DataFrame, text: str, schema: T.StructType, group: str) -> DataFrame:
    """(group, path, kind, n_records, status) for the JSON in ``text``."""
    kinds = declared_kinds(schema)
    rows = df.select(F.col(group).alias("group"), F.inline(F.array(F.struct(F.try_parse_json(text).alias("v")))))
    root = F.when(kind_of(F.col("v")) != "object", F.array(F.struct(F.lit("$").alias("path"), kind_of(F.col("v")).alias("kind"))))
    found = [F.coalesce(root, F.array().cast("array<struct<path:string,kind:string>>"))]
    found += [members("v", json_path(above)) for above in [(), *nested_paths(schema)]]
    pairs = rows.select("group", F.inline(F.concat(*found))).groupBy("group", "path", "kind").agg(F.count(F.lit(1)).alias("n_records"))
    want = F.create_map(*[F.lit(x) for kv in kinds.items() for x in kv])[F.col("path")]
    status = F.when(want.isNull(), "new").when(want.isin("any") | (want == F.col("kind")) | (F.col("kind") == "null"), "declared").otherwise("changed")
    seen = pairs.select("group", "path", "kind", "n_records", status.alias("status"))
    # Declared paths are a fixed list, so a group has that many rows here.
    expected = df.select(F.col(group).alias("group")).distinct().select("group", F.explode(F.array(*map(F.lit, kinds))).alias("path"))
    there = pairs.select(F.col("group").alias("g"), F.col("path").alias("p")).distinct()
    absent = expected.join(there, F.col("group").eqNullSafe(F.col("g")) & (F.col("path") == F.col("p")), "left_anti")
    return seen.unionByName(absent.select("group", "path", F.lit(None).cast("string").alias("kind"), F.lit(0).cast("long").alias("n_records"),
                                          F.lit("absent").alias("status")))
