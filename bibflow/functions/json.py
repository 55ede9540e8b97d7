"""JSON column functions: polymorphic normalisation and nested -> text."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bibflow.functions.scalars import col_of


def parse(c: str | Column, schema: T.DataType | str) -> Column:
    """JSON text -> typed value with a declared schema.

    Malformed text gives NULL (PERMISSIVE), never an exception.
    """
    return F.from_json(col_of(c), schema, {"mode": "PERMISSIVE"})


def parse_once(df, text_col: str, schema: T.DataType | str, out: str = "rec",
               keep=()) -> "DataFrame":
    """Parse a JSON text column once, as a column later filters cannot undo.

    Catalyst pushes a filter below the projection that defines ``out`` and
    substitutes the definition, so a filter on three fields of ``out``
    would parse every record three more times.  Emitting the parsed struct
    from a one-row generator (``inline(array(struct(...)))``) stops that:
    predicates on generator output stay above it, and each record is parsed
    exactly once.
    """
    return df.select(*keep, F.inline(F.array(F.struct(parse(text_col, schema).alias(out)))))


def as_array(raw: str | Column, array_type: T.ArrayType | str) -> Column:
    """Raw JSON text holding one object *or* a list of objects -> array.

    ``{"$":"a"}`` becomes a one-element array, ``[...]`` stays an array,
    NULL stays NULL.
    """
    return F.from_json(col_of(raw), array_type, {"mode": "PERMISSIVE"})


def any_of(conditions) -> Column:
    return reduce(or_, conditions)


def struct_fields(st: T.StructType) -> list[T.StructField]:
    return [f for f in st.fields if isinstance(f.dataType, T.StructType)]


def is_object(v: Column) -> Column:
    return F.try_variant_get(v, "$", "map<string,variant>").isNotNull()


def has_value(v: Column) -> Column:
    """Present and not the JSON null."""
    return v.isNotNull() & ~F.coalesce(F.is_variant_null(v), F.lit(False))


def json_path(names) -> str:
    """The path of nested keys, whatever characters they hold."""
    return "$" + "".join(f"['{n}']" for n in names)


def wrong_element(v: Column, text: Column, element: T.StructType) -> Column:
    """Whether a list element, given as VARIANT and as text, does not fit ``element``.

    It fits if it is an object whose declared nested objects are objects.  Text
    that VARIANT does not accept (repeated keys) is judged by its first character.
    """
    wrong = ~is_object(v)
    for f in struct_fields(element):
        child = F.try_variant_get(v, json_path([f.name]), "variant")
        wrong |= has_value(child) & ~is_object(child)
    return F.when(v.isNull(), ~text.startswith("{")).otherwise(wrong)


def with_elements(df: DataFrame, lists: dict[str, tuple[Column, T.StructType]], raw_field: str, bad: str = "__bad_") -> DataFrame:
    """Raw JSON text of one object or a list of objects -> array columns of structs.

    Every column of ``lists`` (name -> raw text, element type) holds structs of the
    element's fields and, as ``raw_field``, the element's whole text; an element
    that is the JSON null is a NULL struct.  Elements of another type are left out
    and found in ``<bad><name>`` as (pos, value); the others stay.  Lists in which
    every element fits are parsed against the declared type once; only the rest is
    compared element by element, as VARIANT.
    """
    t, a, v, n = ({k: f"__{x}_{k}" for k in lists} for x in "tavn")
    first, second, third = [], [], []
    for k, (raw, element) in lists.items():
        text = F.ltrim(raw)
        # A value that is no list is a list of one.
        first += [F.when(text.startswith("{"), F.array(raw)).when(text.startswith("["), F.coalesce(
            parse(raw, "ARRAY<STRING>"), F.array(raw))).when(raw.isNotNull(), F.array(raw)).alias(t[k]),
            as_array(raw, T.ArrayType(element)).alias(a[k]), raw.alias(n[k])]
        whole = F.col(a[k]).isNotNull() & (F.size(a[k]) == F.size(t[k]))
        doubt = ~whole
        if struct_fields(element):
            doubt |= F.exists(F.col(a[k]), lambda e: any_of(e.getField(f.name).isNull() for f in struct_fields(element)))
        variant = F.when(F.ltrim(n[k]).startswith("["), F.coalesce(
            F.try_variant_get(F.try_parse_json(n[k]), "$", "array<variant>"), F.array().cast("array<variant>"))).otherwise(
            F.array(F.try_parse_json(n[k])))
        second.append(F.when(doubt & F.col(t[k]).isNotNull(), F.transform(
            F.arrays_zip(F.col(t[k]).alias("t"), variant.alias("v")),
            lambda x, i: F.struct(i.alias("pos"), x["t"].alias("value"),
                                  (x["t"].isNotNull() & wrong_element(x["v"], x["t"], element)).alias("wrong")))).alias(v[k]))
        item = lambda e, r: F.struct(*[e.getField(f.name).alias(f.name) for f in element.fields], r.alias(raw_field))  # noqa: E731, B023
        checked = F.transform(F.filter(v[k], lambda x: ~x["wrong"]), lambda x: F.when(
            x["value"].isNotNull(), item(parse(x["value"], element), x["value"])))
        third += [F.when(F.col(v[k]).isNotNull(), checked).otherwise(F.zip_with(a[k], t[k], lambda e, r: F.when(e.isNotNull(), item(e, r)))).alias(k),
                  F.transform(F.filter(v[k], lambda x: x["wrong"]), lambda x: F.struct(
                      x["pos"].alias("pos"), x["value"].alias("value"))).alias(bad + k)]
    # Three steps, so that nothing is parsed twice.
    df = df.select("*", *first).select("*", *second)
    helpers = [*t.values(), *a.values(), *v.values(), *n.values()]
    return df.select("*", *third).drop(*helpers)


# JSON text in tokens: a string, a comma, white space, anything else up to the next of them.  The possessive
# quantifiers keep long strings from deep recursion.
_STRING = r'"(?:[^"\\]++|\\.)*+"'
_NULL_MEMBER = _STRING + r"\s*+:\s*+null\s*+"
_TOKENS = rf"(?s),\s*+{_NULL_MEMBER}(?=[,}}])|{_NULL_MEMBER},?|\s++|({_STRING}|,|[^\s\",]++)"


def without_nulls(raw: str | Column) -> Column:
    """Valid JSON text without the object members whose value is null, and without white space between tokens.

    Tokens are taken one after another from the start, so nothing inside a string
    is taken for a member.  Nulls in lists keep their place.
    """
    raw = col_of(raw)
    return F.when(raw.contains("null"), F.regexp_replace(raw, _TOKENS, "$1")).otherwise(raw)


# The key that marks the end of a text in :func:`is_one_value`.
_END = "__end_of_value"


def is_one_value(raw: str | Column) -> Column:
    """Whether text is exactly one JSON value, nothing after it (JVM only).

    The JSON functions ignore what follows the first value, so the text is read as
    a member of an object with one more behind it: both keys are found, and no other,
    only if it is one value.  One pass over the text; only text that may spell the
    second key itself is counted in arrays of two lengths instead: if it ended such
    an array, both counts would be the same.
    """
    raw = col_of(raw)
    marked = F.json_object_keys(F.concat(F.lit('{"v":'), raw, F.lit(f',"{_END}":0}}'))) == F.array(F.lit("v"), F.lit(_END))
    n = [F.json_array_length(F.concat(F.lit("["), raw, F.lit(",0" * k + "]"))) for k in (1, 2)]
    spelled = raw.contains(_END) | raw.contains("\\u")
    return F.coalesce(F.when(spelled, (n[0] == 2) & (n[1] == 3)).otherwise(marked), F.lit(False))


def is_nested_json(raw: str | Column) -> Column:
    """Whether text is exactly one JSON object or list."""
    raw = col_of(raw)
    return F.when(raw.rlike(r"^\s*[\[{]"), is_one_value(raw)).otherwise(False)


def quoted(text: str | Column) -> Column:
    """Text as a JSON string."""
    return F.to_json(F.array(col_of(text))).substr(F.lit(2), F.length(F.to_json(F.array(col_of(text)))) - 2)


def render(c: str | Column, raw_text: bool = False) -> Column:
    """A nested value as JSON text without NULL members.

    ``raw_text=True`` marks a column declared STRING in the source schema: it
    holds the JSON text of an object or list, or the bare text of a plain value,
    which becomes a JSON string.
    """
    c = col_of(c)
    if not raw_text:
        return F.to_json(c)
    return F.when(c.isNotNull(), F.when(is_nested_json(c), without_nulls(c)).otherwise(quoted(c)))


def json_or_empty(c: str | Column, raw_text: bool = False) -> Column:
    """Nested value -> JSON text; NULL -> ``'[]'``."""
    return F.coalesce(render(c, raw_text), F.lit("[]"))


def json_or_null(c: str | Column, raw_text: bool = False) -> Column:
    """Nested value -> JSON text; NULL stays NULL (P10)."""
    return render(c, raw_text)
