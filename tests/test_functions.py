"""Scalar functions: ANSI-safe conversions and NULL semantics."""

import datetime as dt
import json
import random

from pyspark.sql import functions as F
from pyspark.sql import types as T

from bibflow import functions as BF
from bibflow import schemas
from bibflow.functions import json as BJ


def one(spark, col, values, schema="v STRING"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(col).collect()]


def test_safe_date(spark):
    got = one(spark, BF.safe_date("v"), ["2018-03-04", "bad", None, "2018-13-01"])
    assert got == [dt.date(2018, 3, 4), None, None, None]


def test_safe_int_matches_legacy_cast(spark):
    got = one(spark, BF.safe_int("v"), ["12", "12.0", " 7 ", "x", None, "-3", "3.9"])
    assert got == [12, 12, 7, None, None, -3, 3]


def test_concat_date_parts_skips_nulls_and_gives_empty_string(spark):
    df = spark.createDataFrame([("2020", "1", "2"), ("2020", None, "2"), (None, None, None)],
                               "y STRING, m STRING, d STRING")
    got = [r[0] for r in df.select(BF.concat_date_parts("y", "m", "d")).collect()]
    assert got == ["2020-1-2", "2020-2", ""]


def test_flag_normalize(spark):
    got = one(spark, BF.flag_normalize("v"), ["true", "false", None, "junk"])
    assert got == [True, False, False, False]


def test_json_or_empty_and_json_or_null(spark):
    df = spark.createDataFrame([([1, 2],), (None,)], "v ARRAY<INT>")
    assert [r[0] for r in df.select(BF.json_or_empty("v")).collect()] == ["[1,2]", "[]"]
    assert [r[0] for r in df.select(BF.json_or_null("v")).collect()] == ["[1,2]", None]


def test_as_array_accepts_object_or_list(spark):
    got = one(spark, BF.as_array("v", T.ArrayType(schemas.SUBJECT_AREA)),
              ['{"@code":"1","$":"a"}', '[{"@code":"1"},{"@code":"2"}]', None, "[]"])
    assert [None if g is None else [s["@code"] for s in g] for g in got] == [["1"], ["1", "2"], None, []]


def test_path_with_odd_names(spark):
    df = spark.createDataFrame([('{"a:b":{"@c":{"$":"x"}}}',)], "v STRING")
    parsed = df.select(F.from_json("v", "`a:b` STRUCT<`@c`: STRUCT<`$`: STRING>>").alias("r"))
    assert parsed.select(F.col("r").getField("a:b").getField("@c").getField("$")).first()[0] == "x"


def elements_of(spark, texts, element):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    rows = BF.with_elements(df, {"good": (F.col("t"), element)}, "raw").orderBy("i").collect()
    return [(r["good"], [tuple(b) for b in r["__bad_good"] or []]) for r in rows]


def test_elements_keep_undeclared_fields(spark):
    texts = ['{"@code":"1","x":{"y":[1,null]}}', '[{"@code":"1","$":"a"},{"z":2}]', "[]", None, "plain"]
    got = elements_of(spark, texts, schemas.SUBJECT_AREA)
    assert [None if g is None else [(e["@code"], e["$"], e["raw"]) for e in g] for g, _ in got] == [
        [("1", None, texts[0])], [("1", "a", '{"@code":"1","$":"a"}'), (None, None, '{"z":2}')], [], None, []]
    assert [b for _, b in got] == [[], [], [], [], [(0, "plain")]]


def test_only_the_wrong_elements_go(spark):
    texts = ['[{"author-url":"u"},"str",null,5,{"author-url":"v","preferred-name":{"ce:surname":"s"}}]',
             '[{"author-url":"u","preferred-name":"Ann"},{"author-url":"v","preferred-name":null}]',
             '{"author-url":"u","preferred-name":["x"]}', '[[{"author-url":"u"}]]', '"str"', "[1,2", '{"author-url":"a","author-url":"b"}',
             '[null]', '[{"affiliation":[{"@id":"1"}]}]']
    got = elements_of(spark, texts, schemas.AUTHOR)
    urls = [[None if e is None else e["author-url"] for e in g] for g, _ in got]
    assert urls == [["u", None, "v"], ["v"], [], [], [], [], ["b"], [None], [None]]
    assert got[0][0][2]["preferred-name"]["ce:surname"] == "s" and got[8][0][0]["affiliation"] == '[{"@id":"1"}]'
    assert [b for _, b in got] == [
        [(1, "str"), (3, "5")], [(0, '{"author-url":"u","preferred-name":"Ann"}')], [(0, texts[2])], [(0, '[{"author-url":"u"}]')],
        [(0, '"str"')], [(0, "[1,2")], [], [], []]


def _dropped(v):
    if isinstance(v, dict):
        return {k: _dropped(x) for k, x in v.items() if x is not None}
    return [_dropped(x) for x in v] if isinstance(v, list) else v


def test_render_keeps_everything_but_null_members(spark):
    rnd = random.Random(3)
    texts = [None, 1, 2.5, True, "x", 'a"b":null,', "\\", '\\"k":null', " , null ", ',"null', "é\n"]

    def value(depth=0):
        kind = rnd.random()
        if depth > 4 or kind < 0.35:
            return rnd.choice(texts)
        if kind < 0.7:
            return {rnd.choice(["a", 'n"ull', "null", ":null,", "\\"]) + str(i): value(depth + 1) for i in range(rnd.randint(0, 4))}
        return [value(depth + 1) for _ in range(rnd.randint(0, 4))]

    values = [v for v in (value() for _ in range(600)) if isinstance(v, (dict, list))]
    values.append({"a": '\\"' * 500_000, "n": None, "z": [None]})
    df = spark.createDataFrame([(i, json.dumps(v, indent=rnd.choice([None, 1]))) for i, v in enumerate(values)], "i int, t string")
    got = {r[0]: json.loads(r[1]) for r in df.select("i", BF.render("t", raw_text=True)).collect()}
    assert [got[i] for i in range(len(values))] == [_dropped(v) for v in values]


def test_render_quotes_plain_text(spark):
    plain = ["abc", 'say "x"', "", "[1] Smith", "[1],[2]", "{x", "null", '[1]} junk {"x":1', "[1]] j [[2]", "5", '{"a":1} x']
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*plain, None])], "i int, t string")
    got = dict(map(tuple, df.select("i", BF.render("t", raw_text=True)).collect()))
    assert [json.loads(got[i]) for i in range(len(plain))] == plain
    assert got[len(plain)] is None


def test_one_json_value_is_told_in_one_pass(spark):
    one_value = {'{"a":1}': True, " [1, 2] ": True, '"x"': True, "1": True, '{"a":"\\u0041"}': True, '{"a":"__end_of_value"}': True,
                 "[]": True, "null": True, '{"a":[{"b":"]}"}]}': True,
                 '{"a":1}{"b":2}': False, '{"a":1},{"b":2}': False, '{"a":1}],[{"b":2}': False, '{"a":1}],[': False, "1],0]": False, '1},{"w":2': False,
                 '1,"w":2': False, '1,"__end_of_value":0} x': False, '1,"__end_of_value":0},{"v":1': False, '1,"__end_of_\\u0076alue":0}': False,
                 '{"a":1} x': False, '{"a":': False, "": False, " ": False, "x": False}
    assert one(spark, BJ.is_one_value("v"), [*one_value, None]) == [*one_value.values(), False]
