"""Schema drift against hand-made records."""

from pyspark.sql import types as T

from bibflow.operators.drift import schema_drift

SCHEMA = T.StructType([T.StructField("a", T.StringType()), T.StructField("n", T.LongType()),
                       T.StructField("o", T.StructType([T.StructField("x", T.StringType())]))])


def test_new_changed_and_absent_fields(spark):
    rows = [(2001, '{"a":1,"n":2,"o":{"x":"t","y":[1]}}'), (2001, '{"a":"s","n":"2","extra":{"k":1}}'), (2001, '{"n":null}'),
            (2002, '{"o":"text","it\'s":true}'), (2002, "[1]"), (2002, "{bad"), (2002, None), (None, '{"a":null,"n":1.5,"o":{}}'), (None, '{"a":null}')]
    got = sorted(tuple(r) for r in schema_drift(spark.createDataFrame(rows, "year int, record string"), "record", SCHEMA, "year")
                 .fillna(-1, ["group"]).fillna("-", ["kind"]).collect())
    a, n, o, x = "$['a']", "$['n']", "$['o']", "$['o']['x']"
    assert got == sorted([
        (2001, a, "number", 1, "declared"), (2001, a, "string", 1, "declared"), (2001, n, "number", 1, "declared"),
        (2001, n, "string", 1, "changed"), (2001, n, "null", 1, "declared"), (2001, o, "object", 1, "declared"),
        (2001, x, "string", 1, "declared"), (2001, "$['o']['y']", "array", 1, "new"), (2001, "$['extra']", "object", 1, "new"),
        (2002, o, "string", 1, "changed"), (2002, "$['it's']", "boolean", 1, "new"), (2002, "$", "array", 1, "new"),
        (2002, "$", "malformed", 2, "new"), (2002, a, "-", 0, "absent"), (2002, n, "-", 0, "absent"), (2002, x, "-", 0, "absent"),
        (-1, a, "null", 2, "declared"), (-1, n, "number", 1, "declared"), (-1, o, "object", 1, "declared"), (-1, x, "-", 0, "absent")])
    assert schema_drift(spark.createDataFrame([], "year int, record string"), "record", SCHEMA, "year").count() == 0
