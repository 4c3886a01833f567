"""JSON whose shape changes: no value is lost, whatever the sample saw."""

import json

from conftest import rows
from pyspark.sql import types as T

from smeltery.sources import rescue


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def held(row):
    """Every top-level field of a line, from its column or from the rescued ones."""
    got = {k: v for k, v in row.asDict(recursive=True).items() if k != rescue.RESCUED and v is not None}
    for name, text in json.loads(row[rescue.RESCUED] or "{}").items():
        got[name] = text
    return got


def test_two_shapes_lose_nothing(spark, folder):
    first = ['{"id": 1, "price": 1.5, "who": {"name": "a"}}', '{"id": 2, "price": 2.0, "who": {"name": "b"}}']
    second = ['{"id": "x7", "price": "free", "who": {"name": "c", "age": 3}, "new": [1, 2]}',
              '{"id": 9, "who": "nobody", "rare": {"deep": {"er": 1}}}', "[1, 2]", "no json", "", '{"id": null, "price": 3}']
    for i, batch in enumerate((first, second)):
        lines(spark, *batch).coalesce(1).write.text(f"{folder}/{i}")
    a = rescue.read_json_rescued(spark, f"{folder}/0")
    assert a.schema.simpleString() == "struct<id:bigint,price:double,who:struct<name:string>,_rescued:string>"
    assert {r[rescue.RESCUED] for r in a.collect()} == {None}
    saved = T.StructType([f for f in a.schema.fields if f.name != rescue.RESCUED])
    b = rescue.read_json_rescued(spark, f"{folder}/1", saved, sample_lines=1)
    assert b.columns == ["id", "price", "who", "new", "_rescued"]
    by_line = [held(r) for r in b.collect()]
    assert {"id": "x7", "price": "free", "who": {"name": "c", "age": 3}, "new": [1, 2]} in by_line
    assert {"id": 9, "who": "nobody", "rare": '{"deep":{"er":1}}'} in by_line
    assert {"_line": "no json"} in by_line and {"_line": "[1, 2]"} in by_line and {"price": 3.0} in by_line


def test_saved_types_stay_and_structs_grow(spark):
    old = T.StructType.fromDDL("k int, s struct<a: int>, l array<struct<x: int>>")
    new = T.StructType.fromDDL("k string, s struct<a: string, b: int>, l array<struct<y: int>>, n double")
    assert rescue.merged_schema(old, new) == T.StructType.fromDDL(
        "k int, s struct<a: int, b: int>, l array<struct<x: int, y: int>>, n double")
    assert rescue.merged_schema(None, new) == new
    assert rescue.infer_schema(lines(spark, "x", "", "[1]")) == T.StructType()


def test_all_goes_to_the_rescue_without_a_schema(spark):
    got = rescue.typed_and_rescued(lines(spark, '{"a": 1, "b": null}', "{}"), T.StructType())
    assert rows(got) == [(None,), ('{"a":"1"}',)]
