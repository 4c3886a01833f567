"""JSON files whose shape changes: a schema from a sample, and a column for what does not fit it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

RESCUED = "_rescued"
#: Where a line that is no JSON object is kept.
WHOLE_LINE = "_line"
SAMPLE_LINES = 1000


def infer_schema(lines: DataFrame, sample_lines: int = SAMPLE_LINES) -> T.StructType:
    """Schema of JSON objects, one a line in ``lines(value)``, from the first ``sample_lines`` that are objects."""
    objects = lines.where(F.get_json_object("value", "$").startswith("{")).limit(sample_lines)
    sample = "[" + ",".join(r["value"] for r in objects.collect()) + "]"
    if sample == "[]":
        return T.StructType()
    ddl = lines.sparkSession.range(1).select(F.schema_of_json(F.lit(sample)).alias("ddl")).first()["ddl"]
    found = lines.sparkSession.range(0).select(F.from_json(F.lit("[]"), ddl).alias("rows")).schema["rows"].dataType
    return found.elementType


def merged_schema(saved: T.StructType | None, found: T.StructType) -> T.StructType:
    """The saved schema with the fields it lacks behind its own; fields it has keep their type.

    Structs are merged field by field, also within arrays.
    """
    def both(old: T.DataType, new: T.DataType) -> T.DataType:
        if isinstance(old, T.StructType) and isinstance(new, T.StructType):
            return merged_schema(old, new)
        if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
            return T.ArrayType(both(old.elementType, new.elementType))
        return old

    if saved is None:
        return found
    names = {f.name: f.dataType for f in found.fields}
    kept = [T.StructField(f.name, both(f.dataType, names.get(f.name, f.dataType))) for f in saved.fields]
    return T.StructType(kept + [f for f in found.fields if f.name not in saved.names])


def typed_and_rescued(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """``lines(value)`` as columns of ``schema`` and ``_rescued``.

    ``_rescued`` is a JSON object of the fields that are not in the schema or
    whose value does not come back from its type, each with its text; a line that
    is no object is kept whole.  It is null when all is in the columns.
    """
    typed = F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_none"})
    raw = F.from_json("value", "map<string,string>")
    parsed = lines.select("value", typed.alias("typed"), raw.alias("raw"))

    def lost(name: Column, text: Column) -> Column:
        tests = F.lit(True)
        for field in schema.fields:
            held = F.col("typed").getField(field.name)
            if isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType)):
                gone = held.isNull() | (F.to_json(held) != text)
            else:
                gone = held.isNull()
            tests = F.when(name == field.name, gone).otherwise(tests)
        return text.isNotNull() & tests

    broken = F.col("raw").isNull() & (F.trim("value") != "")
    rest = F.map_filter("raw", lost)
    rescued = F.when(broken, F.to_json(F.struct(F.col("value").alias(WHOLE_LINE)))).when(F.size(rest) > 0, F.to_json(rest))
    return parsed.select(*[F.col("typed").getField(f.name).alias(f.name) for f in schema.fields], rescued.alias(RESCUED))


def read_json_rescued(spark: SparkSession, path: str, saved: T.StructType | None = None,
                      sample_lines: int = SAMPLE_LINES) -> DataFrame:
    """JSON lines under the saved schema, widened by what a sample of these files adds to it.

    Only the sample decides about columns; every value of every line is in a
    column or in ``_rescued``, whatever the sample missed.
    """
    lines = spark.read.text(path)
    return typed_and_rescued(lines, merged_schema(saved, infer_schema(lines, sample_lines)))
