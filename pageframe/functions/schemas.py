"""Output schemas: Spark schemas, DDL text, or a JSON record schema."""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import types as T

# Type names of a JSON record schema.
SIMPLE_TYPES: dict[str, T.DataType] = {
    "boolean": T.BooleanType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "bytes": T.BinaryType(),
    "string": T.StringType(),
}


def to_struct(schema: T.StructType | str | None) -> T.StructType | None:
    """A ``StructType`` from a Spark schema, its JSON text, DDL text or a JSON record schema."""
    if schema is None or isinstance(schema, T.StructType):
        return schema
    text = schema.strip()
    if not text:
        return None
    if not text.startswith("{"):
        return T.StructType.fromDDL(text)
    spec = json.loads(text)
    if spec.get("type") == "struct":
        return T.StructType.fromJson(spec)
    kind, _ = _from_record_schema(spec)
    if not isinstance(kind, T.StructType):
        raise ValueError("the output schema must be a record")
    return kind


def _from_record_schema(spec: Any) -> tuple[T.DataType, bool]:
    """Spark type and nullability of one JSON record schema node."""
    if isinstance(spec, str):
        return SIMPLE_TYPES[spec], False
    if isinstance(spec, list):
        branches = [s for s in spec if s != "null"]
        if len(branches) != 1:
            return T.VariantType(), "null" in spec  # a union of several types keeps its value as it is
        return _from_record_schema(branches[0])[0], "null" in spec
    kind = spec["type"]
    if kind == "record":
        fields = []
        for field in spec["fields"]:
            dtype, nullable = _from_record_schema(field["type"])
            fields.append(T.StructField(field["name"], dtype, nullable))
        return T.StructType(fields), False
    if kind == "array":
        dtype, nullable = _from_record_schema(spec["items"])
        return T.ArrayType(dtype, nullable), False
    if kind == "map":
        dtype, nullable = _from_record_schema(spec["values"])
        return T.MapType(T.StringType(), dtype, nullable), False
    return _from_record_schema(kind)


def as_nullable(dtype: T.DataType) -> T.DataType:
    """The same type with every nested value nullable (the checks are expressions, not metadata)."""
    if isinstance(dtype, T.StructType):
        return T.StructType([T.StructField(f.name, as_nullable(f.dataType), True) for f in dtype])
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(as_nullable(dtype.elementType), True)
    if isinstance(dtype, T.MapType):
        return T.MapType(dtype.keyType, as_nullable(dtype.valueType), True)
    return dtype
