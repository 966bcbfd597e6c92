"""Event properties as JSON text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StringType, StructType, VariantType


def is_json(text: Column) -> Column:
    """Whether the whole text is one JSON value.

    The parser alone ignores whatever follows the first value. Wrapping the text once in an
    object and once in an array closes that gap: text that leaves the object early breaks the
    array, and the array must end up with exactly one element.
    """
    in_object = F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}")))
    in_array = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    elements = F.size(F.try_variant_get(in_array, "$", "array<variant>"))
    return F.coalesce(in_object.isNotNull() & (elements == 1), F.lit(False))


def normalised_properties(df: DataFrame, name: str = "properties") -> Column:
    """Valid JSON text as it stands, objects as JSON text, everything else as `{}`."""
    empty = F.lit("{}")
    if name not in df.columns:
        return empty
    value, kind = F.col(name), df.schema[name].dataType
    if isinstance(kind, StringType):
        return F.when(is_json(value), value).otherwise(empty)
    if isinstance(kind, (StructType, MapType)):
        return F.coalesce(F.to_json(value, {"ignoreNullFields": "false"}), empty)
    if isinstance(kind, VariantType):
        kind_of = F.schema_of_variant(value)
        text = F.try_variant_get(value, "$", "string")
        return (
            F.when(kind_of.startswith("OBJECT"), F.to_json(value))
            .when((kind_of == "STRING") & is_json(text), text)
            .otherwise(empty)
        )
    return empty
