"""JSON helpers on VARIANT: one parse per line, typed leaves, order-free hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parse_once(df: DataFrame, text: str, into: str, objects_only: bool = False) -> DataFrame:
    """Add `into` = VARIANT of the JSON text, NULL for text that does not parse (or, on demand, is no object).

    Of a repeated key the last value counts, by a session setting of `use_utc`.

    The value goes through a one-element explode. Catalyst pushes a filter
    below a projection by copying its expression, which would parse each line
    twice; it does not push through a generator, so filters on leaves reuse
    the parsed value. The generator stays inside whole-stage codegen.

    Sizes of what follows are estimated with 2,048 bytes for a VARIANT, so that ids or hashes of parsed documents seem
    some fifty times smaller than they are. The hint holds for all that is taken from the frame up to its next join,
    union or store: it is sorted and merged there, never sent whole through the driver.
    """
    kept = [F.col(c) for c in df.columns if c != into]
    value = F.when(F.col(text).rlike(r"^\s*\{"), F.col(text)) if objects_only else F.col(text)
    return df.select(*kept, F.explode(F.array(F.try_parse_json(value))).alias(into)).hint("merge")


def leaf(variant: str | Column, path: str, sql_type: str) -> Column:
    """Typed value at a path; NULL when absent or not convertible."""
    return F.try_variant_get(variant, path, sql_type)


def leaf_json(variant: str | Column, path: str) -> Column:
    """Sub-document at a path as JSON text."""
    return F.to_json(F.try_variant_get(variant, path, "variant"))


def canonical_hash(variant: str | Column) -> Column:
    """MD5 of the document with sorted keys: spelling order does not matter."""
    return F.md5(F.to_json(variant))


# JSON types of VARIANT types; all others are numbers.
JSON_TYPES = {"VOID": "null", "STRING": "string", "BOOLEAN": "boolean", "OBJECT": "object", "ARRAY": "array"}


def json_type(value: str | Column) -> Column:
    """JSON type name of a VARIANT value; NULL when the value is absent. The value's type is asked for once."""
    names = F.create_map(*[F.lit(x) for pair in JSON_TYPES.items() for x in pair])
    kind = F.regexp_extract(F.schema_of_variant(value), "^[A-Z]*", 0)
    return F.transform(F.array(kind), lambda k: F.when(k.isNotNull(), F.coalesce(F.try_element_at(names, k), F.lit("number"))))[0]


def is_object(value: str | Column) -> Column:
    """True when the VARIANT value is a JSON object."""
    return F.coalesce(json_type(value) == "object", F.lit(False))
