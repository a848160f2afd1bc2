"""Type aliases of dataset descriptions and casts to them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Accepted type names and the Spark type each stands for.
TYPE_ALIASES = {
    "string": "string",
    "str": "string",
    "text": "string",
    "int": "int",
    "integer": "int",
    "bigint": "bigint",
    "long": "bigint",
    "float": "float",
    "double": "double",
    "boolean": "boolean",
    "bool": "boolean",
    "date": "date",
    "timestamp": "timestamp",
    "datetime": "timestamp",
    "array": "array<string>",
    "map": "map<string,string>",
}


def spark_type(alias: str) -> str:
    """Spark type of an alias; unknown names become string, a bare struct has no fields and is refused."""
    name = alias.strip().lower()
    if name == "struct":
        raise ValueError("a struct needs its fields; give them as 'struct<name: type>'")
    if name.startswith(("struct<", "array<", "map<", "decimal")):
        return name
    return TYPE_ALIASES.get(name, "string")


def cast_schema(df: DataFrame, schema: dict[str, str]) -> DataFrame:
    """Cast the described columns; values that do not fit become NULL, other columns stay."""
    def cast(name: str):
        if name not in schema:
            return F.col(name)
        return F.col(name).try_cast(spark_type(schema[name])).alias(name)

    return df.select(*[cast(c) for c in df.columns])
