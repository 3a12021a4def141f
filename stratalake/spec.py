"""Column specifications.

A schema specification is a dictionary::

    {"strict_validation": True,
     "columns": [{"name": "quantity", "type": "integer", "nullable": False,
                  "constraints": {"min": 1}},
                 {"name": "signup_date", "type": "date", "format": "yyyy-MM-dd"},
                 {"name": "email", "type": "string", "pattern": "..."},
                 {"name": "is_active", "type": "boolean", "nullable": False, "default": True}]}

Every column key but ``name`` is optional; ``type`` defaults to string, ``nullable`` to true.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Actual types that a declared type accepts besides itself.
ALSO_ACCEPTED: dict[type, tuple[type, ...]] = {
    T.StringType: (T.VarcharType, T.CharType),
    T.IntegerType: (T.ShortType,),
    T.DoubleType: (T.FloatType,),
    T.TimestampType: (T.TimestampNTZType,),
}


class SpecError(ValueError):
    """A specification that contradicts itself."""


def quoted(name: str) -> Column:
    """The top-level column of exactly this name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def columns_of(schema: dict[str, Any]) -> list[dict[str, Any]]:
    """The declared columns, checked for repeated names and empty value ranges."""
    columns = list(schema.get("columns", []))
    names = [c["name"] for c in columns]
    repeated = sorted({n for n in names if names.count(n) > 1})
    if repeated:
        raise SpecError(f"columns declared more than once: {repeated}")
    for c in columns:
        check_bounds(c["name"], c.get("constraints", {}))
    return columns


def check_bounds(name: str, bounds: dict[str, Any]) -> None:
    low, high = bounds.get("min"), bounds.get("max")
    if low is not None and high is not None and low > high:
        raise SpecError(f"{name}: min {low} is above max {high}")


def declared_type(column: dict[str, Any]) -> T.DataType:
    """The Spark type of a declared column; ``integer`` and ``int`` are one type."""
    return T.DataType.fromDDL(column.get("type", "string"))


def struct_type(schema: dict[str, Any]) -> T.StructType:
    return T.StructType(
        [
            T.StructField(c["name"], declared_type(c), c.get("nullable", True))
            for c in columns_of(schema)
        ]
    )


def string_struct(names: list[str]) -> T.StructType:
    """All columns as nullable strings: how untyped sources are read."""
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def is_compatible(actual: T.DataType, expected: T.DataType) -> bool:
    """Does a column of type ``actual`` satisfy a declaration of ``expected``?"""
    if isinstance(expected, T.DecimalType):
        return isinstance(actual, T.DecimalType)
    return actual == expected or isinstance(actual, ALSO_ACCEPTED.get(type(expected), ()))
