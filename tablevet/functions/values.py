"""Kinds of columns, how their values are stored in fleet rows, and grouping keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Kind of a column: its type name, and the array of a fleet row that holds its values.
# u: whole numbers beyond 64 bits signed, d: decimals; both keep every digit as text.
DTYPES = {"i": "int", "u": "int", "b": "bool", "f": "float", "d": "float", "s": "string", "t": "datetime"}
STORES = {"i": "longs", "b": "longs", "f": "doubles", "u": "texts", "d": "texts", "s": "texts", "t": "texts"}
STORE_TYPES = {"longs": "bigint", "doubles": "double", "texts": "string"}
# Type of a column by kind, where none is declared.
DECLARED = {
    "i": "bigint", "u": "decimal(20,0)", "b": "boolean", "f": "double", "d": "double", "s": "string",
    "t": "timestamp_ntz",
}
NUMERIC_DTYPES = ["int", "float"]

INT_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
FLOAT_TYPES = (T.FloatType, T.DoubleType)
TIME_TYPES = (T.TimestampType, T.TimestampNTZType, T.DateType)


def kind_of(data_type: T.DataType) -> str | None:
    """Kind letter of a flat type; ``None`` for nested types, which are skipped."""
    if isinstance(data_type, INT_TYPES):
        return "i"
    if isinstance(data_type, FLOAT_TYPES):
        return "f"
    if isinstance(data_type, T.DecimalType):
        return "d"
    if isinstance(data_type, (T.StringType, T.CharType, T.VarcharType)):
        return "s"
    if isinstance(data_type, T.BooleanType):
        return "b"
    if isinstance(data_type, TIME_TYPES):
        return "t"
    return None


def declared_type(data_type: T.DataType) -> str:
    """The type that gives a stored value back as it was."""
    return "string" if kind_of(data_type) == "s" else data_type.simpleString()


def present(value: Column, data_type: T.DataType) -> Column:
    """The value with NaN as NULL and -0.0 as 0.0."""
    if isinstance(data_type, FLOAT_TYPES):
        return F.when(~F.isnan(value), value + F.lit(0.0).cast(data_type))
    return value


def stored_sql(name: str, data_type: T.DataType) -> str:
    """SQL of a column's value in the type of its store; equal exactly when the values are equal."""
    column = "`" + name.replace("`", "``") + "`"
    if isinstance(data_type, FLOAT_TYPES):
        return f"CASE WHEN NOT isnan({column}) THEN CAST({column} AS DOUBLE) + 0D END"
    return f"CAST({column} AS {STORE_TYPES[STORES[kind_of(data_type)]]})"


def missing_sql(name: str, data_type: T.DataType) -> str:
    """SQL that tells whether a column's stored value is missing, without making it."""
    column = "`" + name.replace("`", "``") + "`"
    return f"isnull({stored_sql(name, data_type) if isinstance(data_type, FLOAT_TYPES) else column})"


def value_key(text: Column) -> Column:
    """Grouping key of a text: long texts are keyed by their digest to keep shuffles narrow."""
    return F.when(F.octet_length(text) > 64, F.concat(F.lit("sha256:"), F.sha2(text, 256))).otherwise(
        text
    )


def target_sql(store: str | None, value: str) -> str:
    """SQL of the text by which a target's classes are counted; missing where the target is."""
    if store == "texts":
        return f"if(octet_length({value}) > 64, concat('sha256:', sha2({value}, 256)), {value})"
    if store == "doubles":
        return f"CAST({value} + 0D AS string)"
    return f"CAST({value} AS string)"


def as_text(kind: Column, value: Column) -> Column:
    """Text of a stored whole number or truth value."""
    return F.when(kind == "b", (value == 1).cast("string")).otherwise(value.cast("string"))


def fingerprint_sql(values: list[str], nulls: str, gaps: str, hashes: str, target: str) -> str:
    """SQL of two 64 bit hashes of a row, from both ends; ``nulls`` tells where NULLs are.

    Spark's hash skips NULLs, so their positions are hashed too. With 128 bits the odds that any
    two of 10^12 different rows agree are below 10^-14. Beside them, computed only where they are used:
    ``gaps`` has a ``1`` for each missing value and a ``0`` for others, NULL if none is missing,
    ``hashes`` has a number for each value, NULL where it is missing, and ``target`` is the target's class.
    """
    forth, back = ", ".join([*values, nulls]), ", ".join([nulls, *reversed(values)])
    return (
        f"named_struct('a', xxhash64({forth}), 'b', xxhash64({back}),"
        f" 'gaps', if(contains({gaps}, '1'), {gaps}, NULL), 'hashes', {hashes}, 'target', {target})"
        " AS fingerprint"
    )
