"""Types of the landing layer: what is stored, and how columns widen."""

from __future__ import annotations

from pyspark.sql import types as T

#: How general a type is.
RANKS = {T.BooleanType: 0, T.LongType: 1, T.DateType: 1, T.TimestampType: 1, T.TimestampNTZType: 1, T.DoubleType: 2, T.StringType: 9}


def store_type(kind: T.DataType) -> T.DataType:
    """The landing type of an incoming one; nested types are refused."""
    if isinstance(kind, (T.ArrayType, T.StructType, T.MapType)):
        raise TypeError(f"columns of type {kind.simpleString()} cannot be stored")
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return T.LongType()
    if isinstance(kind, (T.FloatType, T.DoubleType, T.DecimalType)):
        return T.DoubleType()
    if isinstance(kind, (T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        return kind
    if isinstance(kind, (T.StringType, T.CharType, T.VarcharType, T.NullType)):
        return T.StringType()
    raise TypeError(f"columns of type {kind.simpleString()} cannot be stored")


def widened_type(existing: T.DataType, incoming: T.DataType) -> T.DataType | None:
    """The type a stored column must change to, or None if it can stay. Unlike types
    of one rank meet in text."""
    if existing == incoming:
        return None
    old, new = RANKS[type(existing)], RANKS[type(incoming)]
    if old == new:
        return T.StringType()
    return incoming if new > old else None
