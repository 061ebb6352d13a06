"""Types that hold what two types hold, and the expression that brings a value into such a type.

Structs unite field by field, arrays and maps by what they hold. Numbers unite to a type that holds both exactly. What has
no common type but text becomes text: a scalar its usual form, a nested value JSON.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: whole numbers by the digits they may have
_DIGITS: dict[type, int] = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
_TEXT = T.StringType()


def unite(a: T.DataType, b: T.DataType) -> T.DataType:
    """The least type of the lattice that holds every value of both; text is its top."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return unite_structs(a, b)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(unite(a.elementType, b.elementType), True)
    if isinstance(a, T.MapType) and isinstance(b, T.MapType) and a.keyType == b.keyType:
        return T.MapType(a.keyType, unite(a.valueType, b.valueType), True)
    return _unite_numbers(a, b) or _unite_times(a, b) or _TEXT


def unite_structs(a: T.StructType, b: T.StructType) -> T.StructType:
    """The fields of ``a``, then those that only ``b`` has; a name is the same whatever its case."""
    theirs = {f.name.lower(): f for f in b.fields}
    out = []
    for f in a.fields:
        other = theirs.pop(f.name.lower(), None)
        kind = f.dataType if other is None else unite(f.dataType, other.dataType)
        out.append(T.StructField(f.name, kind, True, f.metadata))
    return T.StructType([*out, *[T.StructField(f.name, f.dataType, True, f.metadata) for f in theirs.values()]])


def _unite_numbers(a: T.DataType, b: T.DataType) -> T.DataType | None:
    if type(a) in _DIGITS and type(b) in _DIGITS:
        return max(a, b, key=lambda t: _DIGITS[type(t)])
    binary = (T.FloatType, T.DoubleType)
    if isinstance(a, binary) and isinstance(b, binary):
        return T.DoubleType()
    for x, y in ((a, b), (b, a)):
        if isinstance(x, binary) and type(y) in _DIGITS:
            exact = 7 if isinstance(x, T.FloatType) else 15
            if _DIGITS[type(y)] <= exact:
                return x
            return T.DoubleType() if _DIGITS[type(y)] <= 15 else None
    shapes = [_shape(t) for t in (a, b)]
    if None in shapes:
        return None
    whole, scale = (max(s[i] for s in shapes) for i in (0, 1))
    return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else None


def _shape(t: T.DataType) -> tuple[int, int] | None:
    """Digits before and after the point."""
    if isinstance(t, T.DecimalType):
        return t.precision - t.scale, t.scale
    return (_DIGITS[type(t)], 0) if type(t) in _DIGITS else None


def _unite_times(a: T.DataType, b: T.DataType) -> T.DataType | None:
    return T.TimestampNTZType() if {type(a), type(b)} == {T.DateType, T.TimestampNTZType} else None


def rebuild(value: Column, have: T.DataType, want: T.DataType) -> Column:
    """A value of one type in a type that holds it; fields that it lacks are NULL, and so stays a NULL struct."""
    if have == want:
        return value
    if isinstance(want, T.StructType) and isinstance(have, T.StructType):
        mine = {f.name.lower(): f for f in have.fields}
        fields = []
        for f in want.fields:
            own = mine.get(f.name.lower())
            part = F.lit(None).cast(f.dataType) if own is None else rebuild(value[own.name], own.dataType, f.dataType)
            fields.append(part.alias(f.name))
        return F.when(value.isNotNull(), F.struct(*fields)).cast(want)
    if isinstance(want, T.ArrayType) and isinstance(have, T.ArrayType):
        return F.transform(value, lambda v: rebuild(v, have.elementType, want.elementType))
    if isinstance(want, T.MapType) and isinstance(have, T.MapType):
        return F.transform_values(value, lambda _, v: rebuild(v, have.valueType, want.valueType))
    if isinstance(want, T.StringType) and isinstance(have, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(value)
    return value.cast(want)


def as_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The rows in a schema that holds them."""
    mine = {f.name.lower(): f for f in df.schema.fields}
    columns = []
    for f in schema.fields:
        own = mine.get(f.name.lower())
        value = F.lit(None).cast(f.dataType) if own is None else rebuild(df[f"`{own.name}`"], own.dataType, f.dataType)
        columns.append(value.alias(f.name, metadata=f.metadata))
    return df.select(*columns)
