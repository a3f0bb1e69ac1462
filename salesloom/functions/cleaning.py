"""Replace NaN and infinities by NULL at any depth of a schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesloom.functions.money import is_nonfinite


def _has_floats(data_type: T.DataType) -> bool:
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        return True
    if isinstance(data_type, T.ArrayType):
        return _has_floats(data_type.elementType)
    if isinstance(data_type, T.MapType):
        return _has_floats(data_type.valueType)
    if isinstance(data_type, T.StructType):
        return any(_has_floats(f.dataType) for f in data_type.fields)
    return False


def finite_or_null(value: Column, data_type: T.DataType) -> Column:
    """The value with every NaN or infinity inside it set to NULL; map keys are kept."""
    if not _has_floats(data_type):
        return value
    if isinstance(data_type, T.ArrayType):
        return F.transform(value, lambda x: finite_or_null(x, data_type.elementType))
    if isinstance(data_type, T.MapType):
        return F.transform_values(value, lambda _, x: finite_or_null(x, data_type.valueType))
    if isinstance(data_type, T.StructType):
        rebuilt = F.struct(
            *[
                finite_or_null(value.getField(f.name), f.dataType).alias(f.name)
                for f in data_type.fields
            ]
        )
        return F.when(value.isNotNull(), rebuilt)
    return F.when(~is_nonfinite(value), value)


def clean_nonfinite(df: DataFrame) -> DataFrame:
    """The same columns, with NaN and infinities as NULL. Untouched when no float is present."""
    fields = df.schema.fields
    if not any(_has_floats(f.dataType) for f in fields):
        return df
    # A join result may repeat a column name, so columns are addressed by position.
    by_position = df.toDF(*[f"_{i}" for i in range(len(fields))])
    return by_position.select(
        *[finite_or_null(F.col(f"_{i}"), f.dataType).alias(f.name) for i, f in enumerate(fields)]
    )
