"""Casts from text and small string helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


# A whole number as dataframe tools write it in columns with gaps, such as 5.0.
WHOLE = r"^\s*([+-]?\d+)\.0*\s*$"
# No whole number holds a letter. A cast that fails costs ten times this test, and rejects are common.
LETTER = "[A-Za-z]"


def parsed(text: Column, data_type: T.DataType) -> Column:
    """The text as the type, else NULL. Whole numbers may have a fraction of zero."""
    value = text.try_cast(data_type)
    if isinstance(data_type, T.IntegralType):
        return F.when(~text.rlike(LETTER), F.coalesce(value, F.regexp_extract(text, WHOLE, 1).try_cast(data_type)))
    return value


def typed(name: str, data_type: T.DataType) -> Column:
    """The column cast to the type; text that does not parse becomes NULL."""
    return parsed(F.col(name), data_type).alias(name)


def rejected(name: str, data_type: T.DataType) -> Column:
    """True where text is present but does not parse as the type."""
    return F.col(name).isNotNull() & parsed(F.col(name), data_type).isNull()


def joined_words(*parts: Column) -> Column:
    return F.concat_ws(" ", *parts)


def capitalised(value: Column) -> Column:
    return F.initcap(value)
