"""Missing values: tokens, blanks and NaN."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.schemas import NULL_TOKENS


def null_tokens(c: Column) -> Column:
    return F.when(~c.isin(*NULL_TOKENS), c)


def tokens_to_null(df: DataFrame) -> DataFrame:
    """Read the NULL tokens in every text column as NULL; NaN in float columns too."""
    return df.select(*[_missing_to_null(f).alias(f.name) for f in df.schema.fields])


def _missing_to_null(field: T.StructField) -> Column:
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.StringType):
        return null_tokens(c)
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(c), c)
    return c


def blank_for_null(df: DataFrame) -> DataFrame:
    """Keep blanks and tokens as text: the mart reading."""
    return df.select(*[
        F.coalesce(F.col(f"`{f.name}`"), F.lit("")).alias(f.name)
        if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


def column_or_blank(df: DataFrame, name: str) -> Column:
    """A column by name, `''` where the column or its value is missing."""
    return F.coalesce(F.col(f"`{name}`"), F.lit("")) if name in df.columns else F.lit("")
