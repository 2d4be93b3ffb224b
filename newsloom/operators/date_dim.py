"""The date dimension."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions.nulls import tokens_to_null
from newsloom.schemas import DATE_DIM, DATE_POSITIONS

# The day with key 1, and the words for kinds of days.
FIRST_DAY = date(2005, 1, 1)
NO_HOLIDAY = "Non-Holiday"
HOLIDAY = "Holiday"
WEEKEND = "Weekend"
WEEKDAY = "Weekday"
# End of fixed values.

WIDE_COLUMNS = 20


def date_key(day: Column) -> Column:
    return F.datediff(day, F.lit(FIRST_DAY)) + 1


def calendar(bounds: DataFrame, holidays: DataFrame | None = None) -> DataFrame:
    """One row per day from `first_day` to `last_day` of the one row `bounds`.

    `holidays` (`full_date`, `holiday`) puts names to some days.
    """
    days = bounds.select(F.explode(F.sequence("first_day", "last_day")).alias("full_date"))
    if holidays is None:
        days = days.withColumn("holiday", F.lit(NO_HOLIDAY))
    else:
        days = days.join(holidays.select("full_date", "holiday"), "full_date", "left").withColumn(
            "holiday", F.coalesce("holiday", F.lit(NO_HOLIDAY)))
    day = F.col("full_date")
    return days.select(
        date_key(day).alias("date_key"),
        "full_date",
        F.date_format(day, "EEEE").alias("day_of_week"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.year(day).alias("year"),
        F.dayofmonth(day).alias("day_of_month"),
        "holiday",
        F.when(F.weekday(day) >= 5, WEEKEND).otherwise(WEEKDAY).alias("day_type"),
    )


def from_wide_rows(wide: DataFrame) -> DataFrame:
    """Pick the eight columns by position out of headerless rows, missing cells as NULL."""
    types = {f.name: f.dataType for f in DATE_DIM.fields}
    picked = wide.select(*[F.col(f"_c{at}").alias(name) for at, name in DATE_POSITIONS.items()])
    return tokens_to_null(picked).select(*[
        F.col(name).try_cast(types[name]).alias(name) for name in DATE_POSITIONS.values()
    ])


def to_wide_rows(dim: DataFrame) -> DataFrame:
    """The opposite: positions that the dimension does not use are blank."""
    return dim.select(*[
        (F.col(DATE_POSITIONS[at]).cast("string") if at in DATE_POSITIONS else F.lit("")).alias(f"_c{at}")
        for at in range(WIDE_COLUMNS)
    ])
