"""The comma-separated tag list of an article."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsloom.functions.text import trim_spaces


def has_tags(tags: Column) -> Column:
    return tags.isNotNull() & (tags != "")


def split_tags(tags: Column) -> Column:
    """Trimmed names in their order, repeated ones kept."""
    return F.transform(F.split(tags, ","), lambda name: trim_spaces(name))
