"""Dimension members and their keys."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.operators.lookup import lookup
from newsloom.operators.ordering import number_rows


def new_members(dim: DataFrame, names: DataFrame, key: str, name: str) -> DataFrame:
    """Names that the dimension lacks, numbered by name after its highest key."""
    fresh = (
        names.select(name).filter(F.col(name).isNotNull()).distinct()
        .join(dim.select(name), name, "left_anti")
    )
    highest = dim.agg(F.max(key)).first()[0] or 0
    return number_rows(fresh, [name], key, first=highest + 1).select(key, name)


def extended(dim: DataFrame, names: DataFrame, key: str, name: str) -> DataFrame:
    return dim.select(key, name).unionByName(new_members(dim, names, key, name))


def resolve_keys(rows: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Add the keys of the dimensions, given by their natural column in `rows`; unknown names get NULL."""
    for natural, dim in dims.items():
        rows = lookup(rows, dim, natural, "left")
    return rows
