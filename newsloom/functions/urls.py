"""Links and article keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.schemas import ARTICLE_ID


def normalize_url(url: Column, base_url: Column) -> Column:
    """Absolute form of a link found on a page of the site `base_url`."""
    return (
        F.when(F.startswith(url, F.lit("http")), url)
        .when(F.startswith(url, F.lit("//")), F.concat(F.lit("https:"), url))
        .when(F.startswith(url, F.lit("/")), F.concat(base_url, url))
        .otherwise(F.concat(base_url, F.lit("/"), url))
    )


def site_root(url: Column) -> Column:
    return F.regexp_extract(url, r"^([a-z]+://[^/?#]+)", 1)


def article_key(url: Column) -> Column:
    """Unsigned CRC-32 of the UTF-8 address. Not unique: `address_mark` goes with it."""
    return F.crc32(url)


def address_mark(url: Column) -> Column:
    """60 bits of the address's MD5, which tell addresses of one CRC apart."""
    return F.conv(F.left(F.md5(url), F.lit(15)), 16, 10).cast("bigint")


def with_article_id(rows: DataFrame) -> DataFrame:
    """Add the columns of `ARTICLE_ID` that are not there, by `article_url`."""
    makers = {"article_key": article_key, "address_mark": address_mark}
    return rows.withColumns({c: makers[c](F.col("article_url")) for c in ARTICLE_ID if c not in rows.columns})


def row_mark(*columns: str) -> Column:
    """Digest of a row's columns, NULLs told apart from blanks, to see whether a row has changed."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)
