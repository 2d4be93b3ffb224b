"""Filter URLs by a trie over reversed host labels and path segments.

A rule is a host and a path, such as `example.net` and `/en/`. The trie's first edges are the host's labels from the last
one on, then one mark, then the path's segments. An URL walks down as far as it gets, and the deepest rule on its way
decides. Rules are few beside URLs: up to `MAX_RULES` the trie is broadcast; a longer list is met by a join of every
URL's possible rules instead, with the same result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_RULES = 500_000
_HOST_END = object()
_RULE = object()


@dataclass(frozen=True)
class UrlRule:
    verdict: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """Between the first `://` and the next `/`, `?`, `#` or end, A-Z lower-cased; empty without `://` or for null."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host, up to `?`, `#` or end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def segments(path: str) -> list[str]:
    """A path in pieces that each keep the slash they end in: `/en/a` is `/`, `en/`, `a`."""
    return re.findall(r"[^/]*/|[^/]+", path)


def build_trie(rules: list[UrlRule]) -> dict:
    """Of rules with the same host and path, a block entry wins.

    Raises ValueError for a path that doesn't start and end in a slash.
    """
    root: dict = {}
    for rule in sorted(rules, key=lambda r: r.verdict == "block"):
        if not (rule.path.startswith("/") and rule.path.endswith("/")):
            raise ValueError(f"rule path must start and end in a slash: {rule.path!r}")
        node = root
        for step in [*reversed(rule.host.split(".")), _HOST_END, *segments(rule.path)]:
            node = node.setdefault(_key(step), {})
        node[""] = {"rule": (rule.name, rule.verdict)}
    return root


def _key(step: object) -> str:
    """Edges are strings, so that the trie can be shipped: labels have no slash, segments end in one."""
    return "//" if step is _HOST_END else str(step)


def longest_match(trie: dict, host: str, path: str) -> tuple[str, str] | None:
    """The rule whose host, then path, goes deepest."""
    best = None
    node: dict | None = trie
    for label in reversed(host.split(".")):
        node = node.get(label) if label else None
        if node is None:
            break
        inner = node.get("//")
        for segment in segments(path):
            inner = inner.get(segment) if inner else None
            if inner is None:
                break
            if "" in inner:
                best = inner[""]["rule"]
    return best


def _candidates(labels: str, parts: str) -> Column:
    """All rules an URL with these host labels and path segments could meet, as (depth, rule name)."""
    return F.expr(f"""flatten(transform(sequence(1, size({labels})), n -> transform(sequence(1, size({parts})),
        m -> struct(n AS labels, m AS segments,
                    concat(array_join(slice({labels}, size({labels}) - n + 1, n), '.'),
                           array_join(slice({parts}, 1, m), '')) AS name))))""")


def judge(urls: DataFrame, rules: list[UrlRule], url_col: str = "url", default: str = "allow",
          max_rules: int = MAX_RULES) -> DataFrame:
    """`urls` with host, path, rule (`host/path/`, null if none fits) and verdict (`default` if none fits).

    Null URLs and those without `://` have an empty host and path and meet no rule. Repeated rows are judged each; an
    empty table stays empty. Columns of `urls` named like the four added ones are replaced.
    """
    rows = urls.withColumns({"host": host_of(F.col(url_col)), "path": path_of(F.col(url_col))})
    if len(rules) > max_rules:
        return _judge_by_join(rows, rules, default)
    trie = urls.sparkSession.sparkContext.broadcast(build_trie(rules))

    @F.pandas_udf("struct<rule: string, verdict: string>")
    def match(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for hosts, paths in batches:
            found = [longest_match(trie.value, h, p) or (None, default) for h, p in zip(hosts, paths, strict=True)]
            yield pd.DataFrame(found, columns=["rule", "verdict"], dtype=object)

    found = rows.select(F.struct("*").alias("kept_row"), match("host", "path").alias("found"))
    return found.select(*[F.col(f"kept_row.`{c}`") for c in rows.columns if c.lower() not in ("rule", "verdict")],
                        "found.rule", "found.verdict")


def _judge_by_join(rows: DataFrame, rules: list[UrlRule], default: str) -> DataFrame:
    """Explode every URL's possible rules, meet the list by a join, keep the deepest."""
    build_trie(rules)
    table = rows.sparkSession.createDataFrame(
        [(r.name, r.verdict) for r in rules], "name string, verdict string").groupBy("name").agg(
        F.max("verdict").alias("_verdict"))  # block is after allow
    pairs = rows.select("host", "path").distinct().withColumns({
        "labels": F.split("host", "\\."), "parts": F.regexp_extract_all("path", F.lit("[^/]*/|[^/]+"), F.lit(0))})
    pairs = pairs.filter(F.size("parts") > 0).select("host", "path", F.explode(_candidates("labels", "parts")).alias("c"))
    pairs = pairs.join(table, F.col("c.name") == table["name"])
    deepest = Window.partitionBy("host", "path").orderBy(F.desc("c.labels"), F.desc("c.segments"))
    best = pairs.withColumn("_n", F.row_number().over(deepest)).filter("_n = 1").select(
        "host", "path", F.col("name").alias("rule"), F.col("_verdict").alias("verdict"))
    kept = [c for c in rows.columns if c.lower() not in ("rule", "verdict")]
    return rows.select(*kept).join(best, ["host", "path"], "left").withColumn(
        "verdict", F.coalesce("verdict", F.lit(default)))
