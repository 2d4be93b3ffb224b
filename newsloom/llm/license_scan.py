"""License scan: TF-IDF cosine of headers and licence files to templates, then inheritance from directories.

A text's headers are its lines; a text that is mostly a licence is a licence file and speaks for its directory and all
below it. Weights are term frequency times inverse document frequency over all documents, of the templates' terms; any
other term counts as one that a single document has. A line can only reach the threshold if it holds one of a template's
heaviest terms: those that the rest of the template, by weight, cannot make up for. Only such lines are turned into
vectors, so the gate loses nothing.

A document without a licence of its own takes that of its nearest ancestor directory. Distinct directories are resolved
first, so the join over ancestors grows with directories, not with documents.

Only DataFrame operations are used; the templates' few terms and their counts are known to the driver.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.llm.texts import text_key, whole_text
from newsloom.session import materialize

#: Notices by licence, in the wording in which they are commonly found.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted "
                    "provided that the following conditions are met.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "all-rights-reserved": "All rights reserved.",
}
THRESHOLD = 0.8
#: Share of a text's terms in its best line from which the text is a licence file.
FILE_SHARE = 0.5

TERM = "[a-z0-9]+"


def terms(text: str) -> list[str]:
    return re.findall(TERM, text.lower())


def term_counts(docs: DataFrame, text_col: str, vocabulary: list[str]) -> tuple[int, dict[str, int]]:
    """Number of documents, and of those that have each term of a short list."""
    found = F.array_intersect(
        F.regexp_extract_all(F.lower(whole_text(F.col(text_col))), F.lit(TERM), F.lit(0)),
        F.array(*map(F.lit, vocabulary)))
    # The last entry counts the documents themselves.
    rows = docs.select(F.explode(F.concat(found, F.array(F.lit("")))).alias("term")).groupBy("term").count().collect()
    counts = {r["term"]: r["count"] for r in rows}
    return counts.pop("", 0), counts


def weights(n_docs: int, counts: dict[str, int], vocabulary: list[str]) -> dict[str, float]:
    """Inverse document frequency of each term; '' stands for any other term."""
    rarest = math.log((1 + n_docs) / 2) + 1
    return {"": rarest} | {t: math.log((1 + n_docs) / (1 + max(counts.get(t, 0), 1))) + 1 for t in vocabulary}


def vectors(templates: dict[str, str], weight: dict[str, float]) -> dict[str, dict[str, float]]:
    """Unit vectors of the templates."""
    made = {}
    for name, text in templates.items():
        plain = {t: n * weight[t] for t, n in Counter(terms(text)).items()}
        length = math.sqrt(sum(x * x for x in plain.values()))
        made[name] = {t: x / length for t, x in plain.items()}
    return made


def gate_terms(vector: dict[str, float], threshold: float) -> set[str]:
    """Terms of which a vector with this cosine or more must have one: all but those too light together."""
    kept, light = set(vector), 0.0
    for term, x in sorted(vector.items(), key=lambda item: item[1]):
        light += x * x
        if math.sqrt(light) >= threshold - 1e-9:
            break
        kept.discard(term)
    return kept


def own_licenses(docs: DataFrame, text_col: str, templates: dict[str, str], threshold: float) -> tuple[DataFrame, DataFrame]:
    """(rows, best): written rows with row, their columns but the text, key and path; and for rows with a licence line the
    best (row, license, score, line, share), share being how much of the text the line is."""
    vocabulary = sorted({t for text in templates.values() for t in terms(text)})
    weight = weights(*term_counts(docs, text_col, vocabulary), vocabulary)
    known = vectors(templates, weight)
    gate = "|".join(sorted(set().union(*(gate_terms(v, threshold) for v in known.values()))))
    gate = f"(^|[^a-z0-9])({gate})([^a-z0-9]|$)"

    text = whole_text(F.col(text_col))
    rows = docs.select(*[c for c in docs.columns if c != text_col], text_key(text).alias("key"), text.alias("text"))
    lines = F.filter(F.transform(F.split(F.lower("text"), "\n", -1), lambda l, i: F.struct(i.alias("line"), l.alias("said"))),
                     lambda x: x["said"].rlike(gate))
    rows = rows.withColumn("lines", F.transform(lines, lambda x: F.struct(
        x["line"].alias("line"), F.regexp_extract_all(x["said"], F.lit(TERM), F.lit(0)).alias("terms"))))
    rows = rows.withColumn("n_terms", F.when(F.size("lines") > 0, F.size(F.regexp_extract_all(
        F.lower("text"), F.lit(TERM), F.lit(0))))).drop("text").withColumn("row", F.monotonically_increasing_id())
    rows = materialize(rows, "license-lines")

    table = rows.sparkSession.createDataFrame(
        [(t, weight[t], [(name, v[t]) for name, v in known.items() if t in v]) for t in vocabulary],
        "term string, weight double, parts array<struct<license: string, x: double>>")
    in_lines = rows.select("row", "n_terms", F.explode("lines").alias("l")).select(
        "row", "n_terms", "l.line", F.size("l.terms").alias("n_line"), F.explode("l.terms").alias("term"))
    tf = in_lines.groupBy("row", "n_terms", "line", "n_line", "term").agg(F.count(F.lit(1)).alias("tf"))
    tf = tf.join(F.broadcast(table), "term", "left").withColumn(
        "x", F.col("tf") * F.coalesce("weight", F.lit(weight[""])))
    lengths = tf.groupBy("row", "line").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("length"))
    dots = tf.select("row", "n_terms", "line", "n_line", F.col("x").alias("own"), F.explode("parts").alias("p")) \
        .groupBy("row", "n_terms", "line", "n_line", "p.license").agg(F.sum(F.col("own") * F.col("p.x")).alias("dot"))
    scored = dots.join(lengths, ["row", "line"]).withColumn("score", F.round(F.col("dot") / F.col("length"), 9))
    scored = scored.filter(F.col("score") >= threshold)
    best = scored.groupBy("row").agg(F.max(F.struct(
        "score", (-F.col("line")).alias("back"), "license", (F.col("n_line") / F.col("n_terms")).alias("share"))).alias("b"))
    best = best.select("row", "b.license", "b.score", (-F.col("b.back")).alias("line"), "b.share")
    return rows.drop("lines", "n_terms"), materialize(best, "license-best")


def directory_of(path: str) -> Column:
    """The directory part of a path, empty at the top."""
    return F.regexp_replace(F.coalesce(F.col(path), F.lit("")), "/?[^/]*$", "")


def inherited(directories: DataFrame, licensed: DataFrame) -> DataFrame:
    """(dir, license, from_dir) of each directory that is, or lies below, one of `licensed` (dir, license): the nearest."""
    parts = F.split("dir", "/", -1)
    ups = directories.select("dir", F.explode(F.transform(
        F.sequence(F.lit(0), F.size(parts)), lambda n: F.struct(
            n.alias("depth"), F.array_join(F.slice(parts, F.lit(1), n), "/").alias("up")))).alias("a"))
    ups = ups.select("dir", "a.depth", F.col("a.up").alias("from_dir")).filter(
        (F.col("dir") != "") | (F.col("depth") == 0))
    met = ups.join(licensed.withColumnRenamed("dir", "from_dir"), "from_dir")
    return met.groupBy("dir").agg(F.max(F.struct("depth", "license", "from_dir")).alias("m")).select(
        "dir", "m.license", "m.from_dir")


def scan(docs: DataFrame, path_col: str = "path", text_col: str = "text", templates: dict[str, str] = TEMPLATES,
         threshold: float = THRESHOLD, file_share: float = FILE_SHARE) -> DataFrame:
    """One row for each row of `docs`: id columns as given but the text, and license, score, line, origin, from_dir.

    origin is `file` (a licence file), `header` (a licence line), `inherited` (from the directory from_dir) or null. Of a
    text's lines the most similar counts, then the first; of a directory's licence files the most similar, then the last by
    name. Null texts are empty; a null path lies at the top; repeated rows are judged each; an empty table gives no rows;
    columns of `docs` named like added ones are replaced.
    """
    added = ("license", "score", "line", "origin", "from_dir")
    plain = docs.select(F.struct(*[F.col(c) for c in docs.columns if c != text_col]).alias("given"),
                        F.col(path_col).alias("path"), F.col(text_col).alias("text"))
    rows, best = own_licenses(plain, "text", templates, threshold)
    rows = rows.select("row", "given", directory_of("path").alias("dir"))
    files = best.filter(F.col("share") >= file_share).join(rows.select("row", "dir"), "row")
    licensed = materialize(files.groupBy("dir").agg(F.max(F.struct("score", "license")).alias("m")).select(
        "dir", "m.license"), "license-directories")
    nearest = materialize(inherited(rows.select("dir").distinct(), licensed), "license-nearest")
    done = rows.join(best, "row", "left").join(
        nearest.select("dir", F.col("license").alias("dir_license"), F.col("from_dir").alias("nearest")), "dir", "left")
    own = F.col("license").isNotNull()
    origin = F.when(own & (F.col("share") >= file_share), "file").when(own, "header") \
        .when(F.col("dir_license").isNotNull(), "inherited")
    given = [c for c in docs.columns if c not in (text_col, *added)]
    return done.select(
        *[F.col(f"given.`{c}`") for c in given], F.coalesce("license", "dir_license").alias("license"), "score", "line",
        origin.alias("origin"), F.when(origin == "inherited", F.col("nearest")).alias("from_dir"))
