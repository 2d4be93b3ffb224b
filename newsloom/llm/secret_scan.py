r"""Secret scan over an incremental ledger of blobs.

Every version of every path is addressed by the SHA-256 of its text. A ledger holds which rule version has seen which
blob, so that only blobs and rule versions that have not met yet are scanned, each blob once however many paths and
versions share it. Findings belong to blobs and are joined back to all paths.

The places of a pattern's matches follow from the pieces between them: `split` and `regexp_extract_all` find the same
leftmost non-overlapping matches, so lengths of pieces and matches add up to starts and ends, in code points.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.llm.texts import small, whole_text
from newsloom.session import materialize


@dataclass(frozen=True)
class Rule:
    """A pattern of secrets. A match counts if its `group` has at least `least` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    version: int = 1

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(map(_either_case, ("password", "passwd", "secret", "token"))) \
    + "|" + _either_case("api") + "_?" + _either_case("key")

#: The base patterns. A least number in the pattern is the same as dropping shorter matches, as these two
#: match whole runs of their characters.
BASE_RULES = (
    Rule("assign", rf"({_NAMES})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", group=2, least=6),
    Rule("access", "AKIA[A-Z0-9]{16,}"),
    Rule("hex", "[0-9a-f]{24,}"),
)

#: Further kinds of secrets.
MORE_RULES = (
    Rule("private_key", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", "gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("url_login", r"[a-z][a-z0-9+.-]{1,20}://[^\x20\x09-\x0D/:@]{1,100}:[^\x20\x09-\x0D/:@]{1,100}@"),
)
RULES = BASE_RULES + MORE_RULES
KINDS = tuple(rule.kind for rule in RULES)

SPAN = "struct<start: int, rank: int, end: int, kind: string>"
NO_SPANS = f"CAST(array() AS array<{SPAN}>)"


#: Spans that are walked over in one go. Any number gives the same spans; this one keeps time near to linear in the hits.
AT_ONCE = 256


def _blocks(array: str) -> str:
    """Numbers of the stretches of `AT_ONCE` entries of an array that is not empty."""
    return f"sequence(0, CAST((size({array}) - 1) DIV {AT_ONCE} AS int))"


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _spans(rule: Rule, rank: int, text: str = "text") -> Column:
    """Places of the rule's matches in a text that has some."""
    pattern = _quoted(rule.pattern)
    hits = f"regexp_extract_all({text}, {pattern}, 0)"
    counted = hits if rule.group == 0 else f"regexp_extract_all({text}, {pattern}, {rule.group})"
    matches = f"zip_with({hits}, {counted}, (h, c) -> struct(length(h) AS size, length(c) >= {rule.least} AS counts))"
    parts = f"zip_with({matches}, split({text}, {pattern}, -1), " \
            "(m, p) -> struct(length(p) AS gap, m.size AS size, m.counts AS counts))"
    # The piece after the last match has no match beside it. The walk appends to lists of at most `AT_ONCE` spans, and
    # to the list of these lists, as a list is copied whenever it grows. `p` holds the parts, worked out once.
    walk = f"""transform(array(filter({parts}, x -> x.size IS NOT NULL)), p -> aggregate(
        {_blocks("p")},
        struct(0 AS at, CAST(array() AS array<array<{SPAN}>>) AS done),
        (s, b) -> aggregate(
            slice(p, b * {AT_ONCE} + 1, {AT_ONCE}),
            struct(s.at AS at, {NO_SPANS} AS spans),
            (t, x) -> struct(t.at + x.gap + x.size AS at, IF(x.counts, concat(t.spans, array(struct(
                t.at + x.gap AS start, {rank} AS rank, t.at + x.gap + x.size AS end, '{rule.kind}' AS kind))),
                t.spans) AS spans),
            t -> struct(t.at AS at, concat(s.done, array(t.spans)) AS done)),
        s -> flatten(s.done)))[0]"""
    return F.expr(f"IF({text} RLIKE {pattern}, {walk}, {NO_SPANS})")


def find_spans(text: str, rules: tuple[Rule, ...] = RULES, unseen: str | None = None) -> Column:
    """All spans of the rules (of those named in the array `unseen`, if given), by start, then kind as listed."""
    found = [_spans(rule, rank, text) if unseen is None else
             F.when(F.array_contains(unseen, rule.name), _spans(rule, rank, text)).otherwise(F.expr(NO_SPANS))
             for rank, rule in enumerate(rules)]
    return F.sort_array(F.flatten(F.array(*found)))


def blob_id(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)


def unseen_blobs(versions: DataFrame, ledger: DataFrame | None, rules: tuple[Rule, ...], text_col: str) -> DataFrame:
    """(blob, text, unseen): each blob once, with the names of the rule versions that have not seen it; none if all have."""
    text = whole_text(F.col(text_col))
    blobs = versions.select(text.alias("text")).select(blob_id(F.col("text")).alias("blob"), "text")
    everything = F.array(*[F.lit(rule.name) for rule in rules])
    # Copies are dropped in each task before the shuffle, so a text that fills a third of the table is no hot key.
    blobs = blobs.dropDuplicates(["blob"])
    if ledger is None:
        return blobs.withColumn("unseen", everything)
    seen = ledger.groupBy("blob").agg(F.collect_set("rule").alias("seen"))
    blobs = blobs.join(seen, "blob", "left").withColumn(
        "unseen", F.array_except(everything, F.coalesce("seen", F.array().cast("array<string>"))))
    return blobs.filter(F.size("unseen") > 0).select("blob", "text", "unseen")


def scan(versions: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES,
         text_col: str = "text") -> DataFrame:
    """Scan what `ledger` (blob, rule, spans) has not seen: its new rows, one for each blob and rule version.

    `spans` is the list of places, empty if the rule finds none. A null text is the empty blob.
    """
    found = unseen_blobs(versions, ledger, rules, text_col).select(
        "blob", "unseen", find_spans("text", rules, "unseen").alias("spans"))
    names = F.array(*[F.lit(rule.name) for rule in rules])
    return found.select("blob", "spans", F.explode("unseen").alias("rule")).select(
        "blob", "rule",
        F.filter("spans", lambda s: F.element_at(names, s["rank"] + 1) == F.col("rule")).alias("spans"))


def spans_of_blobs(ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(blob, spans): all places that the given rule versions found in each blob, in order."""
    current = ledger.filter(F.col("rule").isin(*[rule.name for rule in rules]) & (F.size("spans") > 0))
    return current.groupBy("blob").agg(F.sort_array(F.flatten(F.collect_list("spans"))).alias("spans"))


def findings(versions: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text",
             keep: list[str] | None = None) -> DataFrame:
    """One row for each row of `versions`: the columns of `keep` (all but the text by default), blob, spans.

    Repeated rows and copies all get their blob's spans; a blob without any gets an empty list. Columns of `versions`
    named like the two added ones are replaced.
    """
    kept = [c for c in versions.columns if c != text_col] if keep is None else keep
    kept = [c for c in kept if c.lower() not in ("blob", "spans")]
    paths = versions.select(*kept, blob_id(whole_text(F.col(text_col))).alias("blob"))
    # Written first, so that a blob with very many paths is split when it is joined.
    return paths.join(materialize(spans_of_blobs(ledger, rules), "secret-spans"), "blob", "left").withColumn(
        "spans", F.coalesce("spans", F.expr(NO_SPANS)))


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES,
           length_col: str | None = None) -> DataFrame:
    """`docs` with every finding in the text replaced by its kind in brackets; overlapping findings become one.

    All columns stay; `length_col`, if named, is set to the new length of changed texts. A null text stays null.
    """
    ledger = materialize(scan(docs, None, rules, text_col), "secret-ledger")
    dirty = materialize(spans_of_blobs(ledger, rules), "secret-spans")
    text = F.col(text_col)
    rows = docs.select(F.struct("*").alias("kept_row"), blob_id(whole_text(text)).alias("blob"))
    rows = rows.withColumn("mark", F.xxhash64("blob"))
    # Only rows that may have findings are moved to their spans; the others stay where they are.
    marks = materialize(dirty.select(F.xxhash64("blob").alias("mark")).distinct(), "secret-marks")
    found = rows.join(small(marks), "mark", "left_semi").join(dirty, "blob", "left")
    clean = rows.join(small(marks), "mark", "left_anti").withColumn("spans", F.lit(None).cast(dirty.schema["spans"].dataType))
    rows = found.unionByName(clean)
    # Walk over the spans, `AT_ONCE` in one go; `at` is where the text not yet copied begins. `piece` is the text up to
    # the last end of the stretch, so that no cut has to count from the beginning of a long text.
    text = f"kept_row.`{text_col}`"
    part = f"slice(spans, b * {AT_ONCE} + 1, {AT_ONCE})"
    masked = f"""aggregate({_blocks("spans")}, struct(0 AS at, CAST(array() AS array<string>) AS done),
        (s, b) -> transform(
            array(substring({text}, s.at + 1, greatest(0, array_max(transform({part}, x -> x.end)) - s.at))),
            piece -> aggregate({part}, struct(s.at AS at, '' AS made),
                (t, x) -> IF(x.start >= t.at,
                    struct(x.end AS at, concat(t.made, substring(piece, t.at - s.at + 1, x.start - t.at), '[', x.kind, ']')
                           AS made),
                    struct(greatest(t.at, x.end) AS at, t.made AS made)),
                t -> struct(t.at AS at, concat(s.done, array(t.made)) AS done)))[0],
        s -> concat(array_join(s.done, ''), substring({text}, s.at + 1)))"""
    new_text = F.when(F.size("spans") > 0, F.expr(masked)).otherwise(F.expr(text))
    rows = rows.select("kept_row", new_text.alias("new_text"), (F.size("spans") > 0).alias("changed"))
    new = {text_col: F.col("new_text")}
    if length_col:
        old = F.col(f"kept_row.`{length_col}`")
        new[length_col] = F.when(F.col("changed"), F.length("new_text").cast(docs.schema[length_col].dataType)).otherwise(old)
    return rows.select(*[new.get(c, F.col(f"kept_row.`{c}`")).alias(c) for c in docs.columns])
