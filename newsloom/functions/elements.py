"""Elements of pages by selector, as Column expressions.

A page is split into tags and texts. A fold over the tags keeps the open elements, so an element ends at its own end tag or, if it
has none, where an element around it ends. Of every open element the fold knows how many steps of each selector
its ancestors and itself have met, so a start tag is told to match by looking at its parent only. What comes out are
the places of the matching elements among the page's tokens; their texts are read from there.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsloom.functions.html import TAG, decode_entities
from newsloom.functions.text import bound, trim_spaces

# Elements that never have an end tag, and those whose text is not page text.
VOID_TAGS = [
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr",
]
RAW_TAGS = ["script", "style", "template"]
# End of fixed values.

# At each `<` in the order of a tokenizer: comment, raw element as a whole, declaration, tag, cut-off tag; then text.
_TOKEN = (rf"(?is)<(?:!--.*?(?:-->|\z)|({'|'.join(RAW_TAGS)})\b[^>]*>.*?(?:</\1\s*>|\z)|(?:[!?]|/[^a-z>])[^>]*>|{TAG}|[^>]*\z)"
          r"|[^<]+")
_STEP = re.compile(r"^(?P<tag>[A-Za-z][A-Za-z0-9]*)?(?:\.(?P<cls>[\w\-]+))?$")
#: Type of a selector: its steps from the outer element to the inner, with '' for any tag and NULL for any class.
PATH_TYPE = "array<struct<tag:string,cls:string>>"


def selector_path(selector: str) -> list[tuple[str, str | None]]:
    """The `tag.class` steps of a selector."""
    path = []
    for step in selector.split():
        found = _STEP.match(step)
        if not found or not step:
            raise ValueError(f"selector step not supported: {step!r}")
        path.append(((found["tag"] or "").lower(), found["cls"]))
    if not path:
        raise ValueError("empty selector")
    return path


def path_column(selector: str) -> Column:
    """A selector as a literal of `PATH_TYPE`."""
    return F.array(*[
        F.struct(F.lit(tag).alias("tag"), F.lit(cls).cast("string").alias("cls")) for tag, cls in selector_path(selector)])


def page_tokens(html: Column) -> Column:
    """Tags, comments and texts of a page in their order; a `<` that begins none of them belongs to its text."""
    return F.regexp_extract_all(F.regexp_replace(html, "(?i)<(?![a-z/!?])", "&lt;"), F.lit(_TOKEN), F.lit(0))


def _is_markup(token: Column) -> Column:
    return F.startswith(token, F.lit("<"))


def attribute(token: Column, name: str) -> Column:
    """Value of a tag's attribute out of its quotes, entities decoded; `''` without it."""
    raw = F.regexp_extract(token, rf"""(?is)\s{name}\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", 1)

    def value(text: Column) -> Column:
        quoted = F.left(text, F.lit(1)).isin('"', "'")
        return F.when(quoted, F.substr(text, F.lit(2), F.length(text) - 2)).otherwise(text)

    return decode_entities(bound(raw, value))


def _tags(tokens: Column) -> Column:
    """The start and end tags among the tokens, with their places."""
    def tag(token: Column, at: Column) -> Column:
        name = F.lower(F.regexp_extract(token, r"^</?([A-Za-z][^\s/>]*)", 1))
        is_end = F.startswith(token, F.lit("</"))
        # A class is looked for only where there may be one.
        has_class = ~is_end & F.contains(F.lower(token), F.lit("class"))
        classes = F.when(has_class, F.split(F.btrim(F.regexp_replace(F.regexp_extract(
            token, r"""(?is)\sclass\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", 1), "[\"']", " ")), r"\s+")).otherwise(
            F.array().cast("array<string>"))
        return F.struct(at.alias("at"), name.alias("name"), is_end.alias("is_end"), F.endswith(token, F.lit("/>")).alias("is_closed"),
                        classes.alias("classes"))

    # A tag that the end of the page has cut off is none.
    told = F.transform(tokens, lambda token, at: F.when(_is_markup(token) & F.endswith(token, F.lit(">")), tag(token, at)))
    return F.filter(told, lambda t: t.isNotNull() & (t["name"] != "") & ~t["name"].isin(*RAW_TAGS))


def matches(tokens: Column, paths: Column) -> Column:
    """Elements that match the selectors `paths` (an array of `PATH_TYPE`), as `path`, `start`, `stop`, by their start.

    `start` and `stop` are the places of the start tag and of the token that ends the element, counted from 0.
    """
    none = F.array().cast("array<int>")
    start_state = F.struct(
        F.array().cast("array<string>").alias("names"),
        F.array(F.transform(paths, lambda _: F.lit(0))).alias("met"),
        F.array().cast("array<array<int>>").alias("ids"),
        F.array().cast("array<struct<path:int,at:int>>").alias("starts"),
        F.array().cast("array<struct<id:int,at:int>>").alias("ends"))

    def state(names: Column, met: Column, ids: Column, starts: Column, ends: Column) -> Column:
        return F.struct(names.alias("names"), met.alias("met"), ids.alias("ids"), starts.alias("starts"), ends.alias("ends"))

    def ended(ids: Column, at: Column) -> Column:
        return F.transform(ids, lambda i: F.struct(i.alias("id"), at.alias("at")))

    def begin(open_: Column, tag: Column) -> Column:
        def with_fits(parent: Column, fits: Column) -> Column:
            hit = F.filter(F.transform(fits, lambda fit, p: F.when(
                fit & (parent[p] == F.size(paths[p]) - 1), p)), lambda p: p.isNotNull())

            def with_hits(hits: Column) -> Column:
                first = F.size(open_["starts"])
                ids = F.transform(hits, lambda _, i: first + i)
                starts = F.when(F.size(hits) == 0, open_["starts"]).otherwise(F.concat(
                    open_["starts"], F.transform(hits, lambda p: F.struct(p.alias("path"), tag["at"].alias("at")))))
                met = F.transform(parent, lambda n, p: F.when(fits[p] & (n < F.size(paths[p]) - 1), n + 1).otherwise(n))
                stays_open = state(F.concat(open_["names"], F.array(tag["name"])), F.concat(open_["met"], F.array(met)),
                                   F.concat(open_["ids"], F.array(ids)), starts, open_["ends"])
                closed = state(open_["names"], open_["met"], open_["ids"], starts,
                               F.concat(open_["ends"], ended(ids, tag["at"])))
                return F.when(tag["is_closed"] | tag["name"].isin(*VOID_TAGS), closed).otherwise(stays_open)

            return bound(hit, with_hits)

        def with_parent(parent: Column) -> Column:
            def fits(path: Column, p: Column) -> Column:
                step = path[parent[p]]
                return ((step["tag"] == "") | (step["tag"] == tag["name"])) & (
                    step["cls"].isNull() | F.array_contains(tag["classes"], step["cls"]))

            return bound(F.transform(paths, fits), lambda all_fits: with_fits(parent, all_fits))

        return bound(F.element_at(open_["met"], -1), with_parent)

    def end(open_: Column, tag: Column) -> Column:
        def back_to(back: Column) -> Column:
            kept = F.size(open_["names"]) - back
            left = F.flatten(F.slice(open_["ids"], kept + 1, back))
            return F.when(back == 0, open_).otherwise(state(
                F.slice(open_["names"], F.lit(1), kept), F.slice(open_["met"], F.lit(1), kept + 1),
                F.slice(open_["ids"], F.lit(1), kept), open_["starts"], F.concat(open_["ends"], ended(left, tag["at"]))))

        return bound(F.array_position(F.reverse(open_["names"]), tag["name"]).cast("int"), back_to)

    def places(last: Column) -> Column:
        unclosed = F.flatten(F.concat(F.array(none), last["ids"]))
        ends = F.sort_array(F.concat(last["ends"], ended(unclosed, F.size(tokens))))
        return F.zip_with(last["starts"], ends, lambda s, e: F.struct(
            s["path"].alias("path"), s["at"].alias("start"), e["at"].alias("stop")))

    return F.aggregate(_tags(tokens), start_state, lambda open_, tag: F.when(tag["is_end"], end(open_, tag)).otherwise(
        begin(open_, tag)), places)


def of_path(found: Column, path: int) -> Column:
    return F.filter(found, lambda m: m["path"] == path)


def element_text(tokens: Column, element: Column, trim_pieces: bool = True) -> Column:
    """Text of one of the `matches`: its pieces, trimmed or as they are, put together without a separator."""
    inside = F.slice(tokens, element["start"] + 2, F.greatest(element["stop"] - element["start"] - 1, F.lit(0)))

    def piece(token: Column) -> Column:
        text = F.when(F.contains(token, F.lit("&")), decode_entities(token)).otherwise(token)
        return trim_spaces(text) if trim_pieces else text

    return F.array_join(F.transform(F.filter(inside, lambda t: ~_is_markup(t)), piece), "")


def element_attributes(tokens: Column, found: Column, name: str) -> Column:
    """The value of an attribute of each of the `matches`."""
    return F.transform(found, lambda m: attribute(F.get(tokens, m["start"]), name))
