"""HTML to text as Column expressions."""

from __future__ import annotations

import html as html_std
import json
from html.entities import html5, name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsloom.functions.text import clean_plain_text
from newsloom.schemas import NOT_FOUND

# Player texts that are cut out before parsing, in this order.
PLAYER_TEXTS = [
    "Video Player.*?End of dialog window",
    "This is a modal window.*?End of dialog window",
]
# Elements dropped with all they hold. The void ones hold nothing and go with the other tags.
DROPPED_ELEMENTS = ["script", "style", "iframe", "video", "button", "noscript", "source", "meta", "link"]
# End of fixed values.

VOID_ELEMENTS = ["source", "meta", "link"]

# Elements whose body is raw text up to the end tag, or to the end of the page if that is missing.
RAW_TEXT_ELEMENTS = ["script", "style"]

_COMMENT = r"!--.*?(?:-->|\z)"
_DECLARATION = r"[!?][^>]*>"
# A tag whose quoted attributes may hold `>`; or, for broken quoting, anything up to the next `>`.
TAG = r"""/?[a-z][^>"']*+(?:"[^"]*+"[^>"']*+|'[^']*+'[^>"']*+)*+>|/?[a-z][^>]*>"""


def _element(names: list[str], group: int, or_end: bool) -> str:
    end = rf"(?:</\{group}\s*>|\z)" if or_end else rf"</\{group}\s*>"
    return rf"({'|'.join(names)})\b[^>]*>.*?{end}"


# Whatever is not text, tried at each `<` in the order that a tokenizer would: what lies
# inside a script is not a comment or a tag.
MARKUP = (
    f"(?is)<(?:{_COMMENT}|{_DECLARATION}|{_element(RAW_TEXT_ELEMENTS, 1, True)}"
    f"|{_element([e for e in DROPPED_ELEMENTS if e not in RAW_TEXT_ELEMENTS + VOID_ELEMENTS], 2, False)}|{TAG})"
)

# What may follow an ampersand, at the start of a piece.
REFERENCE = r"^(#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*)"


def drop_player_texts(c: Column) -> Column:
    for pattern in PLAYER_TEXTS:
        c = F.regexp_replace(c, f"(?is){pattern}", " ")
    return c


def _constant_map(table: dict[str, str]) -> Column:
    """A map that the optimizer folds into one literal."""
    return F.from_json(F.lit(json.dumps(table)), "map<string,string>")


def _entity_text(name: Column) -> Column:
    """Text of a named entity by the standard library's table, NULL for other names.

    A map is searched from its start, so the frequent names have a map of their own.
    """
    table = {n.rstrip(";"): text for n, text in html5.items()}
    frequent = ["amp", "lt", "gt", "quot", "nbsp", "apos", *name2codepoint]
    return F.coalesce(
        F.try_element_at(_constant_map({n: table[n] for n in frequent}), name),
        F.try_element_at(_constant_map(table), name),
    )


def _code_point_text(point: Column) -> Column:
    """Text of a numeric reference; the range 128-159 means Windows-1252, as browsers have it."""
    shifted = _constant_map({str(n): html_std.unescape(f"&#{n};") for n in range(128, 160)})
    usable = point.between(1, 0x10FFFF) & ~point.between(0xD800, 0xDFFF)
    utf32 = F.unhex(F.lpad(F.hex(point), 8, "0"))
    return (
        F.when(point.between(128, 159), F.try_element_at(shifted, point.cast("string")))
        .when(usable, F.decode(utf32, "UTF-32"))
        .otherwise(F.lit("\ufffd"))
    )


def decode_entities(c: Column) -> Column:
    """Named and numeric character references to characters, each once; unknown names stay."""
    def decode_start(piece: Column) -> Column:
        """A piece after an ampersand: its reference as text, then the rest."""
        body = F.regexp_extract(piece, REFERENCE, 1)
        number = F.regexp_replace(body, "^#[xX]?0*(?=.)", "")
        # Eight digits without leading zeros are beyond the last code point in either notation.
        point = F.when(F.length(number) > 7, F.lit(0x110000).cast("bigint")).when(
            F.lower(F.substring(body, 1, 2)) == "#x", F.conv(number, 16, 10).try_cast("bigint")
        ).otherwise(number.try_cast("bigint"))
        char = F.when(F.startswith(body, F.lit("#")), _code_point_text(point)).otherwise(_entity_text(body))
        rest = F.substr(piece, F.length(body) + 1)
        rest = F.when(F.startswith(rest, F.lit(";")), F.substr(rest, F.lit(2))).otherwise(rest)
        return F.when(body == "", F.lit(None)).otherwise(F.concat(char, rest))

    pieces = F.transform(
        F.split(c, "&", -1),
        lambda piece, i: F.when(i == 0, piece).otherwise(
            F.coalesce(decode_start(piece), F.concat(F.lit("&"), piece))),
    )
    return F.array_join(pieces, "")


def drop_markup(c: Column, put: str = " ") -> Column:
    """Unwanted elements with all they hold, comments and tags go."""
    return F.regexp_replace(c, MARKUP, put)


def html_to_text(c: Column) -> Column:
    """Visible text, with entities decoded."""
    return decode_entities(drop_markup(c))


def clean_content(c: Column, fix_quotes: bool = False) -> Column:
    """The whole cleaning chain from raw article HTML to spaced text; NULL gives `''`."""
    return clean_plain_text(html_to_text(drop_player_texts(c)), fix_quotes)


def joined_or_default(texts: Column, separator: str = "\n", default: str = NOT_FOUND) -> Column:
    return F.when(F.size(texts) > 0, F.array_join(texts, separator)).otherwise(F.lit(default))
