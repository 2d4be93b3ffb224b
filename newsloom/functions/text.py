"""Text cleaning as Column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace as Unicode has it, with the four separator controls; the class is for patterns under (?U).
SPACE = r"[\s\x1c-\x1f]"
SPACES = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())
WORD = r"\p{L}\p{M}\p{N}_"

# The letters between which a missing space is restored. The lists are partial on purpose.
LOWER_LETTERS = "a-zàáạảãâăêôơưéèẻẽẹđỳỳỷỹ"
UPPER_LETTERS = "A-ZÀÁẠẢÃÂĂÊÔƠƯÉÈẺẼẸĐỲỶỸ"
# Characters cut from both ends of a text, next to whitespace; and the marks that may end one.
EDGE_MARKS = ".:;,-"
FINAL_MARKS = [".", "?", "!"]
CURLY_QUOTES = {"‘": "'", "’": "'", "“": '"', "”": '"'}
# End of fixed values.

# A token that is not a word: an ellipsis or a single mark. A point or comma between digits stays.
_MARK = rf"\.\.\.|[.,](?:(?![0-9])|(?<![0-9].))|[^{WORD}.,\s\x1c-\x1f]"
# Links and addresses hold marks. They begin where no word goes on, or right after another token.
_LINK = r"[A-Za-z][A-Za-z0-9+.\-]*://[^\s\x1c-\x1f]+"
_ADDRESS = r"[A-Za-z0-9_][A-Za-z0-9_.+\-]*@[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)+"
_COMPOUND = rf"(?:\G|(?<![{WORD}]))(?:{_LINK}|{_ADDRESS})"
MARK = f"(?U){_MARK}"
MARK_OR_COMPOUND = f"(?U){_COMPOUND}|{_MARK}"


def bound(c: Column, use: Callable[[Column], Column]) -> Column:
    """`use(c)` with `c` worked out once, however often it is used."""
    return F.get(F.transform(F.array(c), lambda value: use(value)), F.lit(0))


def collapse_spaces(c: Column) -> Column:
    return F.regexp_replace(c, f"(?U){SPACE}+", " ")


def trim_spaces(c: Column) -> Column:
    """Trim any Unicode whitespace; plain `trim` only knows the space character."""
    return F.btrim(c, F.lit(SPACES))


def normalize_spaces(c: Column) -> Column:
    return F.trim(collapse_spaces(c))


def text_or_empty(c: Column) -> Column:
    return F.coalesce(trim_spaces(c), F.lit(""))


def strip_edges(c: Column) -> Column:
    """Cut whitespace and stray punctuation from both ends."""
    return F.btrim(c, F.lit(SPACES + EDGE_MARKS))


def end_with_stop(c: Column) -> Column:
    def stopped(text: Column) -> Column:
        ends_well = F.right(text, F.lit(1)).isin(*FINAL_MARKS)
        return F.when((text == "") | ends_well, text).otherwise(F.concat(text, F.lit(".")))

    return bound(c, stopped)


def tidy_sentence(c: Column) -> Column:
    """Single spaces, clean edges and a final stop."""
    return end_with_stop(collapse_spaces(strip_edges(c)))


def straighten_quotes(c: Column) -> Column:
    for curly, straight in CURLY_QUOTES.items():
        c = F.replace(c, F.lit(curly), F.lit(straight))
    return c


def _spread_tokens(c: Column) -> Column:
    def spread(text: Column) -> Column:
        # Looking for links and addresses is slow, and few texts hold any.
        has_compound = F.contains(text, F.lit("://")) | F.contains(text, F.lit("@"))
        return F.when(has_compound, F.regexp_replace(text, MARK_OR_COMPOUND, " $0 ")).otherwise(
            F.regexp_replace(text, MARK, " $0 "))

    return F.replace(bound(c, spread), F.lit("_"), F.lit(" "))


def space_tokens(c: Column) -> Column:
    """Put one space between tokens; underscores count as spaces."""
    return normalize_spaces(_spread_tokens(c))


def split_case_boundary(c: Column) -> Column:
    """Part words that were glued together at a lower/upper case change.

    The tests for any upper and lower case letter are quick and spare the lists for most places.
    """
    return F.regexp_replace(
        c, rf"(?=\p{{Lu}})(?<=\p{{Ll}})(?<=[{LOWER_LETTERS}])(?=[{UPPER_LETTERS}])", " ")


def space_words(c: Column, fix_quotes: bool = False) -> Column:
    """Token and case spacing of one text; missing text gives `''`."""
    text = straighten_quotes(c) if fix_quotes else c
    return F.coalesce(normalize_spaces(split_case_boundary(_spread_tokens(text))), F.lit(""))


def clean_plain_text(c: Column, fix_quotes: bool = False) -> Column:
    """The cleaning chain for text without markup; the spacing of words brings single spaces."""
    return space_words(end_with_stop(strip_edges(c)), fix_quotes)
