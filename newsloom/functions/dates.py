"""Date texts to timestamps and back."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The formats of crawl times, of the daily article file and of the mart files.
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
DAY_FILE_FORMAT = "ddMMyy"
MART_FILE_FORMAT = "yyyyMMdd"
# End of fixed values.

PUBLISHED_FORMATS = [
    TIME_FORMAT,
    "yyyy-MM-dd HH:mm:ss.SSSSSS",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm",
    "d/M/yyyy H:mm",
    "d/M/yyyy, H:mm",
    "d/M/yyyy",
    "d-M-yyyy H:mm",
    "d-M-yyyy",
    "yyyy-MM-dd",
]

# A weekday in front, as in `Thứ hai, ` or `Thứ 2, `, and an offset behind, as in ` (GMT+7)`, `+07:00` or `Z`.
_WEEKDAY = r"^\p{L}[\p{L} ]*[2-7]?,\s*"
_OFFSET = r"(?<=[0-9])\s*\(?\s*(?:(?:GMT|UTC)\s*(?:([+-])([0-9]{1,2})(?::?([0-9]{2}))?)?|([+-])([0-9]{2}):?([0-9]{2})|Z)\s*\)?$"


def _shape(fmt: str) -> str:
    """Pattern of the texts that a format of digits and marks can read; quoted letters stand for themselves."""
    parts = re.split("'([^']*)'", fmt)
    shaped = [re.escape(p) if i % 2 else re.sub(r"([yMdHmsS])\1*", _digits, re.escape(p)) for i, p in enumerate(parts)]
    return f"^{''.join(shaped)}$"


def _digits(letters: re.Match) -> str:
    """One letter reads one digit or two, more read just as many."""
    n = len(letters[0])
    return "[0-9]{1,2}" if n == 1 else f"[0-9]{{{n}}}"


def parse_published(c: Column) -> Column:
    """A date as news pages print it: a weekday in front is passed over, an offset behind is applied."""
    return F.get(F.transform(F.array(F.regexp_replace(F.trim(c), _WEEKDAY, "")), _with_offset), F.lit(0))


def _with_offset(said: Column) -> Column:
    local = parse_time(F.regexp_replace(said, _OFFSET, ""))

    def part(number: int) -> Column:
        return F.regexp_extract(said, _OFFSET, number)

    sign = F.concat(part(1), part(4))
    hours, minutes = F.concat(part(2), part(5)), F.concat(part(3), part(6))
    offset = F.concat(F.when(sign == "", "+").otherwise(sign), F.lpad(hours, 2, "0"), F.lit(":"), F.lpad(minutes, 2, "0"))
    applied = F.try_to_timestamp(F.concat(F.date_format(local, TIME_FORMAT), offset), F.lit(TIME_FORMAT + "xxx"))
    # A time of day alone has an offset; `2024-01-31` ends in digits that look like one.
    return F.when(said.rlike("[0-9]{1,2}:[0-9]{2}.*" + _OFFSET.removeprefix("(?<=[0-9])")), applied).otherwise(
        parse_time(said))


def parse_time(c: Column, formats: Sequence[str] = PUBLISHED_FORMATS) -> Column:
    """Read by the format whose shape the text has; NULL when none fits.

    `c` is used once per format, so it should be a column and not a long expression.
    """
    parsed = F.lit(None).cast("timestamp")
    for fmt in reversed(formats):
        # Parsing a text of another shape would cost an exception each.
        parsed = F.when(c.rlike(_shape(fmt)), F.try_to_timestamp(c, F.lit(fmt))).otherwise(parsed)
    return parsed


def time_text(c: Column) -> Column:
    return F.date_format(c, TIME_FORMAT)
