"""Text expressions: folding, repairs of misread characters, number rendering. All of them stay in the JVM."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Letters that a scan takes for digits, and the digits they stand for.
MISREAD, DIGITS = "lIOoSsgG", "11005599"

# Dashes and spaces that count as the plain ones.
DASHES = "‐‑‒–—―−"
SPACES = "\n\r\t               　"


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once, however often it is used."""
    return F.get(F.transform(F.array(value), use), 0)


def _accented() -> dict[str, str]:
    """Each Latin letter that Unicode composes of a plain one and marks, with the plain one."""
    out = {}
    for code in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        first, *marks = unicodedata.normalize("NFD", chr(code))
        if marks and first.isascii() and all(unicodedata.category(m) == "Mn" for m in marks):
            out[chr(code)] = first
    return out


PLAIN_LETTERS = _accented()


def without_accents(text: Column) -> Column:
    """Composed letters without their accents, position by position."""
    return F.translate(text, "".join(PLAIN_LETTERS), "".join(PLAIN_LETTERS.values()))


def fold(text: Column) -> Column:
    """Lower case without accents, whether they are composed with their letters or marks of their own."""
    return F.regexp_replace(without_accents(F.lower(text)), r"\p{Mn}", "")


def folded(word: str) -> str:
    """What ``fold`` does, for a word at hand."""
    return "".join(c for c in map(lambda c: PLAIN_LETTERS.get(c, c), word.lower()) if unicodedata.category(c) != "Mn")


def plain_spaces(text: Column) -> Column:
    """Spaces and dashes of all kinds to the plain ones, position by position."""
    return F.translate(text, SPACES + DASHES, " " * len(SPACES) + "-" * len(DASHES))


def digits_only(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def read_digits(text: Column) -> Column:
    """Digits of a number, misread letters among them put right."""
    return digits_only(F.translate(text, MISREAD, DIGITS))


def was_misread(text: Column) -> Column:
    """Whether a letter that is taken for a digit stands next to a digit."""
    return text.rlike(f"[0-9][{MISREAD}]|[{MISREAD}][0-9]")


def with_thousands(number: Column) -> Column:
    """1234567 as 1.234.567."""
    return F.reverse(F.regexp_replace(F.reverse(number), "([0-9]{3})(?=[0-9])", "$1."))


def masked(number: Column) -> Column:
    """A case number under the mask NNNNNNN-DD.YYYY.J.TR.OOOO, filled from the right."""
    full = F.lpad(number, 20, "0")
    return F.concat(full.substr(1, 7), F.lit("-"), full.substr(8, 2), F.lit("."), full.substr(10, 4), F.lit("."), full.substr(14, 1), F.lit("."), full.substr(15, 2), F.lit("."), full.substr(17, 4))


def repair_groups(token: Column) -> Column:
    """Misread letters to digits, group by group between dots, dashes and spaces.

    A group changes if it has a digit, or if it is a single character and not the last group; a token without any
    digit stays as it is.
    """
    groups = F.split(token, "(?<=[.\\- ])(?![.\\- ])|(?<![.\\- ])(?=[.\\- ])")

    def content(x: Column) -> Column:
        return ~x.rlike("^[.\\- ]*$")

    last = F.aggregate(F.transform(groups, lambda x, i: F.when(content(x), i).otherwise(-1)), F.lit(-1), lambda a, b: F.greatest(a, b))
    fixed = F.transform(groups, lambda x, i: F.when(content(x) & (x.rlike("[0-9]") | ((F.length(x) == 1) & (i != last))), F.translate(x, MISREAD, DIGITS)).otherwise(x))
    return F.when(token.rlike("[0-9]"), F.array_join(fixed, "")).otherwise(token)


def collapse_number(text: Column) -> Column:
    """No spaces around dashes or within numbers, single dashes, and no dash beside a dot before a digit."""
    text = F.regexp_replace(text, r"\s*-\s*", "-")
    text = F.regexp_replace(text, r"(?<=[0-9]) +(?=[0-9.\-])|(?<=[0-9]\.) +(?=[0-9])", "")
    text = F.regexp_replace(text, r"-+\.(?=[0-9])|\.-+(?=[0-9])", ".")
    return F.regexp_replace(text, "-{2,}", "-")


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds since 1970 of a time without zone, whatever the session's zone."""
    days = F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("long")
    return days * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)
