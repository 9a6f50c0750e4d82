"""Text and number expressions with the null and rounding rules the datasets rely on."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

GEOID_PREFIX_LENGTH = 9


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def glue(*parts: Column | str, sep: str = "") -> Column:
    """Concatenate; null as soon as one part is null."""
    columns = [_col(p) for p in parts]
    if not sep:
        return F.concat(*columns)
    spaced = [columns[0]]
    for column in columns[1:]:
        spaced += [F.lit(sep), column]
    return F.concat(*spaced)


def unite(*parts: Column | str, sep: str) -> Column:
    """Concatenate; a missing part is written as the text ``NA``."""
    return F.concat_ws(sep, *[F.coalesce(_col(p).cast("string"), F.lit("NA")) for p in parts])


def first_match(cases: Iterable[tuple[Column, Column | str]], default: Column | str | None = None) -> Column:
    """Value of the first case whose condition is true; a null condition falls through."""
    def lift(value):
        return value if isinstance(value, Column) else F.lit(value)

    cases = list(cases)
    chain = reduce(lambda acc, case: acc.when(case[0], lift(case[1])), cases[1:],
                   F.when(cases[0][0], lift(cases[0][1])))
    return chain.otherwise(lift(default))


def drop_first(c: Column | str, pattern: str) -> Column:
    """Remove only the first match of ``pattern``: split there once and close the gap."""
    return F.array_join(F.split(_col(c), f"(?U){pattern}", 2), "")


def drop_first_word(c: Column | str, word: str) -> Column:
    return drop_first(c, rf"\b{word}\b")


def squeeze_spaces(c: Column | str) -> Column:
    """Runs of two or more whitespace characters become one space."""
    return F.regexp_replace(_col(c), r"(?U)\s{2,}", " ")


def trim_all(c: Column | str) -> Column:
    """Trim any Unicode whitespace, tabs and non-breaking spaces included."""
    return F.regexp_replace(_col(c), r"(?U)^\s+|\s+$", "")


def pad_left(c: Column | str, width: int, fill: str = "0") -> Column:
    """Pad to ``width``; longer text stays as it is (``lpad`` alone would cut it)."""
    c = _col(c)
    return F.when(F.length(c) >= width, c).otherwise(F.lpad(c, width, fill))


def pad_right(c: Column | str, width: int, fill: str = "0") -> Column:
    c = _col(c)
    return F.when(F.length(c) >= width, c).otherwise(F.rpad(c, width, fill))


def geoid_prefix(c: Column | str) -> Column:
    """The leading nine digits, null where the text does not start with nine digits."""
    return F.regexp_substr(_col(c), F.lit(f"^[0-9]{{{GEOID_PREFIX_LENGTH}}}"))


def text_to_int(c: Column | str) -> Column:
    """Integer, or null for text that is not one."""
    return _col(c).try_cast("int")


def text_to_double(c: Column | str) -> Column:
    return _col(c).try_cast("double")


def number_in_text(c: Column | str) -> Column:
    """First number inside the text, grouping commas ignored: ``+32.47`` → 32.47, ``-086.49`` → -86.49."""
    digits = F.regexp_substr(_col(c), F.lit(r"-?[0-9][0-9,]*(\.[0-9]+)?"))
    return F.replace(digits, F.lit(","), F.lit("")).try_cast("double")


def round_even(c: Column | str, digits: int = 0) -> Column:
    """Round half to even."""
    return F.bround(_col(c), digits)


def missing(c: Column | str, is_floating: bool = False) -> Column:
    """True for null, and for NaN in floating columns."""
    c = _col(c)
    return c.isNull() | F.isnan(c) if is_floating else c.isNull()


def rate_message(matched: Column, total: Column, what: str) -> Column:
    """``1,234 of 2,000 <what>: 62%``."""
    percent = F.bround(matched * 100 / F.nullif(total, F.lit(0)), 0).cast("int")
    return F.concat(
        F.format_number(matched, 0), F.lit(" of "), F.format_number(total, 0),
        F.lit(f" {what}: "), percent.cast("string"), F.lit("%"),
    )
