"""Text predicates on cells and raw lines."""

from __future__ import annotations

import fnmatch
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Cell contents that mean "no value", per operator family.
LOAD_NULLS = ("", "NULL", "null", "\\N")
SAMPLER_NULLS = ("", "NULL", "NONE", "NA")
MISMATCH_NULLS = ("", "NULL", "\\N", "NA")

# Separators that are tried, in order of preference on ties.
DELIMITERS = (",", "\t", "|", ";", ":")

NUMBER = r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?$|^[+-]?(?i:inf|infinity|nan)$"
CONTROL_BYTES = r"[\x00-\x08\x0B\x0C\x0E-\x1F]"
NULL_BYTE = "\u0000"
_MARK = "\u0001"


def is_null_token(value: Column, tokens=LOAD_NULLS, any_case: bool = False) -> Column:
    """True for missing cells and for cells holding a null token."""
    probe = F.upper(value) if any_case else value
    wanted = sorted({t.upper() for t in tokens}) if any_case else list(tokens)
    return F.coalesce(probe.isin(*wanted), F.lit(True))


def null_if(value: Column, tokens=LOAD_NULLS, any_case: bool = False) -> Column:
    return F.when(~is_null_token(value, tokens, any_case), value)


def strip(value: Column) -> Column:
    """Remove white space of any kind at both ends."""
    return F.btrim(value, F.lit(" \t\r\n\u000b\f"))


def occurrences(value: Column, piece: str | Column) -> Column:
    """How often a one-byte piece occurs, counted in bytes: no character is decoded."""
    piece = F.lit(piece) if isinstance(piece, str) else piece
    return F.octet_length(value) - F.octet_length(F.replace(value, piece, F.lit("")))


def fields(value: Column, delimiter: str, quote: str | None = None) -> Column:
    """Split a line; separators inside quotes do not count when a quote is given."""
    plain = F.split(value, re.escape(delimiter), -1)
    if not quote:
        return plain
    # Pieces between quotes lie inside and outside by turns. Separators of the inner ones are masked
    # by a mark that is doubled up wherever the line holds it, so every line comes back as it was.
    own, masked = _MARK + "a", _MARK + "b"
    swap = lambda v, old, new: F.replace(v, F.lit(old), F.lit(new))
    pieces = quote_pieces(swap(value, _MARK, own), quote)
    hidden = F.transform(pieces, lambda p, i: F.when(i % 2 == 1, swap(p, delimiter, masked)).otherwise(p))
    cells = F.transform(
        F.split(F.array_join(hidden, quote), re.escape(delimiter), -1),
        lambda f: swap(swap(f, masked, delimiter), own, _MARK),
    )
    whole = lambda f: f.startswith(quote) & f.endswith(quote) & (F.length(f) > 1)
    unquoted = F.transform(
        cells,
        lambda f: F.when(whole(f), swap(f.substr(F.lit(2), F.length(f) - 2), quote * 2, quote)).otherwise(f),
    )
    return F.when(F.contains(value, F.lit(quote)), unquoted).otherwise(plain)


def quote_pieces(value: Column, quote: str) -> Column:
    """What stands between the quotes of a line; every second piece is inside quotes."""
    return F.split(value, re.escape(quote), -1)


def field_count(value: Column, delimiter: str, quote: str | None = None) -> Column:
    """Fields on a line, counting the separators outside quotes."""
    plain = occurrences(value, delimiter) + 1
    if not quote:
        return plain.cast("bigint")
    outside = F.transform(
        quote_pieces(value, quote), lambda p, i: F.when(i % 2 == 0, occurrences(p, delimiter)).otherwise(F.lit(0))
    )
    quoted = F.aggregate(outside, F.lit(1), lambda a, b: a + b)
    return F.when(F.contains(value, F.lit(quote)), quoted).otherwise(plain).cast("bigint")


def field_at(value: Column, delimiter: str, index: int, quote: str | None = None) -> Column:
    """One field of a line by position, null if the line is too short.

    Lines without a quote are cut at the separators' bytes; only the others
    are split.
    """
    head = F.substring_index(value, delimiter, index + 1)
    plain = F.when(occurrences(value, delimiter) >= index, F.substring_index(head, delimiter, -1) if index else head)
    if not quote:
        return plain
    whole = F.try_element_at(fields(value, delimiter, quote), F.lit(index + 1))
    return F.when(F.contains(value, F.lit(quote)), whole).otherwise(plain)


def is_number(value: Column) -> Column:
    """True where the trimmed text reads as a floating-point number."""
    return strip(value).rlike(NUMBER)


def is_digits(value: Column) -> Column:
    return value.rlike(r"^[0-9]+$")


def truncate_text(value: Column, length: int, mark: str = "...") -> Column:
    return F.when(F.length(value) > length, F.concat(F.left(value, F.lit(length)), F.lit(mark))).otherwise(
        value
    )


def glob_match(name: Column, pattern: str | None) -> Column:
    """Shell-style name filter; no pattern means every name."""
    if not pattern:
        return F.lit(True)
    return name.rlike("^" + fnmatch.translate(pattern).replace(r"\Z", "").replace(r"\z", "") + "$")


def round_half_up(value: Column, digits: int) -> Column:
    """Round by decimal digits, so that binary noise at a tie does not decide."""
    return F.round(value.cast("decimal(38,10)"), digits).cast("double")


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    """Share in percent, zero where the whole is zero."""
    return round_half_up(F.when(whole > 0, part / whole * 100).otherwise(F.lit(0.0)), digits)
