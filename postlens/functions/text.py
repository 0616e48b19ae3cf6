"""Text clean-up expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that stand for "no value" in the incoming posts.
PLACEHOLDERS = (
    "No description available",
    "No description available Story format",
    "No Title Data Available",
    "User Info Error",
    "Image src error.",
    "N,o, ,T,a,g,s, ,A,v,a,i,l,a,b,l,e",
)

# Fixed value: text put before every save path.
SAVE_PREFIX = "Local save in "


def placeholder_to_null(column: Column, placeholders=PLACEHOLDERS) -> Column:
    """NULL where the whole value is one of ``placeholders``; anything else is kept as it is."""
    return F.when(column.isin(*placeholders), None).otherwise(column)


def swap_token(column: Column, token: str, other: str) -> Column:
    """``other`` where the whole value is ``token``."""
    return F.when(column == token, other).otherwise(column)


# What a closing letter multiplies a number by.
FACTORS = {"k": 1_000, "m": 1_000_000}


def expand_suffix(column: Column) -> Column:
    """``12k`` to ``12000``, ``1.5K`` to ``1500``, ``2M`` to ``2000000``; ``k`` alone to ``000``; else as it is."""
    number, mark = F.regexp_extract(column, _MARKED, 1), F.lower(F.regexp_extract(column, _MARKED, 2))
    product = number.try_cast("decimal(28,9)") * F.when(mark == "k", FACTORS["k"]).otherwise(FACTORS["m"])
    expanded = F.when(column.rlike(_MARKED), F.floor(product).cast("string")).otherwise(column)
    return F.when(column == "k", "000").otherwise(expanded)


_MARKED = r"^([0-9]+(?:\.[0-9]+)?)([kKmM])$"


# What a cast of text to a number may take, as patterns. The casts below ask first: a failed try_cast throws and catches
# inside, which costs some forty times a good one, and follower counts fail by the million. Trimmed as the cast trims.
_BLANK = r"[\x00-\x20\x7f]*"
_WHOLE = {"int": rf"^{_BLANK}[+-]?0*[0-9]{{1,10}}{_BLANK}$", "bigint": rf"^{_BLANK}[+-]?0*[0-9]{{1,19}}{_BLANK}$"}
_FRACTION = rf"^({_BLANK}[+-]?)([0-9]*)\.[0-9]*({_BLANK})$"
_NUMBER_START = {"double": rf"^{_BLANK}[+-]?[0-9.iInN]"}


def lenient_number(column: Column, kind: str) -> Column:
    """Text to ``int``, ``bigint`` or ``double``, or NULL where it is none. Never fails, under ANSI mode either.

    Whole numbers are read as the cast without ANSI mode reads them: of decimal text the whole part, cut towards zero.
    """
    if kind in _WHOLE:
        column = F.regexp_replace(column, _FRACTION, "$10$2$3")  # group 1, a zero, then the rest
    pattern = {**_WHOLE, **_NUMBER_START}[kind]
    return F.when(column.rlike(pattern), column.try_cast(kind))


def lenient_int(column: Column) -> Column:
    """E3 to int, the type of follower counts."""
    return lenient_number(column, "int")


def without_text(column: Column, text: str = SAVE_PREFIX) -> Column:
    """Every occurrence of ``text`` removed, case-sensitive."""
    return F.replace(column, F.lit(text), F.lit(""))


def joined_text(*columns: Column, separator: str = " ") -> Column:
    """Non-NULL parts joined by ``separator``; no parts give an empty text."""
    return F.concat_ws(separator, *columns)
