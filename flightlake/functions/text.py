"""Text normalisation."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Unicode-aware stripping removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

ROUTE_SEPARATOR = " -> "

# Texts that data-frame CSV readers commonly take for missing. Not applied
# unless asked for, because NA is also the country code of Namibia.
MISSING_TOKENS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]


def strip(c: Column) -> Column:
    """Strip Unicode whitespace. `trim` with a character list looks at the edges only,
    so it costs far less per row than a regular expression."""
    return F.trim(c, F.lit(WHITESPACE))


def blank_to_null(c: Column) -> Column:
    """Null where nothing but whitespace is left, the value itself otherwise."""
    return F.when(strip(c) != "", c)


def code(c: Column) -> Column:
    """Strip, upper-case, and blank -> null: the form every airport and aircraft code takes."""
    return F.nullif(F.upper(strip(c)), F.lit(""))


def null_tokens(c: Column, tokens: Iterable[str]) -> Column:
    """Null where the text is one of `tokens` (for sources that write missing as e.g. NA)."""
    tokens = list(tokens)
    return F.when(~c.isin(tokens), c) if tokens else c


def route(departure: Column, arrival: Column) -> Column:
    """`DEP -> ARR`; concat is null as soon as one end is."""
    return F.concat(departure, F.lit(ROUTE_SEPARATOR), arrival)


def normalize_header(name: str) -> str:
    return name.strip().lower().replace(" ", "_")
