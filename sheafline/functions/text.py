"""Text columns: strip, citations, quotes, spaces, words."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that counts as white space for stripping and splitting:
# ASCII controls 9-13 and 28-31, space, NEL, NBSP and the Unicode spaces.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The same set as a regular expression class ((?U) makes \\s cover Unicode spaces).
_SPACE_RUN = r"(?U)[\s\x1c-\x1f]+"
_WORD = r"(?U)[^\s\x1c-\x1f]+"

# Citation marks, and the quotes and dashes with their ASCII forms.
CITATION = r"\[(?:[0-9]+|citation needed|clarification needed)\]"
FANCY = "\u201c\u201d\u2018\u2019\u2013\u2014"
PLAIN = "\"\"''--"

# One space needs no replacement, so only longer runs and tabs are matched.
_BLANK_RUN = r"[ \t]{2,}|\t"


def strip(c: Column) -> Column:
    """Remove white space of any kind at both ends."""
    return F.btrim(c, F.lit(WHITESPACE))


def blank(c: Column) -> Column:
    """Null or empty (white space counts as content, as for a stored string)."""
    return c.isNull() | (c == "")


def collapse_blanks(c: Column) -> Column:
    """Each run of spaces and tabs becomes one space."""
    return F.regexp_replace(c, _BLANK_RUN, " ")


def collapse_whitespace(c: Column) -> Column:
    """Each run of white space of any kind becomes one space."""
    return F.regexp_replace(c, _SPACE_RUN, " ")


def drop_citations(c: Column) -> Column:
    return F.regexp_replace(c, CITATION, "")


def clean_text(c: Column) -> Column:
    """Body text: citations, quotes, dashes, blank lines, spaces, strip. Null gives ``''``.

    Blank-line runs are shortened before spaces are, so lines holding only
    spaces keep the newline run apart.
    """
    plain = F.translate(drop_citations(c), FANCY, PLAIN)
    return F.coalesce(strip(collapse_blanks(F.regexp_replace(plain, "\n{3,}", "\n\n"))), F.lit(""))


def clean_title(c: Column) -> Column:
    """Title: citations, spaces, strip; quotes and dashes stay. Null gives ``''``."""
    return F.coalesce(strip(collapse_blanks(drop_citations(c))), F.lit(""))


def word_count(c: Column) -> Column:
    """Number of runs without white space; null and empty give 0."""
    return F.coalesce(F.regexp_count(c, F.lit(_WORD)), F.lit(0)).cast("bigint")


def char_count(c: Column) -> Column:
    """Length in code points; null gives 0."""
    return F.coalesce(F.length(c), F.lit(0)).cast("bigint")


def words(c: Column) -> Column:
    """The distinct lower-case words of a text."""
    return F.array_distinct(F.regexp_extract_all(F.lower(c), F.lit(_WORD), F.lit(0)))


def collector_label(c: Column) -> Column:
    """``name_of_collector`` → ``Name``: the part before the first ``_``, capitalised."""
    head = F.split_part(c, F.lit("_"), F.lit(1))
    return F.concat(F.upper(F.substring(head, 1, 1)), F.lower(F.substring(head, 2, 2**31 - 1)))
