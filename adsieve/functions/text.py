"""White space as the engine understands it, for Java regular expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: All white space of Unicode; Java's own class is ASCII only.
SPACE = r"[\s\x1c-\x1f\x85\p{Z}]"


def strip(text: Column) -> Column:
    return F.regexp_replace(text, f"^{SPACE}+|{SPACE}+$", "")


def collapse(text: Column) -> Column:
    """Runs of white space become one space, none stays at either end."""
    return F.trim(F.regexp_replace(text, f"{SPACE}+", " "))


def spaced(pattern: str) -> str:
    """A pattern in which a space stands for optional white space."""
    return pattern.replace(" ", f"{SPACE}*")


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once for a row, however often, and in whatever lambda, the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


PAGE_BITS = 9
PAGE = 1 << PAGE_BITS


def pages(text: Column) -> Column:
    """The text in pieces of PAGE characters, so that ``cut`` needn't look for a place from the text's beginning."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PAGE}}}"), F.lit(0))


def cut(pages: Column, start: Column, end: Column) -> Column:
    """The characters from ``start`` to before ``end`` (not negative) of a text in pages."""
    first, last = (F.shiftright(x, PAGE_BITS).cast("int") for x in (start, F.greatest(end - 1, start)))
    some = F.when(first == last, F.coalesce(F.get(pages, first), F.lit(""))).otherwise(F.array_join(F.slice(pages, first + 1, last - first + 1), ""))
    return F.substring(some, start - first * PAGE + 1, F.greatest(end - start, F.lit(0)))
