"""Text expressions.

The page and URL expressions have hundreds of nodes. They are put together as SQL text
and parsed once by Spark, since a Python call per node costs seconds per query.
"""

from __future__ import annotations

import re
import sys

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character Python's str.strip() removes; Spark's trim() alone removes spaces only.
WHITESPACE = "".join(c for c in map(chr, range(sys.maxunicode + 1)) if c.isspace())


def quoted(text: str) -> str:
    """SQL literal of `text`."""
    escaped = "".join(
        f"\\{c}" if c in "\\'" else c if c.isprintable() else f"\\u{ord(c):04x}" for c in text
    )
    return f"'{escaped}'"


def let(name: str, value: str, body: str) -> str:
    """SQL of `body`, in which `name` stands for `value`, computed once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def strip_sql(text: str) -> str:
    return f"btrim({text}, {quoted(WHITESPACE)})"


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def to_long(text: Column) -> Column:
    """Number in `text`, null when blank or not a number."""
    return strip(text.cast("string")).try_cast("bigint")


def _any_of(text: Column, pattern: str, terms) -> Column:
    """One pattern for all terms, so that `text` is computed once."""
    terms = [re.escape(t) for t in terms]
    return text.rlike(pattern.format("|".join(terms))) if terms else F.lit(False)


def contains_any(text: Column, terms) -> Column:
    """Whether any of `terms` occurs in `text`, ignoring case."""
    return _any_of(F.lower(text), "(?:{})", [t.lower() for t in terms])


def ends_with_any(text: Column, endings) -> Column:
    return _any_of(text, "(?:{})\\z", endings)
