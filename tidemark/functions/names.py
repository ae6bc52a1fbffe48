"""File-name expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.text import quoted


def base_name(path: Column) -> Column:
    return F.element_at(F.split(F.rtrim(path, F.lit("/")), "/"), -1)


def stored_name(url: Column, period: Column) -> Column:
    """Name a fetched file is stored under: last URL segment, else ``<period>.bin``."""
    name = base_name(F.substring_index(url, "?", 1))
    return F.coalesce(F.nullif(name, F.lit("")), F.concat(period, F.lit(".bin")))


_STEM = r"(?s)^(.+?)(\.[^.]+)?\z"


def stem(name: Column) -> Column:
    """Name without its last extension; a leading dot starts no extension."""
    return F.regexp_extract(name, _STEM, 1)


def suffix(name: Column) -> Column:
    """Last extension with its dot, or an empty string."""
    return F.regexp_extract(name, _STEM, 2)


def versioned_name(name: Column, version: Column) -> Column:
    """``report.tar.gz`` in version 3 becomes ``report.v3.tar.gz``."""
    head = F.substring_index(name, ".", 1)
    tail = F.substring(name, F.length(head) + 1, F.length(name))
    return F.concat(head, F.lit(".v"), version.cast("string"), tail)


def folder_of_archive(path: Column) -> Column:
    """Folder an archive is unpacked to: the path without ``.zip``, else null."""
    is_archive = path.rlike(r"(?is)[^/]\.zip\z")
    return F.when(is_archive, F.substring(path, F.lit(1), F.length(path) - 4))


# The years a combined release may hold.
COMBINED_YEARS = (1996, 1997, 1998, 1999)


def year_in_name(name: str, years=COMBINED_YEARS, strict: bool = False) -> str:
    """Year a file or folder name speaks of, four digits before two; takes and gives SQL.

    With ``strict`` a year counts only where a word ends (``x-96.pdf``); otherwise
    it counts wherever no further digit touches it (``yb96_0.pdf`` too).
    """
    ends = "|".join(f"{y % 100:02d}" for y in years)
    century = {y // 100 for y in years}
    if len(century) != 1:
        raise ValueError("the years of a combined release lie in one century")
    first = century.pop()
    if strict:
        patterns = (rf"(?U){first}({ends})\b", rf"(?U)\b({ends})\b")
    else:
        patterns = (rf"(?<!\d){first}({ends})(?!\d)", rf"(?<!\d)({ends})(?!\d)")
    found = ", ".join(f"nullif(regexp_extract({name}, {quoted(p)}, 1), '')" for p in patterns)
    return f"{first * 100} + cast(coalesce({found}) AS INT)"
