"""Text clean-up: place names, blanks, run names."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from roadpulse.schemas import RUN_NAME


def strip(col: Column) -> Column:
    """Remove white space of any kind (tabs, no-break spaces, ...) at both ends."""
    return F.regexp_replace(col, r"(?U)^\s+|\s+$", "")


_LETTERS = r"\p{L}+|[^\p{L}]+"
_MARK = "\ufdd0"         # no character; where a text has it all the same, a 0 follows it meanwhile


def title_case(col: Column, runs: str = _LETTERS) -> Column:
    """Upper-case the first letter of every run of letters, lower-case the rest.

    `initcap` alone only starts a new word after a space, so `o'higgins` would stay `O'higgins`: a mark and a space
    part the runs meanwhile. Functions over arrays would do without, but Spark compiles no step that has one.
    """
    marked = F.replace(F.lower(col), F.lit(_MARK), F.lit(_MARK + "0"))
    words = F.initcap(F.regexp_replace(marked, f"({runs})", f"$1{_MARK} "))
    return F.replace(F.replace(words, F.lit(_MARK + " "), F.lit("")), F.lit(_MARK + "0"), F.lit(_MARK))


def normalize_city(col: Column) -> Column:
    """`peñaflor, malloco` -> `Peñaflor;Malloco`. Null and empty text stay as they are.

    Nearly all names are letters and digits with single spaces and separators; those need no
    regular expression beyond the test, and `initcap` is right for them. The rest (other
    signs, a letter right after a digit, runs of spaces) goes part by part.
    """
    separated = F.replace(col, F.lit(","), F.lit(";"))
    plain = separated
    for gap in (" ;", "; "):
        plain = F.replace(plain, F.lit(gap), F.lit(";"))
    words = F.initcap(F.replace(F.trim(plain), F.lit(";"), F.lit("; ")))
    stripped = F.regexp_replace(separated, r"(?U)(?:^|(?<=;))\s+|\s+(?=;|$)", "")
    by_part = title_case(stripped, r"\p{L}+|;|[^\p{L};]+")
    unusual = col.rlike(r"[^\p{L}\p{N} ,;]|\p{N}\p{L}|  ")
    return F.when(unusual, by_part).otherwise(F.replace(words, F.lit("; "), F.lit(";")))


def filled(col: Column) -> Column:
    """True where a text is neither null nor empty; never null itself."""
    return col.isNotNull() & (col != "")


def is_digits(col: Column) -> Column:
    return F.coalesce(col.rlike("^[0-9]+$"), F.lit(False))


def is_run_name(col: Column) -> Column:
    return F.coalesce(col.rlike(RUN_NAME), F.lit(False))


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def file_stem(path: Column) -> Column:
    """Lower-cased base name without its last extension."""
    return F.lower(F.regexp_extract(path, r"([^/]*?)(\.[^./]*)?$", 1))
