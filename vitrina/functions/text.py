"""String expressions (all JVM-side, no UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.isspace() treats as blank, as a
# regex class understood by both Java regex and RE2 (DuckDB oracle):
# U+0009-U+000D, U+001C-U+0020, U+0085, U+00A0, U+1680, U+2000-U+200A,
# U+2028, U+2029, U+202F, U+205F, U+3000.
BLANK_CLASS = (r"[\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
               r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]")
STRIP_PATTERN = rf"^{BLANK_CLASS}+|{BLANK_CLASS}+$"
# Letters with case; a title-cased run starts at one that follows anything else.
CASED = r"\p{IsLowercase}\p{IsUppercase}\p{Lt}"
TITLE_START = f"(?<![{CASED}])(?=[{CASED}])"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ustrip(c) -> Column:
    """Strip leading/trailing blanks the way Python's str.strip() does
    (Spark's trim only removes ASCII spaces)."""
    return F.regexp_replace(_c(c), STRIP_PATTERN, "")


def title_case(c) -> Column:
    """Python ``str.strip().title()``: a letter with case is title-cased where it
    follows anything but such a letter, else lower-cased, so ``o'neil-smith`` ->
    ``O'Neil-Smith`` and ``\u4e2dabc`` -> ``\u4e2dAbc``. The text is cut before each start;
    a piece has one run of such letters, so initcap serves for it."""
    pieces = F.split(F.lower(ustrip(c)), TITLE_START)
    return F.array_join(F.transform(pieces, F.initcap), "")


def email_norm(c) -> Column:
    """``.str.lower().str.strip()``."""
    return ustrip(F.lower(_c(c)))


def truncate(c, n: int) -> Column:
    """Python slice ``s[:n]``: counts characters (code points)."""
    return F.substring(_c(c), 1, n)


def preview(c, n: int = 50, suffix: str = "...") -> Column:
    """Cut a value longer than ``n`` characters to ``n`` plus ``suffix``."""
    s = _c(c)
    return F.when(F.length(s) > n, F.concat(F.substring(s, 1, n), F.lit(suffix))).otherwise(s)


def full_name(first, last) -> Column:
    """Generated ``first || ' ' || last``: NULL when either part is NULL."""
    return F.concat(_c(first), F.lit(" "), _c(last))
