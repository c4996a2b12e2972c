"""Label and list helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from herald import config

# Python's ``[^\w\s\-]`` for str patterns, written with Unicode classes.
P_NON_LABEL = r"[^\p{L}\p{N}_\s\-]"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


# T21
def clean_label(col, max_words: int = config.MAX_WORDS) -> Column:
    """Strip, drop characters other than word/space/hyphen, keep the first words."""
    c = F.regexp_replace(py_strip(F.coalesce(_c(col), F.lit(""))), "(?U)" + P_NON_LABEL, "")
    words = F.filter(F.split(c, r"(?U)\s+"), lambda w: w != "")
    return F.array_join(F.slice(words, 1, max_words), " ")


# T23
def display_name(col, max_chars: int = config.DISPLAY_MAX_CHARS,
                 keep: int = config.DISPLAY_KEEP_CHARS) -> Column:
    c = _c(col)
    return F.when(F.length(c) > max_chars, F.concat(c.substr(1, keep), F.lit("..."))).otherwise(c)


# T24
def name_or_default(col, default: str = "") -> Column:
    return F.coalesce(py_strip(_c(col)), F.lit(default))


# W5
def numbered_list(arr, sep: str = "\n", quote: bool = False) -> Column:
    """``"1. a" + sep + "2. b" ...`` from an array, in array order."""
    q = F.lit('"') if quote else F.lit("")
    items = F.transform(_c(arr), lambda x, i: F.concat((i + 1).cast("string"), F.lit(". "), q, x, q))
    return F.array_join(items, sep)


def py_strip(col) -> Column:
    """Strip leading/trailing whitespace as Python's ``str.strip()`` does."""
    from herald.functions.text import PY_SPACE
    return F.regexp_replace(_c(col), f"^{PY_SPACE}+|{PY_SPACE}+$", "")


# F15
def non_blank(arr) -> Column:
    """Stripped, non-empty samples only."""
    return F.filter(F.transform(_c(arr), lambda s: py_strip(s)), lambda s: s != "")
