"""The two Unicode steps Spark SQL has no built-in for, as Arrow (pandas) UDFs.

Both are fed through ``F.when(<needs it>, x)`` so rows that do not need them
cross into Python as nulls only.
"""

from __future__ import annotations

import functools
import unicodedata

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from herald.functions.fixed_values import CONFUSABLES, ZERO_WIDTH

_FOLD_TABLE = {ord(k): v for k, v in CONFUSABLES.items()}
_FOLD_TABLE.update({ord(z): None for z in ZERO_WIDTH})


def _ranges(cps):
    out, start, prev = [], None, None
    for c in cps:
        if start is None:
            start = prev = c
        elif c == prev + 1:
            prev = c
        else:
            out.append((start, prev))
            start = prev = c
    if start is not None:
        out.append((start, prev))
    return out


@functools.lru_cache(maxsize=1)
def _sensitive_code_points() -> frozenset:
    """Characters for which NFKC of a string containing them may differ.

    Derived by rule from the Unicode database: characters not NFKC-stable on
    their own, characters with a non-zero combining class (reordering), and
    characters that can be the second half of a canonical composition.
    """
    cps = set()
    for cp in range(0x80, 0x110000):
        if 0xD800 <= cp <= 0xDFFF:
            continue
        ch = chr(cp)
        if unicodedata.combining(ch) or not unicodedata.is_normalized("NFKC", ch):
            cps.add(cp)
        dec = unicodedata.decomposition(ch)
        if dec and not dec.startswith("<"):
            parts = dec.split()
            if len(parts) == 2:
                cps.add(int(parts[1], 16))
    return frozenset(cps)


@functools.lru_cache(maxsize=1)
def nfkc_sensitive_chars() -> str:
    """All NFKC-sensitive characters as one string (for ``translate``).

    A regex class of these ~6,000 code points is tested range by range by
    Java; ``translate`` builds a hash map once and costs one lookup per
    character, so "text changes when they are deleted" is the fast test.
    """
    return "".join(chr(c) for c in sorted(_sensitive_code_points()))


def has_nfkc_sensitive(col):
    """True when the string holds a character NFKC could change."""
    return F.length(F.translate(col, nfkc_sensitive_chars(), "")) != F.length(col)


@F.pandas_udf(T.StringType())
def nfkc(s: pd.Series) -> pd.Series:
    """Unicode NFKC of each non-null string."""
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFKC", x))


def fold_host(host: str) -> str:
    """Confusable folding, then NFKD with non-ASCII characters dropped."""
    h = host.translate(_FOLD_TABLE)
    return unicodedata.normalize("NFKD", h).encode("ascii", "ignore").decode("ascii")


@functools.lru_cache(maxsize=1)
def nfkd_ascii_table() -> tuple[str, str]:
    """``translate`` strings mapping each non-ASCII character whose NFKD form
    keeps exactly one ASCII character to that character (e.g. accented Latin
    letters and full-width forms). Derived by rule from the Unicode database.
    """
    src, dst = [], []
    for cp in range(0x80, 0x110000):
        if 0xD800 <= cp <= 0xDFFF:
            continue
        kept = unicodedata.normalize("NFKD", chr(cp)).encode("ascii", "ignore").decode("ascii")
        if len(kept) == 1:
            src.append(chr(cp))
            dst.append(kept)
    return "".join(src), "".join(dst)


def ascii_fold_host(col):
    """JVM form of :func:`fold_host` for text that already went through NFKC.

    After NFKC every remaining character's NFKD keeps at most one ASCII
    character (canonical decompositions have one starter), so a translate
    table plus deleting what is left outside ASCII is exact there.
    """
    from herald.functions.text import _FOLD_FROM, _FOLD_TO
    a, b = nfkd_ascii_table()
    folded = F.translate(F.translate(col, _FOLD_FROM, _FOLD_TO), a, b)
    return F.regexp_replace(folded, r"[^\x00-\x7F]", "")
