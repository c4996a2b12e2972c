"""Message normalisation as Spark Column expressions (JVM regex, no Python per row).

Steps are ``Column -> Column`` functions; :func:`normalize_messages` applies them in
the fixed order of the template normaliser, each in a projection of its own.

Patterns use Java regex with ``(?U)`` so that ``\\w``, ``\\d``, ``\\s`` and ``\\b``
follow Unicode, as Python's ``re`` does for ``str`` patterns. The only
Python-side work is Unicode NFKC (:mod:`herald.functions.unicode`), and it is fed
only the rows that contain a character NFKC could change.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from herald.functions.fixed_values import (CONFUSABLES, P_EMAIL, P_GATE, P_GREETING, P_NAME_SENT, P_NUMBER,
                                          P_OTP, P_OTP_CONTEXT, P_PHONE, P_REPEATS, P_SIGNOFF, P_TIME,
                                          P_URL, ZERO_WIDTH)
from herald.functions.unicode import ascii_fold_host, has_nfkc_sensitive, nfkc

# translate(): characters of FROM without a partner in TO are deleted, so the
# zero-width marks go last.
_FOLD_FROM = "".join(CONFUSABLES) + "".join(ZERO_WIDTH)
_FOLD_TO = "".join(CONFUSABLES.values())


def _python_space_class(without: str = "") -> str:
    """Character class of every code point ``str.isspace()`` accepts."""
    return _ranges_class([c for c in range(0x110000) if chr(c).isspace() and chr(c) not in without])


def _ranges_class(cps: list[int]) -> str:
    parts, start, prev = [], None, None
    for c in cps:
        if start is None:
            start = prev = c
        elif c == prev + 1:
            prev = c
        else:
            parts.append((start, prev))
            start = prev = c
    if start is not None:
        parts.append((start, prev))
    out = []
    for a, b in parts:
        out.append(f"\\x{{{a:X}}}" if a == b else f"\\x{{{a:X}}}-\\x{{{b:X}}}")
    return "[" + "".join(out) + "]"


PY_SPACE = _python_space_class()
# Every run of white space but a single plain space, which needs no replacing.
P_SPACES = "(?:" + _python_space_class(without=" ") + PY_SPACE + "*| " + PY_SPACE + "+)"
# The same for text of ASCII characters alone.
_ASCII_SPACES = [c for c in range(0x80) if chr(c).isspace()]
P_ASCII_SPACES = "(?:" + _ranges_class([c for c in _ASCII_SPACES if c != 0x20]) + _ranges_class(_ASCII_SPACES) + "*| " + \
    _ranges_class(_ASCII_SPACES) + "+)"
# Rows of 256 code points that hold a character T1 changes: quick to look for.
P_MAY_FOLD = _ranges_class([c for page in sorted({ord(c) >> 8 for c in _FOLD_FROM}) for c in range(page << 8, (page + 1) << 8)])
# What any URL match holds: cheap to look for, under the same flags as the pattern.
P_URL_HINT = r"(?iU)://|www\.|[A-Za-z0-9-]\.[A-Za-z]{2}"
P_NON_ASCII = r"[^\x00-\x7F]"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def is_ascii(col) -> Column:
    """As many bytes as characters: a test without a look at any character."""
    return F.octet_length(_c(col)) == F.char_length(_c(col))


# T1
def fold_confusables(col) -> Column:
    """Map Cyrillic/Greek look-alikes to Latin and delete zero-width/bidi marks."""
    return F.translate(_c(col), _FOLD_FROM, _FOLD_TO)


# T2
def unicode_nfkc(col) -> Column:
    """NFKC, computed in Python only for rows holding an NFKC-sensitive character."""
    c = _c(col)
    return F.coalesce(nfkc(F.when(~is_ascii(c) & has_nfkc_sensitive(c), c)), c)


# T3
def collapse_repeats(col) -> Column:
    """Any character repeated 3+ times becomes two copies."""
    return F.regexp_replace(_c(col), P_REPEATS, "$1$1")


# T4
def collapse_whitespace(col) -> Column:
    """Runs of (Unicode) whitespace become one space; trimmed."""
    c = _c(col)
    return F.trim(F.when(is_ascii(c), F.regexp_replace(c, P_ASCII_SPACES, " ")).otherwise(F.regexp_replace(c, P_SPACES, " ")))


# T5
def mask_signoff_name(col) -> Column:
    return F.regexp_replace(_c(col), P_SIGNOFF, "$1{NAME}")


# T6
def mask_greeting_name(col) -> Column:
    return F.regexp_replace(_c(col), P_GREETING, "{NAME}, ")


# T7
def mask_name_before_sent(col) -> Column:
    return F.regexp_replace(_c(col), P_NAME_SENT, "$1{NAME}$3")


# T8
def mask_emails(col) -> Column:
    return F.regexp_replace(_c(col), P_EMAIL, "{EMAIL}")


def has_email(col) -> Column:
    return _c(col).rlike(P_EMAIL)


# T9
def mask_phones(col) -> Column:
    return F.regexp_replace(_c(col), P_PHONE, "{PHONE}")


def phone_changed(col) -> Column:
    return _c(col).rlike(P_PHONE)


# T10 (pieces)
def url_host(match: Column) -> Column:
    """Host part of one URL match: scheme, path, port and ``www.`` removed."""
    u = F.regexp_replace(F.trim(match), r"(?i)^https?://", "")
    dom = F.substring_index(F.substring_index(u, "/", 1), ":", 1)
    return F.when(F.lower(dom).startswith("www."), dom.substr(5, 1 << 30)).otherwise(dom)


def url_placeholder(host: Column) -> Column:
    """``{URL:a.b}`` from a folded host (last two non-empty labels), ``{URL}`` if empty."""
    low = F.lower(host)
    parts = F.filter(F.split(low, r"[.]"), lambda p: p != F.lit(""))
    n = F.size(parts)
    dom = F.when(n >= 2, F.concat(F.element_at(parts, -2), F.lit("."), F.element_at(parts, -1))) \
        .otherwise(low)
    return F.when(dom == "", F.lit("{URL}")).otherwise(F.concat(F.lit("{URL:"), dom, F.lit("}")))


def _rebuild_urls(text: Column, hosts: Column) -> Column:
    """Re-assemble ``text`` with each URL match replaced by its placeholder."""
    pieces = F.split(text, P_URL)
    reps = F.transform(hosts, url_placeholder)
    tail = F.zip_with(reps, F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0))),
                      lambda r, p: F.concat(r, p))
    return F.concat(F.element_at(pieces, 1), F.array_join(tail, ""))


def _fold_if_needed(hosts: Column) -> Column:
    return F.transform(hosts, lambda h: F.when(h.rlike(P_NON_ASCII), ascii_fold_host(h)).otherwise(h))


def mask_urls_df(df: DataFrame, text_col: str, out_col: str) -> DataFrame:
    """Replace each URL by ``{URL:domain}``.

    Spark has no replace-with-callback, so the text is split around the matches
    and re-assembled with the rewritten matches. Hosts with non-ASCII
    characters are ASCII-folded in the JVM (exact on NFKC text, which is what
    the normaliser feeds it). Texts without a hint of a URL pass with one cheap scan.
    """
    m, h = "__herald_url_hosts", "__herald_url_folded"
    t = F.col(text_col)
    return (df.withColumn(m, F.when(t.rlike(P_URL_HINT),
                                    F.transform(F.regexp_extract_all(t, F.lit(P_URL), 0), url_host)))
              .withColumn(h, _fold_if_needed(F.col(m)))
              .withColumn(out_col, F.when(F.coalesce(F.size(m), F.lit(0)) > 0, _rebuild_urls(t, F.col(h)))
                          .otherwise(t))
              .drop(m, h))


def url_count(col) -> Column:
    return F.regexp_count(_c(col), F.lit(P_URL))


# T11
def mask_times(col) -> Column:
    return F.regexp_replace(_c(col), P_TIME, "{TIME}")


# T12
def mask_gates(col) -> Column:
    return F.regexp_replace(_c(col), P_GATE, "{GATE}")


# The in-context code is the same 4-8 digit token T14 masks, so the chain
# only keeps it as a predicate.
def has_otp_context(col) -> Column:
    return _c(col).rlike(P_OTP_CONTEXT)


# T14
def mask_codes(col) -> Column:
    return F.regexp_replace(_c(col), P_OTP, "{OTP}")


# T15
def mask_numbers(col) -> Column:
    return F.regexp_replace(_c(col), P_NUMBER, "{NUM}")


# Exact guards: a mask can only fire when its required
# character is present, and a plain search for it is cheaper than the mask's
# regex. Each guarded step is its own projection, so the guard and the mask
# read a column instead of re-evaluating the chain.
P_ANY_DIGIT = r"\p{Nd}"
_STEPS_BEFORE_URL = (
    (lambda c: ~is_ascii(c) & c.rlike(P_MAY_FOLD), fold_confusables),
    (None, unicode_nfkc),
    (None, collapse_repeats),
    (None, collapse_whitespace),
    (lambda c: c.contains(","), mask_signoff_name),
    (None, mask_greeting_name),
    (lambda c: c.contains(":"), mask_name_before_sent),
    (lambda c: c.contains("@"), mask_emails),
    (lambda c: c.rlike(P_ANY_DIGIT), mask_phones),
)
_STEPS_AFTER_URL = (
    (None, F.lower),
    (lambda c: c.contains(":"), mask_times),
    (lambda c: c.contains("gate"), mask_gates),
    (lambda c: c.rlike(P_ANY_DIGIT), lambda c: mask_numbers(mask_codes(c))),
    # white space was collapsed before the masks, which add plain spaces at most
    (lambda c: c.contains("  ") | c.startswith(" ") | c.endswith(" "), collapse_whitespace),
)


def _apply_steps(df: DataFrame, col: str, steps) -> DataFrame:
    for guard, step in steps:
        c = F.col(col)
        df = df.withColumn(col, step(c) if guard is None else F.when(guard(c), step(c)).otherwise(c))
    return df


# T16
def normalize_messages(df: DataFrame, text_col: str = "raw_text",
                       out_col: str = "normalized_text") -> DataFrame:
    """Add ``out_col`` = normalised ``text_col``.

    One projection per step (fused by whole-stage codegen), so that guards and
    the URL step read computed columns instead of re-running earlier masks.
    """
    pre, post = "__herald_pre_url", "__herald_post_url"
    df = _apply_steps(df.withColumn(pre, F.col(text_col)), pre, _STEPS_BEFORE_URL)
    df = mask_urls_df(df, pre, post)
    df = _apply_steps(df, post, _STEPS_AFTER_URL)
    return df.withColumn(out_col, F.col(post)).drop(pre, post)
