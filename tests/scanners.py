"""Character-by-character readings of single masks, independent of the patterns under test."""

from __future__ import annotations

from herald.functions.fixed_values import GENERIC_TERMS, SIGNOFF_WORDS

SEPARATORS = set("-.() ") | {c for c in map(chr, range(0x3100)) if c.isspace()}
NAME = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz'-.")
LETTERS = NAME - set("'-.")


def is_word(text: str, i: int) -> bool:
    return 0 <= i < len(text) and (text[i].isalnum() or text[i] == "_")


def numbers(text: str) -> str:
    """Numbers that stand alone, with at most one fraction, become a placeholder."""
    out, i = [], 0
    while i < len(text):
        before = text[i - 1] if i else ""
        if not text[i].isdecimal() or is_word(text, i - 1) or before == "{":
            out.append(text[i])
            i += 1
            continue
        end = i
        while end < len(text) and text[end].isdecimal():
            end += 1
        far = end + 1
        while end < len(text) and text[end] in ".," and far < len(text) and text[far].isdecimal():
            far += 1
        stops = [e for e in (far if far > end + 1 else None, end)
                 if e is not None and not is_word(text, e) and text[e:e + 1] != "}"]
        if stops:
            out.append("{NUM}")
            i = stops[0]
        else:
            out.append(text[i:end])
            i = end
    return "".join(out)


def phones(text: str) -> str:
    """Runs of digits and separators with seven digits and eight characters become a placeholder."""
    out, i = [], 0
    while i < len(text):
        plus = text[i] == "+" and is_word(text, i - 1)
        at = i + plus
        end = None
        if at < len(text) and text[at].isdecimal() and (plus or not is_word(text, i - 1)):
            digits, j = 0, at
            while j < len(text) and (text[j].isdecimal() or text[j] in SEPARATORS):
                digits += text[j].isdecimal()
                if text[j].isdecimal() and digits >= 7 and j - at >= 7 and not is_word(text, j + 1):
                    end = j + 1
                j += 1
        if end is None:
            out.append(text[i])
            i += 1
        else:
            out.append("{PHONE}")
            i = end
    return "".join(out)


def greeting(text: str) -> str:
    """One to three name words before the first comma, at the very start, become a placeholder."""
    comma = text.find(",")
    if comma < 0 or comma + 1 == len(text) or not text[comma + 1].isspace():
        return text
    head = text[:comma].rstrip()
    words = head.split()
    ok = (1 <= len(words) <= 3 and not head[:1].isspace() and 2 <= len(words[0]) <= 21
          and all(w[0] in LETTERS and set(w) <= NAME and len(w) <= 21 for w in words))
    low = head.lower()
    signs_off = any(low.startswith(s) and not is_word(low, len(s)) for s in SIGNOFF_WORDS)
    if not ok or signs_off or low in GENERIC_TERMS:
        return text
    return "{NAME}, " + text[comma + 1:].lstrip()
