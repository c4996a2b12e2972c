"""Fixed values of the template normaliser.

Fixed values: these must equal the reference normaliser's lists for identical
templates; they are data, stated in their natural order.
"""

CONFUSABLES = {
    # Cyrillic letters read as Latin
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j",
    "һ": "h", "к": "k", "м": "m", "н": "n", "т": "t", "в": "v",
    "А": "A", "В": "B", "С": "C", "Е": "E", "Н": "H", "К": "K", "М": "M", "О": "O", "Р": "P",
    "Т": "T", "Х": "X", "І": "I", "Ј": "J",
    # Greek letters read as Latin
    "α": "a", "β": "b", "γ": "y", "δ": "d", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v",
    "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N",
    "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
    # script small l
    "ℓ": "l",
}
# Marks without width and marks of writing direction, which are deleted.
ZERO_WIDTH = (
    "\u200B", "\u200C", "\u200D", "\uFEFF", "\u2060",
    "\u200E", "\u200F",
    "\u202A", "\u202B", "\u202C", "\u202D", "\u202E",
)
SIGNOFF_WORDS = ("thanks", "thank you", "cheers", "regards", "best")
GENERIC_TERMS = ("dear", "customer", "client", "friend", "partner", "user", "member")
OTP_CONTEXT_WORDS = r"otp|code|verification\s*code|security\s*code|one[-\s]?time(?:\s*password)?|pin"

# Field patterns of an envelope that is no valid JSON; the message format.
ENVELOPE_FIELDS = {
    "sourceAddress": r'"sourceAddress"\s*:\s*"([^"]*)"',
    "requestID": r'"requestID"\s*:\s*"([^"]*)"',
    "shortMessage": r'"shortMessage"\s*:\s*"([^"]*)"',
}

# Mask patterns; templates agree only if these do. Java syntax, (?U) for Unicode classes.
P_REPEATS = r"(.)\1{2,}"
P_SIGNOFF = r"(?iU)(\b(?:" + "|".join(SIGNOFF_WORDS) + r")\s*,\s*)([A-Z][A-Za-z'\-.]{1,20})\b"
# The greeted name runs up to the comma; the second look-ahead leaves generic terms alone.
P_GREETING = (r"(?iU)^(?!(?:" + "|".join(SIGNOFF_WORDS) + r")\b)(?!(?:" + "|".join(GENERIC_TERMS) + r")\s*,)"
              r"([A-Z][A-Za-z'\-.]{1,20}(?:\s+[A-Z][A-Za-z'\-.]{0,20}){0,2})\s*,\s+")
P_NAME_SENT = r"(?iU)(:\s*)([A-Za-z][A-Za-z'\-]*(?:\s+[A-Za-z][A-Za-z'\-]*){0,3})(\s+sent you\b)"
P_EMAIL = r"(?iU)\b[A-Z0-9._%+\-]+@[A-Z0-9.\-]+\.[A-Z]{2,}\b"
# Eight or more digits and separators with at least seven digits; the look-ahead counts them. The seventh or a
# later digit ends a word: the first that no digit follows does, or none. Groups repeated without a limit
# take a stack frame a turn in Java, so a long run of digits or of labels would end the executor; there are none.
P_PHONE = r"(?U)\b(?=\+?\d(?:[\-.\s()\x{A0}]*+\d){6}\d*+\b)\+?\d[\d\-.\s()\x{A0}]{6,}\d\b"
# Labels and dots: no two dots in a row, a dot at the end.
P_URL = r"""(?iU)\b((?:https?://|www\.)[^\s<>"]+|[A-Za-z0-9-](?:(?!\.\.)[A-Za-z0-9.-])*\.[A-Za-z]{2,}(?:/[^\s<>"]*)?)"""
P_TIME = r"(?iU)\b(\d{1,2}):(\d{2})\s*(am|pm)\s*et\b"
P_GATE = r"(?iU)\bgate\s*[a-zA-Z]\d{1,3}\b"
P_OTP_CONTEXT = r"(?iU)\b(?:" + OTP_CONTEXT_WORDS + r")\b[^0-9]{0,20}\b([0-9]{4,8})\b"
P_OTP = r"(?U)\b([0-9]{4,8})\b"
P_NUMBER = r"(?U)(?<![{A-Za-z])\b\d+(?:[.,]\d+)?\b(?![}\w])"
