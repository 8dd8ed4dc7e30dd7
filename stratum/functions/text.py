"""Regular-expression rules for message text, as native Spark expressions (no UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: reply markers, sign-offs, disclaimers, noise phrases and subject prefixes
# (a marker starts on a line of its own)
REPLY_MARKERS = (
    r"On [^\n]{0,120}? wrote:",
    r"-{2,}\s*Original Message\s*-{2,}",
    r"From:\s[^\n]*?\nSent:\s[^\n]*?\nTo:\s",
    r"_{5,}",
    r"Sent from my \w+",
)
SIGNOFFS = ("kind regards", "best regards", "regards", "thanks", "thank you", "cheers", "sincerely")
DISCLAIMERS = (r"This (?:e-?mail|message) and any attachments", r"CONFIDENTIALITY NOTICE")
NOISE_PHRASES = (
    "out of office", "automatic reply", "auto-reply", "do not reply", "delivery (?:has )?failed",
    "undeliverable", "read receipt", "unsubscribe",
)
SUBJECT_PREFIXES = ("re", "fwd", "fw", "aw")
MIN_TOKENS = 5

# fixed values: personal data in free text (13-digit id, phone, e-mail); for a yes-or-no scan one character on
# each side of "@" decides, without walking long runs
PII_PATTERNS = {
    "national_id": r"[0-9]{13}",
    "phone": r"[0-9]{3}[\s-]?[0-9]{3}[\s-]?[0-9]{4}",
    "email": r"[\w.-]@[\w.-]",
}

# fixed value: a well-formed e-mail address
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,}$"

_BREAKS = r"\r\n?|[\x0B\x0C\x1C-\x1E\x85\x{2028}\x{2029}]"
_TO_END = r"(?s:.*)"
# an address is a blank-free run with "@" after its first character and something behind it;
# possessive so that a long run without "@" costs linear time
_ADDRESS = r"(?<!\S)\S[^\s@]*+@\S+"


def _c(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def _replace_if(text: Column, needle: str, pattern: str, by: str) -> Column:
    """Run a regular expression only on texts that contain ``needle``, which every match must contain."""
    return F.when(text.contains(needle), F.regexp_replace(text, pattern, by)).otherwise(text)


def cut_replies(column: Column | str) -> Column:
    """Keep what stands before the first reply marker."""
    return F.regexp_replace(_c(column), rf"\n(?:{'|'.join(REPLY_MARKERS)}){_TO_END}", "")


def drop_quoted(column: Column | str) -> Column:
    """Drop lines that start with ``>``; line breaks become ``\\n`` and a trailing one goes.

    With a break put in front, every line is "break + content" and a quoted line goes with its own break.
    """
    text = F.regexp_replace(_c(column), _BREAKS, "\n")
    return F.substr(F.regexp_replace(F.concat(F.lit("\n"), text), r"\n(?:[^\S\n]*>[^\n]*|\z)", ""), F.lit(2))


def squeeze(column: Column | str) -> Column:
    return F.trim(F.regexp_replace(_c(column), r"\s+", " "))


def clean_message(column: Column | str) -> Column:
    """The sender's own words: no replies, quotes, disclaimers, sign-off, addresses or links."""
    text = drop_quoted(cut_replies(F.coalesce(_c(column), F.lit(""))))
    text = F.regexp_replace(text, f"(?i)(?:{'|'.join(DISCLAIMERS)}){_TO_END}", "")
    text = F.regexp_replace(text, rf"(?i)\n\s*(?:{'|'.join(SIGNOFFS)})[,.]?\s*\n{_TO_END}", "")
    text = _replace_if(text, "@", _ADDRESS, " ")
    return squeeze(F.regexp_replace(text, r"http\S+", " "))


def compose(subject: Column | str, body: Column | str) -> Column:
    """``subject. cleaned body``."""
    return compose_cleaned(subject, clean_message(body))


def compose_cleaned(subject: Column | str, cleaned: Column | str) -> Column:
    head = _c(subject)
    return F.trim(F.concat(F.when(head.isNotNull(), F.concat(head, F.lit(". "))).otherwise(""), _c(cleaned)))


def _slots(text: Column) -> Column:
    """Numbers become ``<num>``, everything but letters and slots becomes blank."""
    text = F.regexp_replace(text, r"\p{Nd}[\p{Nd},./:\-]*", " <num> ")
    return squeeze(F.regexp_replace(text, r"[^a-z<>\s]", " "))


def subject_template(column: Column | str) -> Column:
    """Subject without reply prefixes, addresses and numbers."""
    text = F.lower(F.trim(F.coalesce(_c(column), F.lit(""))))
    text = F.regexp_replace(text, rf"^(?:\s*(?:{'|'.join(SUBJECT_PREFIXES)})\s*:\s*)+", "")
    return _slots(_replace_if(text, "@", _ADDRESS, " "))


def body_template(column: Column | str) -> Column:
    return template_of_cleaned(clean_message(column))


def template_of_cleaned(cleaned: Column | str) -> Column:
    return _slots(F.lower(_c(cleaned)))


def token_count(column: Column | str) -> Column:
    c = squeeze(column)
    return F.when(c == "", 0).otherwise(F.size(F.split(c, " ")))


def is_noise(column: Column | str) -> Column:
    """Automatic replies, bounces and the like."""
    return _c(column).rlike(rf"(?i)\b(?:{'|'.join(NOISE_PHRASES)})\b")


def trim_summary(column: Column | str, size: int, min_sentence: int = 40) -> Column:
    """At most ``size`` characters, ending at the last full sentence when it is long enough."""
    c = _c(column)
    head = F.substring(c, 1, size)
    # position (0-based) of the last ". " in the head
    last = F.length(head) - F.locate(" .", F.reverse(head)) - 1
    cut = F.when((F.locate(" .", F.reverse(head)) > 0) & (last > min_sentence), F.substring(head, F.lit(1), last + 1))
    return F.when(F.length(c) <= size, c).otherwise(F.trim(F.coalesce(cut, head)))
