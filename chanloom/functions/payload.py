"""Predicates over captured HTTP responses (content type + body bytes)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import DENY_MARKERS
from .text import utf8_ignore


def body_text(body: Column, head_bytes: int | None = None) -> Column:
    """The body decoded as UTF-8, bad bytes dropped; with ``head_bytes`` only
    that many first bytes (what a client with such a read limit sees)."""
    whole = F.coalesce(body, F.lit(b""))
    return utf8_ignore(whole if head_bytes is None else F.substring(whole, 1, head_bytes))


def any_contains(text: Column, needles: Sequence[str], at_end: bool = False) -> Column:
    """Any of the needles occurs in the text (with ``at_end``: ends it).  One
    expression, so that long lists do not outgrow a generated method."""
    if not needles:
        return F.lit(False)
    quoted = "|".join("\\Q" + n.replace("\\E", "\\E\\\\E\\Q") + "\\E" for n in needles)
    return text.rlike(f"(?:{quoted})\\z" if at_end else quoted)


def denied_payload(content_type: Column, body: Column,
                   markers: Sequence[str] = DENY_MARKERS, head_bytes: int | None = None) -> Column:
    """A block page: a deny marker in the lower-cased body, and HTML either by
    content type or by an ``<html`` tag in the body."""
    ctype = F.lower(F.coalesce(content_type, F.lit("")))
    head = F.lower(body_text(body, head_bytes))
    marked = any_contains(head, markers)
    return marked & (ctype.contains("text/html") | head.contains("<html"))


def is_playlist(content_type: Column, body: Column, head_bytes: int | None = None) -> Column:
    ctype = F.lower(F.coalesce(content_type, F.lit("")))
    return ctype.contains("mpegurl") | body_text(body, head_bytes).contains("#EXTM3U")


# Line boundaries of ``str.splitlines`` and the whitespace that can occur
# inside a line (Python whitespace minus those boundaries).
_LB = "\\n\\r\\x0B\\f\\x1C-\\x1E\\x85\\u2028\\u2029"
_WSL = "\\t\\x1F \\xA0\\u1680\\u2000-\\u200A\\u202F\\u205F\\u3000"
# First line whose stripped text is non-empty and does not start with '#'.
_MEDIA_RE = (f"(?:\\A|\\r\\n|[{_LB}])[{_WSL}]*([^#{_WSL}{_LB}][^{_LB}]*?)[{_WSL}]*"
             f"(?=\\r\\n|[{_LB}]|\\z)")


def first_media_uri(text: Column) -> Column:
    """First non-blank line that is not a ``#`` comment ('' if none).

    One regular expression (no split into an array): a line starts at the
    beginning or after a line boundary; its stripped text is captured."""
    return F.regexp_extract(F.coalesce(text, F.lit("")), _MEDIA_RE, 1)
