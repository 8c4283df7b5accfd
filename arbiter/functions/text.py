"""String predicates and projections as Column expressions (JVM-side, codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from arbiter import defaults as D


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def word_count(text) -> Column:
    """Whitespace token count, as Python's ``len(s.split())``."""
    return F.regexp_count(col(text), F.lit(D.WORD_TOKEN)).cast("bigint")


def approx_tokens(words) -> Column:
    """Token estimate ``int(words * 1.3)``."""
    return F.floor(col(words) * F.lit(D.TOKENS_PER_WORD)).cast("bigint")


def contains_ci(lowered_text, needle) -> Column:
    """Case-insensitive substring test against an already lowered text."""
    return F.contains(col(lowered_text), F.lower(col(needle)))


def present(items, lowered_text) -> Column:
    """Elements of an array<string> that occur (case-insensitively) in the text."""
    lt = col(lowered_text)
    return F.filter(col(items), lambda t: F.contains(lt, F.lower(t)))


def absent(items, lowered_text) -> Column:
    lt = col(lowered_text)
    return F.filter(col(items), lambda t: ~F.contains(lt, F.lower(t)))


def text_clean(text) -> Column:
    """lower -> non [a-zA-Z0-9 whitespace] to space -> collapse whitespace -> strip."""
    lowered = F.lower(col(text))
    spaced = F.regexp_replace(lowered, r"[^a-zA-Z0-9\s\x1c-\x1f\x85\p{Z}]", " ")
    collapsed = F.regexp_replace(spaced, D.WORD_SEPARATORS, " ")
    return strip(collapsed)


def strip(text) -> Column:
    """Python ``str.strip()``: trims Unicode whitespace, not only spaces."""
    return F.regexp_replace(col(text), r"^[\s\x1c-\x1f\x85\p{Z}]+|[\s\x1c-\x1f\x85\p{Z}]+$", "")


def snippet(text, n: int = D.SNIPPET_CHARS) -> Column:
    """``s[:n]``."""
    return F.substring(col(text), 1, n)


def preview(text, n: int = D.REPLY_PREVIEW_CHARS) -> Column:
    """``s[:n].replace('\\n', ' ')``."""
    return F.regexp_replace(F.substring(col(text), 1, n), "\n", " ")


def or_default(c, default) -> Column:
    """``x or default`` for strings: NULL or empty falls back."""
    return F.coalesce(F.nullif(col(c), F.lit("")), F.lit(default))


def signed_fixed(x, decimals: int = 4) -> Column:
    """``f"{x:+.4f}"``."""
    return F.format_string(f"%+.{decimals}f", col(x))
