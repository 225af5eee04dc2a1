"""Text composition, tokens and n-grams as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The patterns that define a token. Java's \s, \S and \w are ASCII, so the
# Unicode classes are spelled out.
SPACE_CLASS = r"\s\x0B\x1c-\x1f\x85\p{Z}"
URL_PATTERN = rf"https?://[^{SPACE_CLASS}]+|www\.[^{SPACE_CLASS}]+"
USER_PATTERN = r"@[\p{L}\p{N}_]+"
TOKEN_PATTERN = r"[a-z0-9_#@']+"
URL_TOKEN = " urltoken "
USER_TOKEN = " usertoken "
KEYWORD_PATTERN = r"(?id)\bkeyword:\s*(.*)$"
KEYWORD_PREFIX = "  keyword: "


def strip_spaces(text: Column) -> Column:
    """Trim every kind of white space, where trim() only takes off blanks."""
    return F.regexp_replace(text, rf"^[{SPACE_CLASS}]+|[{SPACE_CLASS}]+$", "")


def clean_keyword(keyword: Column) -> Column:
    return strip_spaces(F.replace(F.coalesce(keyword, F.lit("")), F.lit("%20"), F.lit(" ")))


def compose_text(text: Column, keyword: Column | None = None) -> Column:
    """Model input: the text, and the keyword behind it when the table has that column."""
    body = F.coalesce(text, F.lit(""))
    if keyword is None:
        return body
    return F.concat(body, F.lit(KEYWORD_PREFIX), clean_keyword(keyword))


def tokens(text: Column) -> Column:
    marked = F.regexp_replace(F.lower(text), URL_PATTERN, URL_TOKEN)
    marked = F.regexp_replace(marked, USER_PATTERN, USER_TOKEN)
    return F.regexp_extract_all(marked, F.lit(TOKEN_PATTERN), F.lit(0))


def token_words(text: Column) -> Column:
    """The tokens as one string, a blank between any two."""
    return F.array_join(tokens(text), " ")


def raw_token_count(text: Column) -> Column:
    """Number of tokens before links and user names are replaced."""
    return F.regexp_count(F.lower(text), F.lit(TOKEN_PATTERN))


def ngrams(words: Column, n: int) -> Column:
    """Contiguous n-grams, built by pairing each shorter n-gram with the word behind it.

    zip_with keeps the lambda free of outer columns: a lambda that indexes into ``words``
    would evaluate the token expression once per element if Catalyst inlines it.
    """
    grams = words
    for width in range(2, n + 1):
        room = F.greatest(F.size(words) - (width - 1), F.lit(0))
        grams = F.zip_with(
            F.slice(grams, F.lit(1), room),
            F.slice(words, F.lit(width), room),
            lambda head, tail: F.concat_ws(" ", head, tail),
        )
    return grams


def terms(words: Column, ngram_range: tuple[int, int] = (1, 2)) -> Column:
    """All n-grams of the range, shorter ones first, repeats kept."""
    low, high = max(1, ngram_range[0]), ngram_range[1]
    parts = [ngrams(words, n) for n in range(low, high + 1)]
    if not parts:
        return F.array().cast("array<string>")
    return F.concat(*parts) if len(parts) > 1 else parts[0]


def extract_keyword(text: Column) -> Column:
    return F.lower(strip_spaces(F.regexp_extract(text, KEYWORD_PATTERN, 1)))


def contains_any(lowered: Column, phrases: Sequence[str]) -> Column:
    """Substring match, also inside words, against text that is in lower case already."""
    found = F.lit(False)
    for phrase in phrases:
        found = found | F.contains(lowered, F.lit(phrase))
    return found
