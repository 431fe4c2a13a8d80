"""Text, e-mail and URL functions. Each takes and returns a Column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

REPLACEMENT = "�"

# The HTML entities that are decoded, in decoding order.
HTML_ENTITIES = [("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#x27;", "'")]

# Fixed value: the accepted shape of an e-mail address.
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+'-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"


def clean_trailing_path(path: Column) -> Column:
    """Drop trailing slashes, but keep the root path."""
    return F.when(path == "/", path).otherwise(F.regexp_replace(path, "/+$", ""))


def _occurrences(text: Column, piece: str) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(piece), F.lit("")))) / len(piece)


def uri_percent_decode(text: Column) -> Column:
    """Percent-decode as UTF-8; NULL for a broken escape or bytes that are not UTF-8.

    '+' is an ordinary character here, so it is escaped before the form decoder sees it. That decoder
    writes U+FFFD for invalid bytes: more of them than the input spelled out means invalid input.
    """
    decoded = F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))
    spelled = _occurrences(text, REPLACEMENT) + _occurrences(F.upper(text), "%EF%BF%BD")
    return F.when(
        ~decoded.contains(REPLACEMENT) | (_occurrences(decoded, REPLACEMENT) <= spelled), decoded
    )


def clean_utm_term(term: Column) -> Column:
    """Decoded, single-spaced, lower-case term; NULL for blanks and placeholders."""
    bare = F.lower(F.trim(term))
    fallback = F.translate(F.replace(term, F.lit("%20"), F.lit(" ")), "+", " ")
    out = F.coalesce(uri_percent_decode(term), fallback)
    for pattern, replacement in ((r"\s{2,}", " "), (r"[\r\n\t]", " "), (r"^\s+|\s+$", "")):
        out = F.regexp_replace(out, pattern, replacement)
    return F.when(~bare.isin("", "undefined", "null"), F.lower(out))


def email_cleaner(email: Column) -> Column:
    """Trimmed lower-case address; the text 'null' is NULL."""
    return F.nullif(F.trim(F.lower(email)), F.lit("null"))


def is_valid_email(email: Column) -> Column:
    return F.coalesce(email.rlike(EMAIL_PATTERN), F.lit(False))


def email_domain(email: Column) -> Column:
    """Text between the first and second '@'; '' when there is none, NULL for NULL."""
    return F.split_part(email, F.lit("@"), F.lit(2))


def website_domain(url: Column) -> Column:
    """Host with subdomains: no scheme, no leading www., no path, no query."""
    bare = F.regexp_replace(url, r"(?i)^[a-z0-9+.-]+://", "")
    bare = F.regexp_replace(bare, r"(?i)^www\.", "")
    return F.split_part(F.split_part(bare, F.lit("/"), F.lit(1)), F.lit("?"), F.lit(1))


def hash_string(text: Column) -> Column:
    return F.sha2(text, 512)


def html_clean(html: Column) -> Column:
    """Tags become spaces, five entities are decoded, runs of blanks collapse; '' is NULL."""
    out = F.regexp_replace(html, "<[^>]*>", " ")
    for entity, char in HTML_ENTITIES:
        out = F.replace(out, F.lit(entity), F.lit(char))
    return F.when(html != "", F.trim(F.regexp_replace(out, r"\s+", " ")))


def name_clean(name: Column) -> Column:
    """'unknown' for markup; else without a parenthesised part and double quotes."""
    bare = F.regexp_replace(name, r"\s*\(.*\)", "")
    return F.when(name.contains("<") | name.contains(">"), "unknown").otherwise(
        F.regexp_replace(bare, '["“”]', "")
    )


def snake_key(text: Column) -> Column:
    """Trimmed, lower case, with runs of blanks and dashes as one underscore."""
    return F.lower(F.regexp_replace(F.trim(text), r"[\s-]+", "_"))


def base_plan_type(plan: Column) -> Column:
    return F.split_part(plan, F.lit("_"), F.lit(1))


def text_tail(text: Column, n: int = 4000, empty: str = "(no log output)") -> Column:
    """Last n characters, or a placeholder for a missing or empty text."""
    return F.when(F.coalesce(F.length(text), F.lit(0)) == 0, empty).otherwise(F.right(text, F.lit(n)))


def text_head(text: Column, n: int = 3000) -> Column:
    return F.left(text, F.lit(n))


def clean_json_numbers(text: Column) -> Column:
    """JSON has no Infinity or NaN: both read as 0."""
    for word in (": Infinity", ": NaN"):
        text = F.replace(text, F.lit(word), F.lit(": 0"))
    return text
