"""Column expressions over text and markup. Everything here stays in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A token is a run of letters, marks, digits and underscores, or one other visible
# character. A word is a token of the first kind that has a letter or a digit.
TOKEN = r"[\p{L}\p{M}\p{N}_]+|[^\s\p{L}\p{M}\p{N}_]"
WORD = r"[\p{M}_]*[\p{L}\p{N}][\p{L}\p{M}\p{N}_]*"
LETTER_TOKEN = r"[\p{M}\p{N}_]*\p{L}[\p{L}\p{M}\p{N}_]*"


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def token_count(text: Column, pattern: str = TOKEN) -> Column:
    """Number of tokens; the tokenizer is the pattern."""
    return F.regexp_count(text, F.lit(pattern)).cast("long")


def lines(text: Column) -> Column:
    """Lines that are not blank."""
    return F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"\S"))


def paragraphs(text: Column) -> Column:
    """Stretches between empty lines that are not blank."""
    return F.filter(F.split(text, r"\n{2,}", -1), lambda x: x.rlike(r"\S"))


# --- markup --------------------------------------------------------------------------

# Tried at each position in this order, so that a script tag named inside a comment, or a
# style tag named inside a script, is left to the construct that contains it. A raw-text
# element that is never closed runs to the end of the page.
_CLEANUP = (
    r"(?is)(<!--.*?-->)"
    r"|<script\b[^>]*>.*?(?:</script\s*>|\z)"
    r"|<style\b[^>]*>.*?(?:</style\s*>|\z)"
    r"|</?link\b[^>]*>"
)
_SVG_TAG = r"(?is)</?svg\b[^>]*+>"


def strip_markup_noise(html: Column) -> Column:
    """Remove ``style``, ``script``, ``link`` and ``svg`` elements with their content.

    An ``svg`` may hold others, to any depth; one that is never closed runs to the end.
    """
    cleaned = F.regexp_replace(html, _CLEANUP, "$1")
    return F.when(cleaned.rlike(r"(?i)</?svg\b"), _outside_svg(cleaned)).otherwise(cleaned)


def _outside_svg(html: Column) -> Column:
    # The text before each tag and after the last one, kept where no element is open.
    tags = F.regexp_extract_all(html, F.lit(f"({_SVG_TAG})"), F.lit(0))
    pieces = F.arrays_zip(F.split(html, _SVG_TAG, -1).alias("text"), F.concat(tags, F.array(F.lit(""))).alias("tag"))
    step = lambda s, p: F.struct(
        F.when(p["tag"].startswith("</"), F.greatest(s["depth"] - 1, F.lit(0)))
        .when((p["tag"] == "") | p["tag"].endswith("/>"), s["depth"])
        .otherwise(s["depth"] + 1)
        .alias("depth"),
        F.when(s["depth"] == 0, F.concat(s["kept"], F.array(p["text"]))).otherwise(s["kept"]).alias("kept"),
    )
    start = F.struct(F.lit(0).alias("depth"), F.array().cast("array<string>").alias("kept"))
    return F.array_join(F.aggregate(pieces, start, step, lambda s: s["kept"]), "")


# Typographic quotation marks and the ASCII marks they become.
DOUBLE_QUOTES = "“”„‟«»″"
SINGLE_QUOTES = "‘’‚‛‹›′"


def straighten_quotes(text: Column) -> Column:
    return F.translate(text, DOUBLE_QUOTES + SINGLE_QUOTES, '"' * len(DOUBLE_QUOTES) + "'" * len(SINGLE_QUOTES))


# --- URLs ----------------------------------------------------------------------------

# Which whole words of a URL become which placeholder, in this order.
URL_PLACEHOLDERS = [
    (r"\b20\d{2}\b", "<year>"),
    (r"\b19\d{2}\b", "<year>"),
    (r"\b[1-9][0-9]{3,}\b", "<number>"),
    (r"\b[1-9][0-9]{2}\b", "<3number>"),
    (r"\b[1-9][0-9]\b", "<2number>"),
]


def percent_decode(url: Column) -> Column:
    """Percent-decoding that leaves ``+`` and malformed escapes as they are."""
    guarded = F.regexp_replace(F.regexp_replace(url, "%(?![0-9A-Fa-f]{2})", "%25"), r"\+", "%2B")
    return F.coalesce(F.try_url_decode(guarded), url)


def url_path_words(url: Column) -> Column:
    """A URL as classifier input: decoded, without scheme and host, numbers generalised."""
    return _generalise_numbers(_drop_host(percent_decode(url)))


def _drop_host(url: Column) -> Column:
    # No slash after the host keeps the whole URL: the position is then zero.
    slash = F.call_function("locate", F.lit("/"), url, F.call_function("locate", F.lit("://"), url) + F.lit(3))
    return F.substring(url, slash + F.lit(1), F.length(url))


def _generalise_numbers(path: Column) -> Column:
    for pattern, placeholder in URL_PLACEHOLDERS:
        path = F.regexp_replace(path, "(?U)" + pattern, placeholder)
    return path


def url_host(url: Column) -> Column:
    """Lower-case host of an http(s) URL, without user info and port."""
    return F.lower(F.regexp_extract(url, r"^(?i:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))


def host_key(url: Column) -> Column:
    """``host/path`` in lower case: no scheme, ``www.``/``m.``, query, fragment or final slash."""
    bare = F.regexp_replace(F.lower(url), r"^[a-z][a-z0-9+.-]*://", "")
    bare = F.regexp_replace(bare, r"^(www|m)\.", "")
    return F.regexp_replace(F.regexp_replace(bare, r"[?#].*$", ""), "/$", "")


def surt_key(url: Column) -> Column:
    """The sort-friendly key of public crawl indexes: ``com,example)/path?query``.

    Host labels reversed and comma-separated, no ``www.`` prefix, fragment dropped.
    """
    rest = F.regexp_replace(F.regexp_replace(F.lower(url), r"^([a-z][a-z0-9+.-]*:)?//", ""), r"#.*$", "")
    host = F.regexp_replace(F.regexp_extract(rest, r"^([^/?:]*)", 1), r"^www\d*\.", "")
    tail = F.regexp_replace(rest, r"^[^/?]*", "")
    tail = F.when(tail.startswith("/"), tail).otherwise(F.concat(F.lit("/"), tail))
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), tail)


def url_contains(url: Column, fragment: str) -> Column:
    """Case-insensitive substring test."""
    return F.lower(url).contains(fragment.lower())
