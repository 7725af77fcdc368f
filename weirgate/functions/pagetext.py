"""Main text of pages as one column expression: nothing leaves the JVM.

Markup whose content is no text goes first. A state machine over the tags that open and close
surroundings keeps what lies outside all of them. The rest is cut into blocks at block tags; a
block is described by its length, the length of its link texts and whether it is a heading.
"""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# Elements whose content is never text, and comments; each may end with the page.
NO_TEXT = ("script", "style", "template", "noscript", "svg", "iframe", "textarea")
DROPPED = r"(?is)<!--.*?(?:-->|\z)|" + "|".join(rf"<{t}\b[^>]*>.*?(?:</{t}\s*>|\z)" for t in NO_TEXT)
# Elements around the text; they may hold each other. A body begins anew: a head may be left open.
AROUND = r"(?i)</?(?:head|nav|header|footer|aside|form|button|select|body)\b[^>]*>"
BLOCK = (
    r"(?i)</?(?:address|article|blockquote|body|br|dd|div|dl|dt|figcaption|figure|hr|html|li|main|ol|p|pre|section"
    r"|table|td|th|tr|ul|head|nav|header|footer|aside|form|button|select|h[1-6])\b[^>]*>"
)
HEADING, LINK, LINK_END, TAG = r"(?i)<h[1-6]\b[^>]*>", r"(?i)<a\b[^>]*>", r"(?i)</a\s*>", r"<[^>]*>"
SPACE = r"[ \t\n\x0B\f\r]+"
# White space of decoded text: also no-break and other spaces of Unicode.
WIDE_SPACE = r"[ \t\n\x0B\f\r\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
ENTITY = r"&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);"

# Marks inside a block: a link begins, it ends, a heading.
OPEN, CLOSE, HEAD = "\x01", "\x02", "\x03"


def entity_names() -> dict[str, str]:
    """What each named character reference stands for, by its name without the semicolon."""
    return {name[:-1]: text for name, text in sorted(html5.items()) if name.endswith(";")}


def _decoded(reference: Column) -> Column:
    """The text of one character reference; as it is, if it names nothing."""
    body = F.substring(reference, F.lit(2), F.length(reference) - 2)
    number = F.when(body.rlike("^#[xX]"), F.conv(F.substring(body, F.lit(3), F.length(body)), 16, 10)).when(
        body.startswith("#"), F.substring(body, F.lit(2), F.length(body))
    ).cast("long")
    valid = (number > 0) & (number < 0x110000) & ~number.between(0xD800, 0xDFFF)
    names = entity_names()
    known = F.map_from_arrays(F.split(F.lit("\x01".join(names)), "\x01"), F.split(F.lit("\x01".join(names.values())), "\x01"))
    char = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
    return F.coalesce(F.when(valid, char), F.when(number.isNull(), F.element_at(known, body)), reference)


def decoded(text: Column) -> Column:
    """``text`` with its character references replaced."""
    found = F.regexp_extract_all(text, F.lit(f"({ENTITY})"), F.lit(0))
    pieces = F.arrays_zip(F.split(text, ENTITY, -1).alias("gap"), F.concat(F.transform(found, _decoded), F.array(F.lit(""))).alias("new"))
    return F.when(text.contains("&"), F.array_join(F.transform(pieces, lambda p: F.concat(p["gap"], p["new"])), "")).otherwise(text)


def outside(html: Column) -> Column:
    """What lies outside all surrounding elements, with a line break in place of each."""
    tags = F.lower(F.array_join(F.regexp_extract_all(html, F.lit(f"({AROUND})"), F.lit(0)), "\x01"))
    tags = F.when(tags == "", F.array().cast("array<string>")).otherwise(F.split(tags, "\x01"))
    pieces = F.arrays_zip(F.split(html, AROUND, -1).alias("text"), F.concat(tags, F.array(F.lit(""))).alias("tag"))
    step = lambda s, p: F.struct(
        F.when((p["tag"] == "") | p["tag"].endswith("/>"), s["depth"])
        .when(p["tag"].rlike("^</?body"), F.lit(0))
        .when(p["tag"].startswith("</"), F.greatest(s["depth"] - 1, F.lit(0)))
        .otherwise(s["depth"] + 1)
        .alias("depth"),
        F.when(s["depth"] == 0, F.concat(s["kept"], F.array(p["text"]))).otherwise(s["kept"]).alias("kept"),
    )
    start = F.struct(F.lit(0).alias("depth"), F.array().cast("array<string>").alias("kept"))
    return F.array_join(F.aggregate(pieces, start, step, lambda s: s["kept"]), "<br>")


def marked_blocks(html: Column) -> Column:
    """The raw blocks of a page, with marks in place of link and heading tags."""
    plain = F.regexp_replace(F.translate(html, OPEN + CLOSE + HEAD, "   "), DROPPED, "")
    body = F.regexp_replace(outside(plain), SPACE, " ")
    for pattern, mark in ((HEADING, "\n" + HEAD), (BLOCK, "\n"), (LINK, OPEN), (LINK_END, CLOSE), (TAG, "")):
        body = F.regexp_replace(body, pattern, mark)
    return F.split(body, "\n")


def _folded(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, WIDE_SPACE, " "))


def main_text(html: Column, min_block_chars: int, max_link_share: float) -> Column:
    """Blocks joined by line breaks; null where none is left.

    A block that is no heading needs ``min_block_chars`` characters, and no block may have more
    than ``max_link_share`` of its characters in links.
    """
    described = F.transform(
        F.filter(marked_blocks(html), lambda b: b.rlike(r"[^ \x01\x02\x03]")),
        lambda b: F.struct(
            _folded(decoded(F.regexp_replace(b, r"[\x01\x02\x03]", ""))).alias("text"),
            F.length(F.array_join(F.transform(F.regexp_extract_all(b, F.lit(r"\x01([^\x02]*)"), F.lit(1)), lambda a: _folded(decoded(a))), "")).alias("linked"),
            b.startswith(HEAD).alias("heading"),
        ),
    )
    kept = F.filter(
        described, lambda b: (b["text"] != "") & (b["heading"] | (F.length(b["text"]) >= min_block_chars)) & (b["linked"] <= max_link_share * F.length(b["text"]))
    )
    return F.nullif(F.array_join(F.transform(kept, lambda b: b["text"]), "\n"), F.lit(""))
