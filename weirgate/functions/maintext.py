"""Main text of one HTML page: a small helper the extraction operator calls per page."""

from __future__ import annotations

import re
import time
from dataclasses import dataclass
from html.parser import HTMLParser

# Elements whose content is never main text.
SKIPPED = {"head", "script", "style", "noscript", "template", "svg", "nav", "header", "footer", "aside", "form", "button", "select", "iframe"}
# Elements that start a new block of text.
BLOCKS = {
    "address", "article", "blockquote", "body", "br", "dd", "div", "dl", "dt", "figcaption", "figure", "h1", "h2", "h3",
    "h4", "h5", "h6", "hr", "html", "li", "main", "ol", "p", "pre", "section", "table", "td", "th", "tr", "ul",
}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
FEED_CHARS = 1 << 16


@dataclass(frozen=True)
class ExtractConfig:
    min_block_chars: int = 25
    max_link_share: float = 0.5
    time_limit_s: float | None = None


class _Blocks(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.blocks: list[tuple[str, int, bool]] = []
        self.parts: list[str] = []
        self.link_chars = 0
        self.skipping: list[str] = []
        self.links = 0
        self.heading = False

    def flush(self) -> None:
        text = re.sub(r"\s+", " ", "".join(self.parts)).strip()
        if text:
            self.blocks.append((text, self.link_chars, self.heading))
        self.parts, self.link_chars = [], 0

    def handle_starttag(self, tag, attrs):
        if tag == "body":
            self.skipping.clear()  # a head may be left open
        if tag in SKIPPED:
            self.flush()
            self.skipping.append(tag)
        elif not self.skipping:
            if tag in BLOCKS:
                self.flush()
                self.heading = tag in HEADINGS
            elif tag == "a":
                self.links += 1

    def handle_startendtag(self, tag, attrs):
        if tag in BLOCKS and not self.skipping:
            self.flush()

    def handle_endtag(self, tag):
        if tag in self.skipping:
            # An element left open inside ends with the one that contains it.
            while self.skipping.pop() != tag:
                pass
        elif not self.skipping:
            if tag in BLOCKS:
                self.flush()
                self.heading = False
            elif tag == "a" and self.links:
                self.links -= 1

    def handle_data(self, data):
        if not self.skipping:
            self.parts.append(data)
            if self.links:
                self.link_chars += len(data.strip())


def main_text(html: str | None, config: ExtractConfig) -> tuple[str | None, bool]:
    """Text blocks joined by line breaks, null if none is left; and whether the time ran out.

    Short blocks that are not headings, and blocks that are mostly links, are dropped. There
    is no time limit unless one is set; it counts processor time.
    """
    if html is None:
        return None, False
    started = time.thread_time()
    parser = _Blocks()
    for i in range(0, len(html), FEED_CHARS):
        parser.feed(html[i : i + FEED_CHARS])
        if config.time_limit_s is not None and time.thread_time() - started > config.time_limit_s:
            return None, True
    parser.close()
    parser.flush()
    kept = [
        text
        for text, link_chars, heading in parser.blocks
        if (heading or len(text) >= config.min_block_chars) and link_chars <= config.max_link_share * len(text)
    ]
    return "\n".join(kept) or None, False
