"""Helpers that turn one response body into text, run inside Arrow stages."""

import re
from datetime import datetime
from html.parser import HTMLParser
from itertools import accumulate
from urllib.parse import unquote_plus

# Elements whose content is no text, and the fallback charset.
HIDDEN_ELEMENTS = ("script", "style", "noscript")
DEFAULT_CHARSET = "utf-8"

_PARAMETER = re.compile(r"(?:^|[;&])([^;&=]*)=([^;&]*)")


class _Log(HTMLParser):
    """What the tokenizer sees, as (change of depth within hidden elements, text)."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.seen = [(0, "")]
        self.handle_data = lambda text: self.seen.append((0, text))

    def updatepos(self, i, j):
        return j  # Nobody asks for lines and columns.

    def handle_starttag(self, tag, attrs):
        if tag in HIDDEN_ELEMENTS:
            self.seen.append((1, ""))

    def handle_endtag(self, tag):
        if tag in HIDDEN_ELEMENTS:
            self.seen.append((-1, ""))


def visible_text(markup: str) -> str:
    """Text outside hidden elements, its stripped pieces joined by one space."""
    log = _Log()
    log.feed(markup)
    log.close()
    changes, texts = zip(*log.seen)
    # An end without a start does not count against later starts.
    depths = accumulate(changes, lambda depth, change: max(depth + change, 0))
    pieces = (text.strip() for text, depth in zip(texts, depths) if depth == 0)
    return " ".join(piece for piece in pieces if piece)


def charset_name(content_type: str) -> str:
    """First charset parameter that is not blank; see ``columns.charset_of``."""
    parameters = (
        tuple(unquote_plus(part).strip() for part in found)
        for found in _PARAMETER.findall(content_type)
    )
    named = (value for name, value in parameters if name.lower() == "charset" and value)
    return next(named, DEFAULT_CHARSET)


def is_markup(content_type: str) -> bool:
    return re.search("html|xml", content_type, re.IGNORECASE) is not None


def decoded(body: bytes | str, charset: str) -> str:
    """Text of a body, bad bytes replaced; unknown charsets fail."""
    return body if isinstance(body, str) else body.decode(charset, errors="replace")


def body_text(body: bytes | str, content_type: str) -> str:
    """Decoded body; of markup only its visible text."""
    text = decoded(body, charset_name(content_type))
    return visible_text(text) if is_markup(content_type) else text


def utc_date(value: str) -> str:
    """ISO date as UTC with a ``Z``; other text is kept, no zone counts as UTC."""
    try:
        time = datetime.fromisoformat(value)
    except ValueError:
        return value
    shift = time.utcoffset()
    time = time.replace(tzinfo=None)
    return (time - shift if shift else time).isoformat() + "Z"
