"""E-mail bytes to the string nodes of the first html part."""

from __future__ import annotations

import email
from email import policy
from email.headerregistry import HeaderRegistry

from docpipe.functions.html import string_nodes

HEADERS_KEPT = 1000


class _ParsedHeaders(HeaderRegistry):
    """Parses a header once; a message asks for its content type again and again."""

    def __init__(self):
        super().__init__()
        self._parsed = {}

    def __call__(self, name, value):
        key = name, value
        if key not in self._parsed:
            if len(self._parsed) >= HEADERS_KEPT:
                self._parsed.clear()
            self._parsed[key] = super().__call__(name, value)
        return self._parsed[key]


MESSAGE_POLICY = policy.default.clone(header_factory=_ParsedHeaders())


def read_eml(content: bytes) -> list[str] | None:
    """String nodes, or None for a message without a multipart html body."""
    message = email.message_from_bytes(content, policy=MESSAGE_POLICY)
    if not message.is_multipart():
        return None
    html_parts = (part for part in message.walk() if part.get_content_type() == "text/html")
    first = next(html_parts, None)
    return None if first is None else string_nodes(first.get_content())
