"""Word (OOXML) bytes to paragraph texts."""

from __future__ import annotations

import io
import zipfile
from xml.etree import ElementTree

# The document part and the two element names that carry text.
DOCUMENT_PART = "word/document.xml"
PARAGRAPH = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}p"
TEXT = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}t"


def read_docx(content: bytes) -> list[str] | None:
    """Paragraphs in document order, their text runs joined by a blank.

    None for a zip without a document part. A paragraph inside another one counts
    for both. Paragraphs without text are left out.
    """
    if not content:
        raise ValueError("is empty")
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        if DOCUMENT_PART not in archive.namelist():
            return None
        root = ElementTree.fromstring(archive.read(DOCUMENT_PART))
    joined = (" ".join(t.text for t in p.iter(TEXT) if t.text) for p in root.iter(PARAGRAPH))
    return [text for text in joined if text]
